"""One Spark session for all tests."""

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import build_session, ship

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{shared}", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(shared / "warehouse")}
    )
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
