"""The queries of the subpackage on the smallest tables."""

import pytest

from ledgerloom.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "p3_found": {"slip_id": "bigint", "member_id": "string"},
    "p4_found": {"seq": "bigint", "ministry_id": "string"},
    "p5_found": {"form_a": "string", "form_b": "string"},
    "p6_ids": {"doc_id": "bigint", "ids": "array<int>"},
    "p8_found": {"doc_id": "bigint", "kind": "string", "found": "string"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    rows = df.collect()
    if name in COLUMNS:
        assert dict(df.dtypes) == COLUMNS[name]
    if name.endswith("_found"):
        assert rows and len({tuple(r) for r in rows}) == len(rows)
    if name in ORACLES:
        assert not rows
