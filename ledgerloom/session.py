"""Session factory and the places where lineage may be cut."""

from __future__ import annotations

import atexit
import io
import pathlib
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: ANSI, UTC, adaptive execution with skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


_OWN: list[str] = []
#: Tables staged by this process and not yet deleted.
_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests, a laptop) a local folder takes its place, for as long as the process
    lives; on a cluster each machine would have a folder of its own, so its absence is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="ledgerloom-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        folder = f"file://{_OWN[0]}"
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written as a columnar table in the shared folder and read back.

    Smaller than a checkpoint when few columns repeat, and the reader can prune columns and push filters.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if not _STAGED:
        atexit.register(release, spark)
    _STAGED.append(path)
    let_go(spark)
    return spark.read.parquet(path)


def let_go(spark: SparkSession) -> None:
    """Has the driver drop what finished plans left once its heap has grown past half of what it may have.

    Plans and broadcasts of finished steps are garbage, but the heap grows to its limit before it is collected, and does not shrink by itself.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > heap.maxMemory() // 2:
        spark._jvm.System.gc()


def staged_by(df: DataFrame, column: str, name: str) -> dict:
    """``df`` written as one folder for each value of ``column`` (which is left out): value as text -> folder.

    Rows are rebalanced by value: small ones share a task, and one that holds a third of all rows is cut by size into several.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)
    if not _STAGED:
        atexit.register(release, spark)
    _STAGED.append(path)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    folders = [f.getPath().getName() for f in listed if f.isDirectory()]
    return {f.split("=", 1)[1]: f"{path}/{f}" for f in folders if f.startswith(f"{column}=")}


def release(spark: SparkSession) -> None:
    """Deletes the tables staged so far: to be called once the results that read them are written. Also done as the process ends."""
    context = spark.sparkContext
    while _STAGED:
        path = _STAGED.pop()
        try:
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session is gone; what is left expires with the folder
            _STAGED.clear()


def ship(spark: SparkSession) -> None:
    """The package made known to the executors' Python workers, once a session: a zip in the shared folder."""
    context = spark.sparkContext
    if getattr(context, "_ledgerloom_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent).as_posix())
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/ledgerloom-{uuid.uuid4().hex}.zip")
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(path.toString())
    context._ledgerloom_shipped = True
