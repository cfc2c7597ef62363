"""Published files and snapshots.

Writers go through Spark's own writers; a single file is never needed. Rows are gathered by partition key before a partitioned
write, so a key has one file unless it is very large, and sorted within for repeatable output.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import partition_key
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import staged

# Options under which the CSV files read back as they were written.
CSV = {"header": "true", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": ""}
#: Rows a partition file holds about; a key with more has several files, written by several tasks.
FILE_ROWS = 1_000_000
#: Keys of the manifest a caller cannot override.
PROTECTED = ("licence", "attribution")


class PublishError(ValueError):
    """A set that must not be published as it is."""


def _sorted_struct(c: Column, kind: T.StructType) -> Column:
    return F.struct(*[c.getField(f.name).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])


def as_text(c: Column, kind: T.DataType) -> Column:
    """A value as CSV text: null as '', booleans as true/false, lists joined by | (an element holding one raises), nested as JSON."""
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        texts = F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("")))
        bad = F.exists(texts, lambda x: x.contains("|"))
        return F.when(c.isNull(), "").when(bad, F.raise_error(F.lit("a list element holds the separator |"))).otherwise(F.array_join(texts, "|"))
    if isinstance(kind, T.StructType):
        return F.coalesce(F.to_json(_sorted_struct(c, kind)), F.lit(""))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.to_json(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def text_projection(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The published columns in order, each as text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[as_text(F.col(f"`{n}`"), kinds[n]).alias(n) for n in columns or df.columns])


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header and text projection."""
    text_projection(df).write.mode("overwrite").options(**CSV).csv(path)


def write_both(df: DataFrame, path: str) -> int:
    """The same rows in both formats, computed once; the number of rows is that of the write, not of another pass."""
    observed = Observation()
    kept = staged(df.observe(observed, F.count(F.lit(1)).alias("records")), "publish-rows")
    write_ndjson(kept, f"{path}/ndjson")
    write_csv(kept, f"{path}/csv")
    return observed.get["records"]


def key_collisions(df: DataFrame, column: str) -> DataFrame:
    """Partition keys that several values share: part_key, ids."""
    return df.groupBy(partition_key(F.col(column).cast("string")).alias("part_key")).agg(F.countDistinct(column).alias("ids")).where("ids > 1")


def _by_key(df: DataFrame, axis: str) -> DataFrame:
    """``df`` with ``part_key``; an array axis repeats its rows for each element."""
    if isinstance(df.schema[axis].dataType, T.ArrayType):
        return df.withColumn("part_key", F.explode(axis)).withColumn("part_key", partition_key(F.col("part_key")))
    return df.withColumn("part_key", partition_key(F.col(axis)))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_partitions(df: DataFrame, axis: str, path: str, order: str = "question_id", buckets: int | None = None) -> int:
    """Both formats by the axis column, a folder a key, rows in ``order``; gives the rows written. Colliding keys are refused.

    An axis of very many keys takes ``buckets``: so many folders of whole keys, each sorted by key, with ``part_key`` as a column (see
    ``read_partition``). One aggregate over the axis alone tells the keys that collide and those so large that they are split over
    several files and tasks.
    """
    element = F.explode(axis) if isinstance(df.schema[axis].dataType, T.ArrayType) else F.col(axis)
    keys = df.select(element.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    keys = staged(keys.groupBy(partition_key(F.col("id")).alias("part_key")).agg(F.count("id").alias("ids"), F.sum("n").alias("n")), "publish-keys")
    if not keys.where("ids > 1").isEmpty():
        raise PublishError(f"two values of {axis} have one partition key")
    keyed, folder = _by_key(df, axis), "part_key"
    # Keys above the bound are at most rows / FILE_ROWS many; lookup_join measures them before it sends them anywhere.
    large = keys.where(F.col("n") > FILE_ROWS).select("part_key", F.ceil(F.col("n") / FILE_ROWS).alias("__pieces"))
    if large.isEmpty():
        keyed = keyed.withColumn("__piece", F.lit(0))
    else:
        keyed = lookup_join(keyed, large, ["part_key"]).withColumn("__piece", F.pmod(F.xxhash64(order), F.coalesce("__pieces", F.lit(1)))).drop("__pieces")
    if buckets:
        keyed, folder = keyed.withColumn("bucket", _bucket(F.col("part_key"), buckets)), "bucket"
    # A number of tasks of its own: adaptive execution would give thousands of small files to one task.
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = keyed.repartition(tasks, folder, "__piece").drop("__piece").sortWithinPartitions(*dict.fromkeys([folder, "part_key", order]))
    observed = Observation()
    spread.observe(observed, F.count(F.lit(1)).alias("records")).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy(folder).json(f"{path}/ndjson")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [as_text(F.col(f"`{n}`"), k).alias(n) for n, k in kinds.items()]
    spread.select(*texts, *dict.fromkeys(["part_key", folder])).write.mode("overwrite").options(**CSV).partitionBy(folder).csv(f"{path}/csv")
    return observed.get["records"]


def read_partition(spark: SparkSession, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """The rows of one key of an axis; only its folder is read."""
    rows = spark.read.option("pathGlobFilter", "*.json").json(f"{path}/ndjson")
    if buckets:
        own = spark.range(1).select(_bucket(F.lit(key), buckets).alias("b")).first().b
        rows = rows.where(F.col("bucket") == own)
    return rows.where(F.col("part_key") == key)


def partition_counts(df: DataFrame, axis: str) -> DataFrame:
    """part_key, records of a partitioned set."""
    rows = df.select(F.explode(axis).alias("__axis")) if isinstance(df.schema[axis].dataType, T.ArrayType) else df.select(F.col(axis).alias("__axis"))
    return rows.groupBy(partition_key(F.col("__axis")).alias("part_key")).agg(F.count(F.lit(1)).alias("records"))


def manifest(records: dict[str, int], last_refreshed: str, **more) -> dict:
    """Record counts by set, as the writers counted them, with what the caller adds; protected keys are refused."""
    if bad := [k for k in more if k in PROTECTED]:
        raise PublishError(f"protected: {', '.join(bad)}")
    return {"last_refreshed": last_refreshed, "sets": {n: {"records": d} for n, d in sorted(records.items())}, "licence": "see LICENCE", "attribution": "see ATTRIBUTION", **more}


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop.Path(path))


def inspect_previous(spark: SparkSession, path: str, required: list[str], questions: tuple[str, ...] = ()) -> list[str]:
    """What a snapshot lacks of the required sets, a readable manifest and, in the sets of ``questions``, any file; none if it is whole."""
    missing = [s for s in required if not exists(spark, f"{path}/{s}")]
    if not exists(spark, f"{path}/manifest.json"):
        missing.append("manifest.json")
    else:
        try:
            read_manifest(spark, path)
        except ValueError:
            missing.append("manifest.json (unreadable)")
    if questions and not missing:
        fs, hadoop = _fs(spark, path)
        found = [hadoop.Path(f"{path}/{s}") for s in questions]
        if not any(fs.getContentSummary(p).getFileCount() > 0 and fs.getContentSummary(p).getLength() > 0 for p in found if fs.exists(p)):
            missing.append("any question file")
    return missing


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a snapshot; one that is no JSON object raises ValueError."""
    fs, hadoop = _fs(spark, path)
    stream = fs.open(hadoop.Path(f"{path}/manifest.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    content = json.loads(text)
    if not isinstance(content, dict):
        raise ValueError("no manifest")
    return content


def write_manifest(spark: SparkSession, content: dict, path: str) -> None:
    """The manifest as one small JSON file."""
    fs, hadoop = _fs(spark, path)
    stream = fs.create(hadoop.Path(f"{path}/manifest.json"), True)
    stream.write(bytearray(json.dumps(content, sort_keys=True, ensure_ascii=False).encode("utf-8")))
    stream.close()


def retain_previous(coverage: DataFrame, reason: str, attempted: str) -> DataFrame:
    """The coverage rows of the last good snapshot, stamped as such."""
    return coverage.withColumns({"freshness": F.lit("last-known-good"), "retained_reason": F.lit(reason), "attempted": F.lit(attempted)})


def _replace(fs, hadoop, new: str, here: str) -> bool:
    """``new`` in the place of ``here``, which is set aside and deleted only once ``new`` stands there; put back where that fails."""
    target, aside = hadoop.Path(here), hadoop.Path(f"{here}.old")
    if fs.exists(target):
        fs.delete(aside, True)
        if not fs.rename(target, aside):
            return False
    try:
        done = bool(fs.rename(hadoop.Path(new), target))
    except Exception:  # noqa: BLE001 - whatever stopped the rename, the old one must come back
        done = False
    if done:
        fs.delete(aside, True)
    elif fs.exists(aside) and not fs.exists(target):
        fs.rename(aside, target)
    return done


def promote(spark: SparkSession, built: str, current: str, required: list[str], questions: tuple[str, ...] = ()) -> bool:
    """The built snapshot takes the current one's place if it is whole; else all stays as it is.

    A snapshot that a run which died left aside, with none in its place, is put back first.
    """
    fs, hadoop = _fs(spark, current)
    here, aside = hadoop.Path(current), hadoop.Path(f"{current}.old")
    if fs.exists(aside) and not fs.exists(here):
        fs.rename(aside, here)
    return not inspect_previous(spark, built, required, questions) and _replace(fs, hadoop, built, current)


def retain(spark: SparkSession, previous: str, current: str, required: list[str], reason: str, attempted: str, questions: tuple[str, ...] = ()) -> list[str]:
    """The previous snapshot kept as the current one after a failed build, its coverage stamped; what it lacks if it is not whole.

    The date it was refreshed stays as it was. A copy is made beside the current one and takes its place whole; so does the stamped coverage.
    """
    missing = inspect_previous(spark, previous, required, questions)
    if missing:
        return missing
    fs, hadoop = _fs(spark, current)
    if previous != current:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        source, copy = hadoop.Path(previous), f"{current}.retained"
        fs.delete(hadoop.Path(copy), True)
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, hadoop.Path(copy), False, conf)
        if not _replace(fs, hadoop, copy, current):
            return ["a place for the copy"]
    write_both(retain_previous(spark.read.json(f"{current}/coverage/ndjson"), reason, attempted), f"{current}/coverage.stamped")
    return [] if _replace(fs, hadoop, f"{current}/coverage.stamped", f"{current}/coverage") else ["a place for the stamped coverage"]


def remove(spark: SparkSession, path: str) -> bool:
    """A folder that is no longer needed (a checkpoint after its success, a build that failed); false where there was none."""
    fs, hadoop = _fs(spark, path)
    return bool(fs.delete(hadoop.Path(path), True))
