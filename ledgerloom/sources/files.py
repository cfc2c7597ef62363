"""Readers: landed envelopes, NDJSON, CSV, checkpoints, assertions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.dimensions import rename_conflicts
from ledgerloom.operators.ingest import incomplete, unwrap
from ledgerloom.operators.publish import CSV, exists, remove


class IngestionFailed(RuntimeError):
    """What was fetched is not what the source says it has."""


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType | str, records: str, total: str | None = None) -> DataFrame:
    """The records of JSON envelope files (whole files, objects or length-1 arrays); a short or long read raises."""
    rows = unwrap(spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path), records, total)
    odd = incomplete(rows).first() if total else None
    if odd:
        raise IngestionFailed(f"{odd.received} records, {odd.claimed} claimed")
    return rows.drop("claimed_total")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed NDJSON; blank lines are skipped, a line that does not fit raises. Adds ``source_file``."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.withColumn("source_file", F.col("_metadata.file_name"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header, all columns text."""
    return spark.read.options(**CSV).option("inferSchema", "false").csv(path)


def checkpoint_lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of a checkpoint, counted: lines."""
    return spark.read.text(path).where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("lines"))


def checkpoint_is_complete(spark: SparkSession, path: str, sidecar: str) -> bool:
    """True if the sidecar is there and claims as many records as the checkpoint has lines."""
    if not (exists(spark, path) and exists(spark, sidecar)):
        return False
    claimed = spark.read.option("multiLine", "true").json(sidecar).select(F.col("records").cast("bigint")).first()
    return bool(claimed) and claimed[0] == checkpoint_lines(spark, path).first().lines


class MissingFile(FileNotFoundError):
    """A published file that is not there."""


def published_path(base: str, relative: str) -> str:
    """The path of a published file below ``base``; only plain relative paths are taken, so that none leads elsewhere."""
    parts = relative.split("/")
    if not relative or relative.startswith("/") or "\\" in relative or ":" in relative or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"no path below the published folder: {relative}")
    return f"{base.rstrip('/')}/{relative}"


def read_published(spark: SparkSession, base: str, relative: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of one published NDJSON set; blank lines are skipped, a set that is not there raises ``MissingFile``."""
    path = published_path(base, relative)
    if not exists(spark, path):
        raise MissingFile(relative)
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def finish_checkpoint(spark: SparkSession, rows: DataFrame, path: str, claimed: int | None) -> int:
    """Rows written as NDJSON lines, then, only if they are as many as claimed, the sidecar that says so; an old sidecar goes first."""
    remove(spark, f"{path}.complete")
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    lines = checkpoint_lines(spark, path).first().lines
    if claimed is not None and lines != claimed:
        raise IngestionFailed(f"{lines} records, {claimed} claimed")
    spark.range(1).select(F.lit(lines).alias("records")).coalesce(1).write.mode("overwrite").json(f"{path}.complete")
    return lines


def read_renames(spark: SparkSession, path: str) -> DataFrame:
    """dimension_id, canonical_name, former_names of a rename file; a name claimed for two ids raises."""
    entry = "struct<ministry_id:string,canonical_name:string,former_names:array<string>>"
    rows = spark.read.schema(f"renames array<{entry}>").option("multiLine", "true").option("mode", "FAILFAST").json(path)
    listed = rows.select(F.inline("renames")).withColumnRenamed("ministry_id", "dimension_id")
    bad = rename_conflicts(listed).first()
    if bad:
        raise IngestionFailed(f"{bad.minted_id} is claimed {bad.ids} times")
    return listed


def read_assertions(spark: SparkSession, folder: str) -> DataFrame:
    """Form, member_id, basis of all assertion files; a form asserted for two members raises."""
    entry = "struct<name_as_written:string,member_id:string,basis:string>"
    rows = spark.read.schema(f"house string, confirmed_on string, assertions array<{entry}>").option("multiLine", "true").json(folder)
    said = rows.select("house", "confirmed_on", F.inline("assertions")).withColumnRenamed("name_as_written", "form")
    bad = said.groupBy("form").agg(F.countDistinct("member_id").alias("n")).where("n > 1").first()
    if bad:
        raise IngestionFailed(f"conflicting assertions for {bad.form}")
    return said.distinct()
