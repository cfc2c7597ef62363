"""Incremental ingest: landed question records read once each, duplicates within the watermark dropped.

The checkpoint is the commit log: a run that dies is taken up where it stopped, and each file counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.ingest import question_id


def landing(spark: SparkSession, folder: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """A stream of the parquet files of a folder; zone-less times are read as UTC, as watermarks need."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)
    return rows.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def identified(rows: DataFrame, house: str = "lok-sabha") -> DataFrame:
    """Records with their question id; those without one are left out (they are counted by ``unidentified``)."""
    made = rows.withColumn("question_id", question_id(F.lit(house), F.col("lokNo"), F.col("sessionNo"), F.col("type"), F.col("quesNo")))
    return made.where("question_id is not null")


def deduplicated(rows: DataFrame, within: str = "45 days") -> DataFrame:
    """The first record of each question within the watermark; state older than that is dropped."""
    return rows.withWatermark("fetched_at", within).dropDuplicatesWithinWatermark(["question_id"])


def windowed_counts(rows: DataFrame, width: str = "7 days", late: str = "45 days") -> DataFrame:
    """Records by window of fetching and type; late ones are taken until the watermark passes."""
    return rows.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", width), "type").agg(F.count(F.lit(1)).alias("records"))


def run_once(rows: DataFrame, out: str, checkpoint: str) -> None:
    """All that is there now, written as parquet, then stop."""
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
