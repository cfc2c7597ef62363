"""Catalog: table name to file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root``; zone-less timestamps stay as they are stored."""
    return spark.read.parquet(f"{root}/{name}.parquet")
