"""Queries p3 to p8 by name, and the SQL they are held against where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import canonical
from ledgerloom.llm import encode as enc
from ledgerloom.llm import entity
from ledgerloom.llm import mix as mixing
from ledgerloom.llm import names, pii, variants
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import staged
from ledgerloom.sources.tables import table


def p3_matches(spark: SparkSession, root: str) -> DataFrame:
    """Each slip's member with the confidence of the match."""
    left, right = table(spark, root, "member_slips"), table(spark, root, "constituencies")
    found = entity.match(left, right, "slip_id", ("member", "constituency", "state"), "memberId", ("memberName", "constituency", "state"))
    return found.select(F.col("left_id").alias("slip_id"), F.col("right_id").alias("member_id"), F.round("confidence", 6).alias("confidence"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Each slip whose asker is in the roster, with the member."""
    return p3_matches(spark, root).select("slip_id", "member_id").distinct()


def _ministry_names(spark: SparkSession, root: str) -> DataFrame:
    return canonical.entries(table(spark, root, "ministries"), "ministry_id", {"canonical_name": 0, "former_names": 1})


def _mapped(spark: SparkSession, root: str) -> DataFrame:
    """Rows whose ministry is present and no canonical name, with the entry meant."""
    names = table(spark, root, "ministries").select(F.col("canonical_name").alias("value")).where("value is not null").distinct()
    rows = table(spark, root, "shared_ques_no").select("seq", "ministry").withColumnRenamed("ministry", "value")
    rows = lookup_join(rows, names, ["value"], "left_anti")
    return canonical.map_column(rows, "value", ["seq"], _ministry_names(spark, root))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """The ministry meant by each freely typed value, or unmatched."""
    return _mapped(spark, root).select("seq", F.coalesce("entry", F.lit("unmatched")).alias("ministry_id")).distinct()


def p4_unmatched(spark: SparkSession, root: str) -> DataFrame:
    """The values no ministry was found for, with their rows."""
    return _mapped(spark, root).where("entry is null").groupBy(F.col("value").alias("ministry")).agg(F.count(F.lit(1)).alias("records"))


def _forms(spark: SparkSession, root: str) -> DataFrame:
    asked = table(spark, root, "shared_ques_no").select(F.explode("member").alias("form"))
    asserted = table(spark, root, "lok_sabha").select(F.col("name_as_written").alias("form"))
    recorded = table(spark, root, "variants").select(F.explode("name_variants").alias("form"))
    return asked.unionByName(asserted).unionByName(recorded)


def _roster(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "constituencies").select(F.col("memberId").alias("owner"), names.folded(F.col("memberName")).alias("tokens"))


def p5_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Every written form with the number of the name it belongs to."""
    return variants.cluster_forms(_forms(spark, root), _roster(spark, root)).select("form", "cluster")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of writings of one person; names that several roster members bear in full are left out."""
    clusters = staged(variants.cluster_forms(_forms(spark, root), _roster(spark, root)), "p5-clusters")
    return variants.form_pairs(clusters.where("not namesakes")).distinct()


def p6_ids(spark: SparkSession, root: str) -> DataFrame:
    """The ids of every document."""
    return enc.encode(table(spark, root, "documents"))


def p6_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Every document's text as decoded from its ids, by its length and checksum; a null text comes back empty."""
    back = enc.decode(p6_ids(spark, root))
    return back.select("doc_id", F.length("text").cast("bigint").alias("letters"), F.md5("text").alias("checksum"))


def p7_mix(spark: SparkSession, root: str) -> DataFrame:
    """The uses of each document in the mixture."""
    return mixing.mix(table(spark, root, "documents"), table(spark, root, "mix_targets"))


def p7_shares(spark: SparkSession, root: str) -> DataFrame:
    """The shares reached, by source."""
    return mixing.shares(p7_mix(spark, root), table(spark, root, "mix_targets"))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    """Every stretch of personal information, by document and kind."""
    return pii.find(table(spark, root, "documents"))


def p8_redacted(spark: SparkSession, root: str) -> DataFrame:
    """The documents with typed placeholders."""
    return pii.redact(table(spark, root, "documents"))


QUERIES = {"p3_found": p3_found, "p3_matches": p3_matches, "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p5_found": p5_found, "p5_clusters": p5_clusters, "p6_ids": p6_ids, "p6_roundtrip": p6_roundtrip, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_redacted": p8_redacted}

ORACLES = {"p6_roundtrip": "select doc_id, length(coalesce(text, '')) as letters, md5(coalesce(text, '')) as checksum from documents"}
