"""Audits: each gives the rows that break a rule, and none if all is well."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import present

SEVERITIES = ("notice", "degraded", "failed")


def unaudited(bridge: DataFrame, audit_rows: DataFrame) -> DataFrame:
    """Member ids joined to questions that no resolution record names: member_id, joins."""
    joins = bridge.where("member_id is not null").groupBy("member_id").agg(F.count(F.lit(1)).alias("joins"))
    return joins.join(audit_rows.where("member_id is not null").select("member_id").distinct(), "member_id", "left_anti")


def joins_per_member(bridge: DataFrame) -> DataFrame:
    """member_id, joins."""
    return bridge.where("member_id is not null").groupBy("member_id").agg(F.count(F.lit(1)).alias("joins"))


def transitions_out(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q03: questions that were resolved and are so no longer: question_id, was, now (null if it is gone)."""
    old = before.where("resolution_status = 'resolved'").select("question_id", F.col("resolution_status").alias("was")).distinct()
    new = after.select("question_id", F.col("resolution_status").alias("now")).distinct()
    return old.join(new, "question_id", "left").where(~F.col("now").eqNullSafe(F.lit("resolved")))


def question_violations(questions: DataFrame) -> DataFrame:
    """Q05: question_id and rule of each broken invariant: resolved without askers, repeated askers, missing id, ambiguous with askers, unknown status."""
    askers = F.coalesce("asking_members", F.array().cast("array<string>"))
    status = F.col("resolution_status")
    rules = {
        "resolved-without-asker": (status == "resolved") & (F.size(askers) == 0),
        "repeated-asker": F.size(F.array_distinct(askers)) < F.size(askers),
        "missing-id": present(F.col("question_id")).isNull(),
        "ambiguous-with-asker": (status == "ambiguous") & (F.size(askers) > 0),
        "unknown-status": ~F.coalesce(status, F.lit("")).isin("resolved", "unresolved", "ambiguous"),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return questions.select("question_id", F.explode(broken).alias("rule"))


def record_violations(audit_rows: DataFrame) -> DataFrame:
    """Q05: audit rows that contradict themselves: name_as_written, rule."""
    status, ids = F.col("status"), F.col("candidates")
    rules = {
        "ambiguous-without-two": (status == "ambiguous") & (F.size(ids) < 2),
        "ambiguous-with-member": (status == "ambiguous") & F.col("member_id").isNotNull(),
        "resolved-without-member": (status == "resolved") & F.col("member_id").isNull(),
        "method-missing": (status != "unresolved") & F.col("method").isNull(),
        "manual-not-by-maintainer": (F.col("method") == "manual-assertion") != (F.col("asserted_by") == "maintainer"),
    }
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return audit_rows.select("name_as_written", F.explode(broken).alias("rule"))


def status_sum_violations(profile: DataFrame) -> DataFrame:
    """Q10: profile rows whose status counts do not add up: ministry_id, session, questions, counted."""
    counted = F.col("fully_linked") + F.col("partly_linked") + F.col("not_linked") + F.col("ambiguous")
    return profile.withColumn("counted", counted).where("counted <> questions").select("ministry_id", "session", "questions", "counted")


def field_audit(texts: DataFrame, text: str, prohibited: list[str]) -> DataFrame:
    """Prohibited structured keys in text lines, code fences left out: line key, spelt as found.

    ``texts`` has source and line (from 0) besides the text. A key counts as ``"key":`` or ``key:`` or in a comma header, whatever its case
    and separators.
    """
    from pyspark.sql.window import Window

    order = Window.partitionBy("source").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fence = F.col(text).rlike(r"^\s*```").cast("int")
    masked = texts.withColumn("__fences", F.sum(fence).over(order)).where((F.col("__fences") % 2 == 0) & (fence == 0))
    keys = F.regexp_extract_all(F.col(text), F.lit(r'"?([A-Za-z][A-Za-z0-9_\- ]*)"?\s*[:,]'), F.lit(1))
    normal = [p.lower().replace("_", "").replace("-", "").replace(" ", "") for p in prohibited]
    found = masked.select("source", "line", F.explode(keys).alias("spelt"))
    return found.where(F.regexp_replace(F.lower("spelt"), "[^a-z0-9]", "").isin(*normal))


def audit_tree(spark: SparkSession, path: str, prohibited: list[str], names: str = "*") -> DataFrame:
    """Q11: ``field_audit`` over every text file below a folder: source, line, spelt. Files are read as lines, in parallel, never whole."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(path)
    numbered = rows.select(F.col("_metadata.file_path").alias("source"), F.monotonically_increasing_id().alias("line"), "value")
    first = numbered.groupBy("source").agg(F.min("line").alias("__first"))
    return field_audit(numbered.join(first, "source").select("source", (F.col("line") - F.col("__first")).alias("line"), "value"), "value", prohibited)


def scratch_path(folder: str, kept_out_of: str, name: str) -> str:
    """Q12: a path below ``folder`` for what must not land in ``kept_out_of`` (links and dots resolved); raises where it would."""
    root, tree = pathlib.Path(folder).resolve(), pathlib.Path(kept_out_of).resolve()
    made = (root / name).resolve()
    if made == tree or tree in made.parents or (made != root and root not in made.parents):
        raise ValueError("the path leads out of its folder or into the tree it must stay out of")
    return str(made)


def signals(shape: DataFrame, out: DataFrame, assisted_rate: DataFrame, target: float = 0.95) -> DataFrame:
    """Q02, Q03: kind, severity, detail of everything worth telling: shape changes, transitions out, a rate below target."""
    shapes = shape.select(F.lit("shape-changed").alias("kind"), "severity", F.concat_ws(" ", "change", "field").alias("detail"))
    lost = out.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit("resolved-transitions-out").alias("kind"), F.lit("degraded").alias("severity"), F.format_string("%d questions", "n").alias("detail"))
    low = assisted_rate.where(F.col("assisted_rate") < target).select(F.lit("rate-below-target").alias("kind"), F.lit("notice").alias("severity"), F.col("assisted_rate").cast("string").alias("detail"))
    return shapes.unionByName(lost).unionByName(low)


def ingestion_failures(checks: DataFrame) -> DataFrame:
    """Q02: a ``failed`` signal for each check that counted anything: kind, severity, detail.

    ``checks`` has stage, reason and records; stages with no records, or a null count, are fine. Counts and names only, never values.
    """
    bad = checks.where("records > 0")
    return bad.select(F.lit("ingestion-failure").alias("kind"), F.lit("failed").alias("severity"), F.format_string("%s: %s (%d records)", "stage", "reason", "records").alias("detail"))


def should_publish(signal_rows: DataFrame) -> bool:
    """Q02: true unless a signal says failed."""
    return signal_rows.where("severity = 'failed'").isEmpty()
