"""The whole dataset from the landed tables: resolve, canonicalise, publish.

The fact is staged once and read by everything after it; each set is computed once and written in both formats, several at a time, and
counted as it is written.
"""

from __future__ import annotations

import functools
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import slug, stated
from ledgerloom.operators import aggregates, dimensions, ingest, publish, quality, resolve, search, views
from ledgerloom.plans import facts
from ledgerloom.session import shared_dir, staged
from ledgerloom.sources.tables import table

TOP_N = 25
#: Jobs run at a time: parts of the build that do not need each other, sets as they are written.
AT_ONCE = 6
#: The axes, and the folders one of very many keys is laid out in.
AXES = {"by-session": ("session", None), "by-ministry": ("ministry_id", 64), "by-member": ("asking_members", 256)}


@dataclass(frozen=True)
class Dataset:
    """The sets of one build by name, the fact they come from, and the checks of what came in (stage, reason, records)."""

    questions: DataFrame
    sets: dict
    checks: DataFrame


def _pool(spark: SparkSession, root: str, full: bool) -> DataFrame:
    """The candidates of each term; with ``full``, all members in every term that has questions."""
    own = facts.pool(spark, root)
    if not full:
        return own
    scopes = [r.scope for r in facts.mentions(spark, root).select("scope").where("scope is not null").distinct().collect()]  # a handful of terms
    return own.drop("scope").distinct().withColumn("scope", F.explode(F.array(*[F.lit(x) for x in scopes]).cast("array<string>")))


def build(spark: SparkSession, root: str, approximate: bool = True, full_pool: bool = False) -> Dataset:
    """All published sets of the tables under ``root``.

    Records without an identity cannot be published and copies that differ have no first among them; both are counted in ``checks``, and
    it is for the caller to refuse (``quality.ingestion_failures``).
    """
    raw = table(spark, root, "shared_ques_no")
    made = ingest.question_id(F.lit("lok-sabha"), F.col("lokNo"), F.col("sessionNo"), F.col("type"), F.col("quesNo"))
    rows = raw.select(
        made.alias("question_id"), "seq", F.concat_ws("/", F.lit("lok-sabha"), F.trim("lokNo"), F.trim("sessionNo")).alias("session"), ingest.iso_date(F.col("date")).alias("date"),
        F.upper(stated(F.col("type"))).alias("type"), stated(F.col("subjects")).alias("subject"), stated(F.col("ministry")).alias("ministry_name"), F.trim("lokNo").alias("scope"), ingest.asker_forms(F.col("member")).alias("asker_forms"),
    )
    content = ["session", "date", "type", "subject", "ministry_name", "scope", "asker_forms"]
    every = staged(ingest.dedupe(rows, ["question_id"], ["seq"], content), "rebuild-records")
    records = every.where("question_id is not null")
    checks = every.agg(
        F.coalesce(F.sum(F.when(F.col("question_id").isNull(), F.col("copies"))), F.lit(0)).alias("nameless"), F.count_if(F.col("question_id").isNotNull() & (F.col("contents") > 1)).alias("differing")
    )
    told = F.array(
        F.struct(F.lit("identity").alias("stage"), F.lit("records without an identity").alias("reason"), F.col("nameless").alias("records")),
        F.struct(F.lit("deduplication").alias("stage"), F.lit("questions whose copies differ").alias("reason"), F.col("differing").alias("records")),
    )
    checks = checks.select(F.inline(told))
    bridge = records.select("question_id", "scope", "seq", F.posexplode_outer("asker_forms").alias("at", "form"))

    def resolved() -> DataFrame:
        forms = resolve.distinct_forms(bridge.where("scope is not null and form is not null"))
        found = resolve.cascade(forms, resolve.pool_keys(_pool(spark, root, full_pool)), approximate=approximate)
        return staged(resolve.overlay(found, facts.asserted(spark, root)), "rebuild-outcomes")

    def named() -> tuple[DataFrame, DataFrame]:
        observed = staged(dimensions.observations(records, "ministry_name", "date"), "rebuild-observed")
        groups = staged(dimensions.registry(observed), "rebuild-registry")
        renames = table(spark, root, "ministries").select(F.col("ministry_id").alias("dimension_id"), "canonical_name", "former_names")
        return groups, staged(dimensions.with_renames(dimensions.minted_ids(observed, groups), renames), "rebuild-minted")

    def seated() -> tuple[DataFrame, list[int], DataFrame]:
        members = staged(facts.members(spark, root), "rebuild-members")
        window = facts.window_terms(spark, root)
        return members, window, staged(dimensions.in_window(dimensions.representations(members), window), "rebuild-seats")

    with ThreadPoolExecutor(AT_ONCE) as several:
        parts = [several.submit(part) for part in (resolved, named, seated)]
    outcomes, (groups, minted), (members, window, reps) = (p.result() for p in parts)
    status = resolve.question_status(bridge, outcomes)
    fact = (
        records.withColumn("minted_id", slug(F.col("ministry_name")))
        .join(minted, "minted_id", "left")
        .join(status, "question_id")
        .select(
            "question_id", F.lit("lok-sabha").alias("house"), "session", "date", "type", "subject", F.coalesce("dimension_id", "minted_id").alias("ministry_id"), "asking_members", "resolution_status", F.col("seq").cast("string").alias("source_record_ref"),
        )
    )
    questions = staged(fact, "rebuild-questions")
    composed = [aggregates.composition(members, t) for t in window]
    terms, placed = search.terms(questions), staged(search.positions(questions), "rebuild-positions")
    pairs = aggregates.attributed(questions, dimensions.member_states(reps))
    mentions = bridge.where("form is not null").select("scope", "form", "seq", F.col("seq").cast("string").alias("ref"))
    sets = {
        "members": members,
        "ministries": groups.drop("fold"),
        "sessions": dimensions.sessions(questions),
        "constituencies": dimensions.seats(reps),
        "resolution-records": resolve.audit(outcomes, mentions),
        "composition": functools.reduce(DataFrame.unionByName, composed),
        "subject-trends": aggregates.subject_trends(questions),
        "ministry-profile": aggregates.ministry_profile(questions).join(aggregates.type_mix_map(questions), ["ministry_id", "session"]),
        "names": facts.asker_names(questions, members),
        "state-subjects": aggregates.state_subjects(pairs, TOP_N),
        "counting-basis": aggregates.counting_basis(aggregates.counters(questions)),
        "search-index": search.blocked_postings(terms, placed),
        "search-positions": placed,
        "search-digest": search.digest(questions),
        "coverage": views.coverage(questions, ["lok-sabha", "rajya-sabha"]),
    }
    return Dataset(questions, sets, checks)


def write(spark: SparkSession, made: Dataset, path: str, refreshed: str, **more) -> dict:
    """All sets and the partition axes under ``path`` in both formats, then the manifest; its content is returned."""

    def one(name: str) -> tuple[str, int]:
        if name in AXES:
            column, buckets = AXES[name]
            return name, publish.write_partitions(made.questions, column, f"{path}/{name}", buckets=buckets)
        return name, publish.write_both(made.sets[name], f"{path}/{name}")

    with ThreadPoolExecutor(AT_ONCE) as several:
        records = dict(several.map(one, [*AXES, *made.sets]))
    content = publish.manifest({"questions": records["by-session"], **records}, refreshed, **more)
    publish.write_manifest(spark, content, path)
    return content


def rebuild_counts(spark: SparkSession, root: str) -> DataFrame:
    """The records of every set of a full rebuild: set, records.

    Each set is counted by a plan of its own: in one over all of them the driver would plan every set anew after each stage of any.
    """
    made = build(spark, root)
    counted = {"questions": made.questions, **made.sets}
    with ThreadPoolExecutor(AT_ONCE) as several:
        records = list(several.map(lambda df: df.count(), counted.values()))
    return spark.createDataFrame(list(zip(counted, records, strict=True)), "set string, records bigint")


def read_back(spark: SparkSession, path: str, sets: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of each set written under ``path``, told by its file: (set, ndjson) and (set, csv); none for a set without rows.

    One scan for each format, so the plan is as small for many sets as for one.
    """
    told = F.regexp_extract(F.col("_metadata.file_path"), re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + "/([^/]+)/", 1).alias("set")
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text([f"{path}/{name}/ndjson" for name in sets])
    # The columns differ by set and none is read: only rows are told from each other.
    rows = reader.options(**publish.CSV).option("multiLine", "true").schema("value string").csv([f"{path}/{name}/csv" for name in sets])
    return tuple(df.select(told).groupBy("set").agg(F.count(F.lit(1)).alias(kind)) for df, kind in ((lines, "ndjson"), (rows, "csv")))


def rebuild_written(spark: SparkSession, root: str) -> DataFrame:
    """A full rebuild written in both formats and read back: set, records in each, and as the manifest has them."""
    path = f"{shared_dir(spark)}/published-{uuid.uuid4().hex}"
    content = write(spark, build(spark, root), path, "2026-01-01T00:00:00Z")
    said = {name: one["records"] for name, one in content["sets"].items() if name != "questions"}
    lines, rows = read_back(spark, path, list(said))
    out = spark.createDataFrame(list(said.items()), "set string, manifest bigint").join(lines, "set", "left").join(rows, "set", "left")
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("set", none("ndjson"), none("csv"), "manifest")


def publish_signals(spark: SparkSession, root: str) -> DataFrame:
    """Q02: what stands against publishing a build of these tables as it is: kind, severity, detail."""
    raw = table(spark, root, "shared_ques_no")
    made = ingest.question_id(F.lit("lok-sabha"), F.col("lokNo"), F.col("sessionNo"), F.col("type"), F.col("quesNo"))
    rows = raw.select(made.alias("question_id"), "seq", stated(F.col("subjects")).alias("subject"), stated(F.col("ministry")).alias("ministry_name"))
    every = ingest.dedupe(rows, ["question_id"], ["seq"], ["subject", "ministry_name"])
    counted = every.agg(F.count_if(F.col("question_id").isNotNull() & (F.col("contents") > 1)).alias("records"))
    nameless = every.where("question_id is null").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("records"))
    tell = lambda df, stage, reason: df.select(F.lit(stage).alias("stage"), F.lit(reason).alias("reason"), "records")
    return quality.ingestion_failures(tell(counted, "deduplication", "questions whose copies differ").unionByName(tell(nameless, "identity", "records without an identity")))


_CLEAN = facts.present_sql
ORACLES = {
    "publish_signals": f"""with k as (select case when {_CLEAN("lokNo")} is not null and {_CLEAN("sessionNo")} is not null and quesNo is not null then {_CLEAN("lokNo")} || '/' || {_CLEAN("sessionNo")} || '/' || {facts.slug_sql("type")} || '/' || quesNo end as id,
 coalesce({_CLEAN("subjects")}, 'not stated') || chr(1) || coalesce({_CLEAN("ministry")}, 'not stated') as c from shared_ques_no), d as (select id from k where id is not null group by 1 having count(distinct c) > 1),
 n as (select 'deduplication: questions whose copies differ (' as t, count(*) as n from d union all select 'identity: records without an identity (', count(*) from k where id is null)
 select 'ingestion-failure' as kind, 'failed' as severity, t || n || ' records)' as detail from n where n > 0""",
}
QUERIES = {"rebuild_counts": rebuild_counts, "rebuild_written": rebuild_written, "publish_signals": publish_signals}
