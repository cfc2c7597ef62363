"""Queries p1 and p2 on the tables of TESTDATA.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import drift, orphans
from ledgerloom.session import staged
from ledgerloom.sources.tables import table

def _stats(spark: SparkSession, root: str) -> DataFrame:
    return staged(drift.path_stats(drift.path_values(table(spark, root, "shared_ques_no_files"))), "drift-stats")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Every change of a field between two files of a feed."""
    return drift.schema_changes(_stats(spark, root)).select("file_no", "field", "change").distinct()


def p1_path_stats(spark: SparkSession, root: str) -> DataFrame:
    """Values and non-null values by file, path (two levels) and kind."""
    values = drift.path_values(table(spark, root, "shared_ques_no_files"), max_depth=2)
    return values.groupBy("feed", "file_no", "path", F.coalesce("kind", F.lit("null")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _unified(spark: SparkSession, root: str) -> DataFrame:
    stats = _stats(spark, root)
    keys = staged(drift.field_keys(stats), "drift-keys")
    return drift.project_unified(table(spark, root, "shared_ques_no_files"), drift.unified_types(stats, keys), keys)


def p1_unified(spark: SparkSession, root: str) -> DataFrame:
    """All records in one typed table, with the fields whose value did not convert."""
    return _unified(spark, root).withColumn("failed_casts", F.array_join("failed_casts", ",")).withColumn("rest", F.to_json("rest")).withColumn("failed_values", F.to_json("failed_values"))


def p1_failed_casts(spark: SparkSession, root: str) -> DataFrame:
    """Failed conversions by feed, file and field."""
    out = _unified(spark, root)
    return out.select("feed", "file_no", F.explode("failed_casts").alias("field")).groupBy("feed", "file_no", "field").agg(F.count(F.lit(1)).alias("failed"))


#: Where the references are cut into two batches.
HALFWAY = "2024-01-01"


def _references(spark: SparkSession, root: str) -> DataFrame:
    midnight = lambda c: F.try_to_timestamp(F.trim(F.col(c)), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    month = lambda c: F.substring(F.trim(F.col(c)), 1, 7)
    made = []
    for name, key, day in (("lok_sabha", "assertion_id", "confirmed_on"), ("variants", "variant_id", "recorded_on")):
        made.append(
            orphans.references(table(spark, root, name), name, "member_id", "constituencies", F.col(key), F.col("member_id"), midnight(day), month(day))
        )
    published = table(spark, root, "questions_published")
    at, period = F.col("last_refreshed"), month("date")
    asked = published.select("question_id", "date", "last_refreshed", F.explode("asking_members").alias("asker"))
    made.append(
        orphans.references(asked, "questions_published", "asking_members", "constituencies", F.col("question_id"), F.col("asker"), at, period)
    )
    made.append(
        orphans.references(published, "questions_published", "ministry_id", "ministries", F.col("question_id"), F.col("ministry_id"), at, period)
    )
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def _parents(spark: SparkSession, root: str) -> DataFrame:
    members = orphans.parent_rows(table(spark, root, "constituencies"), "constituencies", F.col("memberId"), F.col("createdAt"), F.col("withdrawnAt"))
    day = lambda c: F.try_to_timestamp(F.trim(F.col(c)), F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    ministries = orphans.parent_rows(table(spark, root, "ministries"), "ministries", F.col("ministry_id"), day("listed_on"), day("withdrawn_on"))
    return members.unionByName(ministries)


def _advanced(spark: SparkSession, root: str) -> orphans.OrphanState:
    """The state in two steps: parents as they were entered with the references so far, then the withdrawals with the later references."""
    refs, rows = _references(spark, root), staged(_parents(spark, root).distinct(), "p2-rows")
    early = F.coalesce(F.col("at") < F.lit(HALFWAY), F.lit(True))
    entered = rows.withColumn("end", F.lit(None).cast("timestamp_ntz"))
    # A withdrawal is the row again with its end; rows entered at the same moment under the same key come with it, as it replaces them all.
    gone = rows.where("end is not null").select("target", "ref_value", F.col("start").alias("__start")).distinct()
    same = [rows["target"] == gone["target"], rows["ref_value"] == gone["ref_value"], rows["start"].eqNullSafe(gone["__start"])]
    state = orphans.advance(None, refs.where(early), entered)
    return orphans.advance(state, refs.where(~early), rows.join(gone, same, "left_semi"))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Every reference of which no target row stands at its time."""
    state = _advanced(spark, root)
    return state.pending.select("source_table", "period", "row_key", "ref_field", "ref_value", "kind").distinct()


def p2_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Orphans by table, field, month and kind."""
    return _advanced(spark, root).snapshot()


def p2_batches(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots after each of three batches cut by time: references by their own, parents by their start."""
    refs, rows = staged(_references(spark, root), "p2-refs"), staged(_parents(spark, root), "p2-rows")
    cuts = ["2021-01-01", "2024-01-01", None]
    state, out, low = None, None, None
    for n, high in enumerate(cuts, 1):
        part = lambda df, c: df.where(
            (F.lit(True) if low is None else F.coalesce(F.col(c) >= F.lit(low), F.lit(False)))
            & (F.lit(True) if high is None else (F.col(c) < F.lit(high)) | F.col(c).isNull() & F.lit(low is None))
        )
        state = orphans.advance(state, part(refs, "at"), part(rows, "start"))
        shot = state.snapshot().withColumn("batch", F.lit(n))
        out = shot if out is None else out.unionByName(shot)
        low = high
    return out


QUERIES = {
    "p1_found": p1_found,
    "p1_path_stats": p1_path_stats,
    "p1_unified": p1_unified,
    "p1_failed_casts": p1_failed_casts,
    "p2_found": p2_found,
    "p2_snapshot": p2_snapshot,
    "p2_batches": p2_batches,
}

_P2 = """
with refs as (
  select 'lok_sabha' as source_table, left(trim(confirmed_on), 7) as period, cast(assertion_id as varchar) as row_key, 'member_id' as ref_field,
         'constituencies' as target, lower(regexp_replace(member_id, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')) as ref_value, try_cast(trim(confirmed_on) as timestamp) as seen_at from lok_sabha
  union all
  select 'variants', left(trim(recorded_on), 7), cast(variant_id as varchar), 'member_id', 'constituencies',
         lower(regexp_replace(member_id, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')), try_cast(trim(recorded_on) as timestamp) from variants
  union all
  select 'questions_published', left(trim(date), 7), question_id, 'asking_members', 'constituencies',
         lower(regexp_replace(m, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')), last_refreshed
  from (select question_id, date, last_refreshed, unnest(asking_members) as m from questions_published)
  union all
  select 'questions_published', left(trim(date), 7), question_id, 'ministry_id', 'ministries',
         lower(regexp_replace(ministry_id, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')), last_refreshed from questions_published
), parents as (
  select 'constituencies' as target, lower(regexp_replace(memberId, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')) as ref_value, createdAt as s,
         withdrawnAt as e from constituencies
  union all
  select 'ministries', lower(trim(ministry_id)), try_cast(listed_on as timestamp), try_cast(withdrawn_on as timestamp) from ministries
), judged as (
  select r.source_table, r.period, r.row_key, r.ref_field, r.ref_value, r.seen_at,
         count(p.target) as n,
         coalesce(bool_or(p.target is not null and (r.seen_at is null or ((p.s is null or p.s <= r.seen_at) and (p.e is null or p.e > r.seen_at)))), false) as stands,
         coalesce(bool_or(p.target is not null and (p.s is null or p.s <= r.seen_at)), false) as begun
  from (select distinct * from refs where ref_value <> '') r left join parents p on p.target = r.target and p.ref_value = r.ref_value
  group by all
), cases as (
  select distinct source_table, period, row_key, ref_field, ref_value, seen_at,
         case when n = 0 then 'missing' when not begun then 'late' else 'deleted' end as kind
  from judged where not stands
)
"""

_P2B = _P2[: _P2.index("), judged as")] + """
), cuts as (select * from (values (1, timestamp '2021-01-01'), (2, timestamp '2024-01-01'), (3, null)) v(batch, high)),
judged as (
  select r.source_table, r.period, r.row_key, r.ref_field, r.ref_value, r.seen_at, batch,
         count(p.target) as n,
         coalesce(bool_or(p.target is not null and (r.seen_at is null or ((p.s is null or p.s <= r.seen_at) and (p.e is null or p.e > r.seen_at)))), false) as stands,
         coalesce(bool_or(p.target is not null and (p.s is null or p.s <= r.seen_at)), false) as begun
  from cuts join (select distinct * from refs where ref_value <> '') r on high is null or r.seen_at is null or r.seen_at < high
  left join parents p on p.target = r.target and p.ref_value = r.ref_value and (high is null or p.s is null or p.s < high)
  group by all
), cases as (
  select distinct batch, source_table, period, row_key, ref_field, ref_value, seen_at,
         case when n = 0 then 'missing' when not begun then 'late' else 'deleted' end as kind
  from judged where not stands
)
"""

_P1 = """
with r as (select feed, file_no, payload as j from shared_ques_no_files where payload is not null and regexp_matches(payload, '\\}\\s*$') and json_valid(payload) and json_type(payload) = 'OBJECT'),
one as (select feed, file_no, e.key as path, e.type as t, e.value as v from r, json_each(r.j) e),
two as (select feed, file_no, one.path || '.' || e.key as path, e.type as t from one, json_each(one.v) e where one.t = 'OBJECT'),
every as (select feed, file_no, path, t from one union all select * from two)
select feed, file_no, path, case t when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'ARRAY' then 'array' when 'OBJECT' then 'object' when 'NULL' then 'null' else 'number' end as kind, count(*) as n from every group by all
"""

ORACLES = {
    "p1_path_stats": _P1,
    "p2_found": _P2 + "select distinct source_table, period, row_key, ref_field, ref_value, kind from cases",
    "p2_batches": _P2B + "select source_table, ref_field, period, kind, count(*) as orphans, batch from cases group by all",
    "p2_snapshot": _P2 + "select source_table, ref_field, period, kind, count(*) as orphans from cases group by all",
}
