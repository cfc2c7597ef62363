"""The star of the published tables, once as DataFrames and once as SQL: questions, members, seats, forms, pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import collapse, present, stated
from ledgerloom.operators import dimensions, ingest, resolve
from ledgerloom.sources.tables import table

ORDER = ["last_refreshed", "source_record_ref", "date", "type", "subject", "ministry_id", "resolution_status"]
CONTENT = ["house", "session", "date", "type", "subject", "ministry_id", "resolution_status"]


def id_list(c):
    """Member ids stripped and in lower case, without blanks and repeats, in order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.lower(present(x))), lambda x: x.isNotNull()))


def questions(spark: SparkSession, root: str) -> DataFrame:
    """One row a published question: the first copy, with clean ids."""
    rows = table(spark, root, "questions_published").where("question_id is not null").withColumn("asking_members", F.coalesce(id_list(F.col("asking_members")), F.array().cast("array<string>")))
    first = ingest.dedupe(rows, ["question_id"], ORDER, [*CONTENT, "asking_members"])
    return first.withColumn("ministry_id", F.lower(stated(F.col("ministry_id")))).drop("copies", "contents")


def members(spark: SparkSession, root: str) -> DataFrame:
    """One row a member: the last row entered."""
    c = table(spark, root, "constituencies")
    text = ["memberName", "party", "state", "constituency", "lsExpr"]
    order = F.struct("createdAt", "updatedAt", *[F.coalesce(x, F.lit("")).alias(x) for x in text])
    last = c.where(present(F.col("memberId")).isNotNull()).groupBy(F.lower(present(F.col("memberId"))).alias("member_id")).agg(F.max_by(F.struct(*text, "house", "sittingStatus"), order).alias("r"))
    return last.select(
        "member_id", present(collapse(F.col("r.memberName"))).alias("name"), present(F.col("r.party")).alias("party"), present(collapse(F.col("r.state"))).alias("state"),
        present(collapse(F.col("r.constituency"))).alias("seat"), ingest.terms_served(F.col("r.lsExpr")).alias("terms"),
        ingest.sitting_status(F.col("r.sittingStatus")).alias("sitting_status"),
    )


def window_terms(spark: SparkSession, root: str) -> list[int]:
    """The terms the questions are of, that the roster has members of: the window. A handful of numbers."""
    asked = table(spark, root, "shared_ques_no").select(present(F.col("lokNo")).try_cast("int").alias("term")).where("term is not null").distinct()
    served = table(spark, root, "constituencies").select(F.explode(ingest.terms_served(F.col("lsExpr"))).alias("term")).distinct()
    return sorted(r.term for r in asked.join(served, "term").collect())


def asker_names(asked: DataFrame, known: DataFrame) -> DataFrame:
    """The names a result list needs: member_id and canonical_name of every member who asks."""
    ids = asked.select(F.explode("asking_members").alias("member_id")).distinct()
    return ids.join(known.select("member_id", F.coalesce("name", "member_id").alias("canonical_name")), "member_id")


def seats(spark: SparkSession, root: str) -> DataFrame:
    """The representations of the window's terms."""
    return dimensions.in_window(dimensions.representations(members(spark, root)), window_terms(spark, root))


def states(spark: SparkSession, root: str) -> DataFrame:
    """member_id and state."""
    return members(spark, root).where("state is not null").select("member_id", "state")


def mentions(spark: SparkSession, root: str) -> DataFrame:
    """Every asker as written: question record, scope (term), place, form."""
    rows = table(spark, root, "shared_ques_no").select("seq", present(F.col("lokNo")).alias("scope"), ingest.asker_forms(F.col("member")).alias("forms"))
    return rows.select("seq", "scope", F.posexplode("forms").alias("at", "form"))


def pool(spark: SparkSession, root: str) -> DataFrame:
    """The candidates of each term: member ids with the names they are written by in the roster."""
    rows = table(spark, root, "constituencies").select(
        F.lower(present(F.col("memberId"))).alias("member_id"), F.explode(ingest.terms_served(F.col("lsExpr"))).alias("term"), F.col("memberName").alias("written")
    )
    return rows.select(F.col("term").cast("string").alias("scope"), "member_id", "written")


def asserted(spark: SparkSession, root: str) -> DataFrame:
    """Assertions whose form is asserted for one member: form, member_id."""
    rows = table(spark, root, "lok_sabha").select(present(F.col("name_as_written")).alias("form"), F.lower(present(F.col("member_id"))).alias("member_id"))
    return rows.where("form is not null and member_id is not null").groupBy("form").agg(F.min("member_id").alias("member_id"), F.countDistinct("member_id").alias("n")).where("n = 1").drop("n")


def outcomes(spark: SparkSession, root: str, approximate: bool = False) -> DataFrame:
    """The cascade's outcome for each (term, form)."""
    forms = resolve.distinct_forms(mentions(spark, root).where("scope is not null"))
    return resolve.cascade(forms, resolve.pool_keys(pool(spark, root)), approximate=approximate)


def strip_sql(x: str) -> str:
    """SQL for ``functions.text.strip``."""
    return rf"regexp_replace({x}, '^[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{85}}\x{{b}}]+|[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{85}}\x{{b}}]+$', '', 'g')"


def present_sql(x: str) -> str:
    """SQL for ``functions.text.present``."""
    return f"nullif({strip_sql(x)}, '')"


def collapse_sql(x: str) -> str:
    """SQL for ``functions.text.collapse``."""
    return strip_sql(rf"regexp_replace({x}, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{85}}\x{{b}}]+', ' ', 'g')")


def slug_sql(x: str) -> str:
    """SQL for ``functions.text.slug``."""
    return f"coalesce(nullif(regexp_replace(regexp_replace(lower({strip_sql(x)}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'not-stated')"


def canon_tokens_sql(x: str) -> str:
    """SQL for ``functions.text.canon_tokens``."""
    from ledgerloom.functions.text import HONORIFICS

    words = ", ".join(f"'{h}'" for h in HONORIFICS)
    return f"list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: t <> '' and not list_contains([{words}], t))"


def tokens_sql(x: str) -> str:
    """SQL for ``functions.text.search_tokens``."""
    from ledgerloom.functions.text import STOPWORDS

    words = ", ".join(f"'{h}'" for h in STOPWORDS)
    return rf"list_distinct(list_filter(string_split(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda t: length(t) >= 3 and not list_contains([{words}], t)))"


def fold_sql(x: str) -> str:
    """SQL for ``functions.text.fold_key``."""
    return f"array_to_string(list_transform(string_split({slug_sql(x)}, '-'), lambda t: case when length(t) >= 4 and t like '%s' then t[:-2] else t end), '-')"


BUCKET_SQL = "case when resolution_status = 'resolved' then 'fully_linked' when resolution_status = 'ambiguous' then 'ambiguous' when resolution_status = 'unresolved' and len(asking_members) > 0 then 'partly_linked' when resolution_status = 'unresolved' then 'not_linked' end"

_ORDER_SQL = ", ".join(f"{c} nulls first" for c in ORDER)
STAR = f"""
with q as (
  select question_id, house, session, date, type, subject, coalesce(lower({present_sql("ministry_id")}), 'not stated') as ministry_id, resolution_status, source_record_ref, last_refreshed,
         coalesce(list_filter(list_transform(asking_members, lambda x: lower({present_sql("x")})), lambda x: x is not null), []) as asking_members
  from (select *, row_number() over (partition by question_id order by {_ORDER_SQL}) as rn from questions_published where question_id is not null) where rn = 1
), m as (
  select member_id, {present_sql(collapse_sql("memberName"))} as name, {present_sql("party")} as party, {present_sql(collapse_sql("state"))} as state, {present_sql(collapse_sql("constituency"))} as seat,
         coalesce(list_sort(list_distinct(list_transform(list_filter(string_split(lsExpr, ','), lambda x: regexp_matches(x, '^\\s*\\d+\\s*$')), lambda x: cast(trim(x) as int)))), []) as terms
  from (select *, lower({present_sql("memberId")}) as member_id, row_number() over (partition by lower({present_sql("memberId")})
        order by createdAt desc nulls last, updatedAt desc nulls last, coalesce(memberName, '') desc, coalesce(party, '') desc, coalesce(state, '') desc, coalesce(constituency, '') desc, coalesce(lsExpr, '') desc) as rn
        from constituencies where {present_sql("memberId")} is not null) where rn = 1
), bridge as (select distinct question_id, subject, session, a as member_id from (select question_id, subject, session, unnest(asking_members) as a from q)
), pairs as (select distinct b.question_id, b.subject, m.state from bridge b join m on m.member_id = b.member_id where m.state is not null
), prof as (select ministry_id, session, count(*) as questions, count(*) filter (b = 'fully_linked') as fully_linked, count(*) filter (b = 'partly_linked') as partly_linked,
         count(*) filter (b = 'not_linked') as not_linked, count(*) filter (b = 'ambiguous') as ambiguous from (select *, {BUCKET_SQL} as b from q) group by all
), terms as (select distinct question_id, t as term from (select question_id, unnest({tokens_sql("subject")}) as t from q)
), reps as (
  select distinct case when {slug_sql("state")} = {slug_sql("seat")} then {slug_sql("seat")} else {slug_sql("state")} || '-' || {slug_sql("seat")} end as seat_id, seat, state, member_id, name as member_name, party, term
  from (select *, unnest(terms) as term from m where seat is not null) where term in (select distinct try_cast(trim(lokNo) as int) from shared_ques_no)
)
"""
