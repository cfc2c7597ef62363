"""Queries of the reading side: formats, parsers, lookups, summaries, orders, claims, the written index; each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions import display
from ledgerloom.operators import aggregates, dimensions, ingest, search, views
from ledgerloom.plans import facts
from ledgerloom.plans.facts import BUCKET_SQL, STAR, collapse_sql, present_sql, slug_sql
from ledgerloom.plans.published import MINISTRY, WORDS
from ledgerloom.session import shared_dir
from ledgerloom.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str, star: bool = True):
    """Registers a query under its function's name, with the SQL it is held against."""

    def take(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = (STAR if star else "") + sql
        return f

    return take


_ORD = "{0} || case when {0} % 100 between 11 and 13 then 'th' when {0} % 10 = 1 then 'st' when {0} % 10 = 2 then 'nd' when {0} % 10 = 3 then 'rd' else 'th' end"
_GROUPED = "case when length({0}) <= 3 then {0} else ltrim(reverse(regexp_replace(reverse(left({0}, length({0}) - 3)), '(..)', '\\1,', 'g')), ',') || ',' || right({0}, 3) end"
_MONTH = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_SESSION = r"regexp_matches(session, '^[^/]+/\d+/\d+$')"


@query(
    f""", s as (select session, count(*) as n, count(*) filter (resolution_status = 'resolved') as r, min(date) as d, cast(split_part(session, '/', 2) as int) as t, split_part(session, '/', 3) as k from q where {_SESSION} group by 1)
 select session, {_GROUPED.format("cast(n * 3791 as varchar)")} as figure, printf('%.2f%%', round(r / n * 100, 2)) as rate,
 case when regexp_matches(d, '^\\d{{4}}-\\d\\d-\\d\\d$') then cast(cast(right(d, 2) as int) as varchar) || ' ' || {_MONTH}[cast(substr(d, 6, 2) as int)] || ' ' || left(d, 4) else 'not stated' end as first_day,
 {_ORD.format("t")} || ' LS · Session ' || k as label, {_ORD.format("t")} || ' Lok Sabha · Session ' || k as long_label, 'lok-sabha-' || t || '-' || k || '.jsonl' as file from s"""
)
def display_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Each session as it is shown: figure, rate, first day, labels, file."""
    q = facts.questions(spark, root).where(F.col("session").rlike(r"^[^/]+/\d+/\d+$"))
    per = q.groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("resolution_status") == "resolved").alias("r"), F.min("date").alias("d"))
    c = F.col("session")
    return per.select(
        "session", display.count(F.col("n") * 3791).alias("figure"), display.percent(F.col("r") / F.col("n")).alias("rate"), display.day(F.col("d")).alias("first_day"),
        display.session_label(c).alias("label"), display.long_session_label(c).alias("long_label"), display.session_file_name(c).alias("file"),
    )


@query(r"select question_id, split_part(question_id, '/', 1) as house, try_cast(split_part(question_id, '/', 2) as int) as term, try_cast(split_part(question_id, '/', 3) as int) as session, split_part(question_id, '/', 4) as type, try_cast(split_part(question_id, '/', 5) as int) as number from q where regexp_matches(question_id, '^[^/]*/\d+/\d+/[^/]*/[^/]*$')")
def question_id_parts(spark: SparkSession, root: str) -> DataFrame:
    """Question ids taken apart."""
    parts = facts.questions(spark, root).select("question_id", display.question_parts(F.col("question_id")).alias("p")).where("p is not null")
    return parts.select("question_id", "p.house", "p.term", "p.session", "p.type", "p.number")


@query(f"select member_id, case when len(terms) = 0 then 'not stated' else array_to_string(list_transform(terms, lambda t: {_ORD.format('t')})[:-2], ', ') || case when len(terms) > 1 then ' and ' else '' end || list_transform(terms, lambda t: {_ORD.format('t')})[-1] || ' Lok Sabha' end as phrase from m")
def display_terms(spark: SparkSession, root: str) -> DataFrame:
    """Each member's terms in words."""
    return facts.members(spark, root).select("member_id", display.terms_phrase(F.col("terms")).alias("phrase"))


def _status_sql(x: str) -> str:
    w = f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
    words = lambda k: ", ".join(f"'{x}'" for x in ingest.STATUS[k])
    return f"case when {w} in ({words('sitting')}) then 'sitting' when {w} in ({words('former')}) then 'former' else 'not stated' end"


@query(f"select distinct sittingStatus as written, {_status_sql('sittingStatus')} as status from (select sittingStatus from constituencies union all select unnest(['Active', 'SERVING ', 'Ex-Member', 'past', 'TRUE', '0', 'no', 'Y', 'retired.', 'unclear']))", star=False)
def sitting_statuses(spark: SparkSession, root: str) -> DataFrame:
    """The sitting status of every writing in the roster, and of the vocabulary's other words."""
    more = spark.createDataFrame([(x,) for x in ("Active", "SERVING ", "Ex-Member", "past", "TRUE", "0", "no", "Y", "retired.", "unclear")], "sittingStatus string")
    rows = table(spark, root, "constituencies").select("sittingStatus").unionByName(more).distinct()
    return rows.select(F.col("sittingStatus").alias("written"), ingest.sitting_status(F.col("sittingStatus")).alias("status"))


@query("select question_id from q where house = 'lok-sabha' and session = 'lok-sabha/17/4'")
def extract_house_session(spark: SparkSession, root: str) -> DataFrame:
    """One session of one house."""
    return views.extract(facts.questions(spark, root), house="lok-sabha", session="lok-sabha/17/4").select("question_id")


@query("select question_id from q where house = 'lok-sabha' and session = 'lok-sabha/18/2'")
def extract_written(spark: SparkSession, root: str) -> DataFrame:
    """An extract written as NDJSON and read back."""
    from ledgerloom.operators.publish import write_ndjson

    path = f"{shared_dir(spark)}/extract-{uuid.uuid4().hex}"
    write_ndjson(views.extract(facts.questions(spark, root), session="lok-sabha/18/2"), path)
    return spark.read.schema("question_id string").json(path)


@query("select question_id, session from q where try_cast(split_part(session, '/', 3) as int) between 2 and 4 and try_cast(split_part(session, '/', 2) as int) = 17")
def session_range(spark: SparkSession, root: str) -> DataFrame:
    """the questions of a range of sessions of one term."""
    return views.in_session_range(facts.questions(spark, root), "4-2", 17).select("question_id", "session")


@query("select count(*) filter (coalesce(try_cast(split_part(session, '/', 2) as int), -1) = 18) as inside, count(*) filter (coalesce(try_cast(split_part(session, '/', 2) as int), -1) <> 18) as outside from q")
def outside_window(spark: SparkSession, root: str) -> DataFrame:
    """what lies in and outside of a window of terms."""
    return views.outside_terms(facts.questions(spark, root), [18])


_SPAN = r"(cast(split_part(session, '/', 2) as int) * 1000 + cast(split_part(session, '/', 3) as int)) between 17003 and 18002"


@query(
    f""", s as (select distinct session, cast(split_part(session, '/', 2) as int) * 1000 + cast(split_part(session, '/', 3) as int) as o from q where {_SESSION} and {_SPAN}),
 e as (select arg_min(session, o) as a, arg_max(session, o) as b from s), t as (select type, count(*) filter (session = a) as x, count(*) filter (session = b) as y from q, e where ministry_id = '{MINISTRY}' and session in (select session from s) group by 1)
 select type, x as first_questions, y as last_questions, y - x as difference, round(x * 100.0 / nullif((select sum(x) from t), 0), 4) as first_share, round(y * 100.0 / nullif((select sum(y) from t), 0), 4) as last_share from t"""
)
def span_change_types(spark: SparkSession, root: str) -> DataFrame:
    """A span's first and last session by type, with shares."""
    q = facts.questions(spark, root)
    span = views.in_span(dimensions.sessions(q), (17, 3), (18, 2))
    return views.span_types(aggregates.type_mix(q), span, MINISTRY)


@query("select dimension, category, members, row_number() over (partition by dimension order by try_cast(category as bigint) is null, category) as place from (select dimension, category, count(distinct member_id) as members from (select member_id, unnest([{'dimension': 'party', 'category': coalesce(party, 'not stated')}, {'dimension': 'terms_served', 'category': cast(len(terms) as varchar)}], recursive := true) from m where list_contains(terms, 17)) group by all)")
def composition_order(spark: SparkSession, root: str) -> DataFrame:
    """The categories of a composition in their published order."""
    composed = aggregates.composition(facts.members(spark, root), 17, ("party", "terms_served"))
    order = Window.partitionBy("dimension").orderBy(F.col("category").try_cast("bigint").isNull(), "category")
    return views.in_category_order(composed).select("dimension", "category", "members", F.row_number().over(order).cast("bigint").alias("place"))


@query("select session, row_number() over (order by cast(split_part(session, '/', 2) as int) desc, cast(split_part(session, '/', 3) as int) desc) as place from (select distinct session from q where " + _SESSION + ")")
def sessions_newest_first(spark: SparkSession, root: str) -> DataFrame:
    """Sessions by number, the newest first."""
    rows = views.in_session_order(facts.questions(spark, root).select("session").distinct().where(F.col("session").rlike(r"^[^/]+/\d+/\d+$")), newest_first=True)
    collected = rows.agg(F.collect_list("session").alias("s"))  # sessions are some dozens; the order given is kept
    return collected.select(F.posexplode("s").alias("place", "session")).select("session", (F.col("place") + 1).cast("bigint").alias("place"))


@query(f"""select r.seat_id, s.name, s.state, hands as changed_hands, r.member_id, r.terms, coalesce(c.questions, 0) as questions, coalesce(c.fully_linked, 0) as fully_linked, coalesce(c.partly_linked, 0) as partly_linked
 from (select seat_id, member_id, array_to_string(list_sort(list_distinct(list(term))), ',') as terms from reps group by 1, 2) r join (select seat_id, min(seat) as name, min(state) as state, count(distinct member_id) > 1 as hands from reps group by 1) s using (seat_id)
 left join (select b.member_id, count(*) as questions, count(*) filter (k = 'fully_linked') as fully_linked, count(*) filter (k = 'partly_linked') as partly_linked from (select distinct question_id, member_id from bridge) b join (select question_id, {BUCKET_SQL} as k from q) using (question_id) group by 1) c on c.member_id = r.member_id
 where lower({collapse_sql("s.name")}) = 'pebagadh west'""")
def seat_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Every seat of one name, who held it, and what they asked."""
    reps = facts.seats(spark, root)
    out = views.seat_lookup(dimensions.seats(reps), reps, facts.questions(spark, root), "Pebagadh  WEST")
    return out.select("seat_id", "name", "state", "changed_hands", "member_id", F.array_join("terms", ",").alias("terms"), "questions", "fully_linked", "partly_linked")


@query("select state, coalesce(subject, 'not stated') as subject, questions, state_questions, cast(place as int) as place from (select *, row_number() over (partition by state order by questions desc, subject) as place from (select state, subject, count(*) as questions from pairs group by all)) join (select state, count(distinct question_id) as state_questions from pairs group by 1) using (state) where place <= 25 and lower(" + collapse_sql("state") + ") = 'goluvana'")
def state_summary(spark: SparkSession, root: str) -> DataFrame:
    """The published subjects of one state, in order."""
    rows = aggregates.state_subjects(aggregates.attributed(facts.questions(spark, root), facts.states(spark, root)), 25)
    return views.state_summary(rows, " goluvana ").select("state", "subject", "questions", "state_questions", "place")


@query("select subject, session, count(*) as questions from q where subject = 'Dairy arrears' group by all")
def subject_sessions(spark: SparkSession, root: str) -> DataFrame:
    """One subject over the sessions."""
    return views.subject_sessions(aggregates.subject_trends(facts.questions(spark, root)), "Dairy arrears")


@query("select 'question' as unit, p.session, p.questions, '1' as basis_version, 'Each of ' || (select count(*) from q) || ' questions counts once; ' || (select count(*) filter (len(list_distinct(asking_members)) > 1) from q) || ' of them have several askers, at most ' || (select max(len(list_distinct(asking_members))) from q) || '.' as counting_basis from (select session, count(*) as questions from q group by 1) p")
def counted_with_basis(spark: SparkSession, root: str) -> DataFrame:
    """Rows with the basis on which they are counted."""
    q = facts.questions(spark, root)
    rows = q.groupBy("session").agg(F.count(F.lit(1)).alias("questions")).withColumn("counting_basis_unit", F.lit("question"))
    out = views.with_basis(rows, aggregates.counting_basis(aggregates.counters(q)))
    return out.select(F.col("counting_basis_unit").alias("unit"), "session", "questions", "basis_version", "counting_basis")


@query("select case when count(*) = 0 then 'No House is covered' else 'Lok Sabha only' end as claim from q where house = 'lok-sabha'")
def houses_claim(spark: SparkSession, root: str) -> DataFrame:
    """Q16: which houses are covered, in words."""
    return views.houses_claim(views.coverage(facts.questions(spark, root), ["lok-sabha", "rajya-sabha"]))


@query("select 'rajya-sabha' as house, 'Rajya Sabha' as name, 'no records of this house' as reason where not exists (select 1 from q where house = 'rajya-sabha')")
def uncovered_houses(spark: SparkSession, root: str) -> DataFrame:
    """the houses without questions, and why."""
    return views.uncovered_houses(views.coverage(facts.questions(spark, root), ["lok-sabha", "rajya-sabha"]))


@query("select question_id from terms where term in ('solar', 'fields', 'waste', 'land') group by 1 having count(distinct term) = 4")
def search_written_index(spark: SparkSession, root: str) -> DataFrame:
    """The index written, then a query that reads only its own words' postings."""
    q = facts.questions(spark, root)
    placed = search.positions(q)
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    search.write_index(search.blocked_postings(search.terms(q), placed), placed, path)
    return search.indexed_matches(spark, path, search.parse_query(WORDS))


@query(f"select case when {slug_sql('state')} = {slug_sql('seat')} then {slug_sql('seat')} else {slug_sql('state')} || '-' || {slug_sql('seat')} end as seat_id, count(distinct state) as states from m where seat is not null and len(terms) > 0 group by 1 having count(distinct state) > 1")
def seat_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Seat ids that span two states."""
    return dimensions.seat_conflicts(dimensions.representations(facts.members(spark, root)))


@query(f"select form, count(distinct member_id) as members from (select {present_sql('name_as_written')} as form, lower({present_sql('member_id')}) as member_id from lok_sabha) where form is not null and member_id is not null group by 1 having count(distinct member_id) > 1", star=False)
def assertion_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Forms asserted for several members."""
    from ledgerloom.functions.text import present
    from ledgerloom.operators import resolve

    rows = table(spark, root, "lok_sabha").select(present(F.col("name_as_written")).alias("form"), F.lower(present(F.col("member_id"))).alias("member_id"))
    return resolve.assertion_conflicts(rows.where("form is not null and member_id is not null"))
