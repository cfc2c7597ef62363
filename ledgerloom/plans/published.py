"""Queries over the published star, each with its SQL: text, ingest, dimensions, aggregates, search, views, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.operators import aggregates, dimensions, ingest, publish, quality, search, views
from ledgerloom.plans import facts
from ledgerloom.plans.facts import STAR, canon_tokens_sql, collapse_sql, fold_sql, present_sql, slug_sql, strip_sql, tokens_sql
from ledgerloom.sources.tables import table

QUERIES: dict = {}
ORACLES: dict = {}
TOP = 5
MINISTRY, OTHER = "canal-irrigation", "harbour-works"
WORDS = "solar fields on waste land"


def query(sql: str | None = None, star: bool = True):
    """Registers a query under its function's name, with the SQL it is held against."""

    def take(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (STAR if star else "") + sql
        return f

    return take


# Text


@query(f"select seq, array_to_string({canon_tokens_sql('m')}, ' ') as canon, array_to_string(list_sort({canon_tokens_sql('m')}), ' ') as canon_sorted, place from (select seq, unnest(member) as m, unnest(range(len(member))) as place from shared_ques_no)", star=False)
def text_canon(spark: SparkSession, root: str) -> DataFrame:
    """Canonical forms of every asker as written."""
    rows = table(spark, root, "shared_ques_no").select("seq", F.posexplode("member").alias("at", "m"))
    return rows.select("seq", tx.canon(F.col("m")).alias("canon"), tx.canon_sorted(F.col("m")).alias("canon_sorted"), F.col("at").cast("bigint").alias("place"))


@query(f"select distinct ministry, {slug_sql('ministry')} as slug, {fold_sql('ministry')} as fold from shared_ques_no", star=False)
def text_slug_fold(spark: SparkSession, root: str) -> DataFrame:
    """Slug and fold key of every ministry as typed."""
    rows = table(spark, root, "shared_ques_no").select("ministry").distinct()
    return rows.select("ministry", tx.slug(F.col("ministry")).alias("slug"), tx.fold_key(F.col("ministry")).alias("fold"))


@query(f"select t as term, count(*) as documents from (select unnest({tokens_sql('text')}) as t from documents) group by 1", star=False)
def text_tokens(spark: SparkSession, root: str) -> DataFrame:
    """Document frequency of every search token of the documents."""
    rows = table(spark, root, "documents").select(F.explode(tx.search_tokens(F.col("text"))).alias("term"))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


@query("select distinct constituency, lower(" + collapse_sql("constituency") + ") as name_key, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(constituency, '[^A-Za-z0-9\\-_.]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'not-stated') as part_key, coalesce(lower(" + strip_sql("constituency") + ") in ('', 'not stated'), true) as missing from constituencies", star=False)
def text_keys(spark: SparkSession, root: str) -> DataFrame:
    """Name key, partition key and missingness of every seat as written."""
    c = F.col("constituency")
    rows = table(spark, root, "constituencies").select("constituency").distinct()
    return rows.select("constituency", tx.name_key(c).alias("name_key"), tx.partition_key(c).alias("part_key"), tx.is_missing(c).alias("missing"))


# Ingest


@query(rf"select seq, case when {present_sql('date')} is null then null else regexp_replace({present_sql('date')}, '^(\d\d)\.(\d\d)\.(\d\d\d\d)$', '\3-\2-\1') end as date, 'lok-sabha/' || {present_sql('lokNo')} || '/' || {present_sql('sessionNo')} || '/' || {slug_sql('type')} || '/' || quesNo as question_id, len(list_filter(list_transform(coalesce(member, []), lambda x: {present_sql('x')}), lambda x: x is not null)) as askers from shared_ques_no", star=False)
def ingest_records(spark: SparkSession, root: str) -> DataFrame:
    """Date, identity and askers of every record as served."""
    q = table(spark, root, "shared_ques_no")
    made = ingest.question_id(F.lit("lok-sabha"), F.col("lokNo"), F.col("sessionNo"), F.col("type"), F.col("quesNo"))
    return q.select("seq", ingest.iso_date(F.col("date")).alias("date"), made.alias("question_id"), F.size(ingest.asker_forms(F.col("member"))).cast("bigint").alias("askers"))


_IDENT = f"select *, lower({present_sql('lokNo')}) || '/' || {present_sql('sessionNo')} || '/' || {slug_sql('type')} || '/' || quesNo as qid from shared_ques_no"


def _identified(spark: SparkSession, root: str) -> DataFrame:
    q = table(spark, root, "shared_ques_no")
    parts = [tx.present(F.col("lokNo")), tx.present(F.col("sessionNo")), tx.slug(F.col("type")), F.col("quesNo").cast("string")]
    return q.withColumn("qid", F.concat(parts[0], F.lit("/"), parts[1], F.lit("/"), parts[2], F.lit("/"), parts[3]))


@query(f"select qid, min(seq) as seq, count(*) as copies, arg_min(subjects, seq) as subjects, count(distinct coalesce(subjects, '~') || '|' || coalesce(ministry, '~')) as contents from ({_IDENT}) where qid is not null group by 1", star=False)
def ingest_dedupe(spark: SparkSession, root: str) -> DataFrame:
    """The first record of each question, with its copies and how many contents they have."""
    return ingest.dedupe(_identified(spark, root).where("qid is not null"), ["qid"], ["seq"], ["subjects", "ministry"]).select("qid", "seq", "copies", "subjects", "contents")


@query(f"select qid, count(*) as copies, count(distinct coalesce(subjects, '~') || '|' || coalesce(ministry, '~')) as contents from ({_IDENT}) where qid is not null group by 1 having contents > 1", star=False)
def ingest_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Questions whose records differ."""
    return ingest.conflicting(ingest_dedupe(spark, root), ["qid"])


@query(f"select count(*) as records, count(distinct lokNo || '/' || sessionNo || '/' || quesNo) as old_ids, count(distinct lokNo || '/' || sessionNo || '/' || quesNo || '/' || {slug_sql('type')}) as new_ids from shared_ques_no where lokNo is not null and sessionNo is not null and quesNo is not null", star=False)
def ingest_identity_check(spark: SparkSession, root: str) -> DataFrame:
    """Distinct identities without and with the type."""
    q = table(spark, root, "shared_ques_no").where("lokNo is not null and sessionNo is not null and quesNo is not null").withColumn("kind", tx.slug(F.col("type")))
    return ingest.identity_check(q, ["lokNo", "sessionNo", "quesNo"], ["lokNo", "sessionNo", "quesNo", "kind"])


@query("select unnest(json_keys(props)) as field, count(*) as records from events group by 1", star=False)
def ingest_observed_fields(spark: SparkSession, root: str) -> DataFrame:
    """Keys of the events' JSON."""
    return ingest.observed_fields(table(spark, root, "events"), "props")


@query("with k as (select distinct unnest(json_keys(props)) as f from events), r as (select unnest(['q']) as f) select coalesce(k.f, r.f) as field, case when k.f is null then 'missing' else 'added' end as change, case when k.f is null then 'degraded' else 'notice' end as severity from k full join r on k.f = r.f where k.f is null or r.f is null", star=False)
def ingest_shape_diff(spark: SparkSession, root: str) -> DataFrame:
    """Q01: the events' keys against a recorded shape."""
    return ingest.shape_diff(ingest.observed_fields(table(spark, root, "events"), "props"), ["q"])


@query("select seq, supp.suppNo as suppNo, supp.memberName as memberName from (select seq, unnest(supplementaryQuestionResDtoList) as supp from shared_ques_no)", star=False)
def ingest_allowlist(spark: SparkSession, root: str) -> DataFrame:
    """Only permitted fields, nested ones included; askedOn is not among them."""
    kept = ingest.allowed(table(spark, root, "shared_ques_no"), ["seq", "supplementary_question_res_dto_list", "supp_no", "member name"])
    return kept.select("seq", F.inline("supplementaryQuestionResDtoList"))


@query("select member_id, array_to_string(terms, ',') as terms, coalesce(party, 'not stated') as party, case when seat is null then 'not-stated' when " + slug_sql("state") + " = " + slug_sql("seat") + " then " + slug_sql("seat") + " else " + slug_sql("state") + " || '-' || " + slug_sql("seat") + " end as seat_id from m")
def ingest_members(spark: SparkSession, root: str) -> DataFrame:
    """The roster as published."""
    m = facts.members(spark, root)
    return m.select("member_id", F.array_join("terms", ",").alias("terms"), tx.stated(F.col("party")).alias("party"), ingest.seat_id(F.col("seat"), F.col("state")).alias("seat_id"))


# Dimensions

_OBS = f"obs as (select {present_sql('ministry')} as name, count(*) as observed, min(d) as first_date, max(d) as last_date from (select ministry, right(date, 4) || '-' || substr(date, 4, 2) || '-' || left(date, 2) as d from shared_ques_no) where {present_sql('ministry')} is not null group by 1)"


def _observed(spark: SparkSession, root: str) -> DataFrame:
    q = table(spark, root, "shared_ques_no")
    return dimensions.observations(q.withColumn("day", ingest.iso_date(F.col("date"))), "ministry", "day")


@query(f"with {_OBS} select * from obs", star=False)
def dim_observations(spark: SparkSession, root: str) -> DataFrame:
    """How often and when each ministry name was written."""
    return _observed(spark, root)


_REG = f"{_OBS}, reg as (select {fold_sql('name')} as fold, arg_min(name, (coalesce(first_date, ''), name)) as first_name, arg_max(name, (coalesce(last_date, ''), name)) as canonical_name, list_sort(list(name)) as name_variants from obs group by 1)"


@query(f"with {_REG} select fold, {slug_sql('first_name')} as dimension_id, canonical_name, array_to_string(name_variants, '|') as name_variants, len(name_variants) - 1 as former from reg", star=False)
def dim_registry(spark: SparkSession, root: str) -> DataFrame:
    """One identity a fold group."""
    r = dimensions.registry(_observed(spark, root))
    return r.select("fold", "dimension_id", "canonical_name", F.array_join("name_variants", "|").alias("name_variants"), F.size("former_names").cast("bigint").alias("former"))


@query(f"with {_REG} select fold, array_to_string(list_sort(list(name)), '|') as names from (select {fold_sql('name')} as fold, name, {slug_sql('name')} as s from obs) group by 1 having count(distinct s) > 1", star=False)
def dim_fold_groups(spark: SparkSession, root: str) -> DataFrame:
    """Names that differ by more than case and punctuation and still fold together."""
    return dimensions.fold_groups(_observed(spark, root)).withColumn("names", F.array_join("names", "|"))


_RENAMES = "ren as (select ministry_id as dimension_id, unnest(list_concat([canonical_name], coalesce(former_names, []))) as name from ministries)"


@query(f"""with {_REG}, {_RENAMES}, minted as (select s as minted_id, min(d) as dimension_id from (select {slug_sql('o.name')} as s, {slug_sql('r.first_name')} as d from obs o join reg r on r.fold = {fold_sql('o.name')}) group by 1),
claims as (select distinct {slug_sql('name')} as minted_id, dimension_id as c from ren where {present_sql('name')} is not null),
absorbed as (select dimension_id as a, min(c) as c from minted join claims using (minted_id) where dimension_id <> c group by 1),
every as (select minted_id, coalesce(c, dimension_id) as dimension_id from minted left join absorbed on a = dimension_id)
select distinct coalesce(e.minted_id, c.minted_id) as minted_id, coalesce(c.c, e.dimension_id) as dimension_id from every e full join claims c on c.minted_id = e.minted_id""", star=False)
def dim_renames(spark: SparkSession, root: str) -> DataFrame:
    """Where each minted id leads after the confirmed renames."""
    observed = _observed(spark, root)
    renames = table(spark, root, "ministries").select(F.col("ministry_id").alias("dimension_id"), "canonical_name", "former_names")
    return dimensions.with_renames(dimensions.minted_ids(observed, dimensions.registry(observed)), renames)


@query(f"with {_OBS}, {_RENAMES} select name from obs where name not in (select name from ren where name is not null)", star=False)
def dim_unmapped(spark: SparkSession, root: str) -> DataFrame:
    """Names no confirmed mapping claims."""
    renames = table(spark, root, "ministries").select(F.col("ministry_id").alias("dimension_id"), "canonical_name", "former_names")
    return dimensions.unmapped(_observed(spark, root), renames)


@query("select side, value, others from (select 'source' as side, name as value, count(distinct member_id) as others from m where name is not null group by 2 having others > 1 union all select 'id', member_id, count(distinct name) from m group by 2 having count(distinct name) > 1)")
def dim_bijection(spark: SparkSession, root: str) -> DataFrame:
    """Q04: names of several members."""
    return dimensions.bijection_violations(facts.members(spark, root), "name", "member_id")


@query("select seat_id, min(seat) as name, min(state) as state, count(*) as holders, count(distinct member_id) as members, count(distinct member_id) > 1 as changed_hands from reps group by 1")
def seat_reference(spark: SparkSession, root: str) -> DataFrame:
    """Seats of the window with their holders."""
    return dimensions.seats(facts.seats(spark, root)).withColumn("holders", F.size("holders").cast("bigint"))


@query("select seat_id, member_id, array_to_string(list_sort(list_distinct(list(term))), ',') as terms, count(distinct member_id) over (partition by seat_id) > 1 as changed_hands from reps group by seat_id, member_id")
def seat_history(spark: SparkSession, root: str) -> DataFrame:
    """Who held each seat in which terms."""
    return views.seat_history(facts.seats(spark, root)).withColumn("terms", F.array_join("terms", ","))


ORACLES["seat_history"] = STAR + "select seat_id, member_id, terms, changed_hands from (select seat_id, member_id, array_to_string(list_sort(list_distinct(list(term))), ',') as terms from reps group by 1, 2) join (select seat_id, count(distinct member_id) > 1 as changed_hands from reps group by 1) using (seat_id)"


@query("select member_id, arg_max(state, (seat_id, term)) as state from reps where state is not null group by 1")
def member_state_map(spark: SparkSession, root: str) -> DataFrame:
    """The state of each member by the last seat."""
    return dimensions.member_states(facts.seats(spark, root))


@query(r"select distinct session, cast(split_part(session, '/', 2) as int) as term, cast(split_part(session, '/', 3) as int) as number from q where regexp_matches(session, '^[^/]+/\d+/\d+$')")
def session_reference(spark: SparkSession, root: str) -> DataFrame:
    """The sessions that carry questions."""
    return dimensions.sessions(facts.questions(spark, root))


@query("select seat_id, min(seat) as name, min(state) as state from reps group by 1 having lower(" + collapse_sql("min(state)") + ") = 'belmoria'")
def seats_of_state(spark: SparkSession, root: str) -> DataFrame:
    """seats of one state."""
    return views.seats_in_state(dimensions.seats(facts.seats(spark, root)), " Belmoria ").select("seat_id", "name", "state")


@query("select state, count(distinct seat_id) as seats, count(distinct member_id) as members from reps group by 1")
def state_listing(spark: SparkSession, root: str) -> DataFrame:
    """Seats and members by state."""
    return views.states_in(facts.seats(spark, root))


@query("select name, state, seat_id from (select seat_id, min(seat) as name, min(state) as state from reps group by 1) where contains(lower(" + collapse_sql("name") + "), 'south') order by case when lower(" + collapse_sql("name") + ") = 'south' then 0 else 1 end, name, state nulls first, seat_id limit 12")
def substring_match(spark: SparkSession, root: str) -> DataFrame:
    """the first seats whose name contains a text."""
    return views.seats_matching(dimensions.seats(facts.seats(spark, root)), "South").select("name", "state", "seat_id")


# Aggregates

_COMP = "comp as (select dimension, category, count(distinct member_id) as members from (select member_id, unnest([{'dimension': 'party', 'category': coalesce(party, 'not stated')}, {'dimension': 'state', 'category': coalesce(state, 'not stated')}, {'dimension': 'terms_served', 'category': cast(len(terms) as varchar)}], recursive := true) from m where list_contains(terms, 17)) group by all)"


@query(f", {_COMP} select 17 as term, dimension, category, members, (select count(*) from m where list_contains(terms, 17)) as total_members from comp")
def composition(spark: SparkSession, root: str) -> DataFrame:
    """Members of a term by party, state and terms served."""
    return aggregates.composition(facts.members(spark, root), 17)


@query("select coalesce(party, 'not stated') as party, coalesce(state, 'not stated') as state, cast(len(terms) as int) as terms_served, count(*) as members from m where list_contains(terms, 17) group by grouping sets ((1), (2), (3))")
def composition_grouping_sets(spark: SparkSession, root: str) -> DataFrame:
    """The same by grouping sets."""
    return aggregates.composition_sets(facts.members(spark, root), 17)


@query(f", {_COMP}, t as (select count(*) as n from m where list_contains(terms, 17)) select 17 as term, dimension, cast(sum(members) as bigint) as members, n as total_members from comp, t group by dimension, n having sum(members) <> n")
def composition_reconcile(spark: SparkSession, root: str) -> DataFrame:
    """Q09: dimensions that do not add up: none."""
    return aggregates.unreconciled(composition(spark, root))


@query(f", {_COMP} select dimension, category, cast(sum(members) as bigint) as members from (select dimension, case when row_number() over (partition by dimension order by members desc, category) <= 3 then category else 'others' end as category, members from comp) group by all")
def composition_top(spark: SparkSession, root: str) -> DataFrame:
    """The first three categories of each dimension and the rest."""
    return aggregates.top_and_rest(composition(spark, root), ["dimension"], 3)


@query("select subject, session, count(*) as questions from q group by all")
def subject_trends(spark: SparkSession, root: str) -> DataFrame:
    """Questions by subject and session."""
    return aggregates.subject_trends(facts.questions(spark, root))


@query("select * from prof")
def ministry_profile(spark: SparkSession, root: str) -> DataFrame:
    """Questions and statuses by ministry and session."""
    return aggregates.ministry_profile(facts.questions(spark, root))


@query("select ministry_id, session, type, count(*) as questions from q group by all")
def type_mix(spark: SparkSession, root: str) -> DataFrame:
    """Types by ministry and session."""
    return aggregates.type_mix(facts.questions(spark, root))


@query(f"select state, subject, questions, state_questions, state_subjects, cast(least({TOP}, state_subjects) as int) as subjects_shown, cast(place as int) as place from (select *, row_number() over (partition by state order by questions desc, subject) as place, count(*) over (partition by state) as state_subjects from (select state, subject, count(*) as questions from pairs group by all)) join (select state, count(distinct question_id) as state_questions from pairs group by 1) using (state) where place <= {TOP}")
def state_subjects_topn(spark: SparkSession, root: str) -> DataFrame:
    """The most frequent subjects of each state, with denominators."""
    return aggregates.state_subjects(aggregates.attributed(facts.questions(spark, root), facts.states(spark, root)), TOP)


@query("select count(*) as questions, count(*) filter (n is null) as unattributable, count(*) filter (n > 1) as multi_state from q left join (select question_id, count(*) as n from pairs group by 1) using (question_id)")
def state_counters(spark: SparkSession, root: str) -> DataFrame:
    """Questions no state can be given, and those of several."""
    q = facts.questions(spark, root)
    return aggregates.attribution_counters(q, aggregates.attributed(q, facts.states(spark, root)))


@query("select count(*) as questions, count(*) filter (resolution_status = 'unresolved') as unresolved, count(*) filter (resolution_status = 'unresolved' and len(asking_members) > 0) as partly_resolved, count(*) filter (len(list_distinct(asking_members)) > 1) as co_asked, max(len(list_distinct(asking_members))) as max_askers, count(distinct session) as sessions, min(date) as first_date, max(date) as last_date from q")
def global_counters(spark: SparkSession, root: str) -> DataFrame:
    """Counters of the window."""
    return aggregates.counters(facts.questions(spark, root)).withColumn("max_askers", F.col("max_askers").cast("bigint"))


@query("select 'question' as unit, '1' as basis_version, 'Each of ' || count(*) || ' questions counts once; ' || count(*) filter (len(list_distinct(asking_members)) > 1) || ' of them have several askers, at most ' || max(len(list_distinct(asking_members))) || '.' as counting_basis from q union all select 'member', '1', 'Each member of a term counts once in every dimension, under ''not stated'' where a value is missing.' union all select 'state-question', '1', 'A question counts once for each state of its identified askers; ' || count(*) filter (resolution_status = 'unresolved') || ' unresolved ones may count for none.' from q")
def counting_basis(spark: SparkSession, root: str) -> DataFrame:
    """Q15: how each unit is counted, in words with live figures."""
    return aggregates.counting_basis(aggregates.counters(facts.questions(spark, root)))


# Search


@query("select term, question_id from terms")
def index_terms(spark: SparkSession, root: str) -> DataFrame:
    """The inverted index as rows."""
    return search.terms(facts.questions(spark, root))


_POS = "pos as (select question_id, row_number() over (order by p, question_id) - 1 as position, p as prefix, n as number from (select question_id, regexp_extract(question_id, '^(.*)/[^/]*$', 1) as p, split_part(question_id, '/', -1) as n from q))"


@query(f", {_POS} select term, array_to_string(list(position order by position), ',') as postings from terms join pos using (question_id) group by 1")
def index_postings(spark: SparkSession, root: str) -> DataFrame:
    """The ascending positions of each term."""
    q = facts.questions(spark, root)
    return search.postings(search.terms(q), search.positions(q)).withColumn("postings", F.array_join("postings", ","))


@query(f", {_POS}, d as (select term, position - coalesce(lag(position) over (partition by term order by position), 0) as step, position from terms join pos using (question_id)) select term, array_to_string(list(step order by position), ',') as steps from d group by 1")
def index_delta_encoded(spark: SparkSession, root: str) -> DataFrame:
    """The postings as steps."""
    q = facts.questions(spark, root)
    return search.postings(search.terms(q), search.positions(q)).select("term", F.array_join(search.delta(F.col("postings")), ",").alias("steps"))


@query(f", {_POS} select term, position from terms join pos using (question_id)")
def index_delta_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Every posting, decoded from the blocks of steps."""
    q = facts.questions(spark, root)
    return search.decoded(search.blocked_postings(search.terms(q), search.positions(q)))


@query(f", {_POS} select prefix, row_number() over (order by min(position)) - 1 as place, count(*) as documents from pos group by 1")
def index_prefix_dictionary(spark: SparkSession, root: str) -> DataFrame:
    """Id prefixes in the order of their first document."""
    return search.prefix_dictionary(search.positions(facts.questions(spark, root))).withColumn("place", F.col("place").cast("bigint"))


@query("select count(distinct term) as terms, count(*) as postings, (select count(*) from q) as documents from terms")
def index_stats(spark: SparkSession, root: str) -> DataFrame:
    """Size of the index."""
    q = facts.questions(spark, root)
    return search.index_stats(search.terms(q), q)


@query("select question_id from terms where term in ('solar', 'fields', 'waste', 'land') group by 1 having count(distinct term) = 4")
def search_and(spark: SparkSession, root: str) -> DataFrame:
    """Questions that have all words."""
    return search.matches(search.terms(facts.questions(spark, root)), search.parse_query(WORDS))


@query("select w as term from (select unnest(['solar', 'xylophones']) as w) where w not in (select term from terms)")
def search_missing_words(spark: SparkSession, root: str) -> DataFrame:
    """Words of a query no question has."""
    return search.missing_words(search.terms(facts.questions(spark, root)), search.parse_query("solar xylophones of the"))


@query("select session, count(*) as hits from q where question_id in (select question_id from terms where term in ('solar', 'fields') group by 1 having count(distinct term) = 2) group by 1")
def search_session_buckets(spark: SparkSession, root: str) -> DataFrame:
    """Hits by session."""
    q = facts.questions(spark, root)
    return search.session_buckets(search.matches(search.terms(q), search.parse_query("solar fields")), q)


_PAGE = r"select question_id, session, date, subject from (select *, row_number() over (order by try_cast(split_part(session, '/', 2) as int) desc nulls last, try_cast(split_part(session, '/', 3) as int) desc nulls last, case when regexp_matches(date, '^\d{4}-\d{2}-\d{2}$') then date end desc nulls last, try_cast(split_part(question_id, '/', -1) as int) nulls last, question_id) as place from q where question_id in (select question_id from terms where term = 'solar')) "


@query(_PAGE + "where place <= 25")
def search_page1(spark: SparkSession, root: str) -> DataFrame:
    """The first page of hits."""
    q = facts.questions(spark, root)
    return search.page(search.matches(search.terms(q), search.parse_query("solar")), search.digest(q)).select("question_id", "session", "date", "subject")


@query(_PAGE + "where place between 26 and 50")
def search_page2(spark: SparkSession, root: str) -> DataFrame:
    """The page after the first one's last row."""
    q = facts.questions(spark, root)
    found, digest = search.matches(search.terms(q), search.parse_query("solar")), search.digest(q)
    first = search.page(found, digest).select("__key").collect()  # one page: 25 rows
    if len(first) < search.PAGE:
        return search.page(found, digest).limit(0).select("question_id", "session", "date", "subject")
    return search.page(found, digest, tuple(first[-1][0])).select("question_id", "session", "date", "subject")


@query("select member_id, count(*) as questions from (select distinct question_id, member_id from bridge) where member_id not in (select member_id from m) group by 1")
def unknown_askers(spark: SparkSession, root: str) -> DataFrame:
    """Asker ids without a roster row."""
    return search.unknown_askers(facts.questions(spark, root), facts.members(spark, root))


# Views


@query("select question_id from q where session = 'lok-sabha/17/4'")
def extract_session(spark: SparkSession, root: str) -> DataFrame:
    """One session."""
    return views.extract(facts.questions(spark, root), session="lok-sabha/17/4").select("question_id")


@query(f"select question_id from q where ministry_id = '{MINISTRY}'")
def extract_ministry(spark: SparkSession, root: str) -> DataFrame:
    """One ministry."""
    return views.extract(facts.questions(spark, root), ministry=MINISTRY).select("question_id")


@query("select question_id from q where list_contains(asking_members, 'ls-0000052')")
def extract_member(spark: SparkSession, root: str) -> DataFrame:
    """One member."""
    return views.extract(facts.questions(spark, root), member="ls-0000052").select("question_id")


@query("select distinct question_id from bridge join m using (member_id) where lower(" + collapse_sql("m.state") + ") = 'goluvana'")
def extract_state(spark: SparkSession, root: str) -> DataFrame:
    """Questions of a state's members."""
    return views.extract(facts.questions(spark, root), facts.members(spark, root), state="Goluvana").select("question_id")


@query("select distinct question_id from bridge join m using (member_id) where lower(" + collapse_sql("m.seat") + ") = 'pebagadh west'")
def extract_constituency(spark: SparkSession, root: str) -> DataFrame:
    """Questions of a seat's members."""
    members = facts.members(spark, root).withColumnRenamed("seat", "constituency")
    return views.extract(facts.questions(spark, root), members, constituency="Pebagadh West").select("question_id")


_DENSE = f"dense as (select s.session, coalesce(questions, 0) as questions, coalesce(fully_linked, 0) as fully_linked, coalesce(partly_linked, 0) as partly_linked, coalesce(not_linked, 0) as not_linked, coalesce(ambiguous, 0) as ambiguous from (select distinct session from q where regexp_matches(session, '^[^/]+/\\d+/\\d+$') and cast(split_part(session, '/', 2) as int) * 1000 + cast(split_part(session, '/', 3) as int) between 17003 and 18002) s left join (select * from prof where ministry_id = '{MINISTRY}') p on p.session = s.session)"


def _dense(spark: SparkSession, root: str) -> DataFrame:
    q = facts.questions(spark, root)
    span = views.in_span(dimensions.sessions(q), (18, 2), (17, 3))
    return views.dense_span(aggregates.ministry_profile(q), span, MINISTRY)


@query(f", {_DENSE} select * from dense")
def profile_span_dense(spark: SparkSession, root: str) -> DataFrame:
    """A ministry over a span, zeros included."""
    return _dense(spark, root)


@query(f", {_DENSE} select cast(sum(questions) as bigint) as questions, cast(sum(fully_linked) as bigint) as fully_linked, cast(sum(partly_linked) as bigint) as partly_linked, cast(sum(not_linked) as bigint) as not_linked, cast(sum(ambiguous) as bigint) as ambiguous, count(*) as sessions, count(*) filter (questions > 0) as sessions_with_questions, true as balanced from dense")
def span_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals of the span."""
    return views.span_totals(_dense(spark, root))


@query(f", {_DENSE}, e as (select arg_min(questions, (cast(split_part(session, '/', 2) as int), cast(split_part(session, '/', 3) as int))) as a, arg_max(questions, (cast(split_part(session, '/', 2) as int), cast(split_part(session, '/', 3) as int))) as b, count(*) as n from dense) select a as first_questions, b as last_questions, b - a as difference, round((b - a) * 100.0 / nullif(a, 0), 4) as percent, n = 1 as single_session from e")
def span_change(spark: SparkSession, root: str) -> DataFrame:
    """First against last session."""
    return views.span_change(_dense(spark, root))


@query(f"select type, cast(coalesce(sum(n) filter (ministry_id = '{MINISTRY}'), 0) as bigint) as first_questions, cast(coalesce(sum(n) filter (ministry_id = '{OTHER}'), 0) as bigint) as second_questions from (select ministry_id, type, count(*) as n from q where ministry_id in ('{MINISTRY}', '{OTHER}') group by all) group by 1")
def compare_two(spark: SparkSession, root: str) -> DataFrame:
    """Two ministries side by side."""
    return views.compare(aggregates.type_mix(facts.questions(spark, root)), MINISTRY, OTHER)


@query(f"select count(*) as questions, count(*) filter (b = 'fully_linked') as fully_linked, count(*) filter (b = 'partly_linked') as partly_linked, count(*) filter (b = 'not_linked') as not_linked, count(*) filter (b = 'ambiguous') as ambiguous, count(*) filter (b is null) as unknown_status from (select {facts.BUCKET_SQL} as b from q where list_contains(asking_members, 'ls-0000052'))")
def member_questions(spark: SparkSession, root: str) -> DataFrame:
    """A member's questions by status."""
    return views.member_questions(facts.questions(spark, root), "ls-0000052")


@query("select subject, count(*) as questions from q group by 1 order by 2 desc, 1 nulls last limit 20")
def subject_tally(spark: SparkSession, root: str) -> DataFrame:
    """The most frequent subjects."""
    return views.subject_tally(facts.questions(spark, root), 20)


@query("select question_id, date from q order by date desc nulls last, question_id desc limit 20")
def newest_questions(spark: SparkSession, root: str) -> DataFrame:
    """The newest questions."""
    return views.newest(facts.questions(spark, root), 20).select("question_id", "date")


@query("select 'lok-sabha' as house, true as covered, count(*) as questions, count(*) filter (resolution_status = 'resolved') as resolved, round(count(*) filter (resolution_status = 'resolved') / count(*), 6) as rate, count(*) filter (resolution_status = 'resolved') / count(*) >= 0.95 as meets_target, min(date) as first_date, max(date) as last_date, null as reason from q where house = 'lok-sabha' union all select 'rajya-sabha', false, 0, 0, 0.0, false, null, null, 'no records of this house'")
def coverage_rows(spark: SparkSession, root: str) -> DataFrame:
    """Coverage by house, uncovered ones included."""
    return views.coverage(facts.questions(spark, root), ["lok-sabha", "rajya-sabha"])


@query("select session, questions, sitting_days, round(questions / nullif(sitting_days, 0), 4) as per_day, coalesce(sitting_days = 0, false) as zero_days from (select session, count(*) as questions, any_value(case when session = 'lok-sabha/17/1' then 37 when session = 'lok-sabha/17/2' then 0 end) as sitting_days from q where regexp_matches(session, '^[^/]+/\\d+/\\d+$') group by 1)")
def per_day_rate(spark: SparkSession, root: str) -> DataFrame:
    """Questions per sitting day; a recorded zero is no gap."""
    q = facts.questions(spark, root)
    rows = dimensions.sitting_days(dimensions.sessions(q), {(17, 1): 37, (17, 2): 0})
    counted = rows.join(q.groupBy("session").agg(F.count(F.lit(1)).alias("questions")), "session")
    return views.per_day(counted).select("session", "questions", "sitting_days", "per_day", "zero_days")


@query("select p.ministry_id, session, questions, coalesce(canonical_name, p.ministry_id) as canonical_name from prof p left join ministries d on d.ministry_id = p.ministry_id")
def profile_named(spark: SparkSession, root: str) -> DataFrame:
    """The profile with names, or ids where there is none."""
    names = table(spark, root, "ministries").select("ministry_id", "canonical_name")
    return views.with_names(aggregates.ministry_profile(facts.questions(spark, root)).select("ministry_id", "session", "questions"), names, "ministry_id", "canonical_name")


# Audits


@query("select p.ministry_id, p.session, p.questions as left_value, r.n as right_value from prof p full join (select ministry_id, session, count(distinct question_id) as n from q group by all) r on r.ministry_id = p.ministry_id and r.session is not distinct from p.session where p.questions is distinct from r.n")
def report_recount_diff(spark: SparkSession, root: str) -> DataFrame:
    """Published counts against a recount from the raw rows: no difference."""
    q = facts.questions(spark, root)
    again = views.recount(views.first_of_each(q).select("question_id", "ministry_id", "session"))
    return views.differences(aggregates.ministry_profile(q), again, ["ministry_id", "session"], "questions")


@query("select ministry_id, session, questions, 0 as counted from prof where false")
def status_sum_violations(spark: SparkSession, root: str) -> DataFrame:
    """Q10: profile rows that do not add up: those without a status."""
    return quality.status_sum_violations(aggregates.ministry_profile(facts.questions(spark, root)))


ORACLES["status_sum_violations"] = STAR + "select ministry_id, session, questions, fully_linked + partly_linked + not_linked + ambiguous as counted from prof where counted <> questions"


@query("select question_id, 'resolved-without-asker' as rule from q where resolution_status = 'resolved' and len(asking_members) = 0 union all select question_id, 'ambiguous-with-asker' from q where resolution_status = 'ambiguous' and len(asking_members) > 0 union all select question_id, 'unknown-status' from q where coalesce(resolution_status, '') not in ('resolved', 'unresolved', 'ambiguous')")
def invariant_violations(spark: SparkSession, root: str) -> DataFrame:
    """Q05: questions that contradict themselves."""
    return quality.question_violations(facts.questions(spark, root))


@query("select member_id, count(*) as joins from bridge where member_id not in (select member_id from m) group by 1")
def verify_joins(spark: SparkSession, root: str) -> DataFrame:
    """Joins that no roster row backs."""
    bridge = facts.questions(spark, root).select("question_id", F.explode("asking_members").alias("member_id"))
    return quality.unaudited(bridge, facts.members(spark, root))


@query("select q.question_id, 'resolved' as was, p.resolution_status as now from q join (select question_id, arg_max(resolution_status, (last_refreshed, coalesce(resolution_status, ''))) as resolution_status from questions_published where question_id is not null group by 1) p using (question_id) where q.resolution_status = 'resolved' and p.resolution_status is distinct from 'resolved'")
def transitions_out(spark: SparkSession, root: str) -> DataFrame:
    """Q03: questions resolved in their first copy and no longer in their last."""
    last = table(spark, root, "questions_published").where("question_id is not null").groupBy("question_id").agg(F.max_by("resolution_status", F.struct("last_refreshed", F.coalesce("resolution_status", F.lit("")))).alias("resolution_status"))
    return quality.transitions_out(facts.questions(spark, root), last)


@query("select session as axis, count(*) as records from q group by 1")
def partition_counts(spark: SparkSession, root: str) -> DataFrame:
    """Records by partition of the session axis."""
    counts = publish.partition_counts(facts.questions(spark, root), "session")
    return counts.select(F.regexp_replace("part_key", "-(?=[0-9]+-[0-9]+$)|(?<=[0-9])-", "/").alias("axis"), "records")


@query("select question_id, array_to_string(asking_members, '|') as asking_members, coalesce(subject, '') as subject from q where len(list_distinct(asking_members)) = len(asking_members)")
def publish_text_projection(spark: SparkSession, root: str) -> DataFrame:
    """Questions as CSV text."""
    return publish.text_projection(facts.questions(spark, root), ["question_id", "asking_members", "subject"])


ORACLES["publish_text_projection"] = STAR + "select question_id, coalesce(array_to_string(list_transform(list_filter(list_zip(asking_members, range(len(asking_members))), lambda z: list_position(asking_members, z[1]) = z[2] + 1), lambda z: z[1]), '|'), '') as asking_members, coalesce(subject, '') as subject from q"
