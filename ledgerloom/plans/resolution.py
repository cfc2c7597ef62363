"""Queries of the resolution cascade on the question records and the roster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import resolve
from ledgerloom.plans import facts
from ledgerloom.plans.facts import canon_tokens_sql, present_sql

_C = canon_tokens_sql
CASCADE = f"""
with mentions as (select seq, scope, unnest(range(len(f))) as at, unnest(f) as form from (select seq, {present_sql("lokNo")} as scope, list_filter(list_transform(coalesce(member, []), lambda x: {present_sql("x")}), lambda x: x is not null) as f from shared_ques_no)),
forms as (select scope, form, array_to_string({_C("form")}, ' ') as n, array_to_string(list_sort({_C("form")}), ' ') as r, list_sort(list_distinct({_C("form")})) as t from (select distinct scope, form from mentions where scope is not null)),
pool as (select distinct scope, member_id, written, array_to_string({_C("written")}, ' ') as n, array_to_string(list_sort({_C("written")}), ' ') as r, list_sort(list_distinct({_C("written")})) as t from (
  select cast(unnest(list_distinct(list_transform(list_filter(string_split(lsExpr, ','), lambda x: regexp_matches(x, '^\\s*\\d+\\s*$')), lambda x: cast(trim(x) as int)))) as varchar) as scope,
         lower({present_sql("memberId")}) as member_id, {present_sql("memberName")} as written from constituencies) where written is not null and member_id is not null),
t1 as (select f.scope, f.form, list_sort(list(distinct p.member_id)) as c from forms f join pool p on p.scope = f.scope and p.written = f.form group by all),
t2 as (select f.scope, f.form, list_sort(list(distinct p.member_id)) as c from forms f join pool p on p.scope = f.scope and p.n = f.n where f.n <> '' group by all),
t3 as (select f.scope, f.form, list_sort(list(distinct p.member_id)) as c from forms f join pool p on p.scope = f.scope and p.r = f.r where f.r <> '' group by all),
base as (select f.scope, f.form, f.t, coalesce(t1.c, t2.c, t3.c, []) as c, case when t1.c is not null then 'exact' when t2.c is not null then 'normalised' when t3.c is not null then 'normalised-reordered' end as method
  from forms f left join t1 on t1.scope = f.scope and t1.form = f.form left join t2 on t2.scope = f.scope and t2.form = f.form left join t3 on t3.scope = f.scope and t3.form = f.form),
ft as (select scope, form, len(t) as na, unnest(t) as tok from base where len(c) <> 1),
sets as (select distinct scope, t, array_to_string(t, ' ') as k, len(t) as nb from pool where len(t) > 0),
st as (select scope, k, nb, unnest(t) as tok from sets),
ov as (select ft.scope, ft.form, na, nb, k, count(*) as sh from ft join st on st.scope = ft.scope and st.tok = ft.tok group by all),
t5 as (select o.scope, o.form, list_sort(list(distinct p.member_id)) as c from ov o join pool p on p.scope = o.scope and array_to_string(p.t, ' ') = o.k where na <> nb and sh = least(na, nb) group by all having len(c) = 1),
outcome as (select b.scope, b.form, coalesce(t5.c, b.c) as c, case when t5.c is not null then 'token-containment' else b.method end as method from base b left join t5 on t5.scope = b.scope and t5.form = b.form),
res as (select scope, form, case len(c) when 0 then 'unresolved' when 1 then 'resolved' else 'ambiguous' end as status, method, case when len(c) = 1 then c[1] end as member_id, case when len(c) > 1 then array_to_string(c, '|') else '' end as candidates from outcome),
said as (select {present_sql("name_as_written")} as form, min(lower({present_sql("member_id")})) as m from lok_sabha where {present_sql("name_as_written")} is not null and {present_sql("member_id")} is not null group by 1 having count(distinct lower({present_sql("member_id")})) = 1),
over as (select scope, r.form, case when m is not null then 'resolved' else status end as status, case when m is not null then 'manual-assertion' else method end as method, coalesce(m, member_id) as member_id, case when m is not null then '' else candidates end as candidates, case when m is not null then 'maintainer' else 'automatic' end as asserted_by from res r left join said s on s.form = r.form),
qs as (select s.seq, count(m.form) as n, coalesce(bool_or(m.form is not null and coalesce(o.status, 'unresolved') = 'unresolved'), false) as u, coalesce(bool_or(o.status = 'ambiguous'), false) as a,
  list(o.member_id order by m.at) filter (o.status = 'resolved') as ids from shared_ques_no s left join mentions m on m.seq = s.seq left join over o on o.scope = m.scope and o.form = m.form group by 1),
qa as (select s.seq, count(m.form) as n, coalesce(bool_or(m.form is not null and coalesce(o.status, 'unresolved') = 'unresolved'), false) as u, coalesce(bool_or(o.status = 'ambiguous'), false) as a
  from shared_ques_no s left join mentions m on m.seq = s.seq left join res o on o.scope = m.scope and o.form = m.form group by 1)
"""


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("candidates", F.array_join("candidates", "|"))


def _tier(form_key: str, pool_key: str):
    def run(spark: SparkSession, root: str) -> DataFrame:
        forms = resolve.distinct_forms(facts.mentions(spark, root).where("scope is not null"))
        return _flat(resolve.key_tier(forms, resolve.pool_keys(facts.pool(spark, root)), form_key, pool_key))

    return run


def resolve_containment(spark: SparkSession, root: str) -> DataFrame:
    """Members whose tokens hold, or are held by, a form's."""
    forms = resolve.distinct_forms(facts.mentions(spark, root).where("scope is not null"))
    return _flat(resolve.containment_tier(forms, resolve.pool_keys(facts.pool(spark, root))))


def resolve_cascade(spark: SparkSession, root: str) -> DataFrame:
    """The tiers in order, without the approximate one."""
    return _flat(facts.outcomes(spark, root)).drop("score")


def resolve_approximate(spark: SparkSession, root: str) -> DataFrame:
    """The whole cascade with the approximate tier (its ratio has no SQL equivalent)."""
    return _flat(facts.outcomes(spark, root, approximate=True))


def resolve_overlay(spark: SparkSession, root: str) -> DataFrame:
    """Outcomes under the maintainers' assertions."""
    return _flat(resolve.overlay(facts.outcomes(spark, root), facts.asserted(spark, root))).drop("score")


def resolve_overrides(spark: SparkSession, root: str) -> DataFrame:
    """Assertions against a different automatic match."""
    return resolve.overrides(facts.outcomes(spark, root), facts.asserted(spark, root))


def resolve_told_apart(spark: SparkSession, root: str) -> DataFrame:
    """What tells the candidates of ambiguous forms apart."""
    members = facts.members(spark, root).withColumnRenamed("seat", "constituency")
    out = resolve.told_apart(facts.outcomes(spark, root), members, ["constituency", "party", "state"])
    return out.withColumn("distinguished_on", F.array_join("distinguished_on", "|"))


def _bridge(spark: SparkSession, root: str) -> DataFrame:
    from ledgerloom.sources.tables import table

    every = table(spark, root, "shared_ques_no").select(F.col("seq").alias("question_id"))
    return every.join(facts.mentions(spark, root).withColumnRenamed("seq", "question_id"), "question_id", "left")


def question_status(spark: SparkSession, root: str) -> DataFrame:
    """Status and members of every question record, with assertions."""
    out = resolve.overlay(facts.outcomes(spark, root), facts.asserted(spark, root))
    made = resolve.question_status(_bridge(spark, root), out)
    return made.select(F.col("question_id").alias("seq"), "resolution_status", F.array_join("asking_members", "|").alias("asking_members"))


def resolution_rates(spark: SparkSession, root: str) -> DataFrame:
    """Rates per question, without and with assertions."""
    plain = facts.outcomes(spark, root)
    bridge = _bridge(spark, root)
    return resolve.rates(resolve.question_status(bridge, plain), resolve.question_status(bridge, resolve.overlay(plain, facts.asserted(spark, root))))


def resolve_audit(spark: SparkSession, root: str) -> DataFrame:
    """Q06: one audit row a form."""
    mentions = facts.mentions(spark, root).where("scope is not null").select("scope", "form", "seq", F.col("seq").cast("string").alias("ref"))
    return _flat(resolve.audit(resolve.overlay(facts.outcomes(spark, root), facts.asserted(spark, root)), mentions))


QUERIES = {
    "resolve_exact": _tier("form", "written"),
    "resolve_normalised": _tier("normalised", "normalised"),
    "resolve_reordered": _tier("reordered", "reordered"),
    "resolve_containment": resolve_containment,
    "resolve_cascade": resolve_cascade,
    "resolve_approximate": resolve_approximate,
    "resolve_overlay": resolve_overlay,
    "resolve_overrides": resolve_overrides,
    "resolve_told_apart": resolve_told_apart,
    "question_status": question_status,
    "resolution_rates": resolution_rates,
    "resolve_audit": resolve_audit,
}

_STATUS = "case when n = 0 or u then 'unresolved' when a then 'ambiguous' else 'resolved' end"
_FIRSTS = "array_to_string(list_transform(list_filter(list_zip(ids, range(len(ids))), lambda z: list_position(ids, z[1]) = z[2] + 1), lambda z: z[1]), '|')"
ORACLES = {
    "resolve_exact": CASCADE + "select scope, form, array_to_string(c, '|') as candidates from t1",
    "resolve_normalised": CASCADE + "select scope, form, array_to_string(c, '|') as candidates from t2",
    "resolve_reordered": CASCADE + "select scope, form, array_to_string(c, '|') as candidates from t3",
    "resolve_cascade": CASCADE + "select * from res",
    "resolve_overlay": CASCADE + "select * from over",
    "resolve_overrides": CASCADE + "select scope, r.form, member_id as automatic, m as asserted from res r join said s on s.form = r.form where status = 'resolved' and member_id <> m",
    "question_status": CASCADE + f"select seq, {_STATUS} as resolution_status, case when not (n = 0 or u) and a then '' else coalesce({_FIRSTS}, '') end as asking_members from qs",
    "resolution_rates": CASCADE + f", r as (select (select count(*) from qa where {_STATUS} = 'resolved') as resolved_automatic, (select count(*) from qs where {_STATUS} = 'resolved') as resolved_assisted, (select count(*) from qs) as total) select *, round(resolved_automatic / total, 6) as automatic_rate, round(resolved_assisted / total, 6) as assisted_rate from r",
    "resolve_audit": CASCADE + "select o.scope, o.form as name_as_written, member_id, status, method, candidates, source_record_ref, asserted_by from over o join (select scope, form, cast(min(seq) as varchar) as source_record_ref from mentions group by all) f on f.scope = o.scope and f.form = o.form",
    "resolve_containment": CASCADE.replace("from base where len(c) <> 1", "from base where true").replace("group by all having len(c) = 1", "group by all") + "select scope, form, array_to_string(c, '|') as candidates from t5",
}
