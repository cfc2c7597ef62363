"""Published aggregates over questions and members.

A question is counted once whatever its askers; attributions to states are distinct (question, state) pairs. All group-bys combine on the
map side; top-N uses a window with a group limit, so no group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import stated

DIMENSIONS = ("party", "state", "terms_served")


class UnsupportedDimension(ValueError):
    """A composition was asked for by an attribute that is not published."""


def bucket(status: Column, askers: Column) -> Column:
    """fully_linked, partly_linked, not_linked or ambiguous; null without a status."""
    return (
        F.when(status == "resolved", "fully_linked")
        .when(status == "ambiguous", "ambiguous")
        .when((status == "unresolved") & (F.coalesce(F.size(askers), F.lit(0)) > 0), "partly_linked")
        .when(status == "unresolved", "not_linked")
    )


def composition(members: DataFrame, term: int, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Members of a term by each dimension: term, dimension, category, members, total_members.

    ``members`` has member_id, party, state and terms; each member counts once. One pass: the dimensions are unpivoted in the row.
    """
    if bad := [d for d in dimensions if d not in DIMENSIONS]:
        raise UnsupportedDimension(", ".join(bad))
    own = members.where(F.exists("terms", lambda t: t == term))
    value = {"party": stated(F.col("party")), "state": stated(F.col("state")), "terms_served": F.size("terms").cast("string")}
    rows = own.select("member_id", F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), value[d].alias("category")) for d in dimensions])).alias("x"))
    counted = rows.select("member_id", "x.*").groupBy("dimension", "category").agg(F.countDistinct("member_id").alias("members"))
    total = own.agg(F.countDistinct("member_id").alias("total_members"))
    return counted.join(F.broadcast(total)).select(F.lit(term).alias("term"), "dimension", "category", "members", "total_members")


def composition_sets(members: DataFrame, term: int) -> DataFrame:
    """A05 by grouping sets: party, state, terms_served (one of them per row), members."""
    own = members.where(F.exists("terms", lambda t: t == term)).select("member_id", stated(F.col("party")).alias("party"), stated(F.col("state")).alias("state"), F.size("terms").alias("terms_served"))
    sets = own.groupingSets([[F.col("party")], [F.col("state")], [F.col("terms_served")]], F.col("party"), F.col("state"), F.col("terms_served"))
    return sets.agg(F.count(F.lit(1)).alias("members"))


def unreconciled(composed: DataFrame) -> DataFrame:
    """Q09: dimensions whose members do not add up to the total: none, if all is well."""
    sums = composed.groupBy("term", "dimension").agg(F.sum("members").alias("members"), F.max("total_members").alias("total_members"))
    return sums.where("members <> total_members")


def subject_trends(questions: DataFrame) -> DataFrame:
    """Subject, session, questions; each question once, subjects as they are written."""
    return questions.groupBy("subject", "session").agg(F.countDistinct("question_id").alias("questions"))


def ministry_profile(questions: DataFrame) -> DataFrame:
    """ministry_id, session, questions and the four status counts."""
    b = bucket(F.col("resolution_status"), F.col("asking_members"))
    names = ("fully_linked", "partly_linked", "not_linked", "ambiguous")
    return questions.withColumn("__b", b).groupBy("ministry_id", "session").agg(F.count(F.lit(1)).alias("questions"), *[F.count_if(F.col("__b") == n).alias(n) for n in names])


def type_mix(questions: DataFrame) -> DataFrame:
    """ministry_id, session, type, questions: the histogram as rows."""
    return questions.groupBy("ministry_id", "session", "type").agg(F.count(F.lit(1)).alias("questions"))


def type_mix_map(questions: DataFrame) -> DataFrame:
    """ministry_id, session, question_type_mix: the histogram as a map sorted by type."""
    entries = F.array_sort(F.collect_list(F.struct(F.coalesce("type", F.lit("not stated")).alias("type"), "questions")))
    return type_mix(questions).groupBy("ministry_id", "session").agg(F.map_from_entries(entries).alias("question_type_mix"))


def attributed(questions: DataFrame, states: DataFrame) -> DataFrame:
    """The distinct (question_id, subject, state) pairs of questions and their askers' states."""
    bridge = questions.select("question_id", "subject", F.explode("asking_members").alias("member_id"))
    return bridge.join(states.where("state is not null"), "member_id").select("question_id", "subject", "state").distinct()


def state_subjects(pairs: DataFrame, top_n: int) -> DataFrame:
    """The top subjects of each state with denominators.

    state, subject, questions, state_questions, state_subjects, subjects_shown, place; ties go to the smaller subject.
    """
    if top_n < 1:
        raise ValueError("top_n must be 1 or more")
    counts = pairs.groupBy("state", "subject").agg(F.count(F.lit(1)).alias("questions"))
    totals = counts.groupBy("state").agg(F.count(F.lit(1)).alias("state_subjects"))
    asked = pairs.groupBy("state").agg(F.countDistinct("question_id").alias("state_questions"))
    order = Window.partitionBy("state").orderBy(F.desc("questions"), "subject")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top_n)
    return (
        top.join(totals, "state")
        .join(asked, "state")
        .select("state", "subject", "questions", "state_questions", "state_subjects", F.least(F.lit(top_n), F.col("state_subjects")).cast("int").alias("subjects_shown"), "place")
    )


def attribution_counters(questions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Questions, unattributable (no asker with a state) and multi_state ones."""
    per = pairs.groupBy("question_id").agg(F.countDistinct("state").alias("states"))
    joined = questions.select("question_id").distinct().join(per, "question_id", "left")
    return joined.agg(F.count(F.lit(1)).alias("questions"), F.count_if(F.col("states").isNull()).alias("unattributable"), F.count_if(F.col("states") > 1).alias("multi_state"))


def counters(questions: DataFrame) -> DataFrame:
    """One row: questions, unresolved, partly_resolved, co_asked, max_askers, sessions, first_date, last_date."""
    b = bucket(F.col("resolution_status"), F.col("asking_members"))
    askers = F.coalesce(F.size("asking_members"), F.lit(0))
    return questions.agg(
        F.count(F.lit(1)).alias("questions"),
        F.count_if(F.col("resolution_status") == "unresolved").alias("unresolved"),
        F.count_if(b == "partly_linked").alias("partly_resolved"),
        F.count_if(askers > 1).alias("co_asked"),
        F.coalesce(F.max(askers), F.lit(0)).alias("max_askers"),
        F.countDistinct("session").alias("sessions"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def counting_basis(counted: DataFrame) -> DataFrame:
    """Q15: how each unit is counted, in words that carry the live figures: unit, basis_version, counting_basis."""
    text = {
        "question": F.format_string("Each of %d questions counts once; %d of them have several askers, at most %d.", "questions", "co_asked", "max_askers"),
        "member": F.lit("Each member of a term counts once in every dimension, under 'not stated' where a value is missing."),
        "state-question": F.format_string("A question counts once for each state of its identified askers; %d unresolved ones may count for none.", "unresolved"),
    }
    rows = F.array(*[F.struct(F.lit(u).alias("unit"), F.lit("1").alias("basis_version"), t.alias("counting_basis")) for u, t in text.items()])
    return counted.select(F.inline(rows))


def top_and_rest(counts: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first n categories by members (then name) and the sum of the rest under 'others': by, category, members."""
    order = Window.partitionBy(*by).orderBy(F.desc("members"), "category")
    placed = counts.withColumn("at", F.row_number().over(order))
    shown = F.when(F.col("at") <= n, F.col("category")).otherwise(F.lit("others"))
    return placed.groupBy(*by, shown.alias("category")).agg(F.sum("members").alias("members"))
