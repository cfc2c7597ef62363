"""Read-side views: subset extracts, spans, comparisons, seats, members, coverage."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.display import house_name, listed
from ledgerloom.functions.text import is_missing, name_key, stated
from ledgerloom.operators.aggregates import bucket

STATUS_COUNTS = ("fully_linked", "partly_linked", "not_linked", "ambiguous")


class StatusSumMismatch(ValueError):
    """Status counts do not add up to the questions."""


def first_of_each(questions: DataFrame) -> DataFrame:
    """One row a question id (copies are the same)."""
    return questions.dropDuplicates(["question_id"])


def extract(questions: DataFrame, members: DataFrame | None = None, **axis: str) -> DataFrame:
    """The questions of exactly one axis: session (and house), ministry, member, state or constituency.

    State and constituency go through the members that bear them (compared without case and blanks): a semi-join on a distinct id list.
    """
    if set(axis) == {"house", "session"}:
        house = axis.pop("house")
        questions = questions.where(F.col("house") == house)
    if len(axis) != 1 or "house" in axis:
        raise ValueError("exactly one axis; a house goes with a session only")
    kind, value = next(iter(axis.items()))
    if kind == "session":
        return questions.where(F.col("session") == value)
    if kind == "ministry":
        return questions.where(F.col("ministry_id") == value)
    if kind == "member":
        return questions.where(F.array_contains("asking_members", value))
    if kind not in ("state", "constituency") or members is None:
        raise ValueError(f"no axis {kind}")
    own = members.where(name_key(F.col(kind)) == " ".join(value.lower().split())).select("member_id").distinct()
    hits = questions.select("question_id", F.explode("asking_members").alias("member_id")).join(own, "member_id", "left_semi")
    return questions.join(hits.select("question_id").distinct(), "question_id", "left_semi")


def find_entry(dimension: DataFrame, text: str) -> DataFrame:
    """entries equal to the text by id or any name without case; if none, those that contain it. The caller wants one row."""
    t = text.lower()
    names = F.concat(F.array("ministry_id", "canonical_name"), F.coalesce("former_names", F.array().cast("array<string>")))
    low = F.transform(F.filter(names, lambda x: x.isNotNull()), F.lower)
    marked = dimension.withColumn("__how", F.when(F.array_contains(low, t), 1).when(F.exists(low, lambda x: x.contains(t)), 2))
    best = marked.agg(F.min("__how").alias("__best"))
    return marked.join(F.broadcast(best)).where("__how = __best").drop("__how", "__best")


def parse_sessions(text: str) -> tuple[int, int]:
    """"5-8" or "5" as an inclusive range."""
    m = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", text)
    if not m:
        raise ValueError(f"no session range: {text}")
    low, high = int(m[1]), int(m[2] or m[1])
    return min(low, high), max(low, high)


def session_order(c: Column) -> Column:
    """(term, number) of a session id for ordering; nulls where they are no numbers."""
    part = lambda i: F.split_part(c, F.lit("/"), F.lit(i)).try_cast("int")
    return F.struct(part(2).alias("term"), part(3).alias("number"))


def in_span(df: DataFrame, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """rows whose session lies in the inclusive span; its ends may come in either order."""
    a, b = min(low, high), max(low, high)
    end = lambda x: F.struct(F.lit(x[0]).alias("term"), F.lit(x[1]).alias("number"))
    return df.where(session_order(F.col("session")).between(end(a), end(b)))


def dense_span(profile: DataFrame, session_rows: DataFrame, ministry: str) -> DataFrame:
    """Every session, with zeros where the ministry has no questions: session, questions and the status counts."""
    own = profile.where(F.col("ministry_id") == ministry)
    joined = session_rows.select("session").join(own, "session", "left")
    return joined.select("session", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("questions", *STATUS_COUNTS)])


def span_totals(dense: DataFrame) -> DataFrame:
    """One row: questions, status counts, sessions, sessions_with_questions, balanced (status counts add up); see ``checked_totals``."""
    total = dense.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("questions", *STATUS_COUNTS)], F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("questions") > 0).alias("sessions_with_questions")
    )
    return total.withColumn("balanced", F.col("questions") == sum((F.col(c) for c in STATUS_COUNTS[1:]), F.col(STATUS_COUNTS[0])))


def checked_totals(totals: DataFrame) -> DataFrame:
    """``span_totals`` that raises where its status counts do not add up."""
    row = totals.where("not balanced").first()
    if row:
        raise StatusSumMismatch(f"{row.questions} questions, {sum(row[c] for c in STATUS_COUNTS)} by status")
    return totals


def span_types(mix: DataFrame, session_rows: DataFrame, ministry: str) -> DataFrame:
    """By type, the first and the last session of a span: type, first_questions, last_questions, difference, first_share, last_share.

    ``mix`` has ministry_id, session, type and questions. Types that occur anywhere in the span are listed; shares are of the session's own
    questions, in per cent, null where it has none.
    """
    order = session_order(F.col("session"))
    ends = session_rows.agg(F.min_by("session", order).alias("__first"), F.max_by("session", order).alias("__last"))
    own = mix.where(F.col("ministry_id") == ministry).join(session_rows.select("session"), "session", "left_semi").join(F.broadcast(ends))
    at = lambda end: F.coalesce(F.sum(F.when(F.col("session") == F.col(end), F.col("questions"))), F.lit(0))
    by_type = own.groupBy("type").agg(at("__first").alias("first_questions"), at("__last").alias("last_questions"))
    whole = own.agg(at("__first").alias("__a"), at("__last").alias("__b"))
    return by_type.join(F.broadcast(whole)).select(
        "type", "first_questions", "last_questions", (F.col("last_questions") - F.col("first_questions")).alias("difference"),
        share(F.col("first_questions"), F.col("__a")).alias("first_share"), share(F.col("last_questions"), F.col("__b")).alias("last_share"),
    )


def change(first: Column, last: Column) -> tuple[Column, Column]:
    """The difference, and it in per cent of the first (null if that is 0)."""
    return last - first, F.round(F.try_divide((last - first) * 100.0, first), 4)


def span_change(dense: DataFrame) -> DataFrame:
    """First against last session of a span: first_questions, last_questions, difference, percent, single_session."""
    order = session_order(F.col("session"))
    ends = dense.agg(F.min_by("questions", order).alias("first_questions"), F.max_by("questions", order).alias("last_questions"), F.count(F.lit(1)).alias("n"))
    difference, percent = change(F.col("first_questions"), F.col("last_questions"))
    return ends.select("first_questions", "last_questions", difference.alias("difference"), percent.alias("percent"), (F.col("n") == 1).alias("single_session"))


def share(part: Column, total: Column) -> Column:
    """Part of total in per cent; null over 0."""
    return F.round(F.try_divide(part * 100.0, total), 4)


def compare(mix: DataFrame, one: str, two: str) -> DataFrame:
    """Two ministries by type over the rows given: type, the questions of each (0 where it has none)."""
    rows = mix.where(F.col("ministry_id").isin(one, two))
    of = lambda m: F.coalesce(F.sum(F.when(F.col("ministry_id") == m, F.col("questions"))), F.lit(0))
    return rows.groupBy("type").agg(of(one).alias("first_questions"), of(two).alias("second_questions"))


def seats_in_state(seat_rows: DataFrame, state: str) -> DataFrame:
    """seats of a state, compared without case and blanks."""
    return seat_rows.where(name_key(F.col("state")) == " ".join(state.lower().split()))


def seats_named(seat_rows: DataFrame, name: str) -> DataFrame:
    """All seats of one name, whatever their state."""
    return seat_rows.where(name_key(F.col("name")) == " ".join(name.lower().split()))


def seats_matching(seat_rows: DataFrame, text: str, limit: int = 12) -> DataFrame:
    """seats whose name contains the text (two letters or more), exact ones first, then by name and state."""
    t = " ".join(text.lower().split())
    if len(t) < 2:
        return seat_rows.limit(0)
    key = name_key(F.col("name"))
    return seat_rows.where(key.contains(t)).orderBy((key != t).cast("int"), "name", "state", "seat_id").limit(limit)


def seat_lookup(seat_rows: DataFrame, reps: DataFrame, questions: DataFrame, name: str) -> DataFrame:
    """Every seat of a name with its members, their terms and their questions by status: one row a (seat, member)."""
    own = seats_named(seat_rows, name).select("seat_id", "name", "state", "changed_hands")
    held = seat_history(reps.join(own.select("seat_id"), "seat_id", "left_semi")).drop("changed_hands")
    asked = first_of_each(questions).select("question_id", "resolution_status", "asking_members", F.explode(F.array_distinct("asking_members")).alias("member_id"))
    asked = asked.join(held.select("member_id").distinct(), "member_id", "left_semi").withColumn("__b", bucket(F.col("resolution_status"), F.col("asking_members")))
    counts = asked.groupBy("member_id").agg(F.count(F.lit(1)).alias("questions"), *[F.count_if(F.col("__b") == n).alias(n) for n in STATUS_COUNTS])
    return own.join(held, "seat_id").join(counts, "member_id", "left").na.fill(0, ["questions", *STATUS_COUNTS])


def state_summary(rows: DataFrame, state: str) -> DataFrame:
    """The published subjects of a state (compared without case and blanks) in their order; no rows where it has none."""
    own = rows.where(name_key(F.col("state")) == " ".join(state.lower().split()))
    return own.withColumn("subject", stated(F.col("subject"))).orderBy("place")


def subject_sessions(trends: DataFrame, subject: str) -> DataFrame:
    """A subject's questions by session, in the order of the sessions."""
    return in_session_order(trends.where(F.col("subject") == subject))


def in_session_order(df: DataFrame, newest_first: bool = False) -> DataFrame:
    """By term and number, not by text; ids of another form come last, and none is dropped."""
    term, number = session_order(F.col("session"))["term"], session_order(F.col("session"))["number"]
    way = F.desc_nulls_last if newest_first else F.asc_nulls_last
    good = term.isNotNull() & number.isNotNull()
    return df.orderBy(F.desc(good), way(F.when(good, term)), way(F.when(good, number)), "session")


def in_category_order(composed: DataFrame) -> DataFrame:
    """Whole numbers before words within a dimension, both compared as text."""
    return composed.orderBy("dimension", F.col("category").try_cast("bigint").isNull(), "category")


def in_locale_order(df: DataFrame, *columns: str) -> DataFrame:
    """Alphabetical as a reader expects it (case and accents weigh less than letters), ties by code point."""
    return df.orderBy(*[F.collate(F.col(c), "UNICODE") for c in columns], *columns)


def in_term(df: DataFrame, term: int) -> DataFrame:
    """rows whose session is of the term."""
    return df.where(session_order(F.col("session"))["term"] == term)


def outside_terms(df: DataFrame, terms: list[int]) -> DataFrame:
    """rows of the terms and outside of them: inside, outside (sessions without a term among these)."""
    own = F.coalesce(session_order(F.col("session"))["term"].isin(*terms), F.lit(False))
    return df.agg(F.count_if(own).alias("inside"), F.count_if(~own).alias("outside"))


def in_session_range(df: DataFrame, text: str, term: int | None = None) -> DataFrame:
    """rows whose session number is in a range such as "5-8", of one term if it is given."""
    low, high = parse_sessions(text)
    rows = df.where(session_order(F.col("session"))["number"].between(low, high))
    return rows if term is None else in_term(rows, term)


def with_basis(rows: DataFrame, basis: DataFrame, unit: str = "counting_basis_unit") -> DataFrame:
    """Rows with the wording and version of their unit's counting basis; null for a unit without one, "question" where none is named."""
    said = basis.select(F.col("unit").alias("__unit"), "basis_version", "counting_basis")  # a handful of units
    own = F.coalesce(F.col(unit), F.lit("question")) if unit in rows.columns else F.lit("question")
    return rows.withColumn("__own", own).join(F.broadcast(said), F.col("__own") == F.col("__unit"), "left").drop("__own", "__unit")


def covered_houses(coverage_rows: DataFrame) -> DataFrame:
    """The houses that carry questions, most questions first."""
    return coverage_rows.where("questions > 0").orderBy(F.desc("questions"), "house")


def uncovered_houses(coverage_rows: DataFrame) -> DataFrame:
    """house, name and reason (null where none is stated) of the houses without questions."""
    return coverage_rows.where("coalesce(questions, 0) <= 0").select("house", house_name(F.col("house")).alias("name"), F.when(~is_missing(F.col("reason")), F.col("reason")).alias("reason"))


def houses_claim(coverage_rows: DataFrame) -> DataFrame:
    """Q16: one row, claim: which houses are covered, in words drawn from the rows. Houses are few by nature."""
    names = F.array_sort(F.collect_set(house_name(F.col("house"))))
    own = coverage_rows.where("questions > 0").agg(names.alias("names"))
    n = F.size("names")
    return own.select(F.when(n == 0, "No House is covered").when(n == 1, F.concat(F.get("names", F.lit(0)), F.lit(" only"))).otherwise(listed(F.col("names"))).alias("claim"))


def states_in(reps: DataFrame) -> DataFrame:
    """State, seats, members."""
    return reps.groupBy("state").agg(F.countDistinct("seat_id").alias("seats"), F.countDistinct("member_id").alias("members"))


def seat_history(reps: DataFrame) -> DataFrame:
    """One row a (seat, member): terms ascending, and whether the seat changed hands."""
    own = reps.groupBy("seat_id", "member_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    hands = reps.groupBy("seat_id").agg((F.countDistinct("member_id") > 1).alias("changed_hands"))
    return own.join(hands, "seat_id")


def member_questions(questions: DataFrame, member: str) -> DataFrame:
    """One row: the member's questions by status, and those without a known status."""
    own = first_of_each(extract(questions, member=member))
    b = bucket(F.col("resolution_status"), F.col("asking_members"))
    return own.withColumn("__b", b).agg(F.count(F.lit(1)).alias("questions"), *[F.count_if(F.col("__b") == n).alias(n) for n in STATUS_COUNTS], F.count_if(F.col("__b").isNull()).alias("unknown_status"))


def newest(questions: DataFrame, n: int) -> DataFrame:
    """The n newest questions, by date, then id, both descending."""
    return first_of_each(questions).orderBy(F.desc_nulls_last("date"), F.desc("question_id")).limit(n)


def subject_tally(questions: DataFrame, limit: int) -> DataFrame:
    """The most frequent subjects by exact writing: subject, questions; ties go to the smaller subject."""
    counts = first_of_each(questions).groupBy("subject").agg(F.count(F.lit(1)).alias("questions"))
    return counts.orderBy(F.desc("questions"), F.asc_nulls_last("subject")).limit(limit)


def per_day(rows: DataFrame) -> DataFrame:
    """sessions with per_day (null on no days or zero) and zero_days (recorded as zero, which is no gap)."""
    return rows.withColumn("per_day", F.round(F.try_divide(F.col("questions").cast("double"), F.nullif(F.col("sitting_days"), F.lit(0))), 4)).withColumn("zero_days", F.coalesce(F.col("sitting_days") == 0, F.lit(False)))


def with_names(rows: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with the dimension's name, or the id where it has none, as ``name``."""
    known = dimension.select(key, F.col(name).alias("__name"))
    return rows.join(known, key, "left").withColumn(name, F.coalesce("__name", key)).drop("__name")


def recount(questions: DataFrame) -> DataFrame:
    """ministry_id, session, questions counted again from the rows themselves, by distinct id."""
    return questions.groupBy("ministry_id", "session").agg(F.countDistinct("question_id").alias("questions"))


def differences(one: DataFrame, two: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys whose values differ or that one side lacks: key, left_value, right_value. None, if both agree."""
    a = one.select(*key, F.col(value).alias("left_value"), F.lit(1).alias("__a"))
    b = two.select(*[F.col(k).alias(f"__{k}") for k in key], F.col(value).alias("right_value"), F.lit(1).alias("__b"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    joined = a.join(b, same, "full_outer")
    odd = joined.where(F.col("__a").isNull() | F.col("__b").isNull() | ~F.col("left_value").eqNullSafe(F.col("right_value")))
    return odd.select(*[F.when(F.col("__a").isNotNull(), F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in key], "left_value", "right_value")


def coverage(questions: DataFrame, houses: list[str]) -> DataFrame:
    """One row a house, uncovered ones included: house, covered, questions, resolved, rate, meets_target, first_date, last_date, reason."""
    spark = questions.sparkSession
    every = spark.createDataFrame([(h,) for h in houses], "house string")
    own = questions.groupBy("house").agg(F.count(F.lit(1)).alias("questions"), F.count_if(F.col("resolution_status") == "resolved").alias("resolved"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    joined = every.join(own, "house", "left")
    rate = F.round(F.try_divide(F.col("resolved"), F.col("questions")), 6)
    return joined.select(
        "house", F.col("questions").isNotNull().alias("covered"), F.coalesce("questions", F.lit(0)).alias("questions"), F.coalesce("resolved", F.lit(0)).alias("resolved"),
        F.coalesce(rate, F.lit(0.0)).alias("rate"), F.coalesce(rate >= 0.95, F.lit(False)).alias("meets_target"), "first_date", "last_date",
        F.when(F.col("questions").isNull(), "no records of this house").alias("reason"),
    )


def stated_only(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is neither null, blank nor the sentinel."""
    return df.where(~is_missing(F.col(column)))
