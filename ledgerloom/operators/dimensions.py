"""Reference dimensions: one identity per dimension value across spellings and renames, seats, sessions.

Dates are ISO strings, so their order is that of the calendar. Blank names are skipped; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import fold_key, present, slug
from ledgerloom.operators.ingest import seat_id


def observations(df: DataFrame, name: str, date: str) -> DataFrame:
    """Name, observed, first_date, last_date of each stated name (null dates do not count)."""
    rows = df.select(present(F.col(name)).alias("name"), F.col(date).alias("date")).where("name is not null")
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("observed"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def registry(observed: DataFrame) -> DataFrame:
    """One row a fold group: dimension_id, canonical_name, name_variants, former_names, fold.

    The id is the slug of the earliest name (first date, then name), the display name the latest (last date, then name).
    """
    early = F.struct(F.coalesce("first_date", F.lit("")), "name")
    late = F.struct(F.coalesce("last_date", F.lit("")), "name")
    groups = observed.groupBy(fold_key(F.col("name")).alias("fold")).agg(
        F.min_by("name", early).alias("__first"), F.max_by("name", late).alias("canonical_name"), F.array_sort(F.collect_set("name")).alias("name_variants")
    )
    return groups.select(
        slug(F.col("__first")).alias("dimension_id"), "canonical_name", "name_variants",
        F.array_remove("name_variants", F.col("canonical_name")).alias("former_names"), "fold",
    )


def minted_ids(observed: DataFrame, groups: DataFrame) -> DataFrame:
    """minted_id (slug of a written name) and the dimension_id of its fold group."""
    rows = observed.select(slug(F.col("name")).alias("minted_id"), fold_key(F.col("name")).alias("fold"))
    return rows.join(groups.select("fold", "dimension_id"), "fold").groupBy("minted_id").agg(F.min("dimension_id").alias("dimension_id"))


def with_renames(minted: DataFrame, renames: DataFrame) -> DataFrame:
    """``minted`` with confirmed renames: every id that led to an absorbed group leads to the rename's id.

    ``renames`` has dimension_id, canonical_name and former_names. One level, as given; see ``rename_conflicts``.
    """
    named = renames.select("dimension_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("former_names", F.array().cast("array<string>")))).alias("name"))
    claims = named.where(present(F.col("name")).isNotNull()).select(slug(F.col("name")).alias("minted_id"), F.col("dimension_id").alias("__to")).distinct()
    absorbed = minted.join(claims, "minted_id").where("dimension_id <> __to").groupBy("dimension_id").agg(F.min("__to").alias("__absorbed"))
    every = minted.join(absorbed, "dimension_id", "left").select("minted_id", F.coalesce("__absorbed", "dimension_id").alias("dimension_id"))
    joined = every.join(claims, "minted_id", "full_outer")
    return joined.select("minted_id", F.coalesce("__to", "dimension_id").alias("dimension_id")).distinct()


def rename_conflicts(renames: DataFrame) -> DataFrame:
    """Names claimed by more than one id: minted_id, ids; the caller refuses if there is any."""
    named = renames.select("dimension_id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("former_names", F.array().cast("array<string>")))).alias("name"))
    return named.where(present(F.col("name")).isNotNull()).groupBy(slug(F.col("name")).alias("minted_id")).agg(F.countDistinct("dimension_id").alias("ids")).where("ids > 1")


def fold_groups(observed: DataFrame) -> DataFrame:
    """Fold groups of more than one slug: fold, names."""
    groups = observed.groupBy(fold_key(F.col("name")).alias("fold")).agg(F.countDistinct(slug(F.col("name"))).alias("slugs"), F.array_sort(F.collect_set("name")).alias("names"))
    return groups.where("slugs > 1").select("fold", "names")


def unmapped(observed: DataFrame, renames: DataFrame) -> DataFrame:
    """Observed names that no confirmed rename claims."""
    named = renames.select(F.explode(F.concat(F.array("canonical_name"), F.coalesce("former_names", F.array().cast("array<string>")))).alias("name"))
    return observed.select("name").join(named.distinct(), "name", "left_anti")


def bijection_violations(df: DataFrame, source: str, minted: str) -> DataFrame:
    """Q04: sources with several ids and ids with several sources: side, value, others."""
    pairs = df.select(F.col(source).cast("string").alias("s"), F.col(minted).cast("string").alias("m")).where("s is not null and m is not null").distinct()
    one = pairs.groupBy(F.col("s").alias("value")).agg(F.count(F.lit(1)).alias("others")).where("others > 1").select(F.lit("source").alias("side"), "value", "others")
    two = pairs.groupBy(F.col("m").alias("value")).agg(F.count(F.lit(1)).alias("others")).where("others > 1").select(F.lit("id").alias("side"), "value", "others")
    return one.unionByName(two)


def representations(members: DataFrame) -> DataFrame:
    """One row a (seat, member, term): seat_id, seat, state, member_id, member_name, party, term.

    ``members`` has member_id, name, party, seat, state and terms (array<int>); rows without a seat are left out. Of several rows
    of one member and term the last by (name, party) holds.
    """
    rows = members.where(present(F.col("seat")).isNotNull()).select(
        seat_id(F.col("seat"), F.col("state")).alias("seat_id"), present(F.col("seat")).alias("seat"), present(F.col("state")).alias("state"),
        "member_id", F.col("name").alias("member_name"), "party", F.explode("terms").alias("term"),
    )
    last = F.struct(F.coalesce("member_name", F.lit("")), F.coalesce("party", F.lit("")))
    held = rows.groupBy("seat_id", "member_id", "term").agg(F.max_by(F.struct("seat", "state", "member_name", "party"), last).alias("r"))
    return held.select("seat_id", "r.seat", "r.state", "member_id", "r.member_name", "r.party", "term")


def in_window(reps: DataFrame, terms: list[int]) -> DataFrame:
    """representations of the window's terms; an empty window is refused."""
    if not terms:
        raise ValueError("a window needs a term")
    return reps.where(F.col("term").isin(*terms))


def seats(reps: DataFrame) -> DataFrame:
    """One row a seat: seat_id, name, state, holders, members, changed_hands; holders sorted by (term, member)."""
    return reps.groupBy("seat_id").agg(
        F.min("seat").alias("name"),
        F.min("state").alias("state"),
        F.array_sort(F.collect_set(F.struct("term", "member_id"))).alias("holders"),
        F.countDistinct("member_id").alias("members"),
    ).withColumn("changed_hands", F.col("members") > 1)


def seat_conflicts(reps: DataFrame) -> DataFrame:
    """Seat ids that span two states; the caller refuses if there is any."""
    return reps.groupBy("seat_id").agg(F.countDistinct("state").alias("states")).where("states > 1")


def sessions(df: DataFrame, session: str = "session") -> DataFrame:
    """The distinct sessions house/term/number whose parts are numbers: session, term, number."""
    part = lambda i: F.split_part(F.col(session), F.lit("/"), F.lit(i))
    good = df.where(F.col(session).rlike(r"^[^/]+/\d+/\d+$"))
    return good.select(F.col(session).alias("session"), part(2).cast("int").alias("term"), part(3).cast("int").alias("number")).distinct()


def member_states(reps: DataFrame) -> DataFrame:
    """member_id and state of each member: that of the last seat by (seat_id, term)."""
    held = reps.where("state is not null")
    return held.groupBy("member_id").agg(F.max_by("state", F.struct("seat_id", "term")).alias("state"))


def sitting_days(session_rows: DataFrame, days: dict[tuple[int, int], int]) -> DataFrame:
    """Sessions with their sitting days; null where none is recorded, which is a gap and no zero."""
    spark = session_rows.sparkSession
    known = spark.createDataFrame([(t, n, d) for (t, n), d in days.items()], "term int, number int, sitting_days int")
    return session_rows.join(F.broadcast(known), ["term", "number"], "left")
