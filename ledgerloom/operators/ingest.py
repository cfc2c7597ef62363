"""From records as served to rows as published.

Every function takes and gives DataFrames or Columns; column names are parameters. Null and blank values are missing;
an empty table gives an empty result; columns that are not named are left alone or, where it is said, dropped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import NOT_STATED, collapse, normal_key, present, slug

# The sitting status vocabulary, as normal keys.
STATUS = {
    "sitting": ("sitting", "active", "current", "serving", "yes", "y", "true", "1"),
    "former": ("former", "ex", "exmember", "retired", "expired", "ceased", "past", "no", "n", "false", "0"),
}


def first_stated(*columns: Column) -> Column:
    """The first alias whose text is neither null nor blank, stripped."""
    return F.coalesce(*[present(c) for c in columns])


def allowed(df: DataFrame, allow: Iterable[str]) -> DataFrame:
    """Only the permitted fields, nested ones included, compared by their normal key; everything else is dropped."""
    keys = {normal_key(a) for a in allow}

    def prune(c: Column, kind: T.DataType) -> Column | None:
        if isinstance(kind, T.StructType):
            kept = [(f.name, prune(c.getField(f.name), f.dataType)) for f in kind.fields if normal_key(f.name) in keys]
            kept = [(n, x) for n, x in kept if x is not None]
            return F.when(c.isNotNull(), F.struct(*[x.alias(n) for n, x in kept])) if kept else None
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            if not any(normal_key(f.name) in keys for f in kind.elementType.fields):
                return None
            return F.transform(c, lambda e: prune(e, kind.elementType))
        return c

    out = [(f.name, prune(F.col(f"`{f.name}`"), f.dataType)) for f in df.schema.fields if normal_key(f.name) in keys]
    return df.select(*[c.alias(n) for n, c in out if c is not None])


def excluded_fields(schema: T.StructType, allow: Iterable[str], prefix: str = "") -> list[str]:
    """Paths of the fields ``allowed`` would drop; names only, never values."""
    keys, out = {normal_key(a) for a in allow}, []
    for f in schema.fields:
        path = prefix + f.name
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if normal_key(f.name) not in keys:
            out.append(path)
        elif isinstance(inner, T.StructType):
            out += excluded_fields(inner, allow, path + ".")
    return out


def unwrap(df: DataFrame, records: str, total: str | None = None) -> DataFrame:
    """The rows of an envelope's array of records, with the total it claims (null without one) as claimed_total."""
    claimed = F.col(total).cast("bigint") if total else F.lit(None).cast("bigint")
    return df.select(claimed.alias("claimed_total"), F.inline(records))


def incomplete(df: DataFrame) -> DataFrame:
    """One row (received, claimed) if fewer or more rows came than the envelopes claim, else none."""
    counted = df.agg(F.count(F.lit(1)).alias("received"), F.max("claimed_total").alias("claimed"))
    return counted.where(F.col("claimed").isNotNull() & (F.col("received") != F.col("claimed")))


def iso_date(c: Column) -> Column:
    """DD.MM.YYYY as YYYY-MM-DD, by form alone; null for null and blank; another form raises."""
    s = present(c)
    pattern = r"^(\d{2})\.(\d{2})\.(\d{4})$"
    return F.when(s.isNull(), None).when(s.rlike(pattern), F.regexp_replace(s, pattern, "$3-$2-$1")).otherwise(F.raise_error(F.concat(F.lit("no date: "), s)))


def session_id(house: Column, term: Column, number: Column) -> Column:
    """house/term/number; raises unless both numbers are 1 or more."""
    t, n = present(term.cast("string")).try_cast("int"), present(number.cast("string")).try_cast("int")
    good = F.coalesce((t >= 1) & (n >= 1), F.lit(False))
    return F.when(good, F.concat_ws("/", house, t, n)).otherwise(F.raise_error(F.lit("term and session must be 1 or more")))


def question_id(house: Column, term: Column, session: Column, kind: Column, number: Column) -> Column:
    """house/term/session/type-slug/number; the type is part of the identity. Null if a number is missing."""
    parts = [present(x.cast("string")) for x in (term, session, number)]
    whole = F.concat_ws("/", house, parts[0], parts[1], slug(kind), parts[2])
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), whole)


def asker_forms(c: Column) -> Column:
    """Trimmed, non-blank forms in order, repeats kept; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(c, present), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def terms_served(c: Column) -> Column:
    """The distinct whole numbers of a comma list, ascending."""
    parts = F.filter(F.split(c, ","), lambda x: x.rlike(r"^\s*\d+\s*$"))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.trim(x).cast("int")))), F.array().cast("array<int>"))


def name_variants(*columns: Column) -> Column:
    """The distinct stated forms in the order given, blanks collapsed."""
    return F.array_distinct(F.filter(F.array(*[present(collapse(c)) for c in columns]), lambda x: x.isNotNull()))


def sitting_status(c: Column) -> Column:
    """Sitting, former or not stated; booleans count, and words are compared by their letters and digits alone."""
    s = F.regexp_replace(F.lower(c.cast("string")), r"[^\p{L}\p{N}]+", "")
    out = F.lit(NOT_STATED)
    for status, words in STATUS.items():
        out = F.when(s.isin(*words), status).otherwise(out)
    return out


def minted_id(prefix: str, serial: Column) -> Column:
    """Prefix-serial; null without a serial."""
    return F.concat(F.lit(prefix + "-"), present(serial.cast("string")))


def seat_id(name: Column, state: Column) -> Column:
    """State-slug-seat-slug, collapsed where both are equal; not-stated without a seat."""
    a, b = slug(state), slug(name)
    return F.when(present(name).isNull(), "not-stated").when(a == b, b).otherwise(F.concat_ws("-", a, b))


def add_variant(variants: Column, form: Column) -> Column:
    """The form appended unless it is there or missing."""
    known = F.coalesce(variants, F.array().cast("array<string>"))
    return F.when(present(form).isNull() | F.array_contains(known, form), known).otherwise(F.concat(known, F.array(form)))


def with_term(terms: Column, house: str, number: Column) -> Column:
    """The list of (house, number) terms with one more, unless it is there or the number is missing; null counts as empty."""
    kind = "array<struct<house:string,number:int>>"
    known = F.coalesce(terms, F.array().cast(kind))
    one = F.struct(F.lit(house).alias("house"), number.cast("int").alias("number"))
    there = F.exists(known, lambda t: (t["house"] == house) & (t["number"] == number))
    return F.when(number.isNull() | there, known).otherwise(F.concat(known, F.array(one)))


def unidentified(df: DataFrame, key: str) -> DataFrame:
    """One row (records) with the number of records that have no identity, if there is any; the caller reports or refuses."""
    return df.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("records")).where("records > 0")


def dedupe(df: DataFrame, key: list[str], order: list[str], content: list[str]) -> DataFrame:
    """The first row of each key, with copies and distinct contents counted.

    Gives key, content, ``order`` columns of the first row, ``copies`` and ``contents`` (2 or more where copies differ).
    Aggregates on the map side; a key with many copies sends one partial row a task.
    """
    row = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in content if c not in order])
    own = F.struct(*[F.col(c) for c in content])
    made = df.groupBy(*key).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"), F.count(F.lit(1)).alias("copies"), F.countDistinct(F.xxhash64(own)).alias("contents"))
    names = [*order, *[c for c in content if c not in order]]
    return made.select(*key, *[F.col(f"__row.{c}").alias(c) for c in names], "copies", "contents")


def conflicting(deduped: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose copies differ; the caller refuses if there is any."""
    return deduped.where("contents > 1").select(*key, "copies", "contents")


def observed_fields(df: DataFrame, json: str) -> DataFrame:
    """The distinct top-level keys of a JSON column: field, records."""
    keys = df.select(F.explode(F.json_object_keys(json)).alias("field"))
    return keys.groupBy("field").agg(F.count(F.lit(1)).alias("records"))


def shape_diff(observed: DataFrame, recorded: list[str]) -> DataFrame:
    """Field and change (missing, added) of observed fields against the recorded ones; severity degraded or notice."""
    spark = observed.sparkSession
    known = spark.createDataFrame([(f,) for f in recorded], "field string")
    gone = known.join(observed.select("field"), "field", "left_anti").select("field", F.lit("missing").alias("change"), F.lit("degraded").alias("severity"))
    new = observed.select("field").join(F.broadcast(known), "field", "left_anti").select("field", F.lit("added").alias("change"), F.lit("notice").alias("severity"))
    return gone.unionByName(new)


def identity_check(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    """Rows and distinct identities under two composites: records, old_ids, new_ids."""
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct(F.concat_ws("/", *old)).alias("old_ids"),
        F.countDistinct(F.concat_ws("/", *new)).alias("new_ids"),
    )
