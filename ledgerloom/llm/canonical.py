"""Freely typed values mapped to the closest entry of a reference list, by a prefix-filter set-similarity join.

Both sides become sets of letter pairs (word ends marked, so word order does not matter). Tokens are ordered by their
rarity over both sides; of a set of n tokens only the rarest n - ceil(t n) + 1 are joined, because two sets of Jaccard t or
more must share one of those. Length and positional filters drop pairs that cannot reach t, then Jaccard is computed
exactly and the best entry kept. An entry counts with all its names: canonical, former, and what can be derived from
them by rule - their parts around "and" and commas, and the initials of their words.

An exact check follows: a pair under the sure similarity stands only if the words align one to one, each typed word being
the other, a beginning of it, or at most a few edits away.

Scale. Only distinct values are joined; repeats come back by ``lookup_join``, so a value that a third of all rows bear is one row here and
spread over tasks there. Token order is a join with the token counts, never a collected list.

Edge cases. Null and blank values are mapped to nothing (``match`` null, ``blank`` true). A value without letters or digits is
unmatched. Very long values are compared whole. Equal scores go to the entry whose name is canonical before former before
derived, then to the smaller id. An empty list leaves all unmatched; an empty input gives an empty result.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.text import present
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import staged

#: Least Jaccard similarity of a candidate, and the one from which no word check is needed.
LEAST, SURE = 0.24, 0.72

# Words that announce an office and are no part of its name, at either end.
OFFICE = "(?:the |govt |office )*(?:ministry|ministary|minister|min|m o|mo|deptt|dept|department)(?: of| for)?"


def normal(c: Column) -> Column:
    """Lower case, letters and digits in words one space apart, without dots inside initials and without office words at either end."""
    s = F.lower(F.regexp_replace(c, r"(?U)[\s_]+", " "))
    s = F.regexp_replace(s, r"(?<![\p{L}\p{N}])mo(?=(?:\p{L}\.){2})", "mo ")
    s = F.regexp_replace(s, r"(?<![\p{L}\p{N}])((?:\p{L}\.){2,}\p{L}?)(?![\p{L}\p{N}])", "<$1>")
    s = F.regexp_replace(s, r"(?<=\p{L})\.(?=(?:\p{L}\.)*\p{L}?\.?>)", "")
    s = F.regexp_replace(s, "[&+]", " and ")
    s = F.trim(F.regexp_replace(s, r"[^\p{L}\p{N}]+", " "))
    s = F.regexp_replace(s, f"^{OFFICE} ", "")
    return F.trim(F.regexp_replace(s, " (?:ministry|deptt|dept|department|main)$", ""))


def letter_pairs(c: Column) -> Column:
    """The distinct pairs of neighbouring letters of each word, with its start and end marked; joining words left out."""
    words = F.filter(F.split(c, " "), lambda w: (w != "") & ~w.isin("and", "of", "the"))
    marked = F.transform(words, lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    pairs = F.transform(marked, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2))))
    return F.array_distinct(F.flatten(pairs))


def similarity_join(left: DataFrame, right: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs of ``left`` (l, tokens) and ``right`` (r, tokens) whose token sets have Jaccard ``least`` or more: l, r, jaccard.

    ``l`` and ``r`` are unique. Exact: no pair that reaches ``least`` is lost. Empty sets join nothing.
    """
    both = left.select(F.lit("l").alias("side"), F.col("l").alias("key"), "tokens").unionByName(
        right.select(F.lit("r").alias("side"), F.col("r").alias("key"), "tokens")
    )
    single = both.select("side", "key", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    counts = single.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    ordered = (
        single.join(counts, "token")
        .groupBy("side", "key", "n")
        .agg(F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("list"))
        .withColumn("list", F.col("list.token"))
    )
    ordered = staged(ordered, "setjoin-ordered")
    keep = (F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-9) + 1).cast("int")
    prefix = ordered.select("side", "key", "n", F.posexplode(F.slice("list", F.lit(1), keep)).alias("at", "token"))
    a = prefix.where("side = 'l'").select(F.col("key").alias("l"), F.col("n").alias("ln"), F.col("at").alias("la"), "token")
    b = prefix.where("side = 'r'").select(F.col("key").alias("r"), F.col("n").alias("rn"), F.col("at").alias("ra"), "token")
    need = F.ceil((F.col("ln") + F.col("rn")) * F.lit(least / (1 + least)) - 1e-9)
    most = 1 + F.least(F.col("ln") - F.col("la") - 1, F.col("rn") - F.col("ra") - 1)
    fits = (F.col("rn") >= F.col("ln") * least - 1e-9) & (F.col("ln") >= F.col("rn") * least - 1e-9)
    # A pair met first at a later place shares fewer: the bound uses the first meeting, so the minimum over meetings.
    met = a.join(b, "token").where(fits).groupBy("l", "r").agg(F.max((most >= need).cast("int")).alias("may")).where("may = 1")
    lists = lambda side, name: ordered.where(F.col("side") == side).select(F.col("key").alias(name), F.col("list").alias(f"{name}_list"))
    pairs = met.join(lists("l", "l"), "l").join(lists("r", "r"), "r")
    shared = F.size(F.array_intersect("l_list", "r_list"))
    jaccard = shared / (F.size("l_list") + F.size("r_list") - shared)
    return pairs.select("l", "r", jaccard.alias("jaccard")).where(F.col("jaccard") >= least - 1e-9)


def entries(reference: DataFrame, key: str, names: dict[str, int]) -> DataFrame:
    """Every name of every entry: entry, name (normal), rank (0 canonical, 1 former, 2 part, 3 initials).

    ``names`` maps columns (strings or arrays of strings) to their rank.
    """
    made = None
    for column, rank in names.items():
        c = F.col(column)
        if isinstance(reference.schema[column].dataType, T.ArrayType):
            rows = reference.select(F.col(key).alias("entry"), F.explode(c).alias("raw"), F.lit(rank).alias("rank"))
        else:
            rows = reference.select(F.col(key).alias("entry"), c.alias("raw"), F.lit(rank).alias("rank"))
        made = rows if made is None else made.unionByName(rows)
    full = made.where("entry is not null").select("entry", "rank", normal(F.col("raw")).alias("name"), F.lower("raw").alias("raw")).where("name <> ''")
    parts = full.select("entry", F.lit(2).alias("rank"), F.explode(F.split("raw", r",|&|\+| and ")).alias("raw"))
    parts = parts.select("entry", "rank", normal(F.col("raw")).alias("name"))
    words = F.filter(F.split("name", " "), lambda w: ~w.isin("and", "of", "the", "for", "to"))
    letters = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    initials = full.where(F.size(words) > 1).select("entry", F.lit(3).alias("rank"), F.explode(F.array(letters, F.concat(F.lit("mo"), letters))).alias("name"))
    every = full.select("entry", "rank", "name").unionByName(parts).unionByName(initials).where("name <> ''")
    one = Window.partitionBy("name").orderBy("rank", "entry")
    # A derived name that several entries share says nothing; a full one goes to its first entry.
    owners = F.size(F.collect_set("entry").over(Window.partitionBy("name", "rank")))
    ranked = every.distinct().withColumn("owners", owners).withColumn("place", F.row_number().over(one))
    return ranked.where("place = 1 and (owners = 1 or rank < 2)").select("entry", "rank", "name")


def _edits(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b, or most + 1 where there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def aligned(typed: str, name: str) -> float:
    """0 to 1: how well the words of a typed value and a name pair off, over the longer side's letters."""
    skip = {"and", "of", "the", "for", "to", "adn", "annd"}
    a, b = [w for w in typed.split() if w not in skip], [w for w in name.split() if w not in skip]
    x, y = typed.replace(" ", ""), name.replace(" ", "")
    if not a or not b:
        return 0.0
    allowed = max(1, round(len(y) / 7))
    glued = _edits(x, y, allowed)
    best = 1 - 0.3 * glued / allowed if glued <= allowed and len(y) > 3 else float(x == y)
    used, hit, total = set(), 0.0, max(len(a), len(b))
    for w in a:
        score, at = 0.0, None
        for j, v in enumerate(b):
            if j in used:
                continue
            if w == v:
                s = 1.0
            elif len(w) >= 3 and v.startswith(w):
                s = 0.95
            else:
                d = _edits(w, v, 2 if len(v) > 5 else 1)
                s = 0.9 - 0.15 * d if d <= (2 if len(v) > 5 else 1) and len(v) > 2 else 0.0
            if s > score:
                score, at = s, j
        if at is not None:
            used.add(at)
            hit += score
    return max(best, hit / total)


def match_values(values: DataFrame, reference: DataFrame, least: float = LEAST, sure: float = SURE, accept: float = 0.7) -> DataFrame:
    """The closest entry of each distinct value: value, entry (null where unmatched), score, rank.

    ``values`` has one column ``value`` of distinct, present strings; ``reference`` is a result of ``entries``.
    """
    typed = values.select("value", normal(F.col("value")).alias("name"))
    typed = staged(typed.withColumn("name", F.when(F.col("name") == "", F.lower("value")).otherwise(F.col("name"))), "canonical-typed")
    left = typed.select(F.col("name").alias("l")).distinct().select("l", letter_pairs(F.col("l")).alias("tokens"))
    listed = staged(reference, "canonical-entries")
    right = listed.select(F.col("name").alias("r"), letter_pairs(F.col("name")).alias("tokens"))
    pairs = similarity_join(left, right, least).join(listed.withColumnRenamed("name", "r"), "r")

    @F.pandas_udf(T.DoubleType())
    def check(l: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([aligned(a, b) for a, b in zip(l, r, strict=True)], dtype="float64")

    scored = pairs.withColumn("aligned", check("l", "r"))
    # Initials and single parts must be met almost exactly; whole names may differ as the check says.
    strict = F.col("rank") == 3
    holds = F.when(strict, F.col("l") == F.col("r")).otherwise((F.col("jaccard") >= sure) | (F.col("aligned") >= accept))
    score = F.greatest(F.col("jaccard"), F.col("aligned")) + F.col("jaccard") / 100
    best = Window.partitionBy("l").orderBy(F.desc("score"), "rank", "entry")
    kept = scored.where(holds).withColumn("score", score).withColumn("place", F.row_number().over(best)).where("place = 1")
    return typed.join(kept.select(F.col("l").alias("name"), "entry", "score", "rank"), "name", "left").select("value", "entry", "score", "rank")


def map_column(df: DataFrame, column: str, keep: list[str], reference: DataFrame, exact: Column | None = None) -> DataFrame:
    """The columns ``keep`` of each row whose ``column`` is present, with entry, score and rank of its value.

    ``exact`` may say which rows need no mapping (they are left out).
    """
    rows = df.select(*keep, F.col(column).alias("value")).where(present(F.col("value")).isNotNull())
    if exact is not None:
        rows = rows.where(~exact)
    found = staged(match_values(rows.select("value").distinct(), reference), "canonical-found")
    return lookup_join(rows, found, ["value"])
