"""Schemas that drift between files: profile every file, name every change, project one typed table.

Rows are loaded as path-value entries with the raw JSON kind of each value; statistics by (feed, file, path, kind) are
aggregated with map-side combine, so what reaches the sequential part is a few rows per file whatever the files' sizes - and of a
run of files with one schema only the first and the last, so that a feed of very many files is no large group.

Edge cases. A null payload, one that is no JSON object, is cut short, has text after the object or repeats a key is
unreadable: it counts in ``unreadable`` of ``project_unified`` and nowhere else. A file without a readable payload gives no
evidence, so the files beside it are compared with each other. Repeated records change nothing. An empty table gives
an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import staged

KINDS = ("string", "number", "boolean", "array", "object")


def _kind(c: Column) -> Column:
    """JSON kind of a variant value; null for a JSON null."""
    s = F.schema_of_variant(c)
    return (
        F.when(s == "STRING", "string")
        .when(s == "BOOLEAN", "boolean")
        .when(s.startswith("ARRAY"), "array")
        .when(s.startswith("OBJECT"), "object")
        .when(s == "VOID", None)
        .when(c.isNotNull(), "number")
    )


def readable(payload: Column) -> Column:
    """The payload as a variant object, or null where it is unreadable."""
    v = F.try_parse_json(payload)
    return F.when(payload.rlike(r"(?s)\}\s*$") & F.schema_of_variant(v).startswith("OBJECT"), v)


def path_values(
    files: DataFrame, feed: str = "feed", file_no: str = "file_no", payload: str = "payload", max_depth: int = 1
) -> DataFrame:
    """One row per value: feed, file_no, path, kind (null for a JSON null), text.

    ``max_depth`` levels of object keys are opened (``a.b``); what lies deeper stays in the text of its parent, so nothing
    is lost. Keys are kept character for character; a dot inside a key is not escaped.
    """
    rows = files.select(F.col(feed).alias("feed"), F.col(file_no).alias("file_no"), readable(F.col(payload)).alias("v"))
    rows = rows.where("v is not null")
    spark, level, out = files.sparkSession, rows.select("feed", "file_no", F.lit("").alias("prefix"), "v"), None
    for depth in range(max_depth):
        opened = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
            "feed", "file_no", F.concat("prefix", "key").alias("path"), F.col("value").alias("v")
        )
        here = opened.select("feed", "file_no", "path", _kind(F.col("v")).alias("kind"), F.col("v").cast("string").alias("text"))
        out = here if out is None else out.unionByName(here)
        if depth + 1 < max_depth:
            level = opened.where(_kind(F.col("v")) == "object").select("feed", "file_no", F.concat("path", F.lit(".")).alias("prefix"), "v")
    return out


def path_stats(values: DataFrame) -> DataFrame:
    """Statistics of path-value rows by feed, file_no, path and kind.

    n values; whole, those that are whole numbers; mean length and mean shares of digits, letters and white space; heads and tails: the least and the greatest
    first and last eight characters with digits masked, which tell one kind of value from another.
    """
    t = F.col("text")
    masked = F.regexp_replace(t, "[0-9]+", "9")
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda pattern: F.avg((F.length(t) - F.length(F.regexp_replace(t, pattern, ""))) / n)
    return values.groupBy("feed", "file_no", "path", "kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t.rlike(r"^-?[0-9]{1,18}$")).alias("whole"),
        F.avg(F.length(t).cast("double")).alias("length"),
        share("[0-9]").alias("digits"),
        share(r"\p{L}").alias("letters"),
        share(r"\s").alias("blanks"),
        F.min(F.substring(masked, 1, 8)).alias("head_lo"),
        F.max(F.substring(masked, 1, 8)).alias("head_hi"),
        F.min(F.substring(masked, -8, 8)).alias("tail_lo"),
        F.max(F.substring(masked, -8, 8)).alias("tail_hi"),
    )


def _tokens(key: str) -> list[str]:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", key)
    return [w.lower() for w in re.split(r"[^A-Za-z0-9]+", spaced) if w]


def name_likeness(a: str, b: str) -> float:
    """0 to 1: how likely two keys are writings of one name, by letters, by tokens and by order."""
    x, y = "".join(_tokens(a)), "".join(_tokens(b))
    if x == y and x:
        return 1.0
    ta, tb = _tokens(a), _tokens(b)
    alike = lambda p, q: p == q or (p[:1] == q[:1] and (p.startswith(q) or q.startswith(p)))
    hit = sum(any(alike(p, q) for q in tb) for p in ta) + sum(any(alike(p, q) for p in ta) for q in tb)
    dice = hit / max(1, len(ta) + len(tb))
    order = difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
    inside = 0.8 if min(len(x), len(y)) >= 4 and (x in y or y in x) else 0.0
    return max(order, 0.9 * dice, inside)


def _near(a: str | None, b: str | None) -> float:
    return difflib.SequenceMatcher(None, a or "", b or "", autojunk=False).ratio()


def value_likeness(a: dict, b: dict) -> float | None:
    """0 to 1: how alike the values of two keys are, over the kinds both have; None where they share no kind."""
    both = [k for k in a if k in b]
    if not both:
        return None
    best = 0.0
    for k in both:
        p, q = a[k], b[k]
        size = min(p["length"], q["length"]) / max(p["length"], q["length"], 1e-9) if max(p["length"], q["length"]) else 1.0
        mix = 1 - sum(abs(p[s] - q[s]) for s in ("digits", "letters", "blanks")) / 2
        ends = sum(_near(p[s], q[s]) for s in ("head_lo", "head_hi", "tail_lo", "tail_hi")) / 4
        best = max(best, 0.2 * size + 0.3 * mix + 0.5 * ends)
    return best


def rename_score(a: str, b: str, was: dict, now: dict, known: bool) -> float:
    """0 to 1: how likely the key that went and the key that came are one attribute."""
    name, value = name_likeness(a, b), value_likeness(was, now)
    if name == 1.0 or known:
        return 1.0 + name
    if value is None:  # no values on one side, or none of a common kind: the name alone decides
        return 0.75 * name if not was or not now else 0.65 * name
    return 0.5 * name + 0.5 * value


def feed_changes(stats: pd.DataFrame, least: float = 0.5) -> Iterator[tuple]:
    """The changes of one feed, from its path statistics: (file_no, field, key, change, was, now).

    An attribute is followed through its renames; its field is its key in the first file or, if it came later, the key it
    first came with. Keys that went and keys that came in one file are paired greedily by ``rename_score``.
    """
    field: dict[str, str] = {}  # key -> field, of attributes in the last file
    gone: dict[str, str] = {}  # last key -> field, of attributes that left
    former: dict[str, set[str]] = {}  # field -> the keys it has had
    kinds: dict[str, str] = {}  # field -> kinds in the last file that had any value
    last: dict[str, dict] = {}
    first = True
    for file_no, part in stats.groupby("file_no", sort=True):
        now: dict[str, dict] = {}
        for row in part.to_dict("records"):
            own = now.setdefault(row["path"], {})
            if isinstance(row["kind"], str):
                own[row["kind"]] = row
        came, went, out = sorted(set(now) - set(last)), sorted(set(last) - set(now)), []
        fresh: set[str] = set()
        if first:
            field = {k: k for k in now}
            first = False
        else:
            pairs = sorted(
                ((rename_score(a, b, last[a], now[b], b in former.get(field[a], ())), a, b) for a in went for b in came),
                key=lambda x: (-x[0], x[1], x[2]),
            )
            used: set[str] = set()
            for score, a, b in pairs:
                if score >= least and a not in used and b not in used and not (b in gone and score < 1):
                    used |= {a, b}
                    field[b] = field.pop(a)
                    out.append((field[b], b, "renamed", a, b))
            for k in came:
                if k not in used:
                    field[k] = gone.pop(k, None) or k
                    fresh.add(field[k])
                    out.append((field[k], k, "added", None, k))
            for k in went:
                if k not in used:
                    gone[k] = field.pop(k)
                    out.append((gone[k], k, "removed", k, None))
        for k, f in field.items():
            former.setdefault(f, set()).add(k)
            set_now = ",".join(sorted(now[k]))
            if set_now:
                if f not in fresh and f in kinds and kinds[f] != set_now:
                    out.append((f, k, "retyped", kinds[f], set_now))
                kinds[f] = set_now
        for f, k, change, was, to in out:
            yield int(file_no), f, k, change, was, to
        last = now


def runs(stats: DataFrame) -> DataFrame:
    """feed, file_no, run and ends: runs of files of a feed that have the same paths and kinds; a run is named by its first file.

    ``ends`` is true for a run's first and last file: all that comparing a file with the one before it needs, values' statistics included.
    """
    marks = stats.groupBy("feed", "file_no").agg(F.bit_xor(F.xxhash64("path", F.coalesce("kind", F.lit("")))).alias("mark"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("feed").orderBy("file_no")
    one = F.struct("mark", "n")
    begins, finishes = ~one.eqNullSafe(F.lag(one).over(order)), ~one.eqNullSafe(F.lead(one).over(order))
    placed = marks.withColumn("begins", begins).withColumn("finishes", finishes)
    run = F.max(F.when(F.col("begins"), F.col("file_no"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("feed", "file_no", run.alias("run"), (F.col("begins") | F.col("finishes")).alias("ends"))


def _ends(stats: DataFrame, own: DataFrame) -> DataFrame:
    return stats.join(own.where("ends").select("feed", "file_no"), ["feed", "file_no"], "left_semi")


CHANGES = "feed string, file_no bigint, field string, key string, change string, was string, now string"
CHANGE_COLUMNS = [c.split()[0] for c in CHANGES.split(", ")]


def schema_changes(stats: DataFrame, least: float = 0.5) -> DataFrame:
    """Every change of every feed: feed, file_no, field, key, change (added, removed, renamed, retyped), was, now.

    Works on ``path_stats`` of top-level paths. A feed's files must be walked in order, so each feed is one group of a few
    rows for each change of its schema; records and files without a change never enter it.
    """

    def walk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows = [(key[0], *x) for x in feed_changes(part, least)]
        return pd.DataFrame(rows, columns=CHANGE_COLUMNS)

    return _ends(stats, runs(stats)).groupBy("feed").applyInPandas(walk, CHANGES)


FIELD_KEYS = "feed string, file_no bigint, keys map<string,string>"


def field_keys(stats: DataFrame, least: float = 0.5) -> DataFrame:
    """For each file, the map from field to the key it bears there: feed, file_no, keys."""

    def walk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        changes: dict[int, list[tuple]] = {}
        for file_no, f, k, change, was, _ in feed_changes(part, least):
            changes.setdefault(file_no, []).append((f, k, change, was))
        names, rows = None, []
        for file_no, own in part.groupby("file_no", sort=True):
            if names is None:
                names = {k: k for k in own["path"]}
            for f, k, change, _ in changes.get(int(file_no), []):
                if change == "removed":
                    names.pop(f, None)
                elif change != "retyped":
                    names[f] = k
            rows.append((key[0], int(file_no), dict(names)))
        return pd.DataFrame(rows, columns=["feed", "file_no", "keys"])

    own = staged(runs(stats), "drift-runs")
    told = _ends(stats, own).groupBy("feed").applyInPandas(walk, FIELD_KEYS)
    return own.select("feed", "file_no", "run").join(told.withColumnRenamed("file_no", "run"), ["feed", "run"]).select("feed", "file_no", "keys")


#: Part of the feeds a field must occur in to have a column; the rest is kept in ``rest``.
COLUMN_FEEDS = 0.01


def unified_types(stats: DataFrame, keys: DataFrame, least: float = COLUMN_FEEDS) -> dict[str, str]:
    """The columns of the one table: field -> Spark type, by field; decided by the statistics of all files alone.

    A field has the type of the kind most of its values are of (string before others on a tie): string; bigint where all its numbers are whole,
    else double; boolean; an array of its elements' texts; an object as its JSON text. What does not convert is reported by ``project_unified``.
    """
    by_key = keys.select("feed", "file_no", F.explode("keys").alias("field", "path"))
    own = stats.where("kind is not null").join(by_key, ["feed", "file_no", "path"]).groupBy("field", "kind").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"), F.count_distinct("feed").alias("feeds"))
    feeds = keys.agg(F.count_distinct("feed").alias("all"))
    rank = F.struct("n", (F.col("kind") == "string").alias("s"), "kind")
    said = own.groupBy("field").agg(F.max("feeds").alias("feeds"), F.max_by(F.struct("kind", (F.col("whole") == F.col("n")).alias("whole")), rank).alias("t"))
    kind = {"string": "string", "boolean": "boolean", "array": "array<string>", "object": "string"}
    rows = said.join(F.broadcast(feeds)).where(F.col("feeds") >= F.col("all") * least).select("field", "t.kind", "t.whole").collect()  # one row a column
    return {r.field: kind.get(r.kind) or ("bigint" if r.whole else "double") for r in sorted(rows)}


def project_unified(
    files: DataFrame, fields: dict[str, str], keys: DataFrame, feed: str = "feed", file_no: str = "file_no", payload: str = "payload"
) -> DataFrame:
    """All records under one schema: feed, file_no, the typed ``fields``, failed_casts, unreadable, rest, failed_values.

    ``fields`` maps each field to its Spark type (see ``unified_types``); a value that does not convert is null there and its field is listed in
    ``failed_casts``; arrays and objects convert to ``string`` as their JSON text, and to ``array<string>`` as their elements' texts. ``rest`` maps
    every other key to its text and ``failed_values`` each field that did not convert to its own, so no value is lost. ``keys`` is the result of
    ``field_keys``: a row per file, joined by its key.
    """
    raw = files.select(
        F.col(feed).alias("feed"),
        F.col(file_no).alias("file_no"),
        F.when(readable(F.col(payload)).isNotNull(), F.from_json(F.col(payload), "map<string,string>")).alias("__map"),
    )
    joined = raw.join(keys.select("feed", "file_no", F.col("keys").alias("__keys")), ["feed", "file_no"], "left")
    text = {f: F.col("__map")[F.coalesce(F.col("__keys")[f], F.lit(f))] for f in fields}
    # Only text that is an array is read as one; any other value fails.
    cast = {f: F.when(text[f].startswith("["), F.from_json(text[f], t)) if t.startswith("array") else text[f].try_cast(t) for f, t in fields.items()}
    typed = [cast[f].alias(f) for f in fields]
    failed = F.array_compact(F.array(*[F.when(text[f].isNotNull() & cast[f].isNull(), F.lit(f)) for f in fields]))
    named = F.array(*[F.coalesce(F.col("__keys")[f], F.lit(f)) for f in fields])
    rest = F.map_filter(F.col("__map"), lambda k, v: ~F.array_contains(named, k))
    lost = F.array_compact(F.array(*[F.when(text[f].isNotNull() & cast[f].isNull(), F.struct(F.lit(f), text[f])) for f in fields]))
    return joined.select("feed", "file_no", *typed, failed.alias("failed_casts"), F.col("__map").isNull().alias("unreadable"), rest.alias("rest"), F.map_from_entries(lost).alias("failed_values"))
