"""Records of two sources matched without a common key, each match with a calibrated confidence.

1. Distinct values only: names, (name, seat) pairs and (name, seat, state) triples of the left side; names and rows of the
   right side. Repeats come back at the end by ``lookup_join``.
2. Candidates by MinHash over letter pieces: bands of the name alone, and bands that join one hash of the name with one
   of the seat, so that a name cut to initials still meets its seat. Every band bucket is used whole. Besides, exact joins find what
   bands may miss: names with two tokens in common, one of them perhaps with one edit, or with a token and an initial.
3. Pairwise similarities: token pairing of the names, edit likeness of seat and state, indicators for what is missing.
4. A logistic classifier, fitted on a bounded sample of weakly labelled pairs (``SAMPLE`` rows): see ``weak_labels`` and
   ``training``; copies with blanked attributes teach it what a missing one is worth. Scores of pairs held out in turn, each weighted by
   how many pairs it stands for, calibrate it by Platt's method: the confidences are for the candidates' own rate of matches.
5. The best candidate is the match if its probability is ``least`` or more after it has been shared with its rivals.

Edge cases. Blank and null attributes are missing, as are "not stated" and the like. A record without a name has no match.
Where no pair agrees in all attributes nothing can be learnt, and no record is matched at all. Repeated records get the same match each. Ties (two right records alike in all that is known) are no match. Empty tables give
an empty result. Very long values are compared whole. Only the named columns are read.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.text import present
from ledgerloom.llm import names, variants
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import staged

LOG = logging.getLogger(__name__)

#: Most rows the classifier is fitted on: a third each of pairs labelled a match, pairs labelled none, and matches set beside a stranger.
SAMPLE = 40_000
#: Name bands: how many, and hashes in each.
NAME_BANDS, NAME_ROWS = 20, 5
#: Bands of name and seat: how many, and hashes of each in one.
CROSS_BANDS, CROSS_NAME, CROSS_SEAT = 24, 2, 3
#: Least Jaccard similarity of two names' trigrams for their tokens to be paired off.
LEAST_JACCARD = 0.25
FEATURES = [
    "whole", "part", "weakest", "initials", "left_over", "seat", "seat_missing", "seat_differs", "state", "state_missing", "state_differs", "same_key",
]


# What stands for the parts of a seat and of a state's name.
DIRECTIONS = {"n": "north", "s": "south", "e": "east", "w": "west", "c": "central", "r": "rural", "u": "upper", "l": "lower"}


def place(c: Column) -> Column:
    """A seat or state as compared: plain letters, without what announces or classes it; null where not stated."""
    s = F.translate(F.lower(c), names.MARKED, names.PLAIN)
    s = F.regexp_replace(s, r"\((?:sc|st|gen|general)\)?", " ")
    s = F.regexp_replace(s, r"[^a-z0-9\p{L}. ]+", " ")
    s = F.regexp_replace(s, r"(?<![a-z])(?:constituency|seat|ls|govt|government|state|state of|of|the|union territory|ut)(?![a-z])\.?", " ")
    for letter, word in DIRECTIONS.items():
        s = F.regexp_replace(s, rf"(?<![a-z.]){letter}\.?(?![a-z.])", word)
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.when(~s.isin("", "not stated", "not d", "na", "n a", "n.a.", "none", "unknown", "nil", "."), s)


def _glued(c: Column) -> Column:
    """Without blanks and dots, by sound: what is compared letter by letter."""
    return names.sound(F.regexp_replace(c, "[ .]+", ""))


def minhashes(df: DataFrame, pieces: Column, n: int, seed: int, out: str) -> DataFrame:
    """``df`` with n minimum hashes of a set of strings, as an array of bigint in column ``out``.

    Each step is its own projection, so that none is computed more than once a row.
    """
    base = df.withColumn("__pieces", F.transform(pieces, lambda p: F.xxhash64(p, F.lit(seed))))

    # One expression, however many hashes: the driver plans anew after every stage.
    hashed = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.array_min(F.transform("__pieces", lambda h: F.xxhash64(h, k))))
    return base.withColumn(out, hashed).drop("__pieces")


def candidates(left_names: DataFrame, right_names: DataFrame) -> DataFrame:
    """Pairs (l, r) of ids of names that share a name band; each side has id and tokens."""

    def banded(df: DataFrame, name: str) -> DataFrame:
        hashed = minhashes(df, names.grams(F.col("tokens")), NAME_BANDS * NAME_ROWS, 1, "h")
        h = F.col("h")
        bands = F.transform(F.sequence(F.lit(0), F.lit(NAME_BANDS - 1)), lambda b: F.xxhash64(b, *[h[b * NAME_ROWS + r] for r in range(NAME_ROWS)]))
        return hashed.select(F.col("id").alias(name), F.explode(bands).alias("band"))

    return banded(left_names, "l").join(banded(right_names, "r"), "band").select("l", "r").distinct()


def cross_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (l, r) of ids of names met in a band of name hashes and seat hashes; each side has id, tokens and seat."""

    def banded(df: DataFrame, name: str) -> DataFrame:
        both = minhashes(df.where("seat is not null"), names.grams(F.col("tokens")), CROSS_BANDS * CROSS_NAME, 2, "n")
        both = minhashes(both, names.grams(F.array(_glued(F.col("seat")))), CROSS_BANDS * CROSS_SEAT, 3, "s")
        parts = lambda b: [F.col("n")[b * CROSS_NAME + i] for i in range(CROSS_NAME)] + [F.col("s")[b * CROSS_SEAT + i] for i in range(CROSS_SEAT)]
        bands = F.transform(F.sequence(F.lit(0), F.lit(CROSS_BANDS - 1)), lambda b: F.xxhash64(b, *parts(b)))
        return both.select(F.col("id").alias(name), F.explode(bands).alias("band")).distinct()

    return banded(left, "l").join(banded(right, "r"), "band").select("l", "r").distinct()


def token_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (l, r) of ids of names, found exactly, that need no seat to meet; each side has id and tokens.

    They share two tokens, of which one may be one edit off and one is the rarest of either name; or a token, perhaps one edit off, and
    an initial of the left name; or the only token of the left name.
    """
    spread = lambda df: staged(df.select("id", F.size(F.array_distinct("tokens")).alias("size"), F.explode(F.array_distinct("tokens")).alias("t")), "entity-tokens")
    lt, rt = spread(left), spread(right)
    full = lambda df: df.where(F.length("t") > 1).select("id", "size", "t")
    df = full(rt).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    words = full(lt).select("t").unionByName(full(rt).select("t")).distinct()
    near = variants.edit_join(words.where(F.length("t") > 2).select(F.col("t").alias("item"), F.col("t").alias("word"))).select(F.col("a").alias("t"), F.col("b").alias("y"), F.lit(1).alias("edits"))
    near = near.unionByName(words.select("t", F.col("t").alias("y"), F.lit(0).alias("edits"))).join(df.withColumnRenamed("t", "y"), "y")
    # Left tokens as they occur on the right.
    seen = staged(full(lt).join(near, "t"), "entity-seen")
    pair = lambda x, y: F.concat_ws(" ", F.least(x, y), F.greatest(x, y))
    other = lambda df, *c: df.select("id", *[F.col(x).alias(f"o_{x}") for x in c])
    looked = seen.join(other(seen, "t", "y", "edits", "df"), "id").where("t < o_t and y <> o_y and edits + o_edits <= 1")
    # The rarer token of each left pair that leads is the rarest that the name has on the right, as it is or one edit off.
    rarest = seen.groupBy("id").agg(F.min("df").alias("least"))
    looked = looked.join(rarest, "id").select(F.col("id").alias("l"), pair("y", "o_y").alias("pair"), (F.least("df", "o_df") <= F.col("least")).alias("l_lead"))
    looked = looked.groupBy("l", "pair").agg(F.max("l_lead").alias("l_lead"))
    offered = full(rt).join(df, "t")
    lead = offered.groupBy("id").agg(F.min_by("t", F.struct("df", "t")).alias("lead"))
    offered = offered.join(other(offered, "t"), "id").where("t < o_t").join(lead, "id")
    offered = offered.select(F.col("id").alias("r"), pair("t", "o_t").alias("pair"), ((F.col("t") == F.col("lead")) | (F.col("o_t") == F.col("lead"))).alias("r_lead"))
    twos = looked.join(offered, "pair").where("l_lead or r_lead").select("l", "r")
    letters = lt.where(F.length("t") == 1).select("id", F.col("t").alias("letter")).join(seen, "id").select(F.col("id").alias("l"), "y", "letter")
    named = full(rt).join(other(rt, "t"), "id").where("t <> o_t").select(F.col("id").alias("r"), F.col("t").alias("y"), F.substring("o_t", 1, 1).alias("letter"))
    initials = letters.distinct().join(named.distinct(), ["y", "letter"]).select("l", "r")
    alone = seen.where("size = 1").select(F.col("id").alias("l"), "y").join(full(rt).select(F.col("id").alias("r"), F.col("t").alias("y")), "y").select("l", "r")
    return twos.unionByName(initials).unionByName(alone).distinct()


NAME_FEATURES = T.StructType([T.StructField(n, T.DoubleType()) for n in ("whole", "part", "weakest", "initials", "left_over")])


@F.pandas_udf(NAME_FEATURES)
def _name_features(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    rows = [names.pairing(list(x), list(y)) for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(rows, columns=NAME_FEATURES.names, dtype="float64")


def _likeness(a: Column, b: Column) -> Column:
    """1 - edits / length of the longer, with a written abbreviation (a beginning closed by a dot) counted as alike."""
    x, y = _glued(a), _glued(b)
    longest = F.greatest(F.length(x), F.length(y), F.lit(1))
    words = lambda c: _glued(F.array_join(F.array_sort(F.split(F.regexp_replace(c, "[.]", ""), " ")), ""))
    near = 1 - F.least(F.levenshtein(x, y), F.levenshtein(words(a), words(b))) / longest
    # "Yutha. Central" against "yuthamer central": the words before the dot must begin the other.
    cut = F.regexp_extract(a, r"^([a-z]{3,})\.", 1)
    tail = F.regexp_extract(a, r"\. ?(.*)$", 1)
    short = (cut != "") & b.startswith(cut) & ((tail == "") | b.endswith(tail))
    return F.when(short, F.greatest(near, F.lit(0.9))).otherwise(near)


def _state_likeness(a: Column, b: Column) -> Column:
    """As for seats; two letters that begin the state and occur in it in order count as its abbreviation."""
    letters = F.regexp_replace(a, "[ .]", "")
    short = (F.length(letters) == 2) & (F.substring(b, 1, 1) == F.substring(letters, 1, 1)) & F.substring(b, 2, 99).contains(F.substring(letters, 2, 1))
    return F.when(short, F.lit(0.85)).otherwise(_likeness(a, b))


def features(pairs: DataFrame) -> DataFrame:
    """``pairs`` with seat and state features; it has l_seat, l_state, r_seat, r_state and the name features."""
    seat, state = _likeness(F.col("l_seat"), F.col("r_seat")), _state_likeness(F.col("l_state"), F.col("r_state"))
    no_seat = F.col("l_seat").isNull() | F.col("r_seat").isNull()
    no_state = F.col("l_state").isNull() | F.col("r_state").isNull()
    flag = lambda c: c.cast("double")
    out = pairs.withColumn("seat", F.when(no_seat, 0.0).otherwise(seat)).withColumn("state", F.when(no_state, 0.0).otherwise(state))
    return (
        out.withColumn("seat_missing", flag(no_seat))
        .withColumn("seat_differs", flag(~no_seat & (F.col("seat") < 0.6)))
        .withColumn("state_missing", flag(no_state))
        .withColumn("state_differs", flag(~no_state & (F.col("state") < 0.6)))
        .withColumn("same_key", flag(F.col("lk") == F.col("rk")))
    )


@dataclass(frozen=True)
class Model:
    """Weights of the standardised features, and Platt's two numbers."""

    weights: list[float]
    offset: float
    slope: float
    shift: float

    def probability(self) -> Column:
        raw = F.lit(self.offset)
        for w, f in zip(self.weights, FEATURES, strict=True):
            raw = raw + F.lit(w) * F.col(f)
        return 1 / (1 + F.exp(-(F.lit(self.slope) * raw + F.lit(self.shift))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the last one the offset) by Newton's method with a ridge; defined for labels of one class too."""
    x = np.hstack([x, np.ones((len(x), 1))])
    each = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (each * (y - p)) - keep * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Parts the labelled pairs are cut into; each is scored by the classifier of the others.
FOLDS = 4


def fit(labelled: pd.DataFrame) -> Model:
    """The classifier of a bounded sample: ``label``, the features, ``pair`` (all writings of a pair share a fold), ``weight`` (the pairs it stands for).

    Ranking is learnt from the sample as it is, half of each label; only the calibration knows how frequent each label is.
    """
    x, y, weight = labelled[FEATURES].to_numpy(float), labelled["label"].to_numpy(float), labelled["weight"].to_numpy(float)
    fold = labelled["pair"].to_numpy() % FOLDS
    raw = np.zeros(len(x))
    for k in range(FOLDS):
        own, rest = fold == k, fold != k
        if own.any():
            w = _logistic(x[rest], y[rest])
            raw[own] = x[own] @ w[:-1] + w[-1]
    platt = _logistic(raw[:, None], y, weight, ridge=1e-3)
    w = _logistic(x, y)
    return Model([float(v) for v in w[:-1]], float(w[-1]), float(platt[0]), float(platt[1]))


def weak_labels(scored: DataFrame) -> DataFrame:
    """Pairs with a weak label, each with ``pair``, a number of its own.

    Records with all attributes decide: a pair that agrees in seat and state and pairs off its name, or has the whole name
    and one of the two, is a match; the other pairs of a record with one such pair are none.
    """
    full = scored.where("seat_missing = 0 and state_missing = 0")
    near_seat, near_state = F.col("seat") >= 0.8, F.col("state") >= 0.8
    sure = (near_seat & near_state & (F.col("part") >= 0.7) & (F.col("left_over") <= 1)) | ((near_seat | near_state) & (F.col("whole") >= 0.95))
    per = Window.partitionBy("lk", "l_seat", "l_state")
    marked = full.withColumn("sure", sure.cast("int")).withColumn("n", F.sum("sure").over(per)).where("n = 1")
    pair = F.xxhash64("lk", "l_seat", "l_state", "rk", "r_seat", "r_state", "r_id")
    return marked.select(F.col("sure").cast("double").alias("label"), pair.alias("pair"), "lk", "l_seat", "l_state", "r_id", *FEATURES)


def blanked(pairs: pd.DataFrame) -> pd.DataFrame:
    """Each pair in four writings: as it is, without the seat, without the state, without either."""
    no_seat, no_state = {"seat": 0.0, "seat_missing": 1.0, "seat_differs": 0.0}, {"state": 0.0, "state_missing": 1.0, "state_differs": 0.0}
    return pd.concat([pairs, pairs.assign(**no_seat), pairs.assign(**no_state), pairs.assign(**no_seat, **no_state)], ignore_index=True)


def training(labelled: DataFrame, members: DataFrame, rows: int = SAMPLE, seed: int = 5) -> pd.DataFrame:
    """At most ``rows`` labelled rows for ``fit``: pairs of either label by a seeded hash of the pair itself, in four writings each.

    Candidates alone may lack pairs that are none, so matches are also set beside a right record of another person, drawn by the same
    kind of order; those stand for themselves only. Empty where no pair is labelled a match.
    """
    most = rows // 12
    total = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.lit(seed), "pair")
    taken = [labelled.where(F.col("label") == v).orderBy(order, "pair").limit(most).toPandas() for v in (0.0, 1.0)]
    if taken[1].empty:
        return taken[1].assign(weight=1.0)
    for v, part in enumerate(taken):
        part["weight"] = total.get(float(v), 0) / max(len(part), 1)
    others = members.orderBy(F.xxhash64(F.lit(seed), "r_id", "rk", "r_seat", "r_state"), "r_id").limit(most).toPandas()
    beside = taken[1][["lk", "l_seat", "l_state", "r_id", "pair"]].rename(columns={"r_id": "own"})
    beside = pd.concat([beside.reset_index(drop=True), others.iloc[np.arange(len(beside)) % len(others)].reset_index(drop=True)], axis=1)
    beside = beside[beside["own"] != beside["r_id"]].drop(columns="own")
    schema = "lk string, l_seat string, l_state string, pair bigint, rk string, r_seat string, r_state string, r_id string"
    rows_beside = [tuple(None if pd.isna(v) else v for v in r) for r in beside[[c.split()[0] for c in schema.split(", ")]].astype({"r_id": "str"}).itertuples(index=False)]
    apart = labelled.sparkSession.createDataFrame(rows_beside, schema)
    named = apart.withColumn("f", _name_features(F.split("lk", " "), F.split("rk", " "))).select(*apart.columns, "f.*")
    strangers = features(named).select("pair", *FEATURES).toPandas().assign(label=0.0, weight=1.0)
    made = blanked(pd.concat([*taken, strangers], ignore_index=True)[["label", "pair", "weight", *FEATURES]])
    distinct = made.drop_duplicates(["label", *FEATURES])
    LOG.info("classifier sample: %d rows, %d distinct vectors, by label %s of %s", len(made), len(distinct), made["label"].value_counts().to_dict(), total)
    return made


def match(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_columns: tuple[str, str, str],
    right_id: str,
    right_columns: tuple[str, str, str],
    least: float = 0.5,
) -> DataFrame:
    """left_id, right_id and confidence of every left record with a match; columns are (name, seat, state) of each side."""

    def shaped(df: DataFrame, columns: tuple[str, str, str], keep: str) -> DataFrame:
        name, seat, state = columns
        tokens = names.folded(present(F.col(name)))
        out = df.select(F.col(keep).alias("id"), tokens.alias("tokens"), place(F.col(seat)).alias("seat"), place(F.col(state)).alias("state"))
        return out.where(F.size("tokens") > 0).withColumn("key", F.array_join("tokens", " "))

    l_rows = staged(shaped(left, left_columns, left_id), "entity-left")
    r_rows = staged(shaped(right, right_columns, right_id).where("id is not null").distinct(), "entity-right")
    # Names go by a number while candidates are sought: a pair is then 16 bytes.
    numbered = lambda df, *more: df.select(F.xxhash64("key").alias("id"), "key", "tokens", *more).distinct()
    l_names, r_names = (staged(numbered(df), "entity-names") for df in (l_rows, r_rows))
    # Candidates are sought in two steps and scored in a third, so that none is planned anew with the stages of another.
    banded = staged(candidates(l_names, r_names).unionByName(cross_candidates(numbered(l_rows, "seat"), numbered(r_rows, "seat"))).withColumn("exact", F.lit(False)), "entity-banded")
    pairs = staged(banded.unionByName(token_candidates(l_names, r_names).withColumn("exact", F.lit(True))).groupBy("l", "r").agg(F.max("exact").alias("exact")), "entity-pairs")
    side = lambda df, i, k, t: df.select(F.col("id").alias(i), F.col("key").alias(k), F.col("tokens").alias(t))
    pairs = pairs.join(side(l_names, "l", "lk", "lt"), "l").join(side(r_names, "r", "rk", "rt"), "r")
    # A cheap look at the trigrams on the JVM before the tokens are paired off; initials have few, so it is for the bands' pairs only.
    lg, rg = names.grams(F.col("lt")), names.grams(F.col("rt"))
    pairs = pairs.withColumn("lg", lg).withColumn("rg", rg).withColumn("shared", F.size(F.array_intersect("lg", "rg")))
    pairs = pairs.where(F.col("exact") | (F.col("shared") >= LEAST_JACCARD * (F.size("lg") + F.size("rg") - F.col("shared")))).select("lk", "rk", "lt", "rt")
    # Every token of the shorter name must find a partner; what fails that is no writing of the same name.
    named = pairs.withColumn("f", _name_features("lt", "rt")).select("lk", "rk", "f.*")
    named = staged(named.where("part >= 0.55 and left_over <= 2 and weakest >= 0.55"), "entity-named")
    triples = l_rows.select(F.col("key").alias("lk"), F.col("seat").alias("l_seat"), F.col("state").alias("l_state")).distinct()
    members = r_rows.select(F.col("key").alias("rk"), F.col("seat").alias("r_seat"), F.col("state").alias("r_state"), F.col("id").alias("r_id"))
    scored = staged(features(triples.join(named, "lk").join(members, "rk")), "entity-scored")
    learnt = training(staged(weak_labels(scored), "entity-labels"), members)
    if learnt.empty:
        none = F.lit(None).cast(r_rows.schema["id"].dataType)
        return l_rows.limit(0).select(F.col("id").alias("left_id"), none.alias("right_id"), F.lit(0.0).alias("confidence"))
    model = fit(learnt)
    record = ["lk", "l_seat", "l_state"]
    each = scored.withColumn("p", model.probability()).groupBy(*record, "r_id").agg(F.max("p").alias("p"))
    rivals = Window.partitionBy(*record)
    odds = F.col("p") / F.greatest(1 - F.col("p"), F.lit(1e-9))
    # The chance that this one is the match, given that at most one of the record's candidates is.
    shared = each.withColumn("odds", odds).withColumn("confidence", F.col("odds") / (1 + F.sum("odds").over(rivals)))
    best = shared.withColumn("at", F.row_number().over(rivals.orderBy(F.desc("confidence"), "r_id"))).where((F.col("at") == 1) & (F.col("confidence") >= least))
    nul = F.lit("\u0000")
    token = F.xxhash64("lk", F.coalesce("l_seat", nul), F.coalesce("l_state", nul))
    found = staged(best.select(token.alias("record"), *record, F.col("r_id").alias("right_id"), "confidence"), "entity-best")
    rows = l_rows.select(
        F.col("id").alias("left_id"), F.xxhash64("key", F.coalesce("seat", nul), F.coalesce("state", nul)).alias("record"), "key", "seat", "state"
    )
    joined = lookup_join(rows, found, ["record"], "inner")
    same = (F.col("key") == F.col("lk")) & F.col("seat").eqNullSafe(F.col("l_seat")) & F.col("state").eqNullSafe(F.col("l_state"))
    return joined.where(same).select("left_id", "right_id", "confidence")
