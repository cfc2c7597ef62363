"""Writings of one name put together: n-gram cosine joins, then average-linkage clustering.

1. Written forms fold to token lists (``names.folded``); forms that fold alike are one key. A token that is two frequent
   tokens written together is parted.
2. A key's vector holds the letter trigrams of its tokens and the first letter of each (which is all that an initial says), weighted by
   inverse document frequency over all keys, at unit length. The dot product of two names is the sum of those of their tokens, so
   the sparse join runs over tokens: distinct tokens become vectors themselves, and ``cosine_join`` finds all pairs from
   ``TOKEN_COSINE`` on (trigrams are ordered by rarity, and only the prefix that any partner must share is joined). What one edit
   leaves of a short token may lie below any useful cosine, so tokens one edit apart are joined exactly besides.
3. Two keys meet if they share two tokens, or one and a neighbour of another; a key with initials, if it
   shares a token and an initial. The rarer token leads, so that pairs which have only common tokens in common never meet. Pairs that meet get
   the cosine of their whole vectors; those from ``NAME_COSINE`` on stay, each key with its ``top`` nearest (all of them unless told otherwise).
4. An exact check keeps the pairs whose tokens all pair off but for slips; their cosines are the links, clustered by average linkage, each
   writing weighted by how often it occurs. Linked keys fall into components first; a component of up to ``SMALL`` links is
   clustered in one task, larger ones in distributed rounds with the same result: in every round all clusters that are each other's
   nearest merge, which is right because average linkage is reducible.
5. A key that says less (initials, a missing middle name) joins the cluster it fits if it fits only one and is not, without
   initials, a name the caller knows to be someone's own (``known``). How often it is written does not count.

Edge cases. Null and blank forms, and those with titles alone, are no writings of anyone. Repeated forms count as
occurrences. Forms that fold alike but stand for namesakes cannot be told apart here; clusters with a name that several owners of
``known`` bear in full are marked. Very long forms are compared whole. Empty inputs give an empty result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.text import present
from ledgerloom.llm import names
from ledgerloom.session import staged

#: Least cosine of two tokens' trigram vectors and of two names' vectors, and least average cosine of two clusters that merge.
TOKEN_COSINE, NAME_COSINE, LINKAGE = 0.36, 0.3, 0.3
#: Links of a component that one task clusters; larger components are clustered in distributed rounds.
SMALL = 20_000


def cosine_join(items: DataFrame, least: float = TOKEN_COSINE, edits: int | None = None) -> DataFrame:
    """Pairs (a, b), a <> b in both orders, of ``items`` (item) whose trigram vectors have cosine ``least`` or more.

    With ``edits``, only pairs at most so many edits apart; they are told before the costlier product. Exact: vectors have inverse document frequency weights and unit length over the trigrams that occur in two items or more.
    """
    listed = items.select("item", F.explode(names.grams(F.array("item"))).alias("gram"))
    df = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    total = items.agg(F.count(F.lit(1)).alias("total"))
    weights = df.join(F.broadcast(total)).select("gram", "df", F.log1p(F.col("total") / F.col("df")).alias("idf"))
    whole = Window.partitionBy("item")
    vectors = listed.join(weights, "gram").withColumn("w", F.col("idf") / F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(whole)))
    rest = Window.partitionBy("item").orderBy("df", "gram").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    vectors = staged(vectors.withColumn("rest", F.sqrt(F.sum(F.col("w") * F.col("w")).over(rest))).select("item", "gram", "w", "rest"), "cosine-vectors")
    # From the first place on where what is left is shorter than the threshold, nothing new can reach it.
    prefix = vectors.where(F.col("rest") >= least - 1e-9)
    a = prefix.select(F.col("item").alias("a"), "gram")
    b = prefix.select(F.col("item").alias("b"), "gram")
    met = a.join(b, "gram").where("a < b")
    if edits is not None:
        met = met.where(F.abs(F.length("a") - F.length("b")) <= edits)
    met = met.select("a", "b").distinct()
    if edits is not None:
        met = met.where(F.levenshtein("a", "b", edits) >= 0)
    packed = vectors.groupBy("item").agg(F.map_from_entries(F.collect_list(F.struct("gram", "w"))).alias("v"))
    both = met.join(packed.select(F.col("item").alias("a"), F.col("v").alias("va")), "a").join(packed.select(F.col("item").alias("b"), F.col("v").alias("vb")), "b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("vb"), e["key"]), F.lit(0.0)))
    near = staged(both.select("a", "b", dot.alias("cosine")).where(F.col("cosine") >= least - 1e-9), "cosine-pairs")
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))


def edit_join(items: DataFrame) -> DataFrame:
    """Pairs (a, b), a <> b in both orders, of ``items`` (item, word) with words one edit apart, a swap of neighbours being one.

    Exact: such words, and no others but some two edits apart, have a writing in common when nothing or one letter is left out.
    """
    length = F.length("word")
    out = F.transform(F.sequence(F.lit(1), length), lambda i: F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, length)))
    left = items.where(length > 0).select("item", "word", F.explode(F.array_distinct(F.concat(F.array("word"), out))).alias("left"))
    a = left.select(F.col("item").alias("a"), F.col("word").alias("x"), "left")
    b = left.select(F.col("item").alias("b"), F.col("word").alias("y"), "left")
    met = a.join(b, "left").where("a < b").select("a", "b", "x", "y").distinct()
    # Two edits on words of one length are a swap if the words are equal but for two neighbouring letters.
    at = lambda c, i: F.substring(c, i, F.lit(1))
    same = lambda i: at(F.col("x"), i) == at(F.col("y"), i)
    differ = F.filter(F.sequence(F.lit(1), F.length("x")), lambda i: ~same(i))
    i, j = F.get(differ, F.lit(0)), F.get(differ, F.lit(1))
    swap = (F.length("x") == F.length("y")) & (F.size(differ) == 2) & (j == i + 1) & (at(F.col("x"), i) == at(F.col("y"), j)) & (at(F.col("x"), j) == at(F.col("y"), i))
    near = met.where((F.levenshtein("x", "y", 1) >= 0) | swap).select("a", "b").distinct()
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def partings(keys: DataFrame) -> DataFrame:
    """Tokens of ``keys`` (tokens) that are two much more frequent ones written together: token, parts."""
    token = keys.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    token = staged(token, "variants-tokens")
    cuts = token.where(F.length("token") >= 7).select("token", "n", F.explode(F.sequence(F.lit(3), F.length("token") - 3)).alias("i"))
    cuts = cuts.select("token", "n", F.substring("token", F.lit(1), F.col("i")).alias("x"), F.substring("token", F.col("i") + 1, F.length("token")).alias("y"))
    fits = (
        cuts.join(token.select(F.col("token").alias("x"), F.col("n").alias("nx")), "x")
        .join(token.select(F.col("token").alias("y"), F.col("n").alias("ny")), "y")
        .where("nx > 3 * n and ny > 3 * n")
    )
    return fits.groupBy("token").agg(F.max_by(F.array("x", "y"), F.struct(F.least("nx", "ny"), "x")).alias("parts"))


def part_tokens(keys: DataFrame, parts: DataFrame) -> DataFrame:
    """``keys`` (id, tokens) with the tokens of ``parts`` parted."""
    placed = keys.select("id", F.posexplode("tokens").alias("at", "token")).join(parts, "token", "left")
    made = placed.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("parts", F.array("token")).alias("t")))).alias("list"))
    return keys.drop("tokens").join(made.select("id", F.flatten(F.col("list.t")).alias("tokens")), "id")


def name_cosines(keys: DataFrame, pairs: DataFrame, least: float = NAME_COSINE, top: int | None = None) -> DataFrame:
    """The ``pairs`` (a, b) of ``keys`` (id, tokens) whose vectors have cosine ``least`` or more: a, b, cosine.

    With ``top``, a pair stays if it is among the nearest ``top`` of either side; without, all stay.
    """
    firsts = F.transform("tokens", lambda t: F.concat(F.lit("<"), F.substring(t, 1, 1)))
    listed = keys.select("id", F.explode(F.array_distinct(F.concat(names.grams(F.col("tokens")), firsts))).alias("gram"))
    total = keys.agg(F.count(F.lit(1)).alias("total"))
    weights = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).join(F.broadcast(total)).select("gram", F.log1p(F.col("total") / F.col("df")).alias("idf"))
    vectors = listed.join(weights, "gram").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("gram", "idf"))).alias("v"), F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("n"))
    vectors = staged(vectors, "variants-vectors")
    side = lambda i: vectors.select(F.col("id").alias(i), F.col("v").alias(f"v{i}"), F.col("n").alias(f"n{i}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    dot = F.aggregate(F.map_entries("va"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("vb"), e["key"]), F.lit(0.0)))
    near = both.select("a", "b", (dot / (F.col("na") * F.col("nb"))).alias("cosine")).where(F.col("cosine") >= least - 1e-9)
    if top is None:
        return near
    either = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    kept = either.withColumn("__at", place).where(F.col("__at") <= top)
    return kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine").distinct()


SHAPE = T.StructType([T.StructField("likeness", T.DoubleType()), T.StructField("kind", T.StringType())])

#: A token this much rarer than its neighbour may be a slip for it (one more key being no evidence); two common tokens are two names.
SLIP = 0.25


def slip(a: dict, b: dict) -> float:
    """Likeness of two tokens (t, raw, n): 1 if equal, 0.9 for one edit of a rare one, 0.6 for an initial, else 0."""
    if a["t"] == b["t"]:
        return 1.0
    if len(a["t"]) == 1 or len(b["t"]) == 1:
        return 0.6 if a["t"][0] == b["t"][0] else 0.0
    if min(a["n"], b["n"]) > 1 + SLIP * max(a["n"], b["n"]) or min(len(a["t"]), len(b["t"])) < 3:
        return 0.0
    near = lambda x, y: abs(len(x) - len(y)) <= 1 and names.edits(*sorted((x, y))) <= 1
    return 0.9 if near(a["t"], b["t"]) or near(a["raw"], b["raw"]) else 0.0


def compare(x: list[dict], y: list[dict]) -> tuple[float, str | None]:
    """likeness and kind of two token lists: full (the same tokens but for slips), less (x says less than y), or None."""
    scores = sorted(((slip(p, q), -abs(i - j), i, j) for i, p in enumerate(x) for j, q in enumerate(y)), reverse=True)
    used_x, used_y, total, exact = set(), set(), 0.0, 0
    for score, _, i, j in scores:
        if score <= 0:
            break
        if i not in used_x and j not in used_y:
            used_x.add(i)
            used_y.add(j)
            total += score
            exact += score == 1.0 and len(x[i]["t"]) > 1
    full_x, full_y = sum(len(p["t"]) > 1 for p in x), sum(len(q["t"]) > 1 for q in y)
    if len(used_x) < len(x) or not exact or full_y < 2:
        return 0.0, None
    whole = total / max(len(x), len(y))
    if len(x) == len(y) and full_x == full_y == len(x):
        return whole, "full"
    return (total / len(x), "less") if full_x < full_y and len(y) - len(x) <= 1 else (whole, None)


@F.pandas_udf(SHAPE)
def _compare(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([compare(list(x), list(y)) for x, y in zip(a, b, strict=True)], columns=SHAPE.names)


def candidate_keys(keys: DataFrame, near: DataFrame) -> DataFrame:
    """Pairs (a, b) of key ids that share two tokens, nearly two, or a token and an initial."""
    df = keys.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    placed = keys.select("id", F.explode(F.array_distinct("tokens")).alias("token")).join(df, "token")
    placed = staged(placed, "variants-placed")
    full = placed.where(F.length("token") > 1)
    rarest = full.groupBy("id").agg(F.min_by("token", F.struct("df", "token")).alias("lead"))
    others = full.select("id", F.col("token").alias("other"))
    # What a key can be found by: its rarest token with each other one.
    pair = lambda x, y: F.concat_ws(" ", F.least(x, y), F.greatest(x, y))
    targets = rarest.join(others, "id").where("lead <> other").select(F.col("id").alias("b"), pair("lead", "other").alias("pair"))
    # What a key looks for: all pairs of its tokens, as they are and with one of the two replaced by a neighbour.
    twos = full.select("id", F.col("token").alias("x")).join(others, "id").where("x <> other")
    exact = twos.where("x < other").select(F.col("id").alias("a"), pair("x", "other").alias("pair"))
    moved = twos.join(near.select(F.col("a").alias("x"), F.col("b").alias("y")), "x").where("y <> other").select(F.col("id").alias("a"), pair("y", "other").alias("pair"))
    met = exact.unionByName(moved).distinct().join(targets.distinct(), "pair").where("a <> b").select("a", "b")
    # Keys with initials look for a token with an initial; every key of full tokens offers those.
    short = placed.where(F.length("token") == 1).select("id", F.col("token").alias("letter"))
    looked = short.join(others, "id").select(F.col("id").alias("a"), F.concat_ws(".", "letter", "other").alias("pair"))
    offered = twos.select(F.col("id").alias("b"), F.concat_ws(".", F.substring("x", 1, 1), F.col("other")).alias("pair"))
    by_letter = looked.distinct().join(offered.distinct(), "pair").where("a <> b").select("a", "b")
    met = met.unionByName(by_letter)
    return met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node in it) of all nodes of ``links`` (a, b): each takes its neighbours' least label, then that label's own."""
    ends = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-ends")
    label = staged(ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")), "components-label")
    while True:
        seen = ends.join(label.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("near"))
        lower = label.join(seen, "a").select("a", "c", F.least("c", "near").alias("low"))
        jump = label.select(F.col("a").alias("low"), F.col("c").alias("next"))
        after = staged(lower.join(jump, "low").select("a", F.least("low", "next").alias("c"), (F.least("low", "next") < F.col("c")).alias("moved")), "components-label")
        if after.where("moved").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("c").alias("component"))
        label = after.select("a", "c")


def _linked(links: pd.DataFrame, least: float) -> dict:
    """``linkage_rounds`` over whole components in memory: node -> cluster, from rows a, b, likeness, wa, wb."""
    size: dict[int, float] = {}
    sums: dict[int, dict[int, float]] = {}
    for a, b, s, wa, wb in links.itertuples(index=False):
        size[a], size[b] = float(wa), float(wb)
        sums.setdefault(a, {})[b] = sums.setdefault(b, {})[a] = s * wa * wb
    into = {n: n for n in size}
    fresh = set(sums)
    best: dict[int, int] = {}
    while fresh:
        for a in fresh:
            near = [(s / (size[a] * size[b]), -b) for b, s in sums[a].items()]
            top = max((x for x in near if x[0] >= least), default=None)
            if top is None:
                best.pop(a, None)
            else:
                best[a] = -top[1]
        merges = sorted({(min(a, b), max(a, b)) for a in fresh if (b := best.get(a)) is not None and best.get(b) == a})
        fresh = set()
        for a, b in merges:
            size[a] += size.pop(b)
            best.pop(b, None)
            for c, s in sums.pop(b).items():
                del sums[c][b]
                if c != a:
                    sums[a][c] = sums[c][a] = sums[a].get(c, 0.0) + s
            into[b] = a
            fresh |= {a, *sums[a]}
        fresh &= sums.keys()

    def last(n: int) -> int:
        while into[n] != n:
            n = into[n]
        return n

    return {n: last(n) for n in into}


def average_linkage(nodes: DataFrame, links: DataFrame, least: float = LINKAGE, small: int = SMALL) -> DataFrame:
    """Clusters of weighted nodes: node, cluster (the least node in it).

    ``nodes`` has node and weight, ``links`` has a, b and likeness once a pair. The similarity of two clusters is the mean
    likeness over all pairs of their nodes, by weight, a missing link counting 0. In each round all pairs of clusters
    that are each other's nearest, from ``least`` on, merge; ties go to the smaller node. Components of up to ``small`` links are
    clustered in one task each.
    """
    links = staged(links.select("a", "b", "likeness"), "linkage-links")
    part = components(links)
    placed = staged(links.join(part.withColumnRenamed("node", "a"), "a"), "linkage-placed")
    large = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > small).select("component")
    weights = lambda c, w: nodes.select(F.col("node").alias(c), F.col("weight").alias(w))
    own = placed.join(large, "component", "left_anti").join(weights("a", "wa"), "a").join(weights("b", "wb"), "b")

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(_linked(part[["a", "b", "likeness", "wa", "wb"]], least).items()), columns=["node", "cluster"])

    # Components do not touch, so one call takes many small ones: as many groups as keep each at about SMALL links.
    groups = max(2 * nodes.sparkSession.sparkContext.defaultParallelism, -(-placed.count() // SMALL))
    done = own.groupBy(F.pmod(F.xxhash64("component"), F.lit(groups))).applyInPandas(cluster, "node bigint, cluster bigint")
    if not large.isEmpty():
        inside = part.join(large, "component", "left_semi").select("node")
        done = done.unionByName(linkage_rounds(nodes.join(inside, "node", "left_semi"), placed.join(large, "component", "left_semi").drop("component"), least))
    return nodes.select("node").join(done, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster"))


def linkage_rounds(nodes: DataFrame, links: DataFrame, least: float = LINKAGE) -> DataFrame:
    """As ``average_linkage``, all in distributed rounds."""
    weight = nodes.select("node", "weight")
    sums = links.join(weight.select(F.col("node").alias("a"), F.col("weight").alias("wa")), "a").join(weight.select(F.col("node").alias("b"), F.col("weight").alias("wb")), "b")
    edges = staged(sums.select("a", "b", (F.col("likeness") * F.col("wa") * F.col("wb")).alias("sum")), "linkage-edges")
    label = staged(nodes.select("node", F.col("node").alias("cluster"), "weight"), "linkage-label")
    size = staged(weight.select(F.col("node").alias("c"), F.col("weight").cast("double").alias("n")), "linkage-size")
    while True:
        both = edges.join(size.select(F.col("c").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b")
        alike = both.select("a", "b", (F.col("sum") / (F.col("na") * F.col("nb"))).alias("s")).where(F.col("s") >= least)
        either = alike.unionByName(alike.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        best = staged(either.groupBy("a").agg(F.max_by("b", F.struct(F.col("s"), -F.col("b"))).alias("b")), "linkage-best")
        back = best.select(F.col("b").alias("a"), F.col("a").alias("b"))
        merges = staged(best.join(back, ["a", "b"]).where("a < b").select(F.col("a").alias("into"), F.col("b").alias("old")), "linkage-merges")
        if merges.isEmpty():
            return label.select("node", "cluster")
        renamed = lambda df, c: df.join(merges.select(F.col("old").alias(c), F.col("into").alias("__into")), c, "left").withColumn(
            c, F.coalesce("__into", c)
        ).drop("__into")
        label = staged(renamed(label, "cluster"), "linkage-label")
        size = staged(renamed(size, "c").groupBy("c").agg(F.sum("n").alias("n")), "linkage-size")
        moved = renamed(renamed(edges, "a"), "b").where("a <> b")
        ordered = moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sum")
        edges = staged(ordered.groupBy("a", "b").agg(F.sum("sum").alias("sum")), "linkage-edges")


def cluster_forms(forms: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """form, key, cluster and namesakes of every distinct form of ``forms`` (form); cluster is a number shared by writings of one name.

    ``known`` (tokens, owner) has full names, as in a roster: a writing that is one of them is no shorter writing of another, and
    ``namesakes`` is true for clusters with one that several owners bear.
    """
    counted = forms.where(present(F.col("form")).isNotNull()).groupBy("form").agg(F.count(F.lit(1)).alias("n"))
    spelt = counted.withColumn("written", names.written(F.col("form"))).withColumn("tokens", F.transform("written", names.sound))
    folded = staged(spelt.where("size(tokens) > 0 and not array_contains(tokens, '')"), "variants-folded")
    raw = folded.groupBy(names.key(F.col("tokens")).alias("key")).agg(F.min("tokens").alias("tokens"), F.sum("n").alias("mentions"))
    raw = staged(raw.select(F.xxhash64("key").alias("id"), F.col("key").alias("raw_key"), "tokens", "mentions"), "variants-raw")
    parts = staged(partings(raw), "variants-parts")
    parted = staged(part_tokens(raw, parts), "variants-parted").withColumn("key", names.key(F.col("tokens")))
    keys = parted.groupBy(F.xxhash64("key").alias("id"), "key").agg(F.min("tokens").alias("tokens"), F.sum("mentions").alias("mentions"))
    keys = staged(keys, "variants-keys")
    spellings = folded.select("n", F.explode(F.arrays_zip("tokens", "written")).alias("z")).groupBy(F.col("z.tokens").alias("token"), F.col("z.written").alias("raw")).agg(F.sum("n").alias("n"))
    spellings = staged(spellings, "variants-spellings")
    near = cosine_join(staged(spellings.where(F.length("raw") > 2).select(F.col("raw").alias("item")).distinct(), "variants-items"), edits=2)
    sounds = lambda c, t: spellings.select(F.col("raw").alias(c), F.col("token").alias(t)).distinct()
    close = near.join(sounds("a", "ta"), "a").join(sounds("b", "tb"), "b").where("ta <> tb")
    common = staged(spellings.groupBy("token").agg(F.max_by("raw", F.struct("n", "raw")).alias("raw")), "variants-common")
    # As ``slip`` compares them: the tokens by sound, and as they are mostly written.
    words = lambda c: edit_join(common.where(F.length("token") > 2).select(F.col("token").alias("item"), F.col(c).alias("word")))
    close = close.select(F.col("ta").alias("a"), F.col("tb").alias("b")).unionByName(words("token")).unionByName(words("raw"))
    near_tokens = staged(close.distinct(), "variants-near")
    pairs = candidate_keys(keys, near_tokens)
    counts = keys.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    placed = keys.select("id", F.explode("tokens").alias("token")).join(counts, "token").join(common, "token", "left")
    told = F.struct(F.col("token").alias("t"), F.coalesce("raw", "token").alias("raw"), "n")
    tokens = staged(placed.groupBy("id").agg(F.collect_list(told).alias("tokens")), "variants-told")
    side = lambda c, t: tokens.select(F.col("id").alias(c), F.col("tokens").alias(t))
    near_names = staged(name_cosines(keys, pairs.where("a < b")), "variants-cosines")
    judged = near_names.join(side("a", "ta"), "a").join(side("b", "tb"), "b").withColumn("f", _compare("ta", "tb")).withColumn("g", _compare("tb", "ta"))
    judged = staged(judged.select("a", "b", "cosine", "f.kind", F.col("g.kind").alias("other")).where("kind is not null or other is not null"), "variants-judged")
    links = judged.where("kind = 'full'").select("a", "b", F.col("cosine").alias("likeness"))
    label = staged(average_linkage(keys.select(F.col("id").alias("node"), F.col("mentions").alias("weight")), links), "variants-label")
    less = judged.where("kind = 'less'").select("a", "b").unionByName(judged.where("other = 'less'").select(F.col("b").alias("a"), F.col("a").alias("b")))
    if known is None:
        own = keys.limit(0).select(F.col("id").alias("node"), F.lit(0).cast("bigint").alias("owners"))
    else:
        # The same parting on both sides, so that a name is one key wherever it is written.
        listed = known.where("size(tokens) > 0").withColumn("id", F.xxhash64("tokens"))
        split = part_tokens(listed.select("id", "tokens").distinct(), parts).select("id", F.xxhash64(names.key(F.col("tokens"))).alias("node"))
        own = staged(listed.select("id", "owner").join(split, "id").groupBy("node").agg(F.countDistinct("owner").alias("owners")), "variants-own")
    said = staged(_attach(keys, label, less, own.select("node")), "variants-attached")
    shared = said.join(own.where("owners > 1"), "node").select("cluster", F.lit(True).alias("namesakes")).distinct()
    by_key = parted.select("raw_key", F.col("key").alias("key"), F.xxhash64("key").alias("node")).join(said, "node").join(shared, "cluster", "left")
    joined = folded.withColumn("raw_key", names.key(F.col("tokens"))).join(by_key, "raw_key")
    return joined.select("form", "key", "cluster", F.coalesce("namesakes", F.lit(False)).alias("namesakes"))


def _attach(keys: DataFrame, label: DataFrame, less: DataFrame, own: DataFrame) -> DataFrame:
    """``label`` with the clusters of keys that say less joined to the one cluster they fit; those with a node of ``own`` stay."""
    at = lambda c, name: label.select(F.col("node").alias(c), F.col("cluster").alias(name))
    fits = less.join(at("a", "from"), "a").join(at("b", "to"), "b").where(F.col("from") != F.col("to"))
    initials = keys.select(F.col("id").alias("a"), F.exists("tokens", lambda t: F.length(t) == 1).alias("initials"))
    options = fits.join(initials, "a").groupBy("from", "to").agg(F.bool_and("initials").alias("initials"))
    # Among clusters that it fits, those that themselves say less than another of them do not count as rivals.
    inner = options.select("from", F.col("to").alias("x")).join(options.select(F.col("from").alias("x"), F.col("to").alias("y")), "x")
    covered = inner.join(options.select("from", F.col("to").alias("y")), ["from", "y"]).select("from", F.col("x").alias("to")).distinct()
    top = options.join(covered, ["from", "to"], "left_anti")
    one = top.groupBy("from").agg(F.bool_and("initials").alias("initials"), F.count(F.lit(1)).alias("n"), F.first("to").alias("to"))
    stays = label.join(own, "node", "left_semi").select(F.col("cluster").alias("from"), F.lit(True).alias("stays")).distinct()
    chosen = one.join(stays, "from", "left").where((F.col("n") == 1) & (F.col("initials") | F.col("stays").isNull())).select("from", "to")
    # A cluster that is joined to cannot itself move: its own target takes its place.
    first = chosen.select(F.col("from").alias("c"), F.col("to").alias("into"))
    twice = first.join(first.select(F.col("c").alias("into"), F.col("into").alias("last")), "into", "left").select("c", F.coalesce("last", "into").alias("into"))
    return label.join(twice.select(F.col("c").alias("cluster"), "into"), "cluster", "left").select("node", F.coalesce("into", "cluster").alias("cluster"))


def form_pairs(clusters: DataFrame) -> DataFrame:
    """form_a < form_b of every two different forms of one cluster."""
    a = clusters.select("cluster", F.col("form").alias("form_a"))
    b = clusters.select("cluster", F.col("form").alias("form_b"))
    return a.join(b, "cluster").where("form_a < form_b").select("form_a", "form_b")
