"""Mixing sources to target weights, in tokens.

The mixture's size is the largest at which every source with tokens can give its weight without any document being used
more often than its source allows. That size is cut into blocks of ``BLOCK_TOKENS``, which Sainte-Lague apportionment hands
to the sources, and then each source's blocks to its shards. Each shard's seeded order of documents is cut into blocks of the same size (a
document belongs to the block its middle token lies in); a quota beyond whole passes takes as many of them, in that order.

Block and shard have one size whatever the corpus. As documents are whole, a shard misses its quota by half a document or so; what a source's shards
miss altogether is settled by single blocks (``settled``), so that a source ends about a block and a document from its target.

Scale. Documents are read once for their token counts, aggregated by (source, shard) and written; only the totals by source and
shard reach the driver, at most ``MOST_SHARDS`` a source. Beyond that number shards grow; running sums are taken in
``RANGES`` parts of a shard's order, with the sums of the parts before, so neither a large shard nor a source that holds
most rows is ever one task.

Edge cases. Null and empty texts have no tokens: they are used as often as their shard's whole passes say. A source that
is in no target is left out; a target whose source has no tokens (or whose weight or repeats are null or not positive)
gets share 0, and the others share the mixture by their weights. Repeated rows are separate documents; repeated targets of
one source add up their weights and take the least repeats. Empty tables give an empty mixture.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.encode import VOCABULARY, count_tokens
from ledgerloom.session import staged

#: Tokens in a block.
BLOCK_TOKENS = 256
#: Tokens a shard has about, and the most shards a source has; documents fall into shards by a hash of their id.
SHARD_TOKENS, MOST_SHARDS = 16_384, 4096
#: Parts of a shard's order, by the leading bits of the hash it goes by.
RANGES = 1024


def sainte_lague(weights: dict, seats: int, caps: dict | None = None) -> dict:
    """Seats by highest quotients weight / (2 * seats so far + 1); none beyond its cap. Ties go to the smaller key.

    A lower bound known from the divisor method is taken at once, so the loop is as long as there are keys, not seats.
    Seats that no key may take stay unassigned.
    """
    caps = caps or {}
    live = {k: w for k, w in weights.items() if w > 0 and caps.get(k, 1) > 0}
    total = sum(live.values())
    out = dict.fromkeys(weights, 0)
    if not live or seats <= 0:
        return out
    for k, w in live.items():
        low = math.floor(max(0.0, seats - len(live) / 2) * w / total - 0.5)
        out[k] = max(0, min(low, caps.get(k, low)))
    left = seats - sum(out.values())
    heap = [(-w / (2 * out[k] + 1), str(k), k) for k, w in live.items() if out[k] < caps.get(k, out[k] + 1)]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, name, k = heapq.heappop(heap)
        out[k] += 1
        left -= 1
        if out[k] < caps.get(k, out[k] + 1):
            heapq.heappush(heap, (-live[k] / (2 * out[k] + 1), name, k))
    return out


def quotas(shards: dict[tuple[str, int], int], targets: dict[str, tuple[float, int]], block: int = BLOCK_TOKENS) -> dict[tuple[str, int], int]:
    """Blocks for each (source, shard), from the tokens of each and every source's (weight, most repeats).

    The last block of what a source or shard can give at most may be a part of one.
    """
    tokens: dict[str, int] = {}
    for (source, _), n in shards.items():
        tokens[source] = tokens.get(source, 0) + n
    live = {s: w for s, (w, r) in targets.items() if w > 0 and r > 0 and tokens.get(s, 0) > 0}
    if not live:
        return {}
    scale = sum(live.values())
    size = min(tokens[s] * targets[s][1] * scale / w for s, w in live.items())
    most = {s: -(-tokens[s] * targets[s][1] // block) for s in live}
    out: dict[tuple[str, int], int] = {}
    for s, n in sainte_lague(live, max(1, int(size / block + 0.5)), most).items():
        own = {shard: t for (source, shard), t in shards.items() if source == s and t > 0}
        limit = {shard: -(-t * targets[s][1] // block) for shard, t in own.items()}
        out |= {(s, shard): q for shard, q in sainte_lague(own, n, limit).items()}
    return out


def passes(quota: int, tokens: int, repeats: int, block: int = BLOCK_TOKENS) -> tuple[int, int]:
    """Whole passes over a shard, and the blocks of one more, that a quota of blocks comes to."""
    wanted = quota * block
    if wanted >= tokens * repeats:
        return repeats, 0
    return wanted // tokens, int(wanted % tokens / block + 0.5)


def settled(table: list[tuple], quota: dict, reached: dict, tokens: dict, repeats: dict, block: int) -> list[tuple]:
    """``table`` (source, shard, passes, blocks) after the blocks that whole documents left over or took too much.

    What a source's shards miss of their quotas altogether is given, block by block, to the shards that miss most, and taken likewise.
    """
    out = {(s, k): [p, b] for s, k, p, b in table}
    for source in sorted({s for s, *_ in table}):
        gaps = {key: min(q * block, tokens[key] * repeats[source]) - reached.get(key, 0) for key, q in quota.items() if key[0] == source}
        left = round(sum(gaps.values()) / block)
        for (s, k), _ in sorted(gaps.items(), key=lambda x: (-x[1] if left > 0 else x[1], x[0])):
            if not left:
                break
            p, b = out[s, k]
            if left > 0 and p < repeats[source] and b * block < tokens[s, k]:
                out[s, k][1] += 1
                left -= 1
            elif left < 0 and b:
                out[s, k][1] -= 1
                left += 1
    return [(s, k, p, b) for (s, k), (p, b) in out.items()]


def mix(
    documents: DataFrame,
    targets: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 20,
    path: str = VOCABULARY,
    block: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """The uses of each document of a target source: doc_id, source, tokens, uses.

    ``targets`` has source, weight and max_repeats; it is the mixture's recipe and small by nature.
    """
    spark = documents.sparkSession
    rows = targets.groupBy("source").agg(F.sum("weight").alias("weight"), F.min("max_repeats").alias("max_repeats"))
    wanted = {r.source: (r.weight or 0.0, r.max_repeats or 0) for r in rows.where("source is not null").collect()}
    named = documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = staged(count_tokens(named.where(F.col("source").isin(*wanted) if wanted else F.lit(False)), ["doc_id", "source"], path=path), "mix-counts")
    size = {r.source: r.tokens for r in counted.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}  # one row a target
    n_shards = [(s, max(1, min(MOST_SHARDS, math.ceil(n / shard_tokens)))) for s, n in size.items()]
    spread = counted.join(F.broadcast(spark.createDataFrame(n_shards, "source string, shards int")), "source")
    order = F.xxhash64(F.lit(seed + 1), "doc_id")
    spread = spread.select("doc_id", "source", "tokens", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), "shards").cast("int").alias("shard"), order.alias("order"), F.shiftright(order, 64 - RANGES.bit_length() + 1).alias("range"))
    by_range = staged(spread.groupBy("source", "shard", "range").agg(F.sum("tokens").alias("n")), "mix-ranges")
    by_shard = {(r.source, r.shard): r.tokens for r in by_range.groupBy("source", "shard").agg(F.sum("n").alias("tokens")).collect()}
    quota = quotas(by_shard, wanted, block)
    table = [(s, k, *passes(q, by_shard[s, k], wanted[s][1], block)) for (s, k), q in quota.items()]
    earlier = Window.partitionBy("source", "shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_range.select("source", "shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    joined = spread.join(starts, ["source", "shard", "range"])
    within = Window.partitionBy("source", "shard", "range").orderBy("order", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("start") + F.sum("tokens").over(within) - F.col("tokens") / 2
    placed = staged(joined.select("doc_id", "source", "shard", "tokens", F.floor(middle / block).alias("block")), "mix-placed")

    def used(table: list[tuple]) -> DataFrame:
        # At most MOST_SHARDS rows a source: small enough to send to every executor.
        said = F.broadcast(spark.createDataFrame(table, "source string, shard int, passes bigint, blocks bigint"))
        more = (F.col("tokens") > 0) & (F.col("block") < F.col("blocks"))
        uses = F.coalesce(F.col("passes") + more.cast("bigint"), F.lit(0)).cast("int")
        return placed.join(said, ["source", "shard"], "left").select("doc_id", "source", "shard", "tokens", uses.alias("uses"))

    reached = used(table).groupBy("source", "shard").agg(F.sum(F.col("tokens") * F.col("uses")).alias("n"))
    return used(settled(table, quota, {(r.source, r.shard): r.n for r in reached.collect()}, by_shard, {s: r for s, (_, r) in wanted.items()}, block)).drop("shard")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """By source: weight wanted, max_repeats, tokens in the mixture, share reached, documents used, most_uses."""
    used = mixture.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("uses")).alias("tokens"),
        F.count_if(F.col("uses") > 0).alias("documents"),
        F.max("uses").alias("most_uses"),
    )
    wanted = targets.groupBy("source").agg(F.sum("weight").alias("weight"), F.min("max_repeats").alias("max_repeats"))
    rows = wanted.join(used, "source", "left").na.fill(0, ["tokens", "documents", "most_uses"])
    whole = used.agg(F.sum("tokens").alias("whole"))
    return rows.join(F.broadcast(whole)).select(
        "source", "weight", "max_repeats", "tokens", "documents", "most_uses",
        F.coalesce(F.try_divide(F.col("tokens"), F.col("whole")), F.lit(0.0)).alias("share"),
    )
