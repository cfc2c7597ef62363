"""References to records that do not exist, kept up to date batch by batch.

A parent row stands from its start (inclusive) until its end (exclusive). A reference at time t is an orphan when no
row of its key stands at t: ``missing`` if no row has the key, ``late`` if all its rows begin after t, else ``deleted``.

State between batches, each part in ``BUCKETS`` folders by a hash of (target, key):

* ``rows``: the parent rows as they are known,
* ``parents``: one row per key with the spans of its rows - the probe index,
* ``judged``: references with their kind; null (settled) where a standing row was found, else pending.

A batch brings new references, new parent rows and changed ones: a row of known key and start replaces those that
earlier batches brought, so a withdrawal is the row again with its end. New
references probe the index; references, pending or settled, whose key the batch touched probe it again - so an arriving
parent resolves the orphans that wait for it and a deletion reopens those it had resolved. ``snapshot`` counts the pending ones by table and
period at any time.

Cost. Of a batch, only the buckets its keys fall in are read. Those with parent rows are written anew; those with references alone only
get a folder more. All others keep their folders: the driver holds a list of folders, not of rows.

Skew. The index has one row per key. It is joined as ``lookup_join`` says - broadcast only when counted small, else
salted - so a key with a third of all references is spread over many tasks.

Edge cases. Keys are compared stripped and in lower case; null and blank ones are no references. A null start stands
always, a null end never ends. A reference whose time is null or unreadable is an orphan only if no row has its key.
Repeated references and repeated parent rows count once. Empty tables give empty results. Only named columns are read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import present
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import staged, staged_by

REFERENCE = ["source_table", "period", "row_key", "ref_field", "target", "ref_value", "at"]
KEY = ["target", "ref_value"]
#: What stands for no start and for no end.
FIRST, LAST = "0001-01-01 00:00:00", "9999-12-31 00:00:00"


def key_of(c: Column) -> Column:
    """A key as it is compared: stripped, lower case, null where blank."""
    return F.lower(present(c))


def references(
    df: DataFrame, source_table: str, ref_field: str, target: str, row_key: Column, value: Column, at: Column, period: Column
) -> DataFrame:
    """The references of one column in the common form; ``at`` must be a timestamp without zone."""
    return df.select(
        F.lit(source_table).alias("source_table"),
        period.cast("string").alias("period"),
        row_key.cast("string").alias("row_key"),
        F.lit(ref_field).alias("ref_field"),
        F.lit(target).alias("target"),
        key_of(value).alias("ref_value"),
        at.cast("timestamp_ntz").alias("at"),
    ).where("ref_value is not null")


def parent_rows(df: DataFrame, target: str, key: Column, start: Column, end: Column) -> DataFrame:
    """The parent rows of one table in the common form: target, ref_value, start, end."""
    rows = df.select(
        F.lit(target).alias("target"),
        key_of(key).alias("ref_value"),
        start.cast("timestamp_ntz").alias("start"),
        end.cast("timestamp_ntz").alias("end"),
    )
    return rows.where("ref_value is not null")


def index(rows: DataFrame) -> DataFrame:
    """The probe index: per key the spans in which any of its rows stands, overlapping and touching ones joined.

    The earliest start of a key is always that of its first span, so a probe can still tell late from deleted. A key with very many
    rows is sorted and streamed; what is kept of it are its separate spans.
    """
    begin = F.coalesce("start", F.lit(FIRST).cast("timestamp_ntz"))
    finish = F.coalesce("end", F.lit(LAST).cast("timestamp_ntz"))
    plain = rows.select(*KEY, begin.alias("s"), finish.alias("e")).distinct()
    order = Window.partitionBy(*KEY).orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = plain.withColumn("fresh", F.coalesce(F.col("s") > before, F.lit(True)).cast("int"))
    islands = fresh.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.groupBy(*KEY, "island").agg(F.min("s").alias("start"), F.max("e").alias("end"))
    return joined.groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def probe(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """``refs`` with ``kind``: null where a row stands at the reference's time, else missing, late or deleted."""
    found = lookup_join(refs, parents.select(*KEY, "spans"), KEY)
    at = F.col("at")
    begun = lambda s: s["start"] <= at
    stands = F.exists("spans", lambda s: begun(s) & (s["end"] > at))
    kind = (
        F.when(F.col("spans").isNull(), "missing")
        .when(at.isNull() | stands, None)
        .when(~F.exists("spans", begun), "late")
        .otherwise("deleted")
    )
    return found.withColumn("kind", kind).drop("spans")


#: Folders each part of the state has.
BUCKETS = 16
_BUCKET = "bucket"
ROWS = "target string, ref_value string, start timestamp_ntz, end timestamp_ntz"
SCHEMAS = {
    "rows": ROWS,
    "parents": "target string, ref_value string, spans array<struct<start:timestamp_ntz,end:timestamp_ntz>>",
    "judged": "source_table string, period string, row_key string, ref_field string, target string, ref_value string, at timestamp_ntz, kind string",
}


def _bucketed(df: DataFrame) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int"))


def _buckets_of(df: DataFrame) -> set[str]:
    return {str(r[0]) for r in _bucketed(df).select(_BUCKET).distinct().collect()}  # at most BUCKETS numbers


@dataclass(frozen=True)
class OrphanState:
    """The state between batches: for each part, the folders of each bucket; see the module."""

    spark: SparkSession
    folders: dict[str, dict[str, tuple[str, ...]]]

    def read(self, part: str, buckets: set[str] | None = None) -> DataFrame:
        """The rows of a part, of all buckets or of some."""
        paths = [f for b, own in sorted(self.folders.get(part, {}).items()) if buckets is None or b in buckets for f in own]
        reader = self.spark.read.schema(SCHEMAS[part])
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMAS[part])

    @property
    def pending(self) -> DataFrame:
        """References without a standing row, with their kind."""
        return self.read("judged").where("kind is not null")

    @property
    def settled(self) -> DataFrame:
        """References a standing row was found for."""
        return self.read("judged").where("kind is null").drop("kind")

    def snapshot(self) -> DataFrame:
        """Orphans now: source_table, ref_field, period, kind, orphans."""
        return self.pending.groupBy("source_table", "ref_field", "period", "kind").agg(F.count(F.lit(1)).alias("orphans"))


def advance(state: OrphanState | None, refs: DataFrame, rows: DataFrame) -> OrphanState:
    """The state after one more batch of references and parent rows (new ones, or known ones with an end)."""
    state = state or OrphanState(refs.sparkSession, {})
    refs, rows = staged(refs.select(*REFERENCE).distinct(), "orphan-refs"), staged(rows.select("target", "ref_value", "start", "end").distinct(), "orphan-batch")
    touched, asked = _buckets_of(rows), _buckets_of(refs)
    folders = {part: dict(own) for part, own in state.folders.items()}

    def put(part: str, df: DataFrame, anew: set[str]) -> None:
        own = folders.setdefault(part, {})
        for b in anew:
            own.pop(b, None)
        for b, folder in staged_by(_bucketed(df), _BUCKET, f"orphan-{part}").items():
            own[b] = (*own.get(b, ()), folder)

    if touched:
        old, anew = state.read("rows", touched), rows.select(*KEY, F.col("start").alias("__start")).distinct()
        same = [old[k] == anew[k] for k in KEY] + [old["start"].eqNullSafe(anew["__start"])]
        now = old.join(anew, same, "left_anti").unionByName(rows) if state.folders.get("rows") else rows
        with ThreadPoolExecutor(2) as both:
            for job in [both.submit(put, "rows", now, touched), both.submit(put, "parents", index(now), touched)]:
                job.result()
    after = OrphanState(state.spark, folders)
    known = state.read("judged", touched | asked)
    if not state.folders.get("judged"):
        put("judged", probe(refs, after.read("parents", touched | asked)), touched)
        return OrphanState(state.spark, folders)
    # One row a reference: what is known stays as it is unless its key was touched, when it is probed again with what is new.
    keys = lookup_join(known, rows.select(*KEY).distinct().withColumn("__touched", F.lit(True)), KEY)
    again = keys.where("__touched").select(*REFERENCE)
    fresh = refs.exceptAll(known.select(*REFERENCE))
    judged = probe(again.unionByName(fresh), after.read("parents", touched | asked))
    kept = keys.where("__touched is null").select(*REFERENCE, "kind")
    inside = F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).cast("int").cast("string").isin(*sorted(touched)) if touched else F.lit(False)
    put("judged", judged.unionByName(kept.where(inside)), touched)
    return OrphanState(state.spark, folders)
