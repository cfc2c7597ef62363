"""Orphan references: kinds, increments, edge cases, and increments against one batch on random data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import orphans

REFS = "source_table string, period string, row_key string, ref_field string, target string, ref_value string, at timestamp_ntz"
ROWS = "target string, ref_value string, start timestamp_ntz, end timestamp_ntz"


def day(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def refs(spark, *rows):
    return spark.createDataFrame([("t", "2020-01", k, "f", "p", v, day(a)) for k, v, a in rows], REFS)


def parents(spark, *rows):
    return spark.createDataFrame([("p", v, day(s), day(e)) for v, s, e in rows], ROWS)


def kinds(state):
    return {r.row_key: r.kind for r in state.pending.collect()}


def test_kinds(spark):
    state = orphans.advance(None, refs(spark, ("1", "a", 5), ("2", "a", 0), ("3", "a", 9), ("4", "x", 5), ("5", "a", None), ("6", "x", None), ("7", "a", 2)), parents(spark, ("a", 2, 9), ("a", 2, 9)))
    assert kinds(state) == {"2": "late", "3": "deleted", "4": "missing", "6": "missing"}
    assert {(r.kind, r.orphans) for r in state.snapshot().collect()} == {("late", 1), ("deleted", 1), ("missing", 2)}


def test_arrival_resolves_and_deletion_reopens(spark):
    state = orphans.advance(None, refs(spark, ("1", "a", 5), ("2", "b", 5)), parents(spark, ("b", 0, None)))
    assert kinds(state) == {"1": "missing"}
    state = orphans.advance(state, refs(spark, ("3", "c", 1)), parents(spark, ("a", 1, None)))
    assert kinds(state) == {"3": "missing"}
    state = orphans.advance(state, refs(spark).limit(0), parents(spark, ("b", 0, 3)))
    assert kinds(state) == {"2": "deleted", "3": "missing"}


def test_keys_are_stripped_and_lower_case(spark):
    raw = spark.createDataFrame([("1", " Ls-1\t "), ("2", " "), ("3", None)], "k string, v string")
    got = orphans.references(raw, "t", "f", "p", F.col("k"), F.col("v"), F.lit(day(1)), F.lit("2020-01")).collect()
    assert [(r.row_key, r.ref_value) for r in got] == [("1", "ls-1")]


def test_empty(spark):
    state = orphans.advance(None, refs(spark, ("1", "a", 1)).limit(0), parents(spark, ("a", 1, None)).limit(0))
    assert state.pending.count() == 0 and state.snapshot().count() == 0


def test_null_start_always_stands(spark):
    assert kinds(orphans.advance(None, refs(spark, ("1", "a", -50)), parents(spark, ("a", None, None)))) == {}


def test_spans_are_joined_and_gaps_kept(spark):
    rows = parents(spark, ("a", 1, 4), ("a", 2, 3), ("a", 4, 6), ("a", 9, 9), ("a", 12, 13), ("a", 12, 14))
    assert [len(r.spans) for r in orphans.index(rows).collect()] == [3]
    got = kinds(orphans.advance(None, refs(spark, *[(str(i), "a", i) for i in range(16)]), rows))
    assert got == {"0": "late"} | {str(i): "deleted" for i in (6, 7, 8, 9, 10, 11, 14, 15)}


def test_increments_equal_one_batch(spark):
    rnd = random.Random(7)
    rr = [(str(i), rnd.choice("abcdef"), rnd.randint(0, 30)) for i in range(120)]
    pp = [(rnd.choice("abcde"), s := rnd.randint(0, 30), s + rnd.randint(1, 9) if rnd.random() < 0.5 else None) for _ in range(12)]
    pp = list({(v, s): (v, s, e) for v, s, e in pp}.values())
    whole = kinds(orphans.advance(None, refs(spark, *rr), parents(spark, *pp)))
    state = None
    for n in range(3):
        state = orphans.advance(state, refs(spark, *rr[n * 40 : n * 40 + 40]), parents(spark, *(pp[n::3] or pp[:1])))
    assert kinds(state) == whole


def test_batches_end_where_one_batch_does(spark, small):
    from ledgerloom.plans import parliament

    last = {tuple(r)[:5] for r in parliament.p2_batches(spark, small).where("batch = 3").drop("batch").collect()}
    assert last == {tuple(r) for r in parliament.p2_snapshot(spark, small).collect()}


def test_lookup_join_salted_equals_broadcast(spark):
    from ledgerloom.operators.joins import lookup_join

    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(999, None)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(0, 300, 2)], "k string, v int")
    for how in ("left", "inner", "left_anti", "left_semi"):
        a = sorted(map(str, lookup_join(facts, lookup, ["k"], how).select("i").collect()))
        assert a == sorted(map(str, lookup_join(facts, lookup, ["k"], how, broadcast_rows=0, salts=5).select("i").collect()))


def test_a_batch_leaves_other_buckets_alone(spark):
    rr = [(str(i), f"k{i % 40}", 5) for i in range(200)]
    before = orphans.advance(None, refs(spark, *rr), parents(spark, *[(f"k{i}", 0, None) for i in range(0, 40, 2)]))
    after = orphans.advance(before, refs(spark, ("900", "k3", 5), ("0", "k0", 5)), parents(spark, ("k1", 1, None)))
    own = lambda k: next(iter(orphans._buckets_of(parents(spark, (k, 0, None)))))
    for part in ("rows", "parents"):
        assert {b for b in after.folders[part] if after.folders[part][b] != before.folders[part].get(b)} == {own("k1")}
    changed = {b for b in after.folders["judged"] if after.folders["judged"][b] != before.folders["judged"].get(b)}
    assert changed <= {own("k1"), own("k3"), own("k0")} and own("k1") in changed
    assert after.settled.count() + after.pending.count() == 201
    assert kinds(after) == {str(i): "missing" for i in range(200) if i % 2 and i % 40 != 1} | {"900": "missing"}


def test_a_repeated_reference_counts_once_over_batches(spark):
    state = orphans.advance(None, refs(spark, ("1", "a", 5), ("1", "a", 5)), parents(spark))
    state = orphans.advance(state, refs(spark, ("1", "a", 5), ("2", "a", None)), parents(spark).limit(0))
    state = orphans.advance(state, refs(spark, ("1", "a", 5), ("2", "a", None)), parents(spark, ("b", 1, None)))
    assert [r.orphans for r in state.snapshot().collect()] == [2]
