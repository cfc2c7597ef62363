"""Encoding against the reference library; mixing against its targets and caps."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import encode as enc
from ledgerloom.llm import mix

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    reference = tokenizers.Tokenizer.from_file(enc.VOCABULARY)
    reference.encode_special_tokens = True
    return enc.Encoder(*enc.load_vocabulary()), reference


@settings(max_examples=400, deadline=None)
@given(text=st.text(max_size=80) | st.text(alphabet="aabbeett  hh'sn01\néहि\U0001f600", max_size=120))
def test_ids_equal_the_reference(pair, text):
    mine, reference = pair
    ids = mine.encode(text)
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert mine.decode(ids) == text


@pytest.mark.parametrize("text", ["", "a" * 200_000, "ab" * 50_000, " " * 30_000 + "x", "<|endoftext|>", "हि" * 5000])
def test_long_and_odd_texts(pair, text):
    mine, reference = pair
    assert mine.encode(text) == reference.encode(text, add_special_tokens=False).ids


def test_batches_are_handed_over_by_size(spark, monkeypatch):
    rows = spark.createDataFrame([(i, "hello world " * (i % 5)) for i in range(300)], "doc_id bigint, text string").coalesce(1)
    whole = sorted((r.doc_id, r.ids) for r in enc.encode(rows).collect())
    monkeypatch.setattr(enc, "FLUSH", 7)
    run = enc.encode(rows)
    assert sorted((r.doc_id, r.ids) for r in run.collect()) == whole and len(whole) == 300


def test_encode_rows(spark):
    rows = spark.createDataFrame([(1, "hello world", "x"), (2, None, "x"), (3, "", "x"), (1, "hello world", "x")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in enc.encode(rows).collect())
    assert got == [(1, [31373, 995]), (1, [31373, 995]), (2, []), (3, [])]
    assert sorted(r.text for r in enc.decode(enc.encode(rows)).collect()) == ["", "", "hello world", "hello world"]
    assert enc.encode(rows.limit(0)).count() == 0
    assert [r.tokens for r in enc.count_tokens(rows, ["doc_id"]).orderBy("doc_id").collect()] == [2, 2, 0, 0]


def test_sainte_lague_equals_one_seat_at_a_time():
    rnd = random.Random(5)
    for _ in range(200):
        weights = {k: rnd.random() for k in "abcdefg"[: rnd.randint(1, 7)]}
        caps = {k: rnd.randint(0, 30) for k in weights} if rnd.random() < 0.5 else None
        seats, want = rnd.randint(0, 80), dict.fromkeys(weights, 0)
        for _ in range(seats):
            open_keys = [k for k in weights if not caps or want[k] < caps[k]]
            if not open_keys:
                break
            want[min(open_keys, key=lambda k: (-weights[k] / (2 * want[k] + 1), k))] += 1
        assert mix.sainte_lague(weights, seats, caps) == want


def test_mix_reaches_weights_within_caps(spark):
    rows = [(i, "one two three four five six seven eight nine ten " * 2, "big" if i % 4 else "small") for i in range(400)] + [(900, None, "small"), (901, "x", "other"), (902, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("uses", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.45, 2), ("absent", 0.05, 3), ("null", None, None)], "source string, weight double, max_repeats int")
    out = mix.mix(docs, targets)
    assert out.where("source in ('other')").count() == 0 and out.count() == 401
    most = {r.source: r.m for r in out.groupBy("source").agg(F.max("uses").alias("m")).collect()}
    assert most["big"] <= 1 and most["small"] <= 2
    shares = {r.source: r.share for r in mix.shares(out, targets).collect()}
    assert abs(shares["big"] - 0.5 / 0.95) < 0.01 and abs(shares["small"] - 0.45 / 0.95) < 0.01 and shares["absent"] == 0
    again = {(r.doc_id, r.uses) for r in mix.mix(docs, targets).collect()}
    assert again == {(r.doc_id, r.uses) for r in out.collect()}


def test_quotas_equal_a_plain_apportionment():
    rnd = random.Random(7)
    for _ in range(60):
        shards = {(s, k): rnd.randint(0, 3000) for s in "abc" for k in range(rnd.randint(1, 5))}
        targets = {s: (rnd.random() + 0.01, rnd.randint(1, 3)) for s in "abcd"}
        got = mix.quotas(shards, targets, block=64)
        tokens = {s: sum(n for (x, _), n in shards.items() if x == s) for s in "abcd"}
        live = {s: targets[s][0] for s in "abcd" if tokens[s]}
        if not live:
            assert got == {}
            continue
        size = min(tokens[s] * targets[s][1] * sum(live.values()) / w for s, w in live.items())

        def plain(weights, seats, caps):
            out = dict.fromkeys(weights, 0)
            for _ in range(seats):
                free = [k for k in weights if out[k] < caps[k]]
                if free:
                    out[min(free, key=lambda k: (-weights[k] / (2 * out[k] + 1), str(k)))] += 1
            return out

        first = plain(live, max(1, int(size / 64 + 0.5)), {s: -(-tokens[s] * targets[s][1] // 64) for s in live})
        for s, n in first.items():
            own = {k: t for (x, k), t in shards.items() if x == s and t}
            want = plain(own, n, {k: -(-t * targets[s][1] // 64) for k, t in own.items()})
            assert {k: q for (x, k), q in got.items() if x == s} == want


def test_mix_over_many_shards_takes_whole_blocks(spark):
    rows = [(i, "one two three four five six seven eight nine ten " * 2, "big" if i % 4 else "small") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.3, 1), ("small", 0.7, 2)], "source string, weight double, max_repeats int")
    out = mix.mix(docs, targets, block=100, shard_tokens=1000).collect()
    used = {s: sum(r.tokens * r.uses for r in out if r.source == s) for s in ("big", "small")}
    every = {s: sum(r.tokens for r in out if r.source == s) for s in ("big", "small")}
    assert 0.99 * 2 * every["small"] <= used["small"] <= 2 * every["small"] and max(r.uses for r in out if r.source == "small") == 2
    assert abs(used["big"] / sum(used.values()) - 0.3) < 0.01 and {r.uses for r in out if r.source == "big"} == {0, 1}


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, weight double, max_repeats int")
    assert mix.mix(docs, targets).count() == 0 and mix.shares(mix.mix(docs, targets), targets).first().share == 0.0
    assert mix.mix(docs, targets.limit(0)).count() == 0
