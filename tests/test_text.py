"""Text columns against plain Python."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.operators.search import parse_query


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def many(spark, column, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", column(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_strip_and_present(spark):
    assert many(spark, tx.strip, ["  a b\t", "", None]) == ["a b", "", None]
    assert many(spark, tx.present, [" ", " a ", None]) == [None, "a", None]
    assert many(spark, tx.stated, ["", None, " x"]) == ["not stated", "not stated", "x"]
    assert many(spark, tx.is_missing, ["Not Stated ", None, "x"]) == [True, True, False]


def test_slug_and_fold(spark):
    assert many(spark, tx.slug, ["  Mint & Currency ", "", None, "---"]) == ["mint-currency", "not-stated", "not-stated", "not-stated"]
    assert many(spark, tx.fold_key, ["Salt Pans", "Salt pan", "Gas", "Bus Depots"]) == ["salt-pan", "salt-pan", "gas", "bus-depot"]


def test_canon(spark):
    assert many(spark, tx.canon, ["Shri. Rujil Jovan", "KAKUNOS, Dr. Rujil", None, "Md Ali"]) == ["rujil jovan", "kakunos rujil", None, "md ali"]
    assert one(spark, tx.canon_sorted, "Rujil Kakunos") == "kakunos rujil"
    assert one(spark, tx.token_set, "b a b") == ["a", "b"]


def test_partition_key(spark):
    assert many(spark, tx.partition_key, ["lok-sabha/17/4", "a  b--c", "//", None]) == ["lok-sabha-17-4", "a-b-c", "not-stated", "not-stated"]


@settings(max_examples=20, deadline=None)
@given(values=st.lists(st.text(alphabet="aBc தमЖ1 -_/.the and", max_size=40), min_size=1, max_size=30))
def test_search_tokens_equal_python(spark, values):
    got = many(spark, tx.search_tokens, values)
    want = []
    for v in values:
        runs, run = set(), ""
        for ch in v.lower() + " ":
            if ch.isalnum():
                run += ch
            else:
                if len(run) >= 3 and run not in tx.STOPWORDS:
                    runs.add(run)
                run = ""
        want.append(runs)
    assert [set(g) for g in got] == want


def test_parse_query():
    q = parse_query("The solar  of FIELDS, ab solar")
    assert q.words == ("solar", "fields")
    assert q.ignored == (("the", "too common"), ("of", "too short"), ("ab", "too short"))
    assert parse_query("  ").blank and not parse_query("?!").blank
    assert parse_query(None).words == ()


def test_very_long_text(spark):
    long = "word " * 200_000
    assert one(spark, lambda c: F.length(tx.canon(c)), long) == len(long.strip())
