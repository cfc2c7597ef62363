"""Schema drift: changes by feed, unified projection, edge cases."""

import random
import json

import pandas as pd

from ledgerloom.operators import drift


def files(spark, *feeds):
    rows = [(n, f"feed-{i}", r, json.dumps(x) if isinstance(x, dict) else x) for i, feed in enumerate(feeds) for n, recs in feed for r, x in enumerate(recs)]
    return spark.createDataFrame(rows, "file_no bigint, feed string, record_no int, payload string")


def changes(spark, *feeds):
    stats = drift.path_stats(drift.path_values(files(spark, *feeds)))
    return sorted((r.file_no, r.field, r.change) for r in drift.schema_changes(stats).collect())


def test_added_removed_renamed_retyped(spark):
    one = {"quesNo": 11, "path": "/files/AU11.pdf", "note": "x"}
    feed = [
        (1, [one, one]),
        (2, [{"quesNumber": 12, "path": "/files/AU12.pdf", "note": None}]),
        (3, [{"quesNumber": "13", "path": {"p": 1}}]),
        (4, [{"quesNo": "14", "path": {"p": 1}, "note": "y", "isLate": True}]),
    ]
    assert changes(spark, feed) == [
        (2, "quesNo", "renamed"),
        (3, "note", "removed"),
        (3, "path", "retyped"),
        (3, "quesNo", "retyped"),
        (4, "isLate", "added"),
        (4, "note", "added"),
        (4, "quesNo", "renamed"),
    ]


def test_case_makes_another_key_and_feeds_are_apart(spark):
    feed = [(1, [{"date": "01.02.2020"}]), (2, [{"Date": "02.02.2020"}])]
    other = [(3, [{"z": 1}]), (4, [{"z": 1}])]
    assert changes(spark, feed, other) == [(2, "date", "renamed")]


def test_unlike_values_are_no_rename(spark):
    feed = [(1, [{"questionsDocPath": "/files/AU1.doc", "k": 1}]), (2, [{"answeredBy": "Rujil Kakunos", "k": 1}])]
    assert changes(spark, feed) == [(2, "answeredBy", "added"), (2, "questionsDocPath", "removed")]


def test_unreadable_payloads_do_not_count(spark):
    feed = [(1, [{"a": 1}, '{"a": 1', None, "<html>", "", "[1]", '{"b": 2} x']), (2, ['{"c"']), (3, [{"a": 1}, {"a": 1}])]
    assert changes(spark, feed) == []


def test_null_values_give_no_kind(spark):
    feed = [(1, [{"a": None}]), (2, [{"a": 1}]), (3, [{"a": None}]), (4, [{"a": "x"}])]
    assert changes(spark, feed) == [(4, "a", "retyped")]


def test_empty_and_clashing_columns(spark):
    df = files(spark, [(1, [{"a": 1}])]).withColumnsRenamed({"record_no": "path"}).withColumn("kind", drift.F.lit("x"))
    assert drift.path_stats(drift.path_values(df)).count() == 1
    assert drift.schema_changes(drift.path_stats(drift.path_values(df.limit(0)))).count() == 0


def test_nested_paths(spark):
    feed = [(1, [{"a": {"b": {"c": 1}, "d": "x"}}])]
    paths = {(r.path, r.kind) for r in drift.path_values(files(spark, feed), max_depth=2).collect()}
    assert paths == {("a", "object"), ("a.b", "object"), ("a.d", "string")}


def test_unified_projection_reports_failed_casts_and_keeps_the_rest(spark):
    feed = [(1, [{"no": 1, "s": "x"}]), (2, [{"No": "two", "s": "y", "more": [1]}]), (3, ["broken"])]
    df = files(spark, feed)
    stats = drift.path_stats(drift.path_values(df))
    out = drift.project_unified(df, {"no": "int", "s": "string"}, drift.field_keys(stats)).orderBy("file_no").collect()
    assert [(r.no, r.s, r.failed_casts, r.unreadable) for r in out] == [(1, "x", [], False), (None, "y", ["no"], False), (None, None, [], True)]
    assert out[1].rest == {"more": "[1]"}
    assert out[1].failed_values == {"no": "two"} and out[0].failed_values == {}


def test_name_likeness_orders_sensibly():
    assert drift.name_likeness("quesNo", "ques_no") == 1.0
    assert drift.name_likeness("quesNo", "quesNumber") > drift.name_likeness("quesNo", "sessionName")
    assert list(drift.feed_changes(pd.DataFrame({"file_no": [], "path": [], "kind": []}))) == []


def test_types_come_from_the_statistics(spark):
    feed = [(1, [{"no": 1, "x": 1.5, "t": "a", "l": ["p", 2], "b": True}, {"no": 2, "x": 2, "t": "b", "l": []}]), (2, [{"no": "3", "x": "y", "t": 7, "l": "none", "b": False}, {"new": {"k": 1}}])]
    df = files(spark, feed)
    stats = drift.path_stats(drift.path_values(df))
    keys = drift.field_keys(stats)
    types = drift.unified_types(stats, keys)
    assert types == {"no": "bigint", "x": "double", "t": "string", "l": "array<string>", "b": "boolean", "new": "string"}
    rows = drift.project_unified(df, types, keys).orderBy("file_no", "no").collect()
    last = [r for r in rows if r.no == 3][0]
    assert sorted(last.failed_casts) == ["l", "x"] and last.failed_values == {"x": "y", "l": "none"} and last.t == "7"
    assert [r.l for r in rows if r.no in (1, 2)] == [["p", "2"], []] and [r.new for r in rows if r.new] == ['{"k":1}']
    assert drift.unified_types(stats, keys, least=1.1) == {}


def test_runs_of_equal_files_change_nothing(spark):
    rnd = random.Random(3)
    feed, keys = [], ["a", "b", "colour"]
    for n in range(1, 60):
        if rnd.random() < 0.25:
            keys = rnd.sample(["a", "b", "colour", "Colour", "size", "b_name"], rnd.randint(1, 5))
        feed.append((n, [{k: (n if k == "a" else f"v{n}") if rnd.random() < 0.97 else None for k in keys}]))
    stats = drift.path_stats(drift.path_values(files(spark, feed)))
    want = sorted(drift.feed_changes(stats.toPandas()), key=str)
    got = sorted((tuple(r)[1:] for r in drift.schema_changes(stats).collect()), key=str)
    assert got == want and len(want) > 10
    assert drift.runs(stats).where("ends").count() < 59
    assert drift.field_keys(stats).count() == 59
