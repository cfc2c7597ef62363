"""Ingest: aliases, identity, allowlist, duplicates, shapes, envelopes."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import ingest
from ledgerloom.sources.files import IngestionFailed, checkpoint_is_complete, read_assertions, read_csv, read_envelopes, read_ndjson


def test_identity_needs_the_type(spark):
    rows = spark.createDataFrame([("17", "4", " Starred  ", 12), ("17", "4", "STARRED", 12), ("17", "4", "Unstarred", 12), ("17", None, "x", 1)], "l string, s string, t string, n bigint")
    ids = [r[0] for r in rows.select(ingest.question_id(F.lit("h"), F.col("l"), F.col("s"), F.col("t"), F.col("n"))).collect()]
    assert ids == ["h/17/4/starred/12", "h/17/4/starred/12", "h/17/4/unstarred/12", None]


def test_iso_date(spark):
    df = spark.createDataFrame([("31.02.2020",), (" ",), (None,)], "d string")
    assert [r[0] for r in df.select(ingest.iso_date(F.col("d"))).collect()] == ["2020-02-31", None, None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("2020-02-01",)], "d string").select(ingest.iso_date(F.col("d"))).collect()


def test_session_id_refuses(spark):
    good = spark.createDataFrame([("17", "2")], "t string, n string").select(ingest.session_id(F.lit("h"), F.col("t"), F.col("n"))).first()[0]
    assert good == "h/17/2"
    with pytest.raises(PySparkException):
        spark.createDataFrame([("17", "0")], "t string, n string").select(ingest.session_id(F.lit("h"), F.col("t"), F.col("n"))).collect()


def test_allowlist_is_default_deny(spark):
    df = spark.createDataFrame([(1, "x", [(1, "s")], (2, "t"))], "keep int, drop string, list array<struct<keep:int,secret:string>>, inner struct<keep:int,secret:string>")
    kept = ingest.allowed(df, ["Keep", "list", "inner"])
    assert kept.schema.simpleString() == "struct<keep:int,list:array<struct<keep:int>>,inner:struct<keep:int>>"
    assert ingest.excluded_fields(df.schema, ["keep", "list", "inner"]) == ["drop", "list.secret", "inner.secret"]


def test_dedupe_keeps_first_and_reports_conflicts(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "x"), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, None), ("c", 2, None)], "id string, seq int, v string")
    out = {r.id: (r.seq, r.v, r.copies, r.contents) for r in ingest.dedupe(rows, ["id"], ["seq"], ["v"]).collect()}
    assert out == {"a": (1, "x", 2, 1), "b": (1, "x", 2, 2), "c": (1, None, 2, 1)}
    assert [r.id for r in ingest.conflicting(ingest.dedupe(rows, ["id"], ["seq"], ["v"]), ["id"]).collect()] == ["b"]
    assert ingest.dedupe(rows.limit(0), ["id"], ["seq"], ["v"]).count() == 0


def test_columns(spark):
    df = spark.createDataFrame([("17, 18,x, 17", ["a ", " ", None, "a"], "Former")], "e string, f array<string>, s string")
    r = df.select(ingest.terms_served(F.col("e")), ingest.asker_forms(F.col("f")), ingest.sitting_status(F.col("s")), ingest.minted_id("ls", F.lit(7)), ingest.seat_id(F.lit("Delta"), F.lit("delta"))).first()
    assert list(r) == [[17, 18], ["a", "a"], "former", "ls-7", "delta"]
    v = df.select(ingest.name_variants(F.lit("A  B"), F.lit(None), F.lit("A B"), F.lit("C")), ingest.add_variant(F.array(F.lit("a")), F.lit("b")), ingest.add_variant(F.array(F.lit("a")), F.lit("a"))).first()
    assert list(v) == [["A B", "C"], ["a", "b"], ["a"]]
    assert spark.range(1).select(ingest.first_stated(F.lit(" "), F.lit(None).cast("string"), F.lit("x"))).first()[0] == "x"


def test_shape_diff(spark):
    df = spark.createDataFrame([('{"a":1,"c":2}',), ("{}",), (None,)], "j string")
    got = {(r.field, r.change) for r in ingest.shape_diff(ingest.observed_fields(df, "j"), ["a", "b"]).collect()}
    assert got == {("b", "missing"), ("c", "added")}


def test_envelopes(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps([{"rows": [{"a": 1}, {"a": 2}], "total": 3}]))
    (tmp_path / "p2.json").write_text(json.dumps([{"rows": [{"a": 3}], "total": 3}]))
    schema = "rows array<struct<a:int>>, total bigint"
    assert sorted(r.a for r in read_envelopes(spark, str(tmp_path), schema, "rows", "total").collect()) == [1, 2, 3]
    (tmp_path / "p2.json").unlink()
    with pytest.raises(IngestionFailed):
        read_envelopes(spark, str(tmp_path), schema, "rows", "total")


def test_files(spark, tmp_path):
    lines = tmp_path / "x.jsonl"
    lines.write_text('{"a":1}\n\n{"a":2}\n')
    assert read_ndjson(spark, str(lines), "a int").count() == 2
    (tmp_path / "x.csv").write_text('a,b\n1," x ""y"""\n')
    assert list(read_csv(spark, str(tmp_path / "x.csv")).first()) == ["1", ' x "y"']
    side = tmp_path / "side.json"
    assert not checkpoint_is_complete(spark, str(lines), str(side))
    side.write_text('{"records": 2}')
    assert checkpoint_is_complete(spark, str(lines), str(side))
    side.write_text('{"records": 3}')
    assert not checkpoint_is_complete(spark, str(lines), str(side))


def test_assertions_conflict(spark, tmp_path):
    entry = lambda m: {"name_as_written": "A B", "member_id": m, "basis": "seat"}
    (tmp_path / "a.json").write_text(json.dumps({"house": "h", "confirmed_on": "2020-01-01", "assertions": [entry("m1")]}))
    assert read_assertions(spark, str(tmp_path)).count() == 1
    (tmp_path / "b.json").write_text(json.dumps({"house": "h", "confirmed_on": "2020-01-01", "assertions": [entry("m2")]}))
    with pytest.raises(IngestionFailed):
        read_assertions(spark, str(tmp_path))


def test_paged_source(spark, tmp_path):
    from ledgerloom.sources.paged import PagedSource

    for n, body in ((1, [{"rows": [{"a": 1}, {"a": 2}]}]), (2, {"rows": []}), (3, {"rows": [{"a": 3}]})):
        (tmp_path / f"{n}.json").write_text(json.dumps(body))
    spark.dataSource.register(PagedSource)
    df = spark.read.format("paged_json").options(url=f"file://{tmp_path}/{{page}}.json", pages="3", records="rows").load()
    assert sorted((r.page, json.loads(r.payload)["a"]) for r in df.collect()) == [(1, 1), (1, 2), (3, 3)]
