"""Incremental ingest: each record once, restarts, late data."""

from ledgerloom.streaming import incremental

SCHEMA = "quesNo bigint, lokNo string, sessionNo string, type string, fetched_at timestamp_ntz"


def land(spark, folder, *rows):
    spark.sql("select * from values " + ", ".join(f"(bigint({n}), '17', '1', '{t}', timestamp_ntz'{at}')" for n, t, at in rows) + " as t(quesNo, lokNo, sessionNo, type, fetched_at)").coalesce(1).write.mode("append").parquet(folder)


def test_dedupes_across_runs(spark, tmp_path):
    src, out, check = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check"))
    stream = lambda: incremental.deduplicated(incremental.identified(incremental.landing(spark, src, SCHEMA)))
    land(spark, src, (1, "S", "2020-01-01 00:00:00"), (1, "S ", "2020-01-02 00:00:00"), (2, "S", "2020-01-02 00:00:00"))
    incremental.run_once(stream(), out, check)
    land(spark, src, (1, "S", "2020-01-05 00:00:00"), (3, "U", "2020-01-06 00:00:00"))
    incremental.run_once(stream(), out, check)
    incremental.run_once(stream(), out, check)
    assert sorted(r.question_id for r in spark.read.parquet(out).collect()) == ["lok-sabha/17/1/s/1", "lok-sabha/17/1/s/2", "lok-sabha/17/1/u/3"]


def test_windows(spark, tmp_path):
    src, out, check = (f"file://{tmp_path}/{x}" for x in ("src", "out", "check"))
    land(spark, src, (1, "S", "2020-01-01 00:00:00"), (2, "S", "2020-01-02 00:00:00"), (3, "S", "2020-06-01 00:00:00"))
    incremental.run_once(incremental.windowed_counts(incremental.landing(spark, src, SCHEMA)), out, check)
    land(spark, src, (4, "S", "2020-07-20 00:00:00"))
    incremental.run_once(incremental.windowed_counts(incremental.landing(spark, src, SCHEMA)), out, check)
    assert sum(r.records for r in spark.read.parquet(out).where("window.end < '2020-03-01'").collect()) == 2
