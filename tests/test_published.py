"""Dimensions, aggregates, search, views, audits and published files on small fixtures."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, dimensions, publish, quality, search, views
from ledgerloom.plans import rebuild

Q = "question_id string, house string, session string, date string, type string, subject string, ministry_id string, asking_members array<string>, resolution_status string"


@pytest.fixture(scope="module")
def questions(spark):
    rows = [
        ("h/17/2/s/1", "h", "h/17/2", "2020-01-02", "S", "Rope bridge repair", "a", ["m1", "m2"], "resolved"),
        ("h/17/2/s/2", "h", "h/17/2", "2020-01-01", "S", "rope bridge repair", "a", ["m1"], "unresolved"),
        ("h/17/10/s/1", "h", "h/17/10", "2021-01-01", "U", "Rope bridge repair", "a", ["m3"], "resolved"),
        ("h/17/10/s/2", "h", "h/17/10", None, "U", None, "b", [], "ambiguous"),
        ("h/18/1/s/x", "h", "h/18/1", "bad", "U", "Salt", "b", [], "unresolved"),
    ]
    return spark.createDataFrame(rows, Q)


@pytest.fixture(scope="module")
def members(spark):
    rows = [("m1", "A", "P", "North", "Seat", [17, 18]), ("m2", "B", None, "South", "Seat", [17]), ("m3", "C", "P", "North", "Other", [17]), ("m4", "D", "Q", None, None, [16])]
    return spark.createDataFrame(rows, "member_id string, name string, party string, state string, seat string, terms array<int>")


def test_registry_folds_and_keeps_first_id(spark):
    obs = spark.createDataFrame([("Salt Pan", 1, "2020-01-01", "2020-01-01"), ("Salt Pans", 2, "2021-01-01", "2022-01-01"), ("SALT  PANS", 1, "2021-01-01", "2021-01-01"), ("Silk", 1, None, None)], "name string, observed bigint, first_date string, last_date string")
    got = {r.dimension_id: (r.canonical_name, r.name_variants, r.former_names) for r in dimensions.registry(obs).collect()}
    assert got["salt-pan"] == ("Salt Pans", ["SALT  PANS", "Salt Pan", "Salt Pans"], ["SALT  PANS", "Salt Pan"])
    assert got["silk"][0] == "Silk"
    assert [r.names for r in dimensions.fold_groups(obs).collect()] == [["SALT  PANS", "Salt Pan", "Salt Pans"]]


def test_renames_absorb(spark):
    minted = spark.createDataFrame([("old-name", "old-name"), ("old-names", "old-name"), ("new", "new")], "minted_id string, dimension_id string")
    renames = spark.createDataFrame([("keep", "New", ["Old Name"])], "dimension_id string, canonical_name string, former_names array<string>")
    got = {tuple(r) for r in dimensions.with_renames(minted, renames).collect()}
    assert got == {("old-name", "keep"), ("old-names", "keep"), ("new", "keep")}
    bad = renames.union(spark.createDataFrame([("other", "Old name", None)], renames.schema))
    assert [r.minted_id for r in dimensions.rename_conflicts(bad).collect()] == ["old-name"]


def test_seats(spark, members):
    reps = dimensions.in_window(dimensions.representations(members), [17, 18])
    got = {r.seat_id: (r.members, r.changed_hands, len(r.holders)) for r in dimensions.seats(reps).collect()}
    assert got == {"north-seat": (1, False, 2), "south-seat": (1, False, 1), "north-other": (1, False, 1)}
    with pytest.raises(ValueError):
        dimensions.in_window(reps, [])
    assert {r.member_id: r.state for r in dimensions.member_states(reps).collect()} == {"m1": "North", "m2": "South", "m3": "North"}


def test_bijection(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), (None, "3")], "s string, m string")
    assert {tuple(r) for r in dimensions.bijection_violations(df, "s", "m").collect()} == {("source", "a", 2), ("id", "2", 2)}


def test_composition(members):
    out = aggregates.composition(members, 17)
    got = {(r.dimension, r.category): r.members for r in out.collect()}
    assert got == {("party", "P"): 2, ("party", "not stated"): 1, ("state", "North"): 2, ("state", "South"): 1, ("terms_served", "1"): 2, ("terms_served", "2"): 1}
    assert aggregates.unreconciled(out).count() == 0
    with pytest.raises(aggregates.UnsupportedDimension):
        aggregates.composition(members, 17, ("age",))


def test_state_subjects(spark, questions, members):
    pairs = aggregates.attributed(questions, members.select("member_id", "state"))
    got = {(r.state, r.subject): (r.questions, r.state_questions, r.state_subjects, r.subjects_shown) for r in aggregates.state_subjects(pairs, 1).collect()}
    assert got == {("North", "Rope bridge repair"): (2, 3, 2, 1), ("South", "Rope bridge repair"): (1, 1, 1, 1)}
    c = aggregates.attribution_counters(questions, pairs).first()
    assert (c.questions, c.unattributable, c.multi_state) == (5, 2, 1)
    with pytest.raises(ValueError):
        aggregates.state_subjects(pairs, 0)
    tie = spark.createDataFrame([("q1", "b", "S"), ("q2", "a", "S")], "question_id string, subject string, state string")
    assert [r.subject for r in aggregates.state_subjects(tie, 1).collect()] == ["a"]


def test_profile_and_counters(questions):
    profile = aggregates.ministry_profile(questions)
    got = {(r.ministry_id, r.session): (r.questions, r.fully_linked, r.partly_linked, r.not_linked, r.ambiguous) for r in profile.collect()}
    assert got == {("a", "h/17/2"): (2, 1, 1, 0, 0), ("a", "h/17/10"): (1, 1, 0, 0, 0), ("b", "h/17/10"): (1, 0, 0, 0, 1), ("b", "h/18/1"): (1, 0, 0, 1, 0)}
    assert quality.status_sum_violations(profile).count() == 0
    c = aggregates.counters(questions).first()
    assert (c.questions, c.co_asked, c.max_askers, c.partly_resolved) == (5, 1, 2, 1)
    assert aggregates.counters(questions.limit(0)).first().questions == 0
    assert aggregates.type_mix_map(questions).where("session = 'h/17/2'").first().question_type_mix == {"S": 2}
    assert aggregates.counting_basis(aggregates.counters(questions)).count() == 3


def test_spans(questions):
    sessions = dimensions.sessions(questions)
    dense = views.dense_span(aggregates.ministry_profile(questions), views.in_span(sessions, (18, 1), (17, 2)), "a")
    assert {r.session: r.questions for r in dense.collect()} == {"h/17/2": 2, "h/17/10": 1, "h/18/1": 0}
    total = views.span_totals(dense).first()
    assert (total.questions, total.sessions, total.sessions_with_questions, total.balanced) == (3, 3, 2, True)
    c = views.span_change(dense).first()
    assert (c.first_questions, c.last_questions, c.difference, c.percent, c.single_session) == (2, 0, -2, -100.0, False)
    other = views.span_change(views.dense_span(aggregates.ministry_profile(questions), views.in_span(sessions, (17, 2), (17, 2)), "b")).first()
    assert (other.percent, other.single_session) == (None, True)


def test_search(spark, questions):
    terms = search.terms(questions)
    hits = lambda text: {r.question_id for r in search.matches(terms, search.parse_query(text)).collect()}
    assert hits("bridge ROPE") == {"h/17/2/s/1", "h/17/2/s/2", "h/17/10/s/1"} and hits("rope xylophone") == set() and hits("") == set()
    assert [r.term for r in search.missing_words(terms, search.parse_query("rope xylophone")).collect()] == ["xylophone"]
    found = questions.select("question_id")
    first = search.page(found, search.digest(questions), size=3).collect()
    assert [r.question_id for r in first] == ["h/18/1/s/x", "h/17/10/s/1", "h/17/10/s/2"]
    rest = search.page(found, search.digest(questions), tuple(first[-1]["__key"]), 3).collect()
    assert [r.question_id for r in rest] == ["h/17/2/s/1", "h/17/2/s/2"]
    lost = spark.createDataFrame([("h/1/1/s/9",)], "question_id string")
    assert search.page(lost, search.digest(questions)).first().not_in_digest
    placed = search.positions(questions)
    assert sorted(r.position for r in placed.collect()) == [0, 1, 2, 3, 4]
    want = {(r.term, r.position) for r in terms.join(placed, "question_id").collect()}
    for width in (1, 2, 1000):
        rows = search.blocked_postings(terms, placed, width)
        assert {(r.term, r.position) for r in search.decoded(rows).collect()} == want and rows.where(F.size("steps") > width).count() == 0
    assert [r.place for r in search.prefix_dictionary(placed).orderBy("prefix").collect()] == [0, 1, 2]


def test_extract(questions, members):
    seats = members.withColumnRenamed("seat", "constituency")
    ids = lambda **kw: sorted(r.question_id for r in views.extract(questions, seats, **kw).collect())
    assert ids(state=" north ") == ["h/17/10/s/1", "h/17/2/s/1", "h/17/2/s/2"]
    assert ids(constituency="other") == ["h/17/10/s/1"] and ids(member="m2") == ["h/17/2/s/1"] and len(ids(ministry="b")) == 2
    for bad in ({}, {"session": "x", "member": "y"}, {"planet": "x"}):
        with pytest.raises(ValueError):
            views.extract(questions, seats, **bad)


def test_views(spark, questions):
    assert views.parse_sessions("5-8") == (5, 8) and views.parse_sessions("5") == (5, 5)
    with pytest.raises(ValueError):
        views.parse_sessions("five")
    m = views.member_questions(questions.union(questions), "m1").first()
    assert (m.questions, m.fully_linked, m.partly_linked) == (2, 1, 1)
    assert [(r.subject, r.questions) for r in views.subject_tally(questions, 1).collect()] == [("Rope bridge repair", 2)]
    cover = {r.house: (r.covered, r.questions, r.reason) for r in views.coverage(questions, ["h", "g"]).collect()}
    assert cover == {"h": (True, 5, None), "g": (False, 0, "no records of this house")}
    dim = spark.createDataFrame([("salt", "Salt Pans", ["Brine"]), ("silk", "Silk", None)], "ministry_id string, canonical_name string, former_names array<string>")
    one = lambda t: [r.ministry_id for r in views.find_entry(dim, t).collect()]
    assert one("BRINE") == ["salt"] and one("pan") == ["salt"] and one("zzz") == []
    days = views.per_day(spark.createDataFrame([("a", 6, 3), ("b", 6, 0), ("c", 6, None)], "s string, questions int, sitting_days int"))
    assert [(r.per_day, r.zero_days) for r in days.orderBy("s").collect()] == [(2.0, False), (None, True), (None, False)]
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 4), (None, 3)], "k string, v int")
    assert sorted((r.k, r.left_value, r.right_value) for r in views.differences(a, b, ["k"], "v").collect()) == [("y", 2, 3), ("z", None, 4)]


def test_quality(spark, questions):
    odd = spark.createDataFrame([("q1", [], "resolved"), ("q2", ["m", "m"], "resolved"), ("q3", ["m"], "ambiguous"), (None, ["m"], "resolved"), ("q5", [], "what")], "question_id string, asking_members array<string>, resolution_status string")
    got = {(r.question_id, r.rule) for r in quality.question_violations(odd).collect()}
    assert got == {("q1", "resolved-without-asker"), ("q2", "repeated-asker"), ("q3", "ambiguous-with-asker"), (None, "missing-id"), ("q5", "unknown-status")}
    after = questions.withColumn("resolution_status", F.when(F.col("question_id") == "h/17/2/s/1", "ambiguous").otherwise(F.col("resolution_status"))).where("question_id <> 'h/17/10/s/1'")
    assert {(r.question_id, r.now) for r in quality.transitions_out(questions, after).collect()} == {("h/17/2/s/1", "ambiguous"), ("h/17/10/s/1", None)}
    lines = ['{"questionText": 1}', "```", '"answer_text": 2', "```", "Answer-Text: x", "a,b"]
    text = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "source string, line int, text string")
    assert sorted((r.line, r.spelt) for r in quality.field_audit(text, "text", ["answerText", "question_text"]).collect()) == [(0, "questionText"), (4, "Answer-Text")]
    signal = quality.signals(spark.createDataFrame([("f", "missing", "degraded")], "field string, change string, severity string"), quality.transitions_out(questions, after), spark.createDataFrame([(0.5,)], "assisted_rate double"))
    assert signal.count() == 3 and quality.should_publish(signal)


def test_csv_and_ndjson_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a ,"x"', ["p", "q"], True, None), (2, "", [], None, (1, "z"))], "i int, s string, l array<string>, b boolean, n struct<y:int,x:string>")
    publish.write_both(df, f"file://{tmp_path}/out")
    rows = spark.read.options(**publish.CSV).csv(f"file://{tmp_path}/out/csv").orderBy("i").collect()
    assert [r.s for r in rows] == [' a ,"x"', None] and rows[0].l == "p|q" and rows[0].b == "true" and rows[1].n == '{"x":"z","y":1}'
    raw = sorted(line for f in (tmp_path / "out" / "ndjson").glob("*.json") for line in f.read_text().splitlines())
    assert json.loads(raw[0])["n"] is None
    with pytest.raises(PySparkException):
        publish.text_projection(spark.createDataFrame([(["a|b"],)], "l array<string>")).collect()


def test_partitions(spark, questions, tmp_path):
    path = f"file://{tmp_path}/by"
    for buckets in (None, 2):
        n = publish.write_partitions(questions, "asking_members", f"{path}{buckets}", buckets=buckets)
        back = spark.read.json(f"{path}{buckets}/ndjson")
        assert {r.part_key: r["count"] for r in back.groupBy("part_key").count().collect()} == {"m1": 2, "m2": 1, "m3": 1} and n == 4
        assert spark.read.options(**publish.CSV).csv(f"{path}{buckets}/csv").count() == 4
        assert sorted(r.part_key for r in publish.read_partition(spark, f"{path}{buckets}", "m1", buckets).collect()) == ["m1", "m1"]
    clash = spark.createDataFrame([("1", "a/b"), ("2", "a-b")], "question_id string, s string")
    with pytest.raises(publish.PublishError):
        publish.write_partitions(clash, "s", path + "2")
    with pytest.raises(publish.PublishError):
        publish.manifest({}, "now", licence="mine")


def test_last_known_good(spark, tmp_path, monkeypatch):
    new, cur = f"file://{tmp_path}/new", f"file://{tmp_path}/cur"
    spark.range(1).write.json(f"{new}/set")
    assert not publish.promote(spark, new, cur, ["set"])
    publish.write_manifest(spark, {"a": 1}, new)
    assert publish.promote(spark, new, cur, ["set"]) and publish.inspect_previous(spark, cur, ["set"]) == []
    # The second rename fails: the old snapshot is back in its place, whole.
    spark.range(2).write.json(f"{new}/set")
    publish.write_manifest(spark, {"a": 2}, new)
    fs, hadoop = publish._fs(spark, cur)

    class Failing:
        def __init__(self, error):
            self.calls, self.error = 0, error

        def rename(self, a, b):
            self.calls += 1
            if self.calls == 2:
                if self.error:
                    raise OSError("no such luck")
                return False
            return fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(fs, name)

    for error in (False, True):
        monkeypatch.setattr(publish, "_fs", lambda *a, f=Failing(error): (f, hadoop))
        assert not publish.promote(spark, new, cur, ["set"]) and spark.read.json(f"{cur}/set").count() == 1
        assert publish.read_manifest(spark, cur) == {"a": 1} and publish.exists(spark, new)
    monkeypatch.undo()
    # A run that died between the two renames: the next one starts by putting the old snapshot back.
    fs.rename(hadoop.Path(cur), hadoop.Path(f"{cur}.old"))
    assert not publish.promote(spark, f"{new}.none", cur, ["set"]) and publish.read_manifest(spark, cur) == {"a": 1}
    assert publish.promote(spark, new, cur, ["set"]) and publish.read_manifest(spark, cur) == {"a": 2} and not publish.exists(spark, f"{cur}.old")
    assert publish.inspect_previous(spark, cur, ["set"], ("set",)) == [] and publish.inspect_previous(spark, cur, ["set"], ("none",)) == ["any question file"]
    (tmp_path / "cur" / "manifest.json").write_text("{")
    (tmp_path / "cur" / ".manifest.json.crc").unlink(missing_ok=True)
    assert publish.inspect_previous(spark, cur, ["set"]) == ["manifest.json (unreadable)"]
    assert publish.remove(spark, cur) and not publish.remove(spark, cur)
    kept = publish.retain_previous(spark.createDataFrame([("h",)], "house string"), "outage", "2026-01-01").first()
    assert (kept.freshness, kept.retained_reason) == ("last-known-good", "outage")


def test_cli(spark, tmp_path, small):
    from ledgerloom import cli

    pub = f"file://{tmp_path}/pub"
    common = ["--source", small, "--published-dir", pub, "--no-approximate"]
    assert cli.main([*common, "--accept-differing"]) == 0
    assert publish.inspect_previous(spark, pub, cli.REQUIRED, cli.QUESTIONS) == []
    first = publish.read_manifest(spark, pub)
    assert first["provenance"]["mode"] == "built"
    # A build that fails keeps the snapshot and stamps its coverage.
    assert cli.main(["--source", f"{small}/none", "--published-dir", pub]) == 1
    assert publish.read_manifest(spark, pub) == first
    said = spark.read.json(f"{pub}/coverage/ndjson").first()
    assert said.freshness == "last-known-good" and said.retained_reason and not publish.exists(spark, f"{pub}/coverage.old")
    # The same into a new place, from a named previous snapshot.
    other = f"file://{tmp_path}/other"
    assert cli.main(["--source", f"{small}/none", "--published-dir", other, "--previous", pub]) == 1
    assert publish.inspect_previous(spark, other, cli.REQUIRED, cli.QUESTIONS) == []
    # A complete build left over is taken up only when asked for.
    publish._fs(spark, pub)[0].rename(publish._fs(spark, pub)[1].Path(other), publish._fs(spark, pub)[1].Path(f"{pub}.building"))
    assert cli.main([*common, "--resume"]) == 0
    assert publish.read_manifest(spark, pub)["provenance"] == {"mode": "resumed", "written_at": first["last_refreshed"]}


def test_failed_signals_stop_publishing(spark):
    checks = spark.createDataFrame([("identity", "records without an identity", 0), ("deduplication", "questions whose copies differ", 2), ("x", "y", None)], "stage string, reason string, records bigint")
    failed = quality.ingestion_failures(checks)
    assert [r.detail for r in failed.collect()] == ["deduplication: questions whose copies differ (2 records)"]
    assert not quality.should_publish(failed) and quality.should_publish(quality.ingestion_failures(checks.where("stage <> 'deduplication'")))


def test_span_totals_that_do_not_add_up_raise(spark):
    good = spark.createDataFrame([("h/17/1", 2, 1, 1, 0, 0)], "session string, questions int, fully_linked int, partly_linked int, not_linked int, ambiguous int")
    assert views.checked_totals(views.span_totals(good)).first().questions == 2
    with pytest.raises(views.StatusSumMismatch):
        views.checked_totals(views.span_totals(good.withColumn("questions", F.lit(3))))


def test_orders_and_claims(spark):
    s = spark.createDataFrame([("h/17/10",), ("odd",), ("h/17/2",), ("h/18/1",)], "session string")
    assert [r.session for r in views.in_session_order(s).collect()] == ["h/17/2", "h/17/10", "h/18/1", "odd"]
    assert [r.session for r in views.in_session_order(s, newest_first=True).collect()] == ["h/18/1", "h/17/10", "h/17/2", "odd"]
    c = spark.createDataFrame([("d", x) for x in ("b", "10", "2", "a")], "dimension string, category string")
    assert [r.category for r in views.in_category_order(c).collect()] == ["10", "2", "a", "b"]
    n = spark.createDataFrame([("Zebra",), ("apple",), ("Éclair",), ("Banana",)], "name string")
    assert [r.name for r in views.in_locale_order(n, "name").collect()] == ["apple", "Banana", "Éclair", "Zebra"]
    rows = spark.createDataFrame([("lok-sabha", 5, None), ("rajya-sabha", 7, None), ("third-house", 0, "not stated")], "house string, questions int, reason string")
    assert views.houses_claim(rows).first().claim == "Lok Sabha and Rajya Sabha" and views.houses_claim(rows.limit(0)).first().claim == "No House is covered"
    assert [r.house for r in views.covered_houses(rows).collect()] == ["rajya-sabha", "lok-sabha"]
    assert [tuple(r) for r in views.uncovered_houses(rows).collect()] == [("third-house", "Third House", None)]
    basis = spark.createDataFrame([("question", "1", "counted once")], "unit string, basis_version string, counting_basis string")
    assert {r.counting_basis for r in views.with_basis(rows, basis).collect()} == {"counted once"}


def test_display(spark):
    from ledgerloom.functions import display

    one = lambda kind, make, *values: [r.x for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(make(F.col("v")).alias("x")).collect()]
    assert one("double", display.count, 0.0, 999.5, 1234567.0, -1234567.0, 100000.0, None, float("nan"), float("inf")) == ["0", "1,000", "12,34,567", "-12,34,567", "1,00,000", *["not stated"] * 3]
    assert one("double", display.percent, 0.5, 0.90625, None) == ["50.00%", "90.63%", "not stated"]
    assert one("string", display.day, "2019-06-21", "2019-13-01", "21.06.2019", None) == ["21 Jun 2019", *["not stated"] * 3]
    assert one("int", display.ordinal, 1, 2, 3, 4, 11, 12, 13, 21, 111, None) == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "111th", "not stated"]
    assert one("string", display.session_label, "lok-sabha/17/4", "odd", None) == ["17th LS · Session 4", "odd", "not stated"]
    assert one("string", display.session_file_name, "lok-sabha/17/4/starred/12", None) == ["lok-sabha-17-4.jsonl", None]
    assert one("string", display.https_only, "https://x", "http://x", None) == ["https://x", None, None]
    parts = one("string", display.question_parts, "h/17/4/s/12", "h/17/4/s/x", "h/17/4", "h/a/4/s/1")
    assert parts[0].number == 12 and parts[1].number is None and parts[1].type == "s" and parts[2] is None and parts[3] is None
    assert one("array<int>", display.terms_phrase, [17, 18], [18], [16, 17, None, 18], [], None) == ["17th and 18th Lok Sabha", "18th Lok Sabha", "16th, 17th and 18th Lok Sabha", "not stated", "not stated"]


def test_read_back_counts_each_set_by_its_files(spark, tmp_path):
    plain = spark.createDataFrame([("a", 'x "y"\nz, w'), ("b", ""), ("c", None)], "id string, text string")
    parts = spark.createDataFrame([(f"q{i}", f"k{i % 3}") for i in range(10)], "question_id string, axis string")
    path = str(tmp_path / "made")
    assert publish.write_both(plain, f"{path}/plain") == 3
    assert publish.write_both(plain.limit(0), f"{path}/none") == 0
    assert publish.write_partitions(parts, "axis", f"{path}/by-axis") == 10
    told = [{r.set: r[1] for r in df.collect()} for df in rebuild.read_back(spark, path, ["plain", "none", "by-axis"])]
    assert told == [{"plain": 3, "by-axis": 10}] * 2


def test_counts_of_a_rebuild_hold_no_plan_of_its_sets(spark, small):
    made = rebuild.rebuild_counts(spark, small)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" not in plan.replace("LocalRelation", "") and "Aggregate" not in plan
