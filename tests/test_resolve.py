"""The cascade: every tier, ambiguity, overlay, statuses; the approximate tier against all pairs."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import canon
from ledgerloom.operators import resolve
from ledgerloom.session import staged

POOL = [
    ("17", "m1", "Rujil Jovan Kakunos"),
    ("17", "m1", "R. J. Kakunos"),
    ("17", "m2", "Thekuthe Nizaya"),
    ("17", "m3", "Zevor Hemal Hihapij"),
    ("17", "m4", "Dimuka Tobubel"),
    ("17", "m5", "Dimuka Tobubel"),
    ("18", "m6", "Koyoni Mivilel"),
    ("17", "m7", None),
    ("17", "m8", " "),
]


def run(spark, forms, pool=POOL, **kw):
    f = spark.createDataFrame([("17", x) for x in forms], "scope string, form string")
    p = spark.createDataFrame(pool, "scope string, member_id string, written string")
    out = resolve.cascade(resolve.distinct_forms(f), resolve.pool_keys(p), **kw)
    return {r.form: r for r in out.collect()}


def test_tiers(spark):
    got = run(spark, ["Rujil Jovan Kakunos", "SHRI RUJIL JOVAN KAKUNOS.", "Nizaya Thekuthe", "Zevor Hemal Hihapji", "Jovan Kakunos", "Nobody Known", "Koyoni Mivilel", None, " "])
    assert {k: (v.method, v.member_id, v.status) for k, v in got.items()} == {
        "Rujil Jovan Kakunos": ("exact", "m1", "resolved"),
        "SHRI RUJIL JOVAN KAKUNOS.": ("normalised", "m1", "resolved"),
        "Nizaya Thekuthe": ("normalised-reordered", "m2", "resolved"),
        "Zevor Hemal Hihapji": ("approximate", "m3", "resolved"),
        "Jovan Kakunos": ("token-containment", "m1", "resolved"),
        "Nobody Known": (None, None, "unresolved"),
        "Koyoni Mivilel": (None, None, "unresolved"),  # a member of another term
    }


def test_shared_name_is_never_merged(spark):
    row = run(spark, ["Dimuka Tobubel"])["Dimuka Tobubel"]
    assert (row.status, row.member_id, row.candidates) == ("ambiguous", None, ["m4", "m5"])


def test_containment_can_be_off_and_only_raises(spark):
    assert run(spark, ["Jovan Kakunos"], containment=False)["Jovan Kakunos"].status == "unresolved"
    several = [("17", "a", "Tono Ziar Velu"), ("17", "b", "Tono Ziar Rand")]
    assert run(spark, ["Tono Ziar"], several, approximate=False)["Tono Ziar"].status == "unresolved"


def test_empty(spark):
    assert run(spark, ["x"], POOL[:1])["x"].status == "unresolved"
    p = spark.createDataFrame(POOL, "scope string, member_id string, written string")
    f = spark.createDataFrame([], "scope string, form string")
    assert resolve.cascade(resolve.distinct_forms(f), resolve.pool_keys(p)).count() == 0
    f = spark.createDataFrame([("17", "x")], "scope string, form string")
    assert [r.status for r in resolve.cascade(resolve.distinct_forms(f), resolve.pool_keys(p.limit(0))).collect()] == ["unresolved"]


def test_blocking_loses_no_pair(spark):
    rnd = random.Random(3)
    names = ["".join(rnd.choice("abcdeilnorst ") for _ in range(rnd.randint(1, 30))).strip() or "x" for _ in range(60)]

    def slip(n):
        out = list(n)
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(out) or 1)
            if rnd.random() < 0.5 and out:
                out.pop(i % len(out))
            else:
                out.insert(i, rnd.choice("aeiou"))
        return "".join(out)

    forms = [slip(n) for n in names for _ in range(4)] + names[:20]
    f = resolve.distinct_forms(spark.createDataFrame([("s", x) for x in forms], "scope string, form string"))
    p = resolve.pool_keys(spark.createDataFrame([("s", f"m{i}", n) for i, n in enumerate(names)], "scope string, member_id string, written string"))
    got = {(r.normalised, r.key): round(r.score, 9) for r in resolve.near_keys(f, p).collect()}
    keys = {r[0] for r in p.select("normalised").collect()} - {""}
    want = {}
    for w in {r[0] for r in f.select("normalised").collect()} - {""}:
        for k in keys:
            score = difflib.SequenceMatcher(None, k, w).ratio()
            if score >= resolve.RATIO:
                want[w, k] = round(score, 9)
    assert got == want and len(want) > 60


def test_near_ties_are_ambiguous(spark):
    pool = [("17", "a", "abcdefghijklmnopqrsx"), ("17", "b", "abcdefghijklmnopqrsy")]
    row = run(spark, ["abcdefghijklmnopqrsz"], pool)["abcdefghijklmnopqrsz"]
    assert (row.method, row.status, row.candidates) == ("approximate", "ambiguous", ["a", "b"])


def outcome(spark, rows):
    return spark.createDataFrame(rows, "scope string, form string, status string, method string, member_id string, candidates array<string>, score double")


def test_overlay_wins_and_is_counted(spark):
    out = outcome(spark, [("17", "A", "resolved", "exact", "m1", [], 1.0), ("17", "B", "unresolved", None, None, [], 0.0), ("17", "C", "ambiguous", "exact", None, ["m1", "m2"], 1.0)])
    said = spark.createDataFrame([("A", "m9"), ("B", "m2")], "form string, member_id string")
    got = {r.form: (r.status, r.method, r.member_id, r.asserted_by) for r in resolve.overlay(out, said).collect()}
    assert got == {"A": ("resolved", "manual-assertion", "m9", "maintainer"), "B": ("resolved", "manual-assertion", "m2", "maintainer"), "C": ("ambiguous", "exact", None, "automatic")}
    assert [tuple(r) for r in resolve.overrides(out, said).collect()] == [("17", "A", "m1", "m9")]
    both = said.union(spark.createDataFrame([("A", "m8")], said.schema))
    assert [r.form for r in resolve.assertion_conflicts(both).collect()] == ["A"]


@pytest.fixture()
def statuses(spark):
    out = outcome(
        spark,
        [("17", "A", "resolved", "exact", "m1", [], 1.0), ("17", "A2", "resolved", "exact", "m1", [], 1.0), ("17", "B", "resolved", "exact", "m2", [], 1.0), ("17", "U", "unresolved", None, None, [], 0.0), ("17", "X", "ambiguous", "exact", None, ["m1", "m2"], 1.0)],
    )
    asked = {"q1": ["B", "A"], "q2": ["A", "A2"], "q3": ["U"], "q4": ["A", "U"], "q5": ["A", "X"], "q6": [], "q7": ["X", "U"]}
    rows = [(q, "17", i, f) for q, fs in asked.items() for i, f in enumerate(fs)] + [("q6", "17", None, None)]
    bridge = spark.createDataFrame(rows, "question_id string, scope string, at int, form string")
    return bridge, out


def test_question_status(statuses):
    bridge, out = statuses
    got = {r.question_id: (r.resolution_status, r.asking_members) for r in resolve.question_status(bridge, out).collect()}
    assert got == {
        "q1": ("resolved", ["m2", "m1"]),
        "q2": ("resolved", ["m1"]),
        "q3": ("unresolved", []),
        "q4": ("unresolved", ["m1"]),
        "q5": ("ambiguous", []),
        "q6": ("unresolved", []),
        "q7": ("unresolved", []),
    }


def test_assertions_do_not_add_up_by_form(spark, statuses):
    bridge, out = statuses
    two = bridge.union(spark.createDataFrame([("q8", "17", 0, "U"), ("q8", "17", 1, "V")], bridge.schema))
    more = out.union(outcome(spark, [("17", "V", "unresolved", None, None, [], 0.0)]))
    n = lambda said: {r.question_id for r in resolve.question_status(two, resolve.overlay(more, spark.createDataFrame(said, "form string, member_id string"))).where("resolution_status = 'resolved'").collect()}
    assert "q8" not in n([("U", "m3")]) and "q8" not in n([("V", "m4")]) and "q8" in n([("U", "m3"), ("V", "m4")])


def test_rates_and_audit(spark, statuses):
    bridge, out = statuses
    plain = resolve.question_status(bridge, out)
    rate = resolve.rates(plain, plain).first()
    assert (rate.resolved_automatic, rate.total, rate.automatic_rate) == (2, 7, round(2 / 7, 6))
    assert resolve.rates(plain.limit(0), plain.limit(0)).first().automatic_rate == 0.0
    mentions = bridge.where("form is not null").withColumn("seq", F.substring("question_id", 2, 1).cast("int")).withColumn("ref", F.col("question_id"))
    audit = {r.name_as_written: r.source_record_ref for r in resolve.audit(resolve.overlay(out, spark.createDataFrame([], "form string, member_id string")), mentions).collect()}
    assert audit == {"A": "q1", "A2": "q2", "B": "q1", "U": "q3", "X": "q5"}


def test_told_apart(spark, statuses):
    members = spark.createDataFrame([("m1", "s1", None, "p"), ("m2", "s2", None, "p")], "member_id string, constituency string, state string, party string")
    assert [tuple(r) for r in resolve.told_apart(statuses[1], members, ["constituency", "party", "state"]).collect()] == [("17", "X", ["constituency"])]


def test_canon_of_honorific_only(spark):
    assert spark.range(1).select(canon(F.lit("Shri Dr."))).first()[0] == ""
    assert run(spark, ["Shri Dr."])["Shri Dr."].status == "unresolved"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pieces_of_keys_are_never_broadcast(spark):
    names = [f"velu tonoz{chr(97 + i % 26)}{chr(97 + i // 26)} rand" for i in range(300)]
    f = resolve.distinct_forms(spark.createDataFrame([("s", x + "i") for x in names], "scope string, form string"))
    p = resolve.pool_keys(spark.createDataFrame([("s", f"m{i}", x) for i, x in enumerate(names)], "scope string, member_id string, written string"))
    # As small as they are before they are cut, the planner would send all pieces to the driver.
    near = resolve.near_keys(staged(f), staged(p))
    assert "SortMergeJoin" in _plan(near) and "BroadcastExchange" not in _plan(near)
    assert near.where("normalised = concat(key, 'i')").count() == len(names)


def test_pairs_are_scored_once(spark):
    f = resolve.distinct_forms(spark.createDataFrame([("s", "Tono Ziar Veluu")], "scope string, form string"))
    p = resolve.pool_keys(spark.createDataFrame([("s", "a", "Tono Ziar Velu"), ("s", "b", "Tono Ziar Velo")], "scope string, member_id string, written string"))
    tier = resolve.approximate_tier(staged(f), staged(p))
    assert tier._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.candidates, round(r.score, 4)) for r in tier.collect()] == [(["a"], 0.9655)]


def test_first_key_decides_with_all_its_members(spark):
    pool = [("s", "b", "Tono Ziar"), ("s", "a", "Tono Ziar"), ("s", "c", "TONO ZIAR"), ("s", "d", "Ziar Tono"), ("t", "e", "Tono Ziar")]
    f = spark.createDataFrame([("s", x) for x in ("Tono Ziar", "tono ziar.", "Mr. Ziar, Tono", "...", "Ziar")], "scope string, form string")
    p = spark.createDataFrame(pool, "scope string, member_id string, written string")
    got = {r.form: (r.candidates, r.method) for r in resolve.first_keys(resolve.distinct_forms(f), resolve.pool_keys(p)).collect()}
    assert got == {
        "Tono Ziar": (["a", "b"], "exact"),
        "tono ziar.": (["a", "b", "c"], "normalised"),
        "Mr. Ziar, Tono": (["d"], "normalised"),
        "...": (None, None),
        "Ziar": (None, None),
    }
