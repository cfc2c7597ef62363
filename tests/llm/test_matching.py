"""Set-similarity join, canonical mapping, record matching and name variants against brute force and planted cases."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.llm import canonical, entity, names, variants


def test_similarity_join_equals_all_pairs(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 7))) for _ in range(80)]
    sets = lambda side, ws: spark.createDataFrame([(f"{w}{i}", sorted({w[j : j + 2] for j in range(len(w) - 1)})) for i, w in enumerate(ws)], f"{side} string, tokens array<string>")
    left, right = sets("l", words[:50]), sets("r", words[50:])
    for least in (0.3, 0.5, 0.8):
        got = {(r.l, r.r): round(r.jaccard, 9) for r in canonical.similarity_join(left, right, least).collect()}
        want = {}
        for a in left.collect():
            for b in right.collect():
                x, y = set(a.tokens), set(b.tokens)
                if x and y and len(x & y) / len(x | y) >= least - 1e-12:
                    want[a.l, b.r] = round(len(x & y) / len(x | y), 9)
        assert got == want


def reference(spark):
    rows = [("canal", "Canal Irrigation and Village Tanks", ["Canal Irrigation"]), ("ferries", "Inland Ferries", ["River Crossings"]), ("silk", "Silk", None), ("salt", "Salt Pans", [])]
    return canonical.entries(spark.createDataFrame(rows, "id string, name string, former array<string>"), "id", {"name": 0, "former": 1})


def test_mapping(spark):
    want = {
        "Ministry of Inland Ferries": "ferries", "INLAND  FERRIES ": "ferries", "Inland Frries": "ferries", "Deptt of River Crossings": "ferries", "Village Tanks & Canal Irrigation": "canal",
        "Canal Irrig. and Vill. Tanks": "canal", "CIVT": "canal", "MoC.I.V.T.": "canal", "M/o CIVT": "canal", "Canal_Irrigation": "canal", "Sikl": "silk", "Salt Pan": "salt", "SaltPans": "salt",
        "Cabinet Office": None, "N/A": None, "-": None, "Glass Works": None, "x" * 5000: None,
    }
    values = spark.createDataFrame([(v,) for v in want], "value string")
    assert {r.value: r.entry for r in canonical.match_values(values, reference(spark)).collect()} == want


def test_mapping_rows(spark):
    df = spark.createDataFrame([(1, "Slik"), (1, "Slik"), (2, None), (3, "  "), (4, "Silk")], "seq int, value string").withColumn("entry", F.lit("clash"))
    out = canonical.map_column(df, "value", ["seq"], reference(spark), exact=F.col("value") == "Silk")
    assert sorted((r.seq, r.entry) for r in out.collect()) == [(1, "silk"), (1, "silk")]
    assert canonical.map_column(df.limit(0), "value", ["seq"], reference(spark)).count() == 0
    assert {r.entry for r in canonical.map_column(df, "value", ["seq"], reference(spark).limit(0)).collect()} == {None}


def test_folding(spark):
    forms = ["Tegipap, Sri Sipān", "TEGIPAP Shri Sipan", 'Seepan "Sippu" Tegipap', "Prof. Tegipap (Sipan)", "Sipan Tegip-Ap", "Sipan Tegipap, M.P.", "Shri", None, " "]
    rows = spark.createDataFrame([(f,) for f in forms], "f string").select(names.key(names.folded(F.col("f"))).alias("k")).collect()
    assert [r.k for r in rows] == ["sipan tegipap"] * 6 + ["", None, ""]


def test_pairing():
    whole, part, least, initials, left = names.pairing(["k", "teku", "hotabop"], ["kuvuya", "teku", "hotabop"])
    assert initials == 1 and left == 0 and least == 0.6
    assert names.pairing(["lojormel", "godetut"], ["lojor", "mel", "godetut"])[0] == 1.0
    assert names.pairing([], ["a"]) == (0.0, 0.0, 0.0, 0, 1)


def people(n, seed=4):
    rnd = random.Random(seed)
    syllable = lambda: rnd.choice("bdgjklmnprtvz") + rnd.choice("aeiou")
    given = ["".join(syllable() for _ in range(2)) + rnd.choice("nrtl") for _ in range(25)]
    out, seen = [], set()
    while len(out) < n:
        name = (rnd.choice(given), "".join(syllable() for _ in range(3)) + rnd.choice("nrtlp"))
        if name[1] not in seen:
            seen.add(name[1])
            out.append((f"m{len(out)}", f"{name[0]} {name[1]}".title(), "".join(syllable() for _ in range(3)).title() + rnd.choice(["", " North", " South"]), rnd.choice(["Belmoria", "Chandovar", "Ezhavand"])))
    return out


def test_matching_finds_planted_members(spark):
    rnd, roster = random.Random(9), people(150)
    slips, truth = [], {}
    for i in range(900):
        m, name, seat, state = rnd.choice(roster)
        g, s = name.split()
        written = rnd.choice([name, name.upper(), f"{s}, {g}", f"Shri {name}", name[:-3] + name[-2] + name[-3] + name[-1]])
        slips.append((i, written, rnd.choice([seat, seat.upper(), seat + " (SC)", None]), rnd.choice([state, state, None, "not stated"])))
        truth[i] = m
    strangers = people(40, seed=77)
    slips += [(1000 + i, n, s, t) for i, (_, n, s, t) in enumerate(strangers)] + [(2000, None, "x", "y"), (2001, " ", None, None), (5, slips[5][1], slips[5][2], slips[5][3])]
    left = spark.createDataFrame(slips, "slip int, who string, seat string, state string").withColumn("key", F.lit("clash"))
    right = spark.createDataFrame(roster + roster[:20], "id string, name string, seat string, state string")
    out = entity.match(left, right, "slip", ("who", "seat", "state"), "id", ("name", "seat", "state")).collect()
    found = {r.left_id: r.right_id for r in out}
    right_ones = sum(truth.get(k) == v for k, v in found.items())
    assert right_ones >= 0.95 * len(truth) and right_ones >= 0.97 * len(found)
    assert all(0.5 <= r.confidence <= 1 for r in out) and 2000 not in found and 2001 not in found
    assert entity.match(left.limit(0), right, "slip", ("who", "seat", "state"), "id", ("name", "seat", "state")).count() == 0
    assert entity.match(left, right.limit(0), "slip", ("who", "seat", "state"), "id", ("name", "seat", "state")).count() == 0


def test_exact_candidates_need_no_seat(spark):
    roster = [(1, "kesharimal rajendra lal"), (2, "suka muke rehoberd"), (3, "suka bano rehoberd"), (4, "tono velu bevozir"), (5, "mira bano lal")]
    slips = [(1, "k r lal"), (2, "s m rehoberd"), (3, "suka rehobred"), (4, "tono bevozir"), (5, "tono velu bevozri"), (6, "kesharimal"), (7, "x y zz"), (8, "m rehobred")]
    side = lambda rows: spark.createDataFrame([(i, n.split()) for i, n in rows], "id bigint, tokens array<string>")
    got = {(r.l, r.r) for r in entity.token_candidates(side(slips), side(roster)).collect()}
    assert got == {(1, 1), (2, 2), (2, 3), (3, 2), (3, 3), (4, 4), (5, 4), (6, 1), (8, 2)}
    rows = spark.createDataFrame([("m1", "Kesharimal Rajendra Lal", "Bano", "Belmoria"), ("m2", "Mira Bano Lal", "Tira", "Chandovar")], "id string, name string, seat string, state string")
    asked = spark.createDataFrame([(1, "K R Lal", None, "Belmoria"), (2, "Mira Bano Lal", "Tira", "Chandovar")], "slip int, who string, seat string, state string")
    compared = entity.match(asked, rows, "slip", ("who", "seat", "state"), "id", ("name", "seat", "state"), least=0.0).collect()
    assert (1, "m1") in {(r.left_id, r.right_id) for r in compared}


def test_classifier_is_calibrated():
    rnd = random.Random(1)
    rows = []
    for _ in range(6000):
        y = rnd.random() < 0.3
        row = dict.fromkeys(entity.FEATURES, 0.0) | {"label": float(y), "whole": rnd.gauss(0.8 if y else 0.4, 0.2), "seat": rnd.gauss(0.7 if y else 0.4, 0.3)}
        rows.append(row | {"pair": len(rows), "weight": 1.0})
    model = entity.fit(pd.DataFrame(rows))
    assert model.weights[0] > 0 and model.weights[5] > 0 and 0.5 < model.slope < 2
    # Half of the matches left out and the rest counting double: the same rate, so about the same mean probability.
    def mean(model, rows):
        raw = [sum(w * r[f] for w, f in zip(model.weights, entity.FEATURES)) + model.offset for r in rows]
        return sum(1 / (1 + math.exp(-(model.slope * x + model.shift))) for x in raw) / len(rows)

    thinned = [r | {"weight": 1 + r["label"]} for r in rows if not r["label"] or r["pair"] % 2]
    assert abs(mean(model, rows) - 0.3) < 0.03 and abs(mean(entity.fit(pd.DataFrame(thinned)), rows) - 0.3) < 0.03


def test_one_class_of_weak_labels_still_gives_a_fitted_classifier(spark):
    roster = people(6, seed=3)
    slips = [(i, name, seat, state) for i, (_, name, seat, state) in enumerate(roster)] + [(9, roster[0][1], None, None), (10, "Someone Other", "Nowhere", None)]
    left = spark.createDataFrame(slips, "slip int, who string, seat string, state string")
    right = spark.createDataFrame(roster, "id string, name string, seat string, state string")
    columns = ("slip", ("who", "seat", "state"), "id", ("name", "seat", "state"))
    found = {r.left_id: r.right_id for r in entity.match(left, right, *columns).collect()}
    assert found == {i: m for i, (m, *_) in enumerate(roster)} | {9: roster[0][0]}
    # Without a pair that agrees in everything nothing is learnt, and nothing matched.
    assert entity.match(left.where("seat is null"), right, *columns).count() == 0


def test_training_sample_goes_by_pair(spark):
    row = dict.fromkeys(entity.FEATURES, 0.0)
    often = [row | {"label": 1.0, "pair": i, "lk": "a b", "l_seat": "s", "l_state": "t", "r_id": "m0", "whole": 1.0 if i % 10 else i / 4000} for i in range(4000)]
    labelled = spark.createDataFrame(pd.DataFrame(often + [row | {"label": 0.0, "pair": -1, "lk": "c d", "l_seat": "s", "l_state": "t", "r_id": "m1"}]))
    members = spark.createDataFrame([("e f", "s", "t", "m0"), ("g h", "u", None, "m2")], "rk string, r_seat string, r_state string, r_id string")
    made = entity.training(labelled, members, rows=1200)
    sure = made[made["label"] == 1.0]
    assert len(sure) == 400 and 5 <= sure["whole"].nunique() <= 20 and set(sure["weight"]) == {40.0}
    assert set(made[made["label"] == 0.0]["weight"]) == {1.0}


def test_cosine_join_equals_all_pairs(spark):
    import math

    rnd = random.Random(6)
    words = sorted({"".join(rnd.choice("abcde") for _ in range(rnd.randint(3, 8))) for _ in range(70)})
    items = spark.createDataFrame([(w,) for w in words], "item string")
    grams = {w: {("<" + w + ">")[i : i + 3] for i in range(len(w))} for w in words}
    df = {}
    for g in grams.values():
        for x in g:
            df[x] = df.get(x, 0) + 1
    vectors = {}
    for w, g in grams.items():
        v = {x: math.log1p(len(words) / df[x]) for x in g if df[x] > 1}
        n = math.sqrt(sum(a * a for a in v.values()))
        vectors[w] = {x: a / n for x, a in v.items()} if n else {}
    want = {(a, b) for a in words for b in words if a != b and sum(x * vectors[b].get(g, 0) for g, x in vectors[a].items()) >= 0.4}
    assert {(r.a, r.b) for r in variants.cosine_join(items, 0.4).collect()} == want and want


def test_edit_join_equals_all_pairs(spark):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(120)})
    items = spark.createDataFrame([(w, w) for w in words], "item string, word string")
    want = {(a, b) for a in words for b in words if a != b and names.edits(a, b) == 1}
    assert {(r.a, r.b) for r in variants.edit_join(items).collect()} == want and want


def test_variants_link_one_edit_in_a_short_token(spark):
    rnd = random.Random(5)
    syllable = lambda: rnd.choice("bdgjklmnprtz") + rnd.choice("aeiou")
    given = sorted({"".join(syllable() for _ in range(2)) + rnd.choice(["", "n", "ra"]) for _ in range(60)})
    rows, slips, used = [], [], set(given)
    for i in range(200):
        g, s = rnd.choice(given), "".join(syllable() for _ in range(3)) + "bcdfgjklmnpr"[i % 12] + "aeiou"[i // 12 % 5] + "kmt"[i // 60 % 3] + "z" * (i >= 180)
        at = rnd.randint(1, len(g) - 2)
        typo = rnd.choice([g[:at] + g[at + 1] + g[at] + g[at + 2 :], g[:at] + rnd.choice([x for x in "lmnrt" if x != g[at]]) + g[at + 1 :]])
        if typo in used:  # twice the same would be a name of its own
            continue
        used.add(typo)
        rows += [(f"{g} {s}".title(),)] * 9 + [(f"{typo} {s}".title(),)]
        slips.append((rows[-2][0], rows[-1][0]))
    of = {r.form: r.cluster for r in variants.cluster_forms(spark.createDataFrame(rows, "form string")).collect()}
    assert [(a, b) for a, b in slips if of[a] != of[b]] == []


def test_short_writings_join_by_the_roster_not_by_their_number(spark):
    long, short = ["Nolel Wani Hogatek", "Tono Velu Bevozir"], ["Nolel Hogatek", "NOLEL HOGATEK", 'Nolel "Nolly" Hogatek', "Shri Nolel Hogatek"]
    df = spark.createDataFrame([(f,) for f in long * 2 + short * 5 + ["Tono Bevozir"]], "form string")
    known = spark.createDataFrame([(["nolel", "vani", "hogatek"], "1"), (["tono", "velu", "bevozir"], "2"), (["tono", "bevozir"], "3"), (["bevozir", "tono"], "4"), ([], "5"), (None, "6")], "tokens array<string>, owner string")
    rows = variants.cluster_forms(df, known).collect()
    of = {r.form: r.cluster for r in rows}
    assert {r.form for r in rows if r.namesakes} == {"Tono Bevozir"}
    assert {of[f] for f in short} == {of[long[0]]} and of["Tono Bevozir"] != of[long[1]]


def test_average_linkage_equals_one_merge_at_a_time(spark):
    rnd = random.Random(8)
    n = 30
    links = {(a, b): round(rnd.uniform(0.3, 1), 4) for a in range(n) for b in range(a + 1, n) if rnd.random() < 0.15}
    weight = {a: rnd.randint(1, 9) for a in range(n)}
    clusters = {a: {a} for a in range(n)}
    mean = lambda x, y: sum(links.get((min(i, j), max(i, j)), 0) * weight[i] * weight[j] for i in x for j in y) / (sum(weight[i] for i in x) * sum(weight[j] for j in y))
    while True:
        best = max(((mean(clusters[a], clusters[b]), -a, -b) for a in clusters for b in clusters if a < b), default=(0, 0, 0))
        if best[0] < 0.5:
            break
        clusters[-best[1]] |= clusters.pop(-best[2])
    nodes = spark.createDataFrame(list(weight.items()), "node bigint, weight bigint")
    edges = spark.createDataFrame([(a, b, s) for (a, b), s in links.items()], "a bigint, b bigint, likeness double")
    for small in (0, 5, 1000):
        got = {}
        for r in variants.average_linkage(nodes, edges, least=0.5, small=small).collect():
            got.setdefault(r.cluster, set()).add(r.node)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, clusters.values()))


def test_name_cosines_equal_a_plain_product(spark):
    rnd = random.Random(12)
    listed = [["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(1, 3))] for _ in range(25)]
    keys = spark.createDataFrame(list(enumerate(listed)), "id bigint, tokens array<string>")
    grams = [{("<" + t + ">")[i : i + 3] for t in ts for i in range(max(len(t), 1))} | {"<" + t[0] for t in ts} for ts in listed]
    df = {g: sum(g in x for x in grams) for x in grams for g in x}
    v = [{g: math.log1p(len(grams) / df[g]) for g in x} for x in grams]
    size = [math.sqrt(sum(w * w for w in x.values())) for x in v]
    want = {(a, b): sum(w * v[b].get(g, 0) for g, w in v[a].items()) / size[a] / size[b] for a in range(25) for b in range(25) if a < b}
    pairs = spark.createDataFrame(list(want), "a bigint, b bigint")
    got = {(r.a, r.b): r.cosine for r in variants.name_cosines(keys, pairs, 0.2).collect()}
    assert got.keys() == {k for k, x in want.items() if x >= 0.2} and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    best = {max((x, -b) for (a, b), x in want.items() if a == 0)[1]}
    kept = {(r.a, r.b) for r in variants.name_cosines(keys, pairs, 0.0, top=1).collect()}
    assert all((0, -b) in kept for b in best) and len(kept) <= 25


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 9)] + [(7, 7)]
    got = {r.node: r.component for r in variants.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(21)} | {100 + i: 100 for i in range(9)}


def test_variants_link_writings_of_one_name(spark):
    one = ["Rujil Jovan Kakunos", "KAKUNOS Dr. Rujil Jovan", "Kakunos, Rujil Jovan", "Rujil J. Kakunos", "Rujil Jovan Kaknuos", "Rujil Kakunos", "Rūjil Jovan Kakunos", "Rujil Jovan Kakunos "]
    two = ["Tono Velu Bevozir", "Tono Velu Bevoozir", "Shri Tono Velu Bevozir"]
    other = ["Nizi Umak Gothachar", "Nizi Rand Gothachar", "Nizi Gothachar"]
    rows = [(f,) for f in one * 3 + two + other + [None, " ", "Shri"]]
    df = spark.createDataFrame(rows, "form string").withColumn("cluster", F.lit(1))
    got = {}
    for r in variants.cluster_forms(df).collect():
        got.setdefault(r.cluster, set()).add(r.form)
    assert set(one) in got.values() and set(two) in got.values()
    assert sum(bool(c & set(other)) for c in got.values()) == 3
    pairs = variants.form_pairs(variants.cluster_forms(df))
    assert pairs.count() == 28 + 3 and pairs.where("form_a >= form_b").count() == 0
    assert variants.cluster_forms(df.limit(0)).count() == 0


def test_hashes_do_not_swell_the_plan(spark):
    df = spark.createDataFrame([(1, ["ab", "cd"]), (2, ["q"]), (3, [])], "id long, p array<string>")
    made = entity.minhashes(df, F.col("p"), 100, 2, "h")
    size = lambda df: len(df._jdf.queryExecution().analyzed().toJSON())
    assert size(made) < 2 * size(entity.minhashes(df, F.col("p"), 2, 2, "h"))
    seeded = df.withColumn("s", F.transform("p", lambda p: F.xxhash64(p, F.lit(2))))
    each = seeded.select("id", "p", F.array(*[F.array_min(F.transform("s", lambda h: F.xxhash64(h, F.lit(k)))) for k in range(100)]).alias("h"))
    assert made.collect() == each.collect()
