"""Written names linked to stable identities: a cascade of tiers, human overrides, statuses and an audit trail.

Each distinct (scope, form) is matched once, never once per question. A tier is an equi-join on (scope, key); the first tier with
any candidate decides. One candidate resolves, several are ambiguous, none is unresolved; ties are never broken by guess.
Null and blank forms are dropped before matching; empty tables give empty results.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.text import canon, canon_sorted, present, token_set
from ledgerloom.session import staged

#: Least similarity of the approximate tier, and the margin within which runners-up count.
RATIO, MARGIN = 0.90, 0.02
TIERS = ("exact", "normalised", "normalised-reordered", "approximate", "token-containment")


def distinct_forms(forms: DataFrame) -> DataFrame:
    """Each (scope, form) once with its keys: scope, form, normalised, reordered, tokens."""
    f = F.col("form")
    return (
        forms.select("scope", present(f).alias("form"))
        .where("form is not null")
        .distinct()
        .select("scope", "form", canon(f).alias("normalised"), canon_sorted(f).alias("reordered"), token_set(f).alias("tokens"))
    )


def pool_keys(pool: DataFrame) -> DataFrame:
    """Each written variant of each member with its keys: scope, member_id, written, normalised, reordered, tokens."""
    w = F.col("written")
    return (
        pool.select("scope", "member_id", present(w).alias("written"))
        .where("written is not null and member_id is not null")
        .distinct()
        .select("scope", "member_id", "written", canon(w).alias("normalised"), canon_sorted(w).alias("reordered"), token_set(w).alias("tokens"))
    )


def _ids(df: DataFrame) -> DataFrame:
    return df.groupBy("scope", "form").agg(F.array_sort(F.collect_set("member_id")).alias("candidates"))


def key_tier(forms: DataFrame, pool: DataFrame, form_key: str, pool_key: str) -> DataFrame:
    """Scope, form, candidates (sorted ids) of forms whose key is in the pool; empty keys match nothing."""
    side = pool.where(F.col(pool_key) != "").select("scope", F.col(pool_key).alias("__key"), "member_id").distinct()
    return _ids(forms.select("scope", "form", F.col(form_key).alias("__key")).join(side, ["scope", "__key"]))


def containment_tier(forms: DataFrame, pool: DataFrame) -> DataFrame:
    """Scope, form, candidates whose token set strictly holds, or is strictly held by, the form's.

    The smaller set of such a pair lies wholly in the larger, its rarest token too; so each set offers only its rarest token, and is
    sought by all its tokens, once from either side. A common token brings together only sets that have nothing rarer.
    """
    a = forms.where(F.size("tokens") > 0).select("scope", "tokens").distinct()
    b = pool.where(F.size("tokens") > 0).select("scope", "tokens").distinct()
    each = a.unionByName(b).distinct().select("scope", F.explode("tokens").alias("token"))
    rarity = staged(each.groupBy("scope", "token").agg(F.count(F.lit(1)).alias("n")), "resolve-rarity")

    def spread(df: DataFrame, name: str) -> DataFrame:
        return df.select("scope", F.col("tokens").alias(name), F.explode("tokens").alias("token"))

    def rarest(df: DataFrame, name: str) -> DataFrame:
        placed = spread(df, name).join(rarity, ["scope", "token"])
        return placed.groupBy("scope", name).agg(F.min_by("token", F.struct("n", "token")).alias("token"))

    held = spread(a, "ta").join(rarest(b, "tb"), ["scope", "token"])
    holds = rarest(a, "ta").join(spread(b, "tb"), ["scope", "token"])
    met = held.select("scope", "ta", "tb").unionByName(holds.select("scope", "ta", "tb")).distinct()
    within = lambda x, y: F.size(F.array_except(x, y)) == 0
    strict = met.where((F.size("ta") != F.size("tb")) & (within("ta", "tb") | within("tb", "ta")))
    ids = pool.select("scope", F.col("tokens").alias("tb"), "member_id").distinct()
    named = strict.join(ids, ["scope", "tb"]).select("scope", F.col("ta").alias("tokens"), "member_id")
    return _ids(forms.select("scope", "form", "tokens").join(named, ["scope", "tokens"]))


@F.pandas_udf(T.DoubleType())
def _ratio(candidate: pd.Series, written: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; it is not symmetric: the written form is the second sequence."""
    matcher, last, out = difflib.SequenceMatcher(None), None, []
    for c, w in zip(candidate, written, strict=True):
        if w != last:
            matcher.set_seq2(w)
            last = w
        matcher.set_seq1(c)
        out.append(matcher.ratio() if matcher.real_quick_ratio() >= RATIO and matcher.quick_ratio() >= RATIO else 0.0)
    return pd.Series(out, dtype="float64")


#: As if it were not deterministic: else the filter on the score has it run a second time.
_ratio = _ratio.asNondeterministic()


def near_keys(forms: DataFrame, pool: DataFrame, least: float = RATIO) -> DataFrame:
    """Scope, normalised (of the form), key (of the pool) and score of all pairs with ratio ``least`` or more.

    Lossless blocking: a ratio of r over lengths m and n leaves at most (1 - r)(m + n) letters unmatched. A pool key cut into
    one more piece than that has a piece that stands whole in the form, moved by no more than that many letters; pieces meet in an equi-join.
    """
    share = 1 - least
    most = least / (2 - least)  # the shorter length is at least this part of the longer
    errors = lambda n: F.floor(F.lit(share) * (n + F.floor(n / F.lit(most) + 1e-9)) + 1e-9).cast("int")
    keys = pool.where("normalised <> ''").select("scope", F.col("normalised").alias("key")).distinct()
    cut = keys.withColumn("m", F.length("key")).withColumn("parts", F.least(errors(F.col("m")) + 1, F.col("m")))
    start = lambda i: F.floor(i * F.col("m") / F.col("parts")).cast("int")
    pieces = cut.select("scope", "key", "m", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    pieces = pieces.select("scope", "key", "m", "i", F.substring("key", start(F.col("i")) + 1, start(F.col("i") + 1) - start(F.col("i"))).alias("piece"))
    # A number of tasks of its own: adaptive execution would give all forms to one, and each is cut into hundreds of pieces.
    tasks = max(2 * forms.sparkSession.sparkContext.defaultParallelism, int(forms.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    written = forms.where("normalised <> ''").select("scope", "normalised").repartition(tasks, "scope", "normalised").distinct().withColumn("n", F.length("normalised"))
    lengths = F.sequence(F.greatest(F.ceil(F.col("n") * most - 1e-9).cast("int"), F.lit(1)), F.floor(F.col("n") / most + 1e-9).cast("int"))
    sought = written.select("scope", "normalised", "n", F.explode(lengths).alias("m")).withColumn("parts", F.least(errors(F.col("m")) + 1, F.col("m")))
    sought = sought.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("at", start(F.col("i"))).withColumn("size", start(F.col("i") + 1) - start(F.col("i")))
    low, high = F.greatest(F.col("at") - F.col("parts"), F.lit(0)), F.least(F.col("at") + F.col("parts"), F.col("n") - F.col("size"))
    places = F.when(high >= low, F.sequence(low, high))
    cut_out = F.array_distinct(F.transform(places, lambda p: F.substring(F.col("normalised"), p + 1, F.col("size"))))
    sought = sought.select("scope", "normalised", "m", "i", F.explode(cut_out).alias("piece"))
    # Never broadcast: the planner takes either side for as small as the keys, but a key has pieces by the hundred.
    pairs = sought.hint("merge").join(pieces, ["scope", "m", "i", "piece"]).select("scope", "normalised", "key").distinct()
    # What is matched stands in order on both sides, so no such pair is more edits apart than it has letters unmatched: told on the JVM first.
    apart = F.floor(F.lit(share) * (F.length("key") + F.length("normalised")) + 1e-9)
    scored = pairs.where(F.levenshtein("key", "normalised") <= apart).withColumn("score", _ratio("key", "normalised"))
    return scored.where(F.col("score") >= least)


def approximate_tier(forms: DataFrame, pool: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Scope, form, candidates, score.

    The best key (highest score, then greatest key) gives its members; if a key with other members scores within the margin of
    it, all members within the margin are candidates.
    """
    near = near_keys(forms, pool)
    members = pool.where("normalised <> ''").groupBy("scope", F.col("normalised").alias("key")).agg(F.array_sort(F.collect_set("member_id")).alias("ids"))
    # Each form's keys in one list, so that pairs are sought and scored once.
    listed = near.join(members, ["scope", "key"]).groupBy("scope", "normalised").agg(F.collect_list(F.struct("score", "key", "ids")).alias("near"))
    listed = listed.withColumn("best", F.array_max("near"))
    decided = listed.select(
        "scope",
        "normalised",
        "best",
        F.array_max(F.transform(F.filter("near", lambda x: x["ids"] != F.col("best.ids")), lambda x: x["score"])).alias("runner_up"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("near", lambda x: x["score"] >= F.col("best.score") - margin), lambda x: x["ids"])))).alias("tied"),
    )
    close = (F.size("best.ids") == 1) & F.coalesce((F.col("best.score") - F.col("runner_up")) < margin, F.lit(False))
    out = decided.select("scope", "normalised", F.when(close, F.col("tied")).otherwise(F.col("best.ids")).alias("candidates"), F.col("best.score").alias("score"))
    return forms.select("scope", "form", "normalised").join(out, ["scope", "normalised"]).select("scope", "form", "candidates", "score")


def verdict(candidates: Column) -> Column:
    """Resolved for one candidate, ambiguous for several, unresolved for none."""
    return F.when(F.size(candidates) == 1, "resolved").when(F.size(candidates) > 1, "ambiguous").otherwise("unresolved")


def first_keys(forms: DataFrame, pool: DataFrame) -> DataFrame:
    """J01-J03 at once: every form with its tokens, and candidates, method and score by the first of the three keys that is in the pool (null without one).

    All keys meet the pool in one join; a form's rows come together once.
    """
    keys = lambda df, *names: df.select(*df.columns, F.posexplode(F.array(*names)).alias("__tier", "__key"))
    side = keys(pool, "written", "normalised", "reordered").where("__key <> ''").select("scope", "__tier", "__key", "member_id").distinct()
    met = keys(forms, "form", "normalised", "reordered").join(side, ["scope", "__tier", "__key"], "left")
    hit = F.when(F.col("member_id").isNotNull(), F.struct(F.col("__tier").alias("tier"), "member_id"))
    each = met.groupBy("scope", "form").agg(F.first("normalised").alias("normalised"), F.first("tokens").alias("tokens"), F.array_sort(F.collect_set(hit)).alias("hits"))
    first = F.try_element_at("hits", F.lit(1))["tier"]
    candidates = F.transform(F.filter("hits", lambda x: x["tier"] == first), lambda x: x["member_id"])
    return each.select(
        "scope", "form", "normalised", "tokens", F.when(first.isNotNull(), candidates).alias("candidates"), F.get(F.array(*[F.lit(t) for t in TIERS[:3]]), first).alias("method"), F.when(first.isNotNull(), 1.0).otherwise(0.0).alias("score"),
    )


def cascade(forms: DataFrame, pool: DataFrame, approximate: bool = True, containment: bool = True) -> DataFrame:
    """Scope, form, status, method, member_id, candidates, score of each distinct form.

    ``forms`` is a result of ``distinct_forms``, ``pool`` of ``pool_keys``. Tiers run in order on what is still unmatched; containment
    may only turn a form that is not resolved into a resolved one.

    Each step is staged for the next and carries what that needs, so no plan holds an earlier tier's: the driver plans anew after every stage.
    """
    none = F.array().cast("array<string>")
    pool = staged(pool, "resolve-pool")  # read once, however many tiers look at it
    out = staged(first_keys(forms, pool), "resolve-keys")
    if approximate:
        near = approximate_tier(out.where("candidates is null"), pool).select("scope", "form", F.col("candidates").alias("__near"), F.col("score").alias("__score"))
        kept = out.join(near, ["scope", "form"], "left")
        method = F.when(F.col("__near").isNotNull(), TIERS[3]).otherwise(F.col("method"))
        out = staged(kept.select("scope", "form", "tokens", F.coalesce("__near", "candidates").alias("candidates"), method.alias("method"), F.coalesce("__score", "score").alias("score")), "resolve-near")
    out = out.withColumn("candidates", F.coalesce("candidates", none)).withColumn("status", verdict(F.col("candidates")))
    if containment:
        open_forms = out.where("status <> 'resolved'").select("scope", "form", "tokens")
        held = containment_tier(open_forms, pool).where(F.size("candidates") == 1).select("scope", "form", F.col("candidates").alias("__held"))
        out = out.join(held, ["scope", "form"], "left")
        up = F.col("__held").isNotNull()
        out = out.select(
            "scope",
            "form",
            F.coalesce("__held", "candidates").alias("candidates"),
            F.when(up, TIERS[4]).otherwise(F.col("method")).alias("method"),
            F.when(up, 1.0).otherwise(F.col("score")).alias("score"),
            F.when(up, "resolved").otherwise(F.col("status")).alias("status"),
        )
    one = F.when(F.col("status") == "resolved", F.element_at("candidates", 1))
    shown = F.when(F.col("status") == "ambiguous", F.col("candidates")).otherwise(none)
    return out.select("scope", "form", "status", "method", one.alias("member_id"), shown.alias("candidates"), "score")


def told_apart(outcomes: DataFrame, members: DataFrame, attributes: list[str]) -> DataFrame:
    """Scope, form and the sorted attributes on which the candidates of an ambiguous form differ from the first one."""
    each = outcomes.where("status = 'ambiguous'").select("scope", "form", F.posexplode("candidates").alias("at", "member_id")).join(members.select("member_id", *attributes), "member_id")
    first = each.where("at = 0").select("scope", "form", *[F.col(a).alias(f"__{a}") for a in attributes])
    both = each.where("at > 0").join(first, ["scope", "form"])
    names = F.array_compact(F.array(*[F.when(~F.col(a).eqNullSafe(F.col(f"__{a}")), F.lit(a)) for a in sorted(attributes)]))
    return both.groupBy("scope", "form").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(names)))).alias("distinguished_on"))


def overlay(outcomes: DataFrame, assertions: DataFrame) -> DataFrame:
    """Outcomes with each asserted form's member put in, whatever the tiers said; adds asserted_by.

    ``assertions`` has form and member_id, one row a form (see ``assertion_conflicts``).
    """
    said = assertions.select(F.col("form"), F.col("member_id").alias("__said")).where("__said is not null")
    joined = outcomes.join(said, "form", "left")
    by = F.col("__said").isNotNull()
    return joined.select(
        "scope",
        "form",
        F.when(by, "resolved").otherwise(F.col("status")).alias("status"),
        F.when(by, "manual-assertion").otherwise(F.col("method")).alias("method"),
        F.coalesce("__said", "member_id").alias("member_id"),
        F.when(by, F.array().cast("array<string>")).otherwise(F.col("candidates")).alias("candidates"),
        F.when(by, 1.0).otherwise(F.col("score")).alias("score"),
        F.when(by, "maintainer").otherwise("automatic").alias("asserted_by"),
    )


def assertion_conflicts(assertions: DataFrame) -> DataFrame:
    """Forms asserted for more than one member; the caller refuses if there is any."""
    return assertions.groupBy("form").agg(F.countDistinct("member_id").alias("members")).where("members > 1")


def overrides(outcomes: DataFrame, assertions: DataFrame) -> DataFrame:
    """Forms whose assertion names another member than the tiers resolved: scope, form, automatic, asserted."""
    said = assertions.select("form", F.col("member_id").alias("asserted"))
    return outcomes.where("status = 'resolved'").join(said, "form").where("member_id <> asserted").select("scope", "form", F.col("member_id").alias("automatic"), "asserted")


def question_status(bridge: DataFrame, outcomes: DataFrame) -> DataFrame:
    """question_id, resolution_status, asking_members of questions from their forms.

    ``bridge`` has question_id, scope, at and form (null for a question without askers). All askers must resolve; any
    unresolved one makes it unresolved, else any ambiguous one ambiguous. Members are the resolved ones in order of first mention,
    without repeats, and none where the question is ambiguous.
    """
    joined = bridge.join(outcomes.select("scope", "form", "status", "member_id"), ["scope", "form"], "left")
    per = joined.groupBy("question_id").agg(
        F.count("form").alias("forms"),
        F.coalesce(F.bool_or((F.coalesce("status", F.lit("unresolved")) == "unresolved") & F.col("form").isNotNull()), F.lit(False)).alias("open"),
        F.coalesce(F.bool_or(F.col("status") == "ambiguous"), F.lit(False)).alias("several"),
        F.array_sort(F.collect_list(F.when(F.col("status") == "resolved", F.struct("at", "member_id")))).alias("found"),
    )
    status = F.when((F.col("forms") == 0) | F.col("open"), "unresolved").when(F.col("several"), "ambiguous").otherwise("resolved")
    members = F.array_distinct(F.transform("found", lambda x: x["member_id"]))
    none = F.array().cast("array<string>")
    return per.select("question_id", status.alias("resolution_status"), F.when(status == "ambiguous", none).otherwise(members).alias("asking_members"))


def rates(automatic: DataFrame, assisted: DataFrame) -> DataFrame:
    """resolved_automatic, resolved_assisted, total and both ratios, counted per question; 0 over none."""
    a = automatic.agg(F.count_if(F.col("resolution_status") == "resolved").alias("resolved_automatic"), F.count(F.lit(1)).alias("total"))
    b = assisted.agg(F.count_if(F.col("resolution_status") == "resolved").alias("resolved_assisted"))
    ratio = lambda c: F.coalesce(F.round(F.try_divide(F.col(c), F.col("total")), 6), F.lit(0.0))
    return a.join(F.broadcast(b)).select(
        "resolved_automatic", "resolved_assisted", "total", ratio("resolved_automatic").alias("automatic_rate"), ratio("resolved_assisted").alias("assisted_rate")
    )


def audit(outcomes: DataFrame, mentions: DataFrame) -> DataFrame:
    """Q06: one row a (scope, form): name_as_written, member_id, status, method, candidates, source_record_ref, asserted_by.

    ``mentions`` has scope, form, seq and ref; the ref is that of the first mention by seq.
    """
    first = mentions.groupBy("scope", "form").agg(F.min_by("ref", F.struct("seq", "ref")).alias("source_record_ref"))
    return outcomes.join(first, ["scope", "form"]).select(
        "scope", F.col("form").alias("name_as_written"), "member_id", "status", "method", "candidates", "source_record_ref", "asserted_by"
    )


def best_per(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by an order that must be total."""
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__at = 1").drop("__at")
