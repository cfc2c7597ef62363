"""Subject search: an inverted index, its codecs, a conjunctive planner and keyset pages.

Documents are numbered by an explicit total order, never by arrival in a partition. The query string is parsed on the driver; all
else stays in DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import STOPWORDS, id_prefix, id_tail, search_tokens

PAGE = 25


@dataclass(frozen=True)
class Query:
    """The words to search in typed order, and those ignored with the reason; blank if nothing was typed."""

    words: tuple[str, ...]
    ignored: tuple[tuple[str, str], ...]
    blank: bool


def parse_query(text: str | None, least: int = 3) -> Query:
    """Letter and digit runs, lower case; short words and stopwords are ignored and named with their reason."""
    runs, run = [], ""
    for ch in (text or "").lower() + " ":
        if ch.isalnum():
            run += ch
        elif run:
            runs.append(run)
            run = ""
    words, ignored = [], []
    for w in runs:
        if len(w) < least:
            ignored.append((w, "too short"))
        elif w in STOPWORDS:
            ignored.append((w, "too common"))
        elif w not in words:
            words.append(w)
    return Query(tuple(words), tuple(ignored), not (text or "").strip())


def terms(questions: DataFrame, subject: str = "subject") -> DataFrame:
    """The postings as rows: term, question_id. Each term of a subject once."""
    return questions.select("question_id", F.explode(search_tokens(F.col(subject))).alias("term")).select("term", "question_id").distinct()


def positions(questions: DataFrame) -> DataFrame:
    """question_id, position (from 0 by id), prefix and number of each document.

    The count by prefix and a window within each prefix number all documents without one global sort task.
    """
    rows = questions.select("question_id").distinct().select("question_id", id_prefix(F.col("question_id")).alias("prefix"), id_tail(F.col("question_id")).alias("number"))
    sizes = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("prefix", F.coalesce(before, F.lit(0)).alias("start"))
    inner = F.row_number().over(Window.partitionBy("prefix").orderBy("question_id")) - 1
    return rows.withColumn("__at", inner).join(starts, "prefix").select("question_id", (F.col("start") + F.col("__at")).alias("position"), "prefix", "number")


def prefix_dictionary(placed: DataFrame) -> DataFrame:
    """Prefix, place (by first position), documents."""
    sizes = placed.groupBy("prefix").agg(F.min("position").alias("__first"), F.count(F.lit(1)).alias("documents"))
    return sizes.select("prefix", (F.row_number().over(Window.orderBy("__first")) - 1).alias("place"), "documents")


def postings(term_rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Term and its ascending positions, one row a term."""
    return term_rows.join(placed, "question_id").groupBy("term").agg(F.array_sort(F.collect_list("position")).alias("postings"))


def delta(c: Column) -> Column:
    """The first position, then the steps between neighbours."""
    return F.transform(c, lambda x, i: F.when(i == 0, x).otherwise(x - F.element_at(c, F.when(i == 0, 1).otherwise(i))))


def decoded(rows: DataFrame, steps: str = "steps") -> DataFrame:
    """Term and position of every posting, from rows (term, block, ``steps``): a running sum over the steps of a block, linear in their number."""
    each = rows.select("term", "block", F.posexplode(steps).alias("at", "step"))
    order = Window.partitionBy("term", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return each.select("term", F.sum("step").over(order).alias("position"))


#: Documents whose positions one block of a posting list covers.
BLOCK = 65_536


def blocked_postings(term_rows: DataFrame, placed: DataFrame, width: int = BLOCK) -> DataFrame:
    """Term, block and steps: the positions of a term in a block of ``width`` documents, the first from 0, then the steps.

    However many documents a term is in, no row holds more than ``width`` of them. Each block decodes by itself.
    """
    at = term_rows.join(placed.select("question_id", "position"), "question_id").select("term", F.floor(F.col("position") / width).alias("block"), "position")
    listed = at.groupBy("term", "block").agg(F.array_sort(F.collect_list("position")).alias("postings"))
    return listed.select("term", "block", delta(F.col("postings")).alias("steps"))


def write_index(rows: DataFrame, placed: DataFrame, path: str) -> None:
    """The blocked postings and the positions, as columnar tables sorted by what they are sought by, so that a reader skips the rest."""
    rows.repartitionByRange("term").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/postings")
    placed.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(f"{path}/positions")


def indexed_matches(spark: SparkSession, path: str, query: Query) -> DataFrame:
    """question_id of the documents that have all words, from a written index; only the words' own postings are read."""
    words = list(query.words)
    rows = spark.read.parquet(f"{path}/postings").where(F.col("term").isin(*words) if words else F.lit(False))
    hits = decoded(rows).groupBy("position").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(words)).select("position")
    return hits.join(spark.read.parquet(f"{path}/positions").select("position", "question_id"), "position").select("question_id")


def index_stats(term_rows: DataFrame, questions: DataFrame) -> DataFrame:
    """Terms, postings, documents."""
    return term_rows.agg(F.countDistinct("term").alias("terms"), F.count(F.lit(1)).alias("postings")).join(F.broadcast(questions.agg(F.countDistinct("question_id").alias("documents"))))


def lookup(term_rows: DataFrame, word: str) -> DataFrame:
    """The documents of one exact term, in any case."""
    return term_rows.where(F.col("term") == word.lower()).select("question_id")


def matches(term_rows: DataFrame, query: Query) -> DataFrame:
    """question_id of the documents that have all words; none for an empty query or an unknown word."""
    if not query.words:
        return term_rows.select("question_id").limit(0)
    hits = term_rows.where(F.col("term").isin(*query.words)).groupBy("question_id").agg(F.countDistinct("term").alias("n"))
    return hits.where(F.col("n") == len(query.words)).select("question_id")


def missing_words(term_rows: DataFrame, query: Query) -> DataFrame:
    """The words of the query that no document has."""
    spark = term_rows.sparkSession
    words = spark.createDataFrame([(w,) for w in query.words], "term string")
    known = term_rows.where(F.col("term").isin(*query.words) if query.words else F.lit(False)).select("term").distinct()
    return words.join(known, "term", "left_anti")


def session_buckets(found: DataFrame, questions: DataFrame) -> DataFrame:
    """Hits by session, for the plan of which sessions to read: session, hits."""
    return found.join(questions.select("question_id", "session"), "question_id").groupBy("session").agg(F.count(F.lit(1)).alias("hits"))


def sort_key(df: DataFrame) -> DataFrame:
    """``df`` with __key, ascending in result order: newest session, newest date (others last), number (others last), id."""
    part = lambda c, i: F.split_part(F.coalesce(F.col(c), F.lit("")), F.lit("/"), F.lit(i)).try_cast("int")
    good = F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$")
    day = F.when(good, F.regexp_replace("date", "-", "").cast("int")).otherwise(F.lit(-1))
    number = id_tail(F.col("question_id")).try_cast("int")
    top = F.lit(2147483647)
    return df.withColumn(
        "__key", F.struct((-F.coalesce(part("session", 2), F.lit(-1))).alias("t"), (-F.coalesce(part("session", 3), F.lit(-1))).alias("s"), (-F.coalesce(day, F.lit(-1))).alias("d"), F.coalesce(number, top).alias("n"), F.col("question_id").alias("i"))
    )


def page(found: DataFrame, digest: DataFrame, after: tuple | None = None, size: int = PAGE) -> DataFrame:
    """The next ``size`` hits after a key, with their digest row; ids that have none are kept and marked not_in_digest.

    ``after`` is the (t, s, d, n, i) of the last row seen. A key filter and a limit, so no earlier page is sorted again in full.
    """
    joined = found.select("question_id").join(digest.withColumn("__in", F.lit(True)), "question_id", "left")
    keyed = sort_key(joined.withColumn("not_in_digest", F.col("__in").isNull()).drop("__in"))
    if after is not None:
        t, s, d, n, i = after
        last = F.struct(F.lit(t).alias("t"), F.lit(s).alias("s"), F.lit(d).alias("d"), F.lit(n).alias("n"), F.lit(i).alias("i"))
        keyed = keyed.where(F.col("__key") > last)
    return keyed.orderBy("__key").limit(size)


def digest(questions: DataFrame) -> DataFrame:
    """The narrow copy a result list needs."""
    return questions.select("question_id", "session", "date", "subject", "ministry_id", "asking_members")


def askers(question_rows: DataFrame, names: DataFrame) -> DataFrame:
    """question_id, at, member_id, canonical_name (null for an unknown id), in order of mention."""
    each = question_rows.select("question_id", F.posexplode("asking_members").alias("at", "member_id"))
    return each.join(names.select("member_id", "canonical_name"), "member_id", "left")


def unknown_askers(question_rows: DataFrame, names: DataFrame) -> DataFrame:
    """Asker ids no name row has, with the questions that cite them; publishing refuses if there is any."""
    each = question_rows.select("question_id", F.explode("asking_members").alias("member_id"))
    return each.join(names.select("member_id"), "member_id", "left_anti").groupBy("member_id").agg(F.count(F.lit(1)).alias("questions"))
