"""Column builders for what a reader is shown: figures, dates, labels, and ids taken apart (P25, P26, P28, Q16, T15). All stay on the JVM.

Where a value is missing or has not the form asked for, the text is "not stated"; nothing is guessed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import NOT_STATED, is_missing, present

# Month names as shown.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _finite(c: Column) -> Column:
    x = c.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def count(c: Column) -> Column:
    """A rounded number in Indian grouping: the last three digits, then pairs."""
    whole = F.floor(c.cast("double") + 0.5).cast("bigint").cast("string")
    return F.when(_finite(c), F.regexp_replace(whole, r"(\d)(?=(?:\d\d)+\d$)", "$1,")).otherwise(NOT_STATED)


def percent(c: Column, decimals: int = 2) -> Column:
    """A rate as a percentage."""
    return F.when(_finite(c), F.format_string(f"%.{decimals}f%%", c.cast("double") * 100)).otherwise(NOT_STATED)


def day(c: Column) -> Column:
    """YYYY-MM-DD as ``21 Jun 2019``, by form alone."""
    part = lambda i: F.regexp_extract(F.trim(c), r"^(\d{4})-(\d{2})-(\d{2})$", i)
    month = F.get(F.array(*[F.lit(m) for m in MONTHS]), part(2).try_cast("int") - 1)
    made = F.concat_ws(" ", part(3).try_cast("int").cast("string"), month, part(1))
    return F.when(month.isNotNull() & (part(1) != ""), made).otherwise(NOT_STATED)


def ordinal(c: Column) -> Column:
    """17 as 17th."""
    ending = F.when((c % 100).between(11, 13), "th").when(c % 10 == 1, "st").when(c % 10 == 2, "nd").when(c % 10 == 3, "rd").otherwise("th")
    return F.when(c.isNotNull(), F.concat(c.cast("string"), ending)).otherwise(NOT_STATED)


def house_name(c: Column) -> Column:
    """A house's slug with each part capitalised."""
    titled = F.transform(F.split(c, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p))))
    return F.when(is_missing(c), NOT_STATED).otherwise(F.array_join(titled, " "))


def session_parts(c: Column) -> Column:
    """House, term and number of a session id; null unless it has three parts, the last two whole numbers."""
    p = F.split(c, "/")
    term, number = F.get(p, F.lit(1)).try_cast("int"), F.get(p, F.lit(2)).try_cast("int")
    return F.when((F.size(p) == 3) & term.isNotNull() & number.isNotNull(), F.struct(F.get(p, F.lit(0)).alias("house"), term.alias("term"), number.alias("number")))


def question_parts(c: Column) -> Column:
    """House, term, session, session_id, type and number of a question id; null unless it has five parts with a numeric term and session.

    A question number that is no whole number is null; the rest still stands.
    """
    p = F.split(c, "/")
    at = lambda i: F.get(p, F.lit(i))
    term, session = at(1).try_cast("int"), at(2).try_cast("int")
    made = F.struct(at(0).alias("house"), term.alias("term"), session.alias("session"), F.concat_ws("/", at(0), at(1), at(2)).alias("session_id"), at(3).alias("type"), at(4).try_cast("int").alias("number"))
    return F.when((F.size(p) == 5) & term.isNotNull() & session.isNotNull(), made)


def session_file_name(c: Column, ending: str = ".jsonl") -> Column:
    """P25: the file of a session or question id: its first three parts joined by hyphens; fewer parts raise."""
    p = F.split(c, "/")
    return F.when(F.size(p) >= 3, F.concat(F.concat_ws("-", F.slice(p, 1, 3)), F.lit(ending))).when(c.isNull(), None).otherwise(F.raise_error(F.concat(F.lit("no session in the id: "), c)))


def session_label(c: Column) -> Column:
    """``17th LS · Session 4``; an id of another form as it is."""
    p = session_parts(c)
    return F.when(p.isNotNull(), F.concat(ordinal(p["term"]), F.lit(" LS · Session "), p["number"].cast("string"))).otherwise(F.coalesce(present(c), F.lit(NOT_STATED)))


def long_session_label(c: Column) -> Column:
    """``17th Lok Sabha · Session 4``; an id of another form as it is."""
    p = session_parts(c)
    return F.when(p.isNotNull(), F.concat(ordinal(p["term"]), F.lit(" "), house_name(p["house"]), F.lit(" · Session "), p["number"].cast("string"))).otherwise(F.coalesce(c, F.lit("")))


def listed(c: Column) -> Column:
    """The texts of an array with commas, the last after ``and``; '' for an empty one."""
    n = F.size(c)
    return F.when(n == 0, "").when(n == 1, F.get(c, F.lit(0))).otherwise(F.concat(F.array_join(F.slice(c, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.get(c, n - 1)))


def terms_phrase(c: Column, house: str = "Lok Sabha") -> Column:
    """[17, 18] as ``17th and 18th Lok Sabha``; nulls inside do not count."""
    own = F.filter(c, lambda t: t.isNotNull())
    return F.when(F.coalesce(F.size(own), F.lit(0)) < 1, NOT_STATED).otherwise(F.concat(listed(F.transform(own, ordinal)), F.lit(f" {house}")))


def https_only(c: Column) -> Column:
    """The address if it is one by https, else null."""
    return F.when(c.startswith("https://"), c)
