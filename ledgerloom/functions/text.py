"""Column builders for text: each returns a Column and stays on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Honorific tokens dropped from names before comparison.
HONORIFICS = (
    "shri shrimati shrimathi smt smti sri srimati dr doctor prof professor adv advocate kumari kum kunwar kunwari sardar shrimatiji "
    "col colonel lt gen general capt captain maj major justice thiru thirumathi er mr mrs ms miss"
).split()

# Words too common to be searched for.
STOPWORDS = (
    "a an and are as at be been by for from has have in into is it its of on or that the their there these this to was were will with not no any all"
).split()

NOT_STATED = "not stated"


def strip(c: Column) -> Column:
    """Without surrounding white space of any kind (no-break space and tab included)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Stripped, with inner runs of white space made one space."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def present(c: Column) -> Column:
    """The text, or null where it is null or blank."""
    return F.nullif(strip(c), F.lit(""))


def stated(c: Column, default: str = NOT_STATED) -> Column:
    """The stripped text, or the sentinel where it is null or blank."""
    return F.coalesce(present(c), F.lit(default))


def is_missing(c: Column) -> Column:
    """True for null, blank and the sentinel in any case."""
    return F.coalesce(F.lower(strip(c)).isin("", NOT_STATED), F.lit(True))


def slug(c: Column, default: str = "not-stated") -> Column:
    """Lower case with every run outside a-z0-9 made one hyphen, without hyphens at the ends; null or empty: ``default``."""
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def fold_key(c: Column) -> Column:
    """The slug with a closing plural s taken off every token of four letters or more."""
    parts = F.transform(
        F.split(slug(c), "-"),
        lambda t: F.when((F.length(t) >= 4) & t.endswith("s"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t),
    )
    return F.array_join(parts, "-")


def name_key(c: Column) -> Column:
    """Lower case, stripped, one space between words."""
    return F.lower(collapse(c))


def canon_tokens(c: Column, honorifics: list[str] = HONORIFICS) -> Column:
    """Lower-case ASCII letter and digit runs of a name, in order, without honorifics."""
    words = F.split(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), " ")
    return F.filter(words, lambda t: (t != "") & ~t.isin(*honorifics))


def canon(c: Column, honorifics: list[str] = HONORIFICS) -> Column:
    """The canonical form of a name: its canon tokens joined by one space; token order is kept."""
    return F.array_join(canon_tokens(c, honorifics), " ")


def canon_sorted(c: Column, honorifics: list[str] = HONORIFICS) -> Column:
    """As ``canon`` with the tokens sorted, so word order does not matter."""
    return F.array_join(F.array_sort(canon_tokens(c, honorifics)), " ")


def token_set(c: Column, honorifics: list[str] = HONORIFICS) -> Column:
    """The sorted distinct canon tokens."""
    return F.array_sort(F.array_distinct(canon_tokens(c, honorifics)))


def search_tokens(c: Column, stopwords: list[str] = STOPWORDS, least: int = 3) -> Column:
    """Distinct lower-case letter and digit runs of ``least`` characters or more that are no stopwords."""
    words = F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda t: (F.length(t) >= least) & ~t.isin(*stopwords)))


def partition_key(c: Column, default: str = "not-stated") -> Column:
    """A file-name-safe key: letters, digits, ``-_.`` kept, other runs one hyphen, hyphen runs collapsed, ends trimmed."""
    s = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9\-_.]+", "-"), "-+", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def normal_key(name: str) -> str:
    """A field name with only its letters and digits, in lower case."""
    return "".join(ch for ch in name.lower() if ch.isalnum())


def id_prefix(c: Column, sep: str = "/") -> Column:
    """All of an id up to its last separator, or '' without one."""
    return F.regexp_extract(c, rf"^(.*){sep}[^{sep}]*$", 1)


def id_tail(c: Column, sep: str = "/") -> Column:
    """The part of an id after its last separator."""
    return F.substring_index(c, sep, -1)
