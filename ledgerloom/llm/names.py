"""Personal names as compared: folding on the JVM, token pairing in Python.

``folded`` turns a written name into its tokens, given names first: honorifics and quoted nicknames go, a comma or a
bracket swaps surname and given names, letters with marks become plain, digits typed for letters become letters, and
spellings of one sound become one (ee/i, oo/u, aa/a, au/o, w/v, h within a word). Null and blank names fold to an
empty list; letters outside Latin stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the plain letters they stand for, one for one.
MARKED = "āáàâäãåēéèêëīíìîïōóòôöõūúùûüñçśşšżźžṭḍṇṣḥ"
PLAIN = "aaaaaaaeeeeeiiiiioooooouuuuuncssszzztdnsh"

# Titles before or after a name.
TITLES = (
    "shri sri smt shrimati srimati shrimathi kumari km kum mr mrs ms miss dr prof professor adv advocate col colonel capt maj gen "
    "thiru tmt sushri hon honble er pt ji saheb sahib sh lt retd"
).split()


def sound(token: Column) -> Column:
    """One spelling for one sound."""
    t = F.translate(token, "w0135", "voies")
    for pattern, plain in (("ee", "i"), ("oo", "u"), ("au", "o"), ("ou", "u"), (r"(?<=.)h", ""), (r"(.)\1+", "$1")):
        t = F.regexp_replace(t, pattern, plain)
    return t


def written(c: Column) -> Column:
    """The tokens of a written name, given names before the surname where the writing says which is which, not yet by sound."""
    s = F.regexp_replace(c, r"(?<![\p{L}])(\p{Lu})(\p{Lu})(?![\p{L}])", "$1 $2")  # initials written together
    s = F.translate(F.lower(s), MARKED, PLAIN)
    s = F.regexp_replace(s, r",?\s*\bm\. ?p\.?\s*$|[-\s]ji\s*$", "")
    s = F.regexp_replace(s, "[\"“”„«»][^\"“”„«»]*[\"“”„«»]", " ")
    s = F.regexp_replace(s, r"\((?:retd|dr|prof|adv|mp)\.?\)", " ")
    s = F.regexp_replace(s, r"^\s*([^,(]+),\s*(.+)$", "$2 $1")
    s = F.regexp_replace(s, r"^\s*([^,(]+)\(\s*([^)]+)\)\s*$", "$2 $1")
    s = F.regexp_replace(s, r"(?<=\p{L})[-'’`](?=\p{L})", "")
    words = F.split(F.regexp_replace(s, r"[^\p{L}\p{M}\p{N}]+", " "), " ")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*TITLES))


def folded(c: Column) -> Column:
    """``written`` tokens, each by sound: as names are compared."""
    return F.filter(F.transform(written(c), sound), lambda w: w != "")


def key(tokens: Column) -> Column:
    """The tokens sorted and joined: equal for any order of the same tokens."""
    return F.array_join(F.array_sort(tokens), " ")


def grams(tokens: Column, n: int = 3) -> Column:
    """The distinct n-letter pieces of all tokens, each token marked at both ends; an initial gives one short piece."""
    marked = F.transform(tokens, lambda t: F.concat(F.lit("<"), t, F.lit(">")))
    cut = lambda m: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(m) - n + 1, F.lit(1))), lambda i: F.substring(m, i, F.lit(n))
    )
    return F.array_distinct(F.flatten(F.transform(marked, cut)))


def edits(a: str, b: str) -> int:
    """Edits between two tokens, a swap of neighbours being one."""
    if a == b:
        return 0
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


def token_likeness(a: str, b: str) -> float:
    """1 for equal tokens, less for a few edits, 0.6 for an initial of the other, else 0."""
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.6 if a[0] == b[0] else 0.0
    most = max(len(a), len(b))
    if abs(len(a) - len(b)) > 2:
        return 0.0
    d = edits(a, b) if a < b else edits(b, a)
    return 1 - d / most if d <= (1 if most <= 5 else 2) and d < most - 1 else 0.0


def pairing(a: list[str], b: list[str]) -> tuple[float, float, float, int, int]:
    """How two token lists pair off, best pairs first.

    Gives: mean likeness over the longer list's tokens, over the shorter list's, the least likeness of a pair, the number of
    initials used, and the tokens left over on both sides. Tokens written together are paired with the two they hold.
    """
    a, b = _unglue(a, b)
    scores = sorted(((token_likeness(x, y), -abs(i - j), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), reverse=True)
    used_a, used_b, total, least, initials = set(), set(), 0.0, 1.0, 0
    for s, _, i, j in scores:
        if s <= 0:
            break
        if i in used_a or j in used_b:
            continue
        used_a.add(i)
        used_b.add(j)
        total += s
        least = min(least, s)
        initials += len(a[i]) == 1 or len(b[j]) == 1
    if not used_a:
        return 0.0, 0.0, 0.0, 0, len(a) + len(b)
    return total / max(len(a), len(b)), total / min(len(a), len(b)), least, initials, len(a) + len(b) - 2 * len(used_a)


def _unglue(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """Two neighbouring tokens of one side joined where the other side has them as one."""
    for _ in range(2):
        for i in range(len(b) - 1):
            one = b[i] + b[i + 1]
            if len(b[i]) > 1 and len(b[i + 1]) > 1 and any(len(x) > 4 and x != b[i] and token_likeness(x, one) >= 0.8 for x in a):
                b = [*b[:i], one, *b[i + 2 :]]
                break
        a, b = b, a
    return a, b
