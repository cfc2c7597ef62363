"""Personal information in free text: found by anchor expansion, replaced by typed placeholders.

One Aho-Corasick pass over a text finds anchors: at-signs and their disguises, country codes and opening digits of numbers,
words that announce phone and identity numbers, words and numbers that open a street address, titles and phrases that go with
names, and names the caller knows. At each anchor a local parser expands to the left or right as far as the writing goes (no window, no
most letters or tokens) and validates what it got: a mail host must have a dot, a number with a country code 8 to 15
digits, an account number in the international form its remainder, a bank card its check digit, an address a street word and a
town. Spans that overlap are settled by kind (email, address, id_number, phone, name), then the longer one.

Everything happens inside the row: no shuffle, texts are scanned whole, time is linear in their length: what one anchor walks over
is not walked over by the next.

Edge cases. Null, empty and blank texts have no findings and stay as they are. Very long texts are one row like any other.
Repeated rows give repeated rows in ``redact`` and one finding in ``find`` (equal stretches of one document count once).
Placeholders already in a text are ordinary text. An empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "address", "id_number", "phone", "name")

# Words and signs that anchor each kind, compared in lower case.
ANCHORS = {
    "email": ["@", "[at]", "(at)", "{at}", " at "],
    "phone": [
        "+", "00999", "००९९९", "(", " 0", "\n0", "\t0", "\r0", "\u00a00", ":0", "\"0", "'0", "“0", "‘0", "[0", "०",
        "tel", "phone", "ph.", "mob", "call ", "fax", "whatsapp", "दूरभाष",
    ],
    "id_number": [
        "citizen card", "citizen number", "citizen no", "tax card", "voter slip", "ration book", "क्रमांक", "identity", "id no",
        "passport", "licence", "license", "pension", "card no", "aadhaar", "aadhar", "ssn", "social security", "iban", "account", "a/c",
        "credit card", "debit card", "bank card", "pan no", "pan card", "pan:",
    ],
    "address": ["flat", "house no", "h. no", "h.no", "plot", "door no", "door", "home at", "address:", "resident of", "live at", "at ", "to ", "\n", ". "],
    "name": [
        "shri", "smt", "mr.", "ms.", "mrs.", "dr.", "prof.", "sri ", "kumari", "adv.", "col.", "thiru", "sushri", "signed:", "(sd/-)",
        "contact:", "petitioner:", "i, ", "asked by", "faithfully,", "sincerely,", "<", "श्री", "श्रीमती", "डॉ", "कुमारी", "திரு", "child of", "appeared before",
        "(", "reach ", "speak to ", "speak with ", "ask for ", "attn:", "attention:", "s/o ", "d/o ", "w/o ", "c/o ", "son of ", "daughter of ", "wife of ", "dear ", "regards,",
    ],
}

D = r"[0-9०-९]"
#: Read from the right to the left, as far as the letters go.
MAIL_LEFT = regex.compile(r"(?r)[\w.+-]*")
MAIL_RIGHT = regex.compile(r"@[\w-]+(?:\.[\w-]+)+")
#: Disguised: a word for the at-sign and, possibly, one for each dot.
SPELT_RIGHT = regex.compile(
    r"\s*(?:\[at\]|\(at\)|\{at\})\s*\w[\w-]*(?:(?:\s*(?:\[dot\]|\(dot\)|\{dot\})\s*|\.)\w[\w-]*)+|\s+at\s+\w[\w-]*(?:\s+dot\s+\w[\w-]*)+", regex.I
)
PHONE = regex.compile(
    rf"(?<![\w/.,–-])(?:(?:\+|00|००)(?:999|९९९)[ .-]?)?(?:\([0०]{D}{{3}}\)|[0०]{D}{{3}})[ .-]?{D}{{3}}[ .-]?{D}{{4}}"
    rf"(?:,?\s?(?:ext\.?|extn\.?|x\.?|extension)\s?{D}{{1,5}})?(?![\w/]|[.-]{D})",
    regex.I,
)
#: A number with its country code, of any country; one that a word for telephones announces; an area code in brackets.
EXTENSION = rf"(?:,?\s?(?:ext\.?|extn\.?|x\.?|extension)\s?{D}{{1,5}})?(?![\w/]|[.-]{D})"
ABROAD = regex.compile(rf"(?<![\w/.,–-])\(?\+(?P<n>{D}{{1,3}}\)?(?:[ .-]?(?:\({D}{{1,5}}\)|{D}{{1,12}})){{1,7}}){EXTENSION}", regex.I)
ANNOUNCED = regex.compile(rf"(?<![\w/.,–-])(?P<n>(?:\({D}{{2,5}}\)|{D}{{2,14}})(?:[ .-]?(?:\({D}{{1,5}}\)|{D}{{2,12}})){{0,6}}){EXTENSION}", regex.I)
BRACKETED = regex.compile(rf"\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}{EXTENSION}", regex.I)
#: What may stand between a word for telephones and the number.
CALLED = regex.compile(r"(?:ephone|ile)?(?:\s(?:no|number|num))?[.:]{0,2}\s{0,2}(?:(?:at|on)\s)?", regex.I)
CITIZEN = r"(?<![\w/])[0-9०-९]{4}(?:[ -]?)[0-9०-९]{4}(?:[ -]?)[0-9०-९]{4}(?![\w]|[ -]\d{4}(?!\d))"
TAX = r"(?<!\w)[A-Za-z]{5}\d{4}[A-Za-z](?!\w)"
SLASHED = r"(?<![\w/])[A-Za-z]{2}/\d{2}(?:/\d{3})?/\d{6}(?![\w/])"
NUMBER = regex.compile(rf"{SLASHED}|{TAX}|{CITIZEN}")
#: Numbers of wider use, each after its own words only.
CARD = regex.compile(r"(?<![\w/])\d(?:[ -]?\d){12,18}(?![\w/])")
IBAN = regex.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
OWN = {
    "passport": regex.compile(r"(?<!\w)[A-Z]{1,2}\d{6,8}(?!\w)"),
    "licence": regex.compile(r"(?<![\w/])[A-Z]{1,2}[- ]?\d{2}[- ]?\d{4}[- ]?\d{5,8}(?!\w)|(?<![\w/])[A-Z]\d{7,14}(?!\w)"),
    "ssn": regex.compile(r"(?<![\w/-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "account": regex.compile(r"(?<![\w/])\d{9,18}(?![\w/])"),
}
OWN |= {"license": OWN["licence"], "social security": OWN["ssn"], "a/c": OWN["account"]}
#: What may stand between the announcing words and the number.
GAP = regex.compile(r"[^\w\n]{0,3}(?:(?:no|number|num|card|is|संख्या|क्रमांक)\b[.:]?[^\w\n(]{0,3}){0,2}", regex.I)
STREETS = "Road|Street|Lane|Marg|Cross|Layout|Bazaar|Bazar|Chowk|Nagar|Colony|Path|Gali|Market|Avenue|Main|Extension|Enclave|Row|Square|Quarter|Mohalla"
W = r"\p{Lu}[\p{L}'’-]*"
NO = r"\d{1,4}(?:/\d{1,3})?(?:-?[A-Za-z])?(?![\w/])"
STATE = r"(?:Upper |Lower )?\p{Lu}[\p{L}]+(?: (?:and )?\p{Lu}[\p{L}]+)?"
STREET = rf"(?:{W}[ ]){{1,3}}?(?:{STREETS})\b(?! (?:{STREETS})\b)"
TOWN = rf"(?!(?:{STREETS})\b)\p{{Lu}}[\p{{L}}-]+"
PIN = r"\s?[-–]?\s?\d{6}(?!\d)"
ADDRESS = regex.compile(
    rf"(?<![\w/.-])(?:Flat\s(?:No\.?\s?)?{NO},?\s+)?(?:(?:House|Plot|Door|H\.)\s?(?:No\.?|Number)?\s?)?{NO},?\s+{STREET}"
    rf"(?:,\s*(?:near|opp\.?|opposite|behind|beside)\s(?:the\s)?[\p{{Ll}} ]+?(?=,|\n))?(?:,\s*(?:Ward|Sector|Block|Phase)\s(?:No\.?\s)?\d{{1,3}})?"
    rf"(?:,\s*|\s*\n\s*|\s+)(?:(?P<pinned>{TOWN}(?:,\s*{STATE})?{PIN})|(?P<town>{TOWN}))"
)
# Capitalised words that follow a name but are no part of it.
AFTER = (
    "Flat|House|Plot|Door|Address|Ph|Phone|Fax|Tel|Telephone|Mob|Mobile|Call|Contact|Signed|The|My|Our|A|An|It|He|She|We|I|As|At|No|In|On|Of|Has|"
    "Cf|See|File|Section|Will|Whether|Kindly|Proof|Copies|About|Since|Out|Against|Work|Paragraph|Members|Notices|Replies|Recommendation|Yours|Applicant|Smt|Shri|Mr|Ms|Mrs|Dr|Prof|"
    "Nobody|Interruptions|Minister|Ministry|Chair|House|Speaker|Petitioner|Rs|And|For|To"
)
INITIAL = r"\p{Lu}\."
TOKEN = rf"(?!(?:{AFTER})\b)(?:\p{{Lu}}[\p{{Ll}}\p{{M}}'’]+(?:-\p{{Lu}}[\p{{Ll}}\p{{M}}]+)?|\p{{Lu}}{{2,}}(?:-\p{{Lu}}{{2,}})?)(?!\w)"
GIVEN = rf"(?:{INITIAL}(?:\s?{INITIAL})*+|{TOKEN}(?: {TOKEN}| {INITIAL})*+)"
# Initials and tokens have no writing in common, so a run of either is never taken back.
WHOLE = rf"{TOKEN}(?: {TOKEN})*+(?: {INITIAL})++(?: {TOKEN})++|(?:{INITIAL}\s?)++{TOKEN}(?: {TOKEN})*+|{TOKEN}(?: {TOKEN})*+"
NAME = regex.compile(rf"{TOKEN},\s{GIVEN}(?=$|[\s,.;:)(<])|{WHOLE}")
#: One token, one initial and the comma after a surname before a place, read from the right to the left.
APART = r"(?<![\p{L}\p{M}'’-])"
TOKEN_LEFT, INITIAL_LEFT = regex.compile(rf"(?r){APART}{TOKEN}"), regex.compile(rf"(?r){APART}{INITIAL}")
OTHER_NAME = regex.compile(r"[\p{L}\p{M}‌‍]+(?: [\p{L}\p{M}‌‍]+)*")
TITLE = regex.compile(r"(?:Shri|Smt|Mr|Ms|Mrs|Dr|Prof|Sri|Kumari|Adv|Col|Thiru|Sushri|Shrimati)\b\.?\s+", regex.I)
TITLE_LEFT = regex.compile(r"(?:Shri|Smt|Mr|Ms|Mrs|Dr|Prof|Sri|Kumari|Adv|Col|Thiru|Sushri|Shrimati)\.? $", regex.I)
# Words that end a name in Devanagari after its title.
HINDI_END = {"ने", "का", "की", "के", "को", "से", "द्वारा", "पर", "और", "एवं", "तथा", "में", "जी"}
TITLES_WORD = ("shri", "smt", "mr.", "ms.", "mrs.", "dr.", "prof.", "sri ", "kumari", "adv.", "col.", "thiru", "sushri")
CLOSED = regex.compile(r"[)\n]")
PHRASES = ("signed:", "(sd/-)", "contact:", "petitioner:", "asked by", "child of", "faithfully,", "sincerely,", "i, ")
#: Phrases after which only a name of two parts or more counts, and not one that ends like an office.
LOOSE = ("reach ", "speak to ", "speak with ", "ask for ", "attn:", "attention:", "s/o ", "d/o ", "w/o ", "c/o ", "son of ", "daughter of ", "wife of ", "dear ", "regards,")
OFFICES = {"Office", "Ministry", "Minister", "Department", "Committee", "Board", "Council", "Commission", "Section", "Branch", "Desk", "Court", "Members", "Member", "Sir", "Madam", "Table", "House"}
OPENERS = ("home at", "address:", "resident of", "live at", "at ", "to ", "\n", ". ")
#: Most names a caller may hand over as known; they are sent to every worker with the operator.
KNOWN = 200_000


def _automaton(known: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    uses: dict[str, list[str]] = {}
    for kind, words in ANCHORS.items():
        for w in words:
            uses.setdefault(w, []).append(kind)
    for name in known:
        if (low := name.strip().lower()) and len(low) == len(name.strip()):
            uses.setdefault(low, []).append("known")
    for w, kinds in uses.items():
        found.add_word(w, (w, kinds))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def remainder_one(number: str) -> bool:
    """Whether an account number in the international form leaves 1 over 97, letters being 10 to 35."""
    turned = number[4:] + number[:4]
    return int("".join(str(int(ch, 36)) for ch in turned)) % 97 == 1


def _name_before(text: str, stop: int) -> int:
    """Where the name that ends at ``stop`` begins (``stop`` if none does): token by token to the left, each looked at a fixed number of times."""

    def back(at: int, *kinds: regex.Pattern) -> int:
        while True:
            end = at - (at < stop and text[at - 1 : at] == " ")
            if at < stop and end == at and kinds != (INITIAL_LEFT,):
                return at
            m = next((m for k in kinds if (m := k.match(text, 0, end))), None)
            if not m:
                return at
            at = m.start()

    given = back(stop, TOKEN_LEFT, INITIAL_LEFT)
    if given < stop and text[given - 2 : given] == ", " and (surname := TOKEN_LEFT.match(text, 0, given - 2)):
        return surname.start()
    tokens = back(stop, TOKEN_LEFT)
    if tokens == stop:
        return stop
    initials = back(tokens, INITIAL_LEFT)
    return back(initials, TOKEN_LEFT) if initials < tokens else tokens


class Finder:
    """Finds the spans of one text; ``known`` are names found wherever they stand as whole words, without any phrase beside them."""

    def __init__(self, known: tuple[str, ...] = ()):
        self.anchors = _automaton(known)
        self.blank = (0, 0)

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) of every finding, in order, without overlaps."""
        if not text:
            return []
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: fold letter by letter instead
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        self.blank = (0, 0)
        got: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        reach = dict.fromkeys(KINDS, -1)
        later: list[tuple[int, int, str]] = []
        if text[0] in "0०" and (span := PHONE.match(text)):
            got["phone"].append(span.span())
        for last, (word, kinds) in self.anchors.iter(low):
            start, end = last - len(word) + 1, last + 1
            for kind in kinds:
                if kind == "name":
                    later.append((start, end, word))
                elif kind == "known":
                    if not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()):
                        got["name"].append((start, end))
                elif start >= reach[kind] or kind == "email":
                    if span := getattr(self, f"_{kind}")(text, start, end, word):
                        if not got[kind] or got[kind][-1] != span:
                            got[kind].append(span)
                        reach[kind] = max(reach[kind], span[1])
        mails, numbers = {a for a, _ in got["email"]}, sorted(a for k in ("phone", "id_number") for a, _ in got[k])
        closed = [m.start() for m in CLOSED.finditer(text)]
        for start, end, word in later:
            if start < reach["name"] and word in TITLES_WORD:
                continue
            # A name before a bracket or a pointed bracket needs a mail address or a number inside it.
            if word == "<" and end not in mails:
                continue
            if word == "(":
                at, to = bisect.bisect_left(numbers, start), bisect.bisect_left(closed, start)
                if at == len(numbers) or (to < len(closed) and closed[to] < numbers[at]):
                    continue
            if span := self._name(text, start, end, word):
                got["name"].append(span)
                if span[0] >= end:
                    reach["name"] = max(reach["name"], span[1])
        taken: list[tuple[int, int, str]] = []
        used = bytearray(len(text))
        for kind in KINDS:
            for a, b in sorted(set(got[kind]), key=lambda s: (-(s[1] - s[0]), s[0])):
                if not any(used[a:b]):
                    used[a:b] = b"\x01" * (b - a)
                    taken.append((a, b, kind))
        return sorted(taken)

    def _past_blanks(self, text: str, at: int) -> int:
        """The first place from ``at`` on that is no white space; a run is walked once, however many anchors stand in it."""
        low, high = self.blank
        if not low <= at < high:
            high = at
            while text[high : high + 1].isspace():
                high += 1
            self.blank = (at, high)
        return high

    @staticmethod
    def _email(text: str, start: int, end: int, word: str) -> tuple[int, int] | None:
        right = MAIL_RIGHT.match(text, start) if word == "@" else SPELT_RIGHT.match(text, start - (text[start - 1 : start] == " "))
        if not right:
            return None
        a = right.start()
        begin = MAIL_LEFT.match(text, 0, a).start()
        while begin < a and text[begin] in ".+-_":
            begin += 1
        return (begin, right.end()) if begin < a else None

    @staticmethod
    def _phone(text: str, start: int, end: int, word: str) -> tuple[int, int] | None:
        digits = lambda m: sum(ch.isdigit() for ch in m["n"])
        if word[-1] not in "0०९9+(":
            if text[start - 1 : start].isalnum():
                return None
            m = ANNOUNCED.match(text, CALLED.match(text, end).end())
            return m.span() if m and 7 <= digits(m) <= 15 else None
        at = start + (len(word) == 2 and word[0] != "(")
        if m := PHONE.match(text, at) or (text[at : at + 1] == "(" and PHONE.match(text, at + 1)):
            return m.span()
        if word == "(" and (m := BRACKETED.match(text, at)):
            return m.span()
        if m := word in ("+", "(") and ABROAD.match(text, at):
            return m.span() if 8 <= digits(m) <= 15 else None
        return None

    @staticmethod
    def _id_number(text: str, start: int, end: int, word: str) -> tuple[int, int] | None:
        at = GAP.match(text, end).end()
        if m := NUMBER.match(text, at):
            return m.span()
        if (own := OWN.get(word)) and not text[start - 1 : start].isalnum() and (m := own.match(text, at)):
            return m.span()
        if word in ("iban", "account", "a/c") and (m := IBAN.match(text, at)):
            # The last group may be the next word: the longest writing with the right remainder counts.
            for stop in sorted({m.end(), *(m.start() + i for i, ch in enumerate(m[0]) if ch == " ")}, reverse=True):
                number = text[m.start() : stop].replace(" ", "")
                if len(number) >= 15 and remainder_one(number):
                    return m.start(), stop
        if word in ("card no", "credit card", "debit card", "bank card") and (m := CARD.match(text, at)):
            return m.span() if luhn("".join(ch for ch in m[0] if ch.isdigit())) else None
        return None

    def _address(self, text: str, start: int, end: int, word: str) -> tuple[int, int] | None:
        m = ADDRESS.match(text, self._past_blanks(text, end) if word in OPENERS else start)
        return m.span() if m else None

    def _name(self, text: str, start: int, end: int, word: str) -> tuple[int, int] | None:
        if word in ("श्री", "श्रीमती", "डॉ", "कुमारी", "திரு"):
            if text[start - 1 : start].isalpha() or not text[end : end + 1].isspace() and text[end : end + 1] != ".":
                return None
            at = end + (text[end : end + 1] == ".")
            m = OTHER_NAME.match(text, at + 1)
            if not m:
                return None
            words, stop = m.group(0).split(" "), at + 1
            for w in words:
                if w in HINDI_END:
                    break
                stop += len(w) + 1
            return (at + 1, stop - 1) if stop > at + 1 else None
        if word in TITLES_WORD:
            if text[start - 1 : start].isalnum():
                return None
            t = TITLE.match(text, start)
            m = t and NAME.match(text, t.end())
            return m.span() if m else None
        if word in PHRASES or word in LOOSE:
            if word == "i, " and (text[start : start + 1] != "I" or text[start - 1 : start].isalnum()):
                return None
            at = end
            if word.endswith(("ly,", "regards,")):
                at = self._past_blanks(text, end)
            else:
                while text[at : at + 1] == " ":
                    at += 1
            t = TITLE.match(text, at)
            m = NAME.match(text, t.end() if t else at)
            if not m or word == "i, " and not text[m.end() :].startswith((", declare", " declare", ", ")):
                return None
            if word in LOOSE and (text[start - 1 : start].isalnum() or len(m[0].split()) < 2 or m[0].split()[-1] in OFFICES):
                return None
            return m.span()
        # What stands before a mail address or a number in brackets.
        stop = start
        while text[stop - 1 : stop] == " ":
            stop -= 1
        begin = _name_before(text, stop)
        return (begin, stop) if begin < stop else None


_FINDERS: dict[tuple[str, ...], Finder] = {}


def _finder(known: tuple[str, ...]) -> Finder:
    if known not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[known] = Finder(known)
    return _FINDERS[known]


def _known(names: Iterable[str]) -> tuple[str, ...]:
    out = tuple(sorted({n for n in names if n and n.strip()}))
    if len(out) > KNOWN:
        raise ValueError(f"more than {KNOWN} known names; they go to every worker")
    return out


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def find(df: DataFrame, doc_id: str = "doc_id", text: str = "text", known: Iterable[str] = ()) -> DataFrame:
    """doc_id, kind, found: every stretch, verbatim; equal ones of one document once. ``known``: names found without any phrase beside them."""
    names = _known(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(names)
        for batch in batches:
            ids, kinds, found = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for kind, what in dict.fromkeys((k, t[a:b]) for a, b, k in finder.spans(t)):
                    ids.append(i)
                    kinds.append(kind)
                    found.append(what)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(found, pa.string())], ["doc_id", "kind", "found"])

    return _rows(df, doc_id, text).mapInArrow(run, "doc_id bigint, kind string, found string").distinct()


def redact(df: DataFrame, doc_id: str = "doc_id", text: str = "text", known: Iterable[str] = ()) -> DataFrame:
    """doc_id and text with each stretch replaced by [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] or [NAME]; one row a row."""
    names = _known(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(names)
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                spans = finder.spans(t)
                if spans:
                    parts, at = [], 0
                    for a, b, kind in spans:
                        parts += [t[at:a], f"[{kind.upper()}]"]
                        at = b
                    t = "".join([*parts, t[at:]])
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return _rows(df, doc_id, text).mapInArrow(run, "doc_id bigint, text string")
