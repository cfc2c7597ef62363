"""Encoding of whole texts by a public byte-level BPE vocabulary, exact and in linear time.

Each pre-split piece is encoded by backtracking: all token occurrences come from one Aho-Corasick pass, the longest token
at each place is tried first, and a token is kept only if it may follow the one before it - looked up in a
pair-compatibility table that is derived from the merges. A dead end marks its place and steps back; no place is
entered twice, so time is linear in the piece. Decoding concatenates slices of one byte string by an offset table.

Edge cases. A null text and an empty one give an empty list. A text of any length is encoded whole, in one row. Strings of
special tokens inside a text are ordinary text. Rows are kept one for one, repeated rows included; columns other than
the named ones are dropped, so clashing names do no harm. An empty table gives an empty one.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary files lie on the machine that starts the query; workers get the tables from there.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

# Fixed value: the pattern that splits a text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Ids after which a batch is handed over, however few rows it has; one long text may exceed it.
FLUSH = 1 << 20
#: Pieces whose ids a worker remembers; beyond that it forgets all and goes on. Affects speed only.
REMEMBERED = 400_000


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def load_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """The tokens' bytes by id (special tokens left out, as b'') and the merges as (left, right, whole) ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = _byte_letters()
    special = {x["content"] for x in spec.get("added_tokens", [])}
    vocab = spec["model"]["vocab"]
    tokens = [b""] * (max(vocab.values()) + 1)
    for word, number in vocab.items():
        if word not in special:
            tokens[number] = bytes(letters[ch] for ch in word)
    merges = []
    for pair in spec["model"]["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((vocab[a], vocab[b], vocab[a + b]))
    return tokens, merges


class Encoder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]]):
        self.tokens = tokens
        self.length = [len(t) for t in tokens]
        self.rank = list(range(len(tokens)))  # order in which a token comes to be: single bytes first, then the merges
        base = [i for i, t in enumerate(tokens) if len(t) == 1]
        for n, i in enumerate(base):
            self.rank[i] = n
        self.whole: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(len(tokens))), list(range(len(tokens)))
        for n, (a, b, c) in enumerate(merges):
            self.whole.setdefault((a, b), c)
            if self.left[c] == c:
                self.left[c], self.right[c], self.rank[c] = a, b, len(base) + n
        self.by_text = {t.decode("latin-1"): i for i, t in enumerate(tokens) if t}
        self.finder = ahocorasick.Automaton()
        for t, i in self.by_text.items():
            self.finder.add_word(t, i)
        self.finder.make_automaton()
        self.shorter = [self._shorter(t) for t in tokens]
        self.offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.joined = b"".join(tokens)
        self.split = regex.compile(PATTERN)
        self.fits: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}

    def _shorter(self, token: bytes) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        for n in range(len(token) - 1, 0, -1):
            if (i := self.by_text.get(token[:n].decode("latin-1"))) is not None:
                return i
        return -1

    def follows(self, a: int, b: int) -> bool:
        """True if the merges leave a and b apart where they stand side by side: the pair-compatibility table."""
        key = a * len(self.tokens) + b
        if (said := self.fits.get(key)) is None:
            if len(self.fits) > 4_000_000:
                self.fits.clear()
            said = self.fits[key] = self._apart(a, b)
        return said

    def _apart(self, a: int, b: int) -> bool:
        """Undo merges from the latest on, on both sides of the border: no merge across it may come before one undone."""
        rank, limit = self.rank, 1 << 40
        while True:
            c = self.whole.get((a, b))
            if c is not None and rank[c] < limit:
                return False
            inner_a, inner_b = self.right[a] != a, self.left[b] != b
            if not inner_a and not inner_b:
                return True
            # Of two merges next to the border the later one is undone; left ones win ties of equal rank.
            if inner_a and (not inner_b or rank[a] > rank[b]):
                limit, a = rank[a], self.right[a]
            else:
                limit, b = rank[b] + 1, self.left[b]

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece, the same that applying the merges in order gives."""
        text = data.decode("latin-1")
        if (i := self.by_text.get(text)) is not None and (self.left[i] != i or len(data) == 1):
            return [i]
        n, length, shorter = len(data), self.length, self.shorter
        longest = [-1] * n
        for end, i in self.finder.iter(text):
            at = end - length[i] + 1
            if longest[at] < 0 or length[i] > length[longest[at]]:
                longest[at] = i
        open_at = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if open_at[end] and (not out or self.follows(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[at] = 0
                token = out.pop()
                at -= length[token]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; [] for null and empty."""
        if not text:
            return []
        known, out = self.known, []
        for p in self.split.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p.encode("utf-8"))
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(p) <= 64:
                    known[p] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        at, joined = self.offsets, self.joined
        return b"".join([joined[at[i] : at[i + 1]] for i in ids]).decode("utf-8", errors="replace")


_HERE: list = [None, None]


def _encoder(sent) -> Encoder:
    """One encoder a worker process, made from the broadcast tables."""
    tables = sent.value
    if _HERE[0] is not tables:
        _HERE[:] = [tables, Encoder(*tables)]
    return _HERE[1]


def _tables(spark: SparkSession, path: str):
    """The vocabulary (about 2 MB, fixed) sent once to every executor."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (array<int>) of every row."""
    sent = _tables(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            first, sizes, flat = 0, [0], array("i")
            for at in range(batch.num_rows):
                flat.extend(encoder.encode(batch.column(1)[at].as_py()))
                sizes.append(len(flat))
                if len(flat) >= FLUSH or at + 1 == batch.num_rows:
                    column = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.frombuffer(flat, dtype=np.int32) if flat else [], pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at + 1 - first), column], ["doc_id", "ids"])
                    first, sizes, flat = at + 1, [0], array("i")

    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id and text of rows of doc_id and ids; null ids give an empty text."""
    sent = _tables(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and tokens (bigint), the number of ids of the text, of every row."""
    sent = _tables(df.sparkSession, path)
    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            n = [len(encoder.encode(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*keep, "tokens"])

    return rows.mapInArrow(run, schema)
