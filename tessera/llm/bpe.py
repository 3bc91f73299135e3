"""Byte-level BPE by prefix dynamic programming.

For a byte string, every prefix has exactly one encoding, and the last token
``t`` of a prefix's encoding is the only vocabulary string ending there for
which the shorter prefix's last token and ``t`` stay apart when their bytes
are merged. So one token number per prefix holds all encodings: walking back
from any position gives the encoding of that prefix, appended bytes extend
the table, and after an edit the table is filled only until it agrees with
the old one over the longest token.

Texts are cut to pre-tokens by a pattern and each is encoded separately;
encodings are kept in bounded tables per worker.

Defined results: a null or empty text has no tokens; repeated rows are each
encoded; other columns are kept by ``encoded`` and ignored by the digests;
special strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bounded import BoundedCache
from tessera.llm.common import require, small_batches

CACHED = 100_000  # encodings kept per generation in a worker, unless asked otherwise
LONG_PRE_TOKEN = 256  # characters; longer ones are not kept
BLOCK_CHARS = 1 << 20  # of a long text handled at a time


class Vocabulary:
    """Byte strings by rank (the token number), their splits and the test
    whether two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int], cached: int | None = None):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.bytes[r] = b
        self.longest = max(map(len, ranks))
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.apart = BoundedCache(CACHED if cached is None else cached)
        # tokens that merges never give end no prefix's encoding
        unreachable = {b for b, r in ranks.items() if len(b) > 1 and self._parts_before(b, r) is None}
        self.reachable = {b: r for b, r in ranks.items() if b not in unreachable}
        self.endings = ahocorasick.Automaton()
        for b, r in self.reachable.items():
            self.endings.add_word(b.decode("latin-1"), (r, len(b)))
        self.endings.make_automaton()

    def _parts_before(self, b: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives the token, or None if merges
        never give it."""
        parts = self.merge(b, rank)
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def merge(self, b: bytes, below: int | None = None) -> list[int]:
        """Encoding by repeated merges of the adjacent pair of lowest rank
        (of ranks under ``below``), leftmost first."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 1:
            options = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not options or (below is not None and min(options)[0] >= below):
                break
            _, i = min(options)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        if token not in self.splits:
            b = self.bytes[token]
            self.splits[token] = self._parts_before(b, token) if len(b) > 1 else None
        return self.splits[token]

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of ``a`` and ``b``.

        The pieces at the border are followed back in time, the later merge
        undone first. A merge of two pieces happens if its rank comes before
        the ranks that absorb them; at equal ranks the left merge is first.
        """
        key = (a, b)
        known = self.apart.get(key)
        if known is None:
            known = self._stay_apart(a, b)
            self.apart.put(key, known)
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        ranks, strings = self.ranks, self.bytes
        absorbed_a = absorbed_b = len(strings)
        while True:
            rank = ranks.get(strings[a] + strings[b])
            if rank is not None and rank < absorbed_a and rank <= absorbed_b:
                return False
            parts_a, parts_b = self.split(a), self.split(b)
            if parts_a is not None and (parts_b is None or a > b):
                absorbed_a, a = a, parts_a[1]
            elif parts_b is not None:
                absorbed_b, b = b, parts_b[0]
            else:
                return True


    def encode(self, data: bytes) -> tuple[int, ...]:
        """The encoding of ``data`` by a table of last tokens that is filled
        once; ``PrefixEncoding`` keeps such a table for appends and edits."""
        whole = self.reachable.get(data)
        if whole is not None:
            return (whole,)
        last, at, apart = [-1] * (len(data) + 1), 0, self.apart
        for end, (token, size) in self.endings.iter(data.decode("latin-1")):
            end += 1
            if end == at:
                continue  # a longer match was the one
            if end > size:
                key = (last[end - size], token)
                fits = apart.young.get(key)
                if not (self.stay_apart(*key) if fits is None else fits):
                    continue
            last[end] = token
            at = end
        if at != len(data):
            raise ValueError("the vocabulary lacks a byte")
        out, strings = [], self.bytes
        while at:
            token = last[at]
            out.append(token)
            at -= len(strings[token])
        return tuple(out[::-1])


class PrefixEncoding:
    """The table of last tokens of one byte string. ``last[i]`` belongs to
    the prefix of ``i`` bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, start: int, until=None) -> int | None:
        """Appends entries for the prefixes longer than ``start`` bytes.
        ``until(i)`` may end it early; returns where it did."""
        v, last = self.vocabulary, self.last
        base = max(0, start - v.longest + 1)  # no token that ends later begins before
        window = self.data[base:].decode("latin-1")
        at = start
        for end, (token, size) in v.endings.iter(window):
            end += base + 1
            if end <= at:
                continue  # before the start, or a longer match was the one
            before = last[end - size]
            if end == size or v.stay_apart(before, token):
                last.append(token)
                at = end
                if until is not None and until(end):
                    return end
        if at != len(self.data):
            raise ValueError("the vocabulary lacks a byte")
        return None

    def append(self, data: bytes) -> None:
        start, self.data = len(self.data), self.data + data
        self._fill(start)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Bytes ``[start, end)`` become ``data``; entries are computed from
        there until as many as the longest token has bytes agree with the
        old ones, from where all do."""
        old, shift, edited = self.last, len(data) - (end - start), start + len(data)
        self.data = self.data[:start] + data + self.data[end:]
        self.last = old[: start + 1]
        same = 0

        def agrees(i: int) -> bool:
            nonlocal same
            same = same + 1 if i > edited and self.last[i] == old[i - shift] else 0
            return same >= self.vocabulary.longest

        stop = self._fill(start, agrees)
        if stop is not None:
            self.last.extend(old[stop - shift + 1 :])

    def tokens(self, size: int | None = None) -> list[int]:
        """The encoding of the whole string or of its first ``size`` bytes."""
        at = len(self.data) if size is None else size
        out = []
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class TextEncoder:
    """Encodings of texts; those of up to ``cached`` words and pre-tokens are
    kept per generation, packed as four bytes a number."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int | None = None):
        self.vocabulary = Vocabulary(ranks, cached)
        self.pattern = regex.compile(pattern)
        self.pre_tokens = BoundedCache(CACHED if cached is None else cached)
        self.pieces = BoundedCache(CACHED if cached is None else cached)
        self.line_feed = self._pre_token("\n")

    def _pre_token(self, text: str, keep: bool = True) -> bytes:
        found = self.pre_tokens.young.get(text) or self.pre_tokens.get(text)
        if found is None:
            numbers = self.vocabulary.encode(text.encode("utf-8", "surrogatepass"))
            found = struct.pack(f"<{len(numbers)}i", *numbers)
            if keep and len(text) <= LONG_PRE_TOKEN:
                self.pre_tokens.put(text, found)
        return found

    def _cut(self, text: str) -> list[str]:
        return [m.group() for m in self.pattern.finditer(text)] if self.pattern.groups else self.pattern.findall(text)

    def _slow(self, text: str) -> bytes:
        return b"".join(map(self._pre_token, self._cut(text)))

    def _piece(self, piece: str) -> bytes | None:
        """A word with the space or line feed before it, or None if there is
        other white space in it."""
        text = piece if piece.startswith("\n") else f" {piece}"
        rest = text[1:]
        if not rest or rest.split() != [rest]:
            return None
        cut = self._cut(text)
        # a word that is one pre-token is kept once, as a word
        found = b"".join([self._pre_token(t, len(cut) > 1) for t in cut])
        if len(text) <= LONG_PRE_TOKEN:
            self.pieces.put(piece, found)
        return found

    def encode_block(self, text: str) -> bytes:
        """Where all white space is single spaces and line feeds between
        words, the pattern never crosses from a word to the space after it:
        words with what stands before them are looked up whole."""
        pieces = f"\n{text}".replace("\n", " \n").split(" ")
        del pieces[0]
        out = list(map(self.pieces.young.get, pieces))
        if None in out:
            pieces_ = self.pieces
            for i, found in enumerate(out):
                if found is None:
                    p = pieces[i]
                    found = pieces_.get(p) or self._piece(p)
                    if found is None:
                        return self._slow(text)
                    out[i] = found
        return b"".join(out)[len(self.line_feed) :]

    def encode_blocks(self, text: str) -> Iterator[np.ndarray]:
        """Encodings of the parts of a text, cut before single spaces
        between other characters."""
        at = 0
        while at < len(text):
            end = at + BLOCK_CHARS
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace() and not text[end + 1 : end + 2].isspace()):
                end += 1
            part = text[at:end]
            yield np.frombuffer(self._slow(part) if at else self.encode_block(part), dtype="<i4")
            at = end

    def encode(self, text: str | None) -> list[int]:
        return self.encode_array(text).tolist()

    def encode_array(self, text: str | None) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<i4"), *self.encode_blocks(text or "")])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str, cached: int | None = None) -> TextEncoder:
    return TextEncoder(read_ranks(path), pattern, cached)


def encoded(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with the token numbers as an array column. ``ranks_file``
    must be readable where tasks run; a worker keeps at most ``3 * CACHED``
    encodings and as many older ones."""
    require(docs, [text_col])
    small_batches(docs.sparkSession)
    if into in docs.columns:
        docs = docs.drop(into)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_file, pattern)
        for b in batches:
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                each = [encoder.encode_array(t.as_py()) for t in part.column(text_col)]
                ends = np.cumsum([0, *map(len, each)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, "<i4"), *each]), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decoded(rows: DataFrame, ranks_file: str, pattern: str, ids_col: str = "token_ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of the token numbers as a binary column."""
    require(rows, [ids_col])
    small_batches(rows.sparkSession)
    if into in rows.columns:
        rows = rows.drop(into)
    schema = T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_file, pattern)
        for b in batches:
            back = pa.array([encoder.decode(x.as_py() or ()) for x in b.column(ids_col)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, back], names=schema.names)

    return rows.mapInArrow(run, schema)


def encoding_digests(docs: DataFrame, ranks_file: str, pattern: str, cached: int = 250_000) -> DataFrame:
    """Per document the number of tokens and digests of the ids (decimal,
    comma-joined) and of the bytes that they decode to. Long texts are
    encoded, decoded and hashed in blocks; ``cached`` sets how many encodings
    a worker keeps."""
    require(docs, ["doc_id", "text"])
    small_batches(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([
        slim.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_file, pattern, cached)
        decimal = [str(i) for i in range(len(encoder.vocabulary.bytes))]
        for b in batches:
            rows = []
            for t in b.column(1):
                n, ids_hash, bytes_hash = 0, hashlib.sha256(), hashlib.sha256()
                for found in encoder.encode_blocks(t.as_py() or ""):
                    ids = found.tolist()
                    joined = ",".join(map(decimal.__getitem__, ids))
                    ids_hash.update(f"{',' if n else ''}{joined}".encode())
                    bytes_hash.update(encoder.decode(ids))
                    n += len(ids)
                rows.append((n, ids_hash.hexdigest(), bytes_hash.hexdigest()))
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string())))], names=schema.names
            )

    return slim.mapInArrow(run, schema)
