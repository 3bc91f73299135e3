"""Phrase collocations by Rabin-Karp fingerprints.

The fingerprint of a phrase is a polynomial over its words modulo 2 ** 64,
and that of a word one over its bytes. Prefix sums of both polynomials give
every n-gram of a block of text in a few numpy steps. Passes over the texts
count fingerprints, first of words, then of pairs of frequent words, then of
longer phrases of frequent pairs, since no phrase is more frequent than its
parts; blocks count for themselves before Spark sums them, and every count
goes with a pointer to the first document that holds it. What is frequent
reaches the next pass as a bitmap of fixed size. A bit that is set for
another fingerprint costs work and changes no result.

The last pass materialises the frequent phrases only: within a block every
occurrence is compared with the text at the first occurrence of its
fingerprint, phrases that share a fingerprint are parted, and the counts are
summed by text. So counts are those of texts, whatever the fingerprints.

Words are lower-cased in A-Z only and phrases stay within pieces, the parts
of a text between ``.,;:!?`` and line ends. Defined results: a null or empty
text has no words; a null language is ``und``; a repeated row counts again;
ties of cuts go to the smaller first part, ties of rank to the greater count
and then the phrase's bytes; an empty table has no phrases; other columns
are ignored. A text is read in blocks that end between words and overlap by
what a phrase can reach, so a long one needs no more memory than a block and
its longest word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import require, small_batches, stored

LONGEST = 4
BLOCK = 1 << 20
#: Fingerprints counted at once in a task.
TOGETHER = 1 << 20
#: Phrases gathered in a task before they go to Spark.
HELD = 100_000
FILTER_BITS = 27

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
#: 0 within words, 1 between the words of a piece, 2 between pieces.
KIND = bytes(2 if c in BREAKS else 1 if c in SPACES else 0 for c in range(256))
_OUTSIDE = re.compile(rb"[ \t.,;:!?\n-\r]")
_REACH = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
NO_DOC = np.iinfo(np.int64).max


class Powers:
    """Powers of an odd base modulo 2 ** 64 and of its inverse, as far as
    they have been asked for."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            def table(b: int) -> np.ndarray:
                steps = np.full(n, b, dtype=np.uint64)
                steps[0] = 1
                return np.cumprod(steps)

            self.up, self.down = table(self.base), table(pow(self.base, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = Powers(BYTE_BASE), Powers(WORD_BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ``values[i] * base ** i``, and the inverse powers: the
    polynomial of values s to e is ``(sums[e] - sums[s]) * down[s]``."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


class Block:
    """The words of a block of lower-cased bytes. N-grams may start at the
    words before ``own`` and reach beyond it."""

    def __init__(self, data: bytes, own: int):
        self.bytes = np.frombuffer(data, dtype=np.uint8)
        kind = np.frombuffer(data.translate(KIND), dtype=np.uint8)
        inside = np.zeros(len(kind) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts]
        self.n_own = int(np.searchsorted(self.starts, own))
        sums, down = _spans(self.bytes + np.uint64(1), _byte_powers)
        self.words = _mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self._sums, self._down = _spans(self.words, _word_powers)
        self.data = data

    def grams(self, n: int, reach: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First words of the n-grams, and their fingerprints; with ``reach``
        also of those that start beyond the block's own words."""
        last = max(len(self.words) - n + 1, 0)
        last = last if reach else min(self.n_own, last)
        at = np.flatnonzero(self.piece[:last] == self.piece[n - 1 : n - 1 + last])
        return at, _mixed((self._sums[at + n] - self._sums[at]) * self._down[at] + np.uint64(n))

    def exact(self) -> np.ndarray:
        """Numbers of the words, equal if and only if their texts are."""
        _, first, ids = np.unique(self.words, return_index=True, return_inverse=True)
        of = first[ids]
        size = self.ends - self.starts
        other = size != size[of]
        same = np.flatnonzero(~other & (of != np.arange(len(of))))
        long = size[same]
        step = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        unlike = self.bytes[np.repeat(self.starts[same], long) + step] != self.bytes[np.repeat(self.starts[of[same]], long) + step]
        other[same[np.unique(np.repeat(np.arange(len(same)), long)[unlike])]] = True
        if other.any():  # fingerprints that two words share
            known: dict[bytes, int] = {}
            for i in np.flatnonzero(other):
                ids[i] = known.setdefault(self.data[self.starts[i] : self.ends[i]], len(first) + len(known))
        return ids

    def phrases(self, first: np.ndarray, n: int) -> list[bytes]:
        """The phrases of ``n`` words that begin with the words ``first``. Where
        single spaces part the words, a phrase is a piece of the text."""
        data, tight = self.data, np.ones(len(first), dtype=bool)
        for k in range(n - 1):
            ends = self.ends[first + k]
            tight &= (self.starts[first + k + 1] == ends + 1) & (self.bytes[ends] == 32)
        out = [data[s:e] for s, e in zip(self.starts[first].tolist(), self.ends[first + n - 1].tolist())]
        for j in np.flatnonzero(~tight):
            i = first[j]
            out[j] = b" ".join(data[s:e] for s, e in zip(self.starts[i : i + n].tolist(), self.ends[i : i + n].tolist()))
        return out


def blocks(data: bytes) -> Iterator[tuple[int, Block]]:
    """``data`` in blocks, each with its place."""
    at = 0
    while len(data) - at > BLOCK:
        cut = max(data.rfind(c, at + 1, at + BLOCK) for c in map(bytes, zip(SPACES + BREAKS)))
        if cut < 0:
            found = _OUTSIDE.search(data, at + BLOCK)
            cut = found.start() if found else len(data)
        yield at, Block(data[at : _REACH.match(data, cut).end()], cut - at)
        at = cut
    if at < len(data):
        yield at, Block(data[at:], len(data) - at)


@dataclass(frozen=True)
class Texts:
    """Texts of one language, put together with line ends between them."""

    data: bytes
    places: np.ndarray
    docs: np.ndarray

    def pieces(self) -> Iterator[tuple[Block, np.ndarray]]:
        """Blocks, and the document of each of their words."""
        for at, block in blocks(self.data):
            yield block, self.docs[np.searchsorted(self.places, block.starts + at, side="right") - 1]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Texts]]:
    """The texts of batches (``lang``, ``doc``, ``text``) by language, about a
    block at a time."""
    held: dict[str, list[tuple[bytes, int]]] = {}
    size: dict[str, int] = {}

    def made(lang: str) -> Texts:
        found = held.pop(lang)
        size.pop(lang)
        lengths = np.array([len(t) + 1 for t, _ in found], dtype=np.int64)
        return Texts(b"\n".join(t for t, _ in found), np.cumsum(lengths) - lengths, np.array([d for _, d in found], dtype=np.int64))

    for b in batches:
        for lang, doc, text in zip(b.column("lang"), b.column("doc"), b.column("text")):
            if not (data := (text.as_py() or "").encode("utf-8", "surrogatepass").translate(LOWER)):
                continue
            key = lang.as_py()
            doc = doc.as_py()
            held.setdefault(key, []).append((data, NO_DOC if doc is None else doc))
            size[key] = size.get(key, 0) + len(data)
            if size[key] >= BLOCK:
                yield key, made(key)
        # many languages together hold no more than a few blocks
        while sum(size.values()) > 4 * BLOCK:
            most = max(size, key=size.get)
            yield most, made(most)
    for key in list(held):
        yield key, made(key)


class Frequent:
    """A bitmap of fingerprints: two bits for each of them."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def places(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - self.bits)
        return prints >> shift, (prints * np.uint64(BYTE_BASE)) >> shift

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        a, b = ((self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) for p in self.places(prints))
        return (a & b).astype(bool)


def _bitmap(spark: SparkSession, counts: DataFrame, bits: int) -> Frequent:
    """The bitmap of the fingerprints of ``counts``; the driver gets its words
    that are not zero, at most ``2 ** bits / 8`` bytes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = Frequent(bits, np.zeros(0, dtype=np.uint64))
        for b in batches:
            prints = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.unique(np.concatenate(empty.places(prints)))
            each = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(each.view(np.int64))], names=["word", "bit"])

    found = counts.select("print").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[found.column("word").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return Frequent(bits, words)


COUNTED = "lang string, n int, print long, count long, doc long"


def _summed(prints: np.ndarray, counts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints, their counts and their first documents."""
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    return prints[first], np.add.reduceat(counts[order], first), np.minimum.reduceat(docs[order], first)


def _counted(texts: DataFrame, sizes: tuple[int, ...], least: int, part: int, frequent: Frequent | None) -> DataFrame:
    """Fingerprints of the n-grams of ``sizes`` whose parts of ``part`` words are
    all ``frequent``, with counts from ``least`` on and the first document.
    In the pass over single words also the number of words, as n = 0."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent) if frequent else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value if shared else None
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def emitted() -> Iterator[pa.RecordBatch]:
            for (lang, n), parts in held.items():
                prints, docs = (np.concatenate(x) for x in zip(*parts))
                if not len(prints):
                    continue
                if n == 0:
                    prints, counts, docs = np.zeros(1, np.uint64), prints.sum(dtype=np.uint64, keepdims=True).view(np.int64), docs[:1]
                else:
                    prints, counts, docs = _summed(prints, np.ones(len(prints), np.int64), docs)
                columns = [
                    pa.array([lang] * len(prints), pa.string()), pa.array(np.full(len(prints), n, np.int32)),
                    pa.array(prints.view(np.int64)), pa.array(counts), pa.array(docs),
                ]
                for i in range(0, len(prints), 1 << 16):
                    yield pa.RecordBatch.from_arrays([c[i : i + (1 << 16)] for c in columns], names=["lang", "n", "print", "count", "doc"])

        for lang, found in gathered(batches):
            for block, docs in found.pieces():
                if known is None:
                    held.setdefault((lang, 0), []).append((np.array([block.n_own], np.uint64), np.array([NO_DOC])))
                else:
                    ok = np.zeros(len(block.words) + LONGEST, dtype=bool)
                    at, prints = block.grams(part, reach=True)
                    ok[at] = known(prints)
                for n in sizes:
                    at, prints = block.grams(n)
                    if known is not None:
                        some = np.logical_and.reduce([ok[at + k] for k in range(n - part + 1)])
                        at, prints = at[some], prints[some]
                    held.setdefault((lang, n), []).append((prints, docs[at]))
                    waiting += len(prints)
                if waiting >= TOGETHER:
                    yield from emitted()
                    held.clear()
                    waiting = 0
        yield from emitted()

    rows = texts.mapInArrow(run, COUNTED)
    sums = rows.groupBy("lang", "n", "print").agg(F.sum("count").alias("count"), F.min("doc").alias("doc"))
    return stored(sums.filter((F.col("count") >= least) | (F.col("n") == 0)), f"phrase-prints-{sizes[0]}")


def _materialised(texts: DataFrame, frequent: Frequent, least: int) -> DataFrame:
    """The phrases whose fingerprints are ``frequent``, counted by their text:
    ``lang``, ``n_words``, ``phrase``, ``f`` and ``first_doc``."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held: dict[tuple[str, int], dict[bytes, tuple[int, int]]] = {}

        def emitted() -> Iterator[pa.RecordBatch]:
            for (lang, n), phrases in held.items():
                f, doc = zip(*phrases.values())
                text = pa.array(list(phrases), pa.binary()).cast(pa.string())
                columns = [pa.array([lang] * len(text), pa.string()), pa.array(np.full(len(text), n, np.int32)), text]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(f, pa.int64()), pa.array(doc, pa.int64())], names=["lang", "n_words", "phrase", "f", "first_doc"])

        for lang, found in gathered(batches):
            for block, docs in found.pieces():
                ids = block.exact()
                for n in range(1, LONGEST + 1):
                    at, prints = block.grams(n)
                    some = known(prints)
                    first, counts, first_docs = distinct_phrases(ids, at[some], prints[some], docs[at[some]], n)
                    if not len(first):
                        continue
                    mine = held.setdefault((lang, n), {})
                    for phrase, f, doc in zip(block.phrases(first, n), counts.tolist(), first_docs.tolist()):
                        now = mine.get(phrase)
                        mine[phrase] = (f, doc) if now is None else (now[0] + f, doc if doc < now[1] else now[1])
                if sum(map(len, held.values())) >= HELD:
                    yield from emitted()
                    held.clear()
        yield from emitted()

    rows = texts.mapInArrow(run, "lang string, n_words int, phrase string, f long, first_doc long")
    sums = rows.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f"), F.min("first_doc").alias("first_doc"))
    sums = sums.withColumn("first_doc", F.nullif("first_doc", F.lit(int(NO_DOC))))
    return stored(sums.filter(F.col("f") >= least), "phrases")


def distinct_phrases(ids: np.ndarray, at: np.ndarray, prints: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence, count and first document of each distinct phrase
    among the n-grams at words ``at``, by the exact numbers of their words."""
    if not len(at):
        return at, at, at
    order = np.argsort(prints, kind="stable")
    at, prints, docs = at[order], prints[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    counts = np.diff(np.append(first, len(at)))
    pointer = np.repeat(at[first], counts)
    like = np.logical_and.reduce([ids[at + k] == ids[pointer + k] for k in range(n)])
    if like.all():
        return at[first], counts, np.minimum.reduceat(docs, first)
    parted: dict[tuple[int, ...], list[int]] = {}
    for i, doc in zip(at.tolist(), docs.tolist()):
        now = parted.setdefault(tuple(ids[i : i + n].tolist()), [i, 0, doc])
        now[1] += 1
        now[2] = min(now[2], doc)
    return tuple(np.array(x) for x in zip(*parted.values()))


@dataclass(frozen=True)
class Phrases:
    """``counts``: every phrase of up to four words that occurs often enough,
    by ``lang``, with its count ``f``; ``totals``: the words of a language."""

    counts: DataFrame
    totals: DataFrame


def frequent_phrases(docs: DataFrame, least: int = 30, id: str = "doc_id", filter_bits: int = FILTER_BITS) -> Phrases:
    """The phrases of ``docs`` (``id``, ``lang``, ``text``) with at least
    ``least`` occurrences in their language."""
    require(docs, [id, "lang", "text"])
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col(id).cast("long").alias("doc"), "text")
    words = _counted(texts, (1,), least, 0, None)
    single = words.filter("n = 1")
    pairs = _counted(texts, (2,), least, 1, _bitmap(spark, single, filter_bits))
    longer = _counted(texts, tuple(range(3, LONGEST + 1)), least, 2, _bitmap(spark, pairs, filter_bits))
    every = _bitmap(spark, single.unionByName(pairs).unionByName(longer), filter_bits)
    return Phrases(_materialised(texts, every, least), words.filter("n = 0").select("lang", F.col("count").alias("n")))


def _part(words: Column, start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def _long(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int | None = 2000, id: str = "doc_id") -> DataFrame:
    """Per language the ``top`` phrases of 2 to 4 words (None: all) by their
    worst cut: ``floor(2000000 * a / (l + r))`` with a, l and r the counts of
    the phrase and its two parts. A phrase inside a longer candidate with at
    least ``inside`` hundredths of its count is left to that one."""
    found = frequent_phrases(docs, least, id)
    counts = found.counts
    candidates = counts.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), "first_doc", F.split("phrase", " ").alias("w"))
    cut = candidates.select("lang", "phrase", "a", "first_doc", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cut = cut.withColumn("left_part", _part(F.col("w"), 1, F.col("k"))).withColumn("right_part", _part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")))
    for side, name in (("left_part", "l"), ("right_part", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    cut = cut.withColumn("score", F.expr("(2000000BD * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"))
    worst = cut.groupBy("lang", "phrase", "a", "first_doc").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    spans = [(i, m) for m in range(2, LONGEST) for i in range(1, LONGEST - m + 2)]
    parts = [F.when((F.col("n_words") > m) & (F.col("n_words") >= i + m - 1), _part(F.col("w"), i, m)) for i, m in spans]
    within = candidates.filter("n_words > 2").select("lang", F.col("a").alias("f"), F.explode(F.array_compact(F.array(*parts))).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    left = worst.join(within, ["lang", "phrase"], "left").filter(
        F.col("longest").isNull() | (_long(F.col("longest")) * 100 < _long(F.col("a")) * inside)
    )
    rank = Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = left.withColumn("rank", F.row_number().over(rank).cast("long"))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.join(found.totals, "lang").select("lang", "rank", "phrase", "a", "c.l", "c.r", "n", "c.score", "first_doc")
