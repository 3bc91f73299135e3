"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents, so its size is bounded by the
session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` and
``maxBytesPerBatch``. Its text is the documents' words as numbers; a word
that no phrase has can be in no occurrence and acts as a separator, and so
does a stretch between separators that is shorter than every phrase. All
phrases are searched backward together, occurrences are located through the
sampled positions, and the hit words of a document are merged to spans.

Phrases reach the tasks in blocks of at most ``block_bytes`` of benchmark
text; a larger benchmark takes one pass per block and spans and items of the
passes are merged, so nothing unbounded is broadcast.

Defined results: a null or empty text has no words; a null ``item_id`` marks
words but is not listed; repeated items and rows count once in ``items`` and
all appear; an empty benchmark leaves every document clean; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh_names, joined_by_comma, require, small_batches, stored
from tessera.llm.fm_index import FMIndex

#: A-Z lower-cased; bytes that are not digits, letters or non-ASCII become a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SPANS = "array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class Phrases:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), set()).update([] if item is None else [item])
        self.lengths = np.array([len(k) for k in found], dtype=np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        width = int(self.lengths.max()) if found else 0
        self.rows = np.zeros((len(found), width), dtype=np.int64)
        for row, k in zip(self.rows, found):
            row[width - len(k) :] = k
        self.items = [sorted(v) for v in found.values()]


def _shard_runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of known words that can hold a
    phrase."""
    known = np.concatenate([[False], ids != 0, [False]])
    turns = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = turns[::2], turns[1::2]
    enough = ends - starts >= shortest
    return starts[enough], ends[enough]


def occurrences(ids: np.ndarray, phrases: Phrases, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """``(phrase, position)`` of all occurrences in a shard, whose documents
    are separated by zeros."""
    none = np.zeros(0, np.int64)
    if not len(phrases.rows):
        return none, none
    starts, ends = _shard_runs(ids, phrases.shortest)
    if not len(starts):
        return none, none
    sizes = ends - starts + 1  # a separator after each
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    text = ids[np.minimum(source, len(ids) - 1)].astype(np.int64)
    text[offsets[1:] - 1] = 0
    index = FMIndex(text, len(phrases.vocabulary) + 1, rate)
    lo, hi = index.search(phrases.rows, phrases.lengths)
    counts = hi - lo
    phrase = np.repeat(np.arange(len(lo)), counts)
    row = np.repeat(lo - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return phrase, source[index.locate(row)]


def _search_shard(texts: list, phrases: Phrases, rate: int) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
    """Word counts, merged hit spans and items of each text."""
    number = phrases.vocabulary.get
    parts, n_words = [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        w = words(t)
        n_words[i] = len(w)
        parts.append(np.fromiter(map(number, w, repeat(0)), dtype=np.int32, count=len(w)))
        parts.append(np.zeros(1, np.int32))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    first = np.concatenate([[0], np.cumsum(n_words + 1)])
    phrase, at = occurrences(ids, phrases, rate)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if len(at):
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + phrases.lengths[phrase], -1)
        hit = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
        turns = np.flatnonzero(hit[1:] != hit[:-1])
        doc_of = np.searchsorted(first, turns[::2], side="right") - 1
        for d, s, e in zip(doc_of.tolist(), turns[::2].tolist(), turns[1::2].tolist()):
            spans[d].append((s - int(first[d]), e - int(first[d])))
        doc = np.searchsorted(first, at, side="right") - 1
        for key in np.unique(doc * len(phrases.rows) + phrase).tolist():
            items[key // len(phrases.rows)].update(phrases.items[key % len(phrases.rows)])
    return n_words, spans, items


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(a + b):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between
    them."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(WORD_BYTES))]
    out, at = [], 0
    for s, e in spans:
        out.append(data[at : places[s][0]])
        at = places[e - 1][1]
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def benchmark_blocks(benchmark: DataFrame, block_bytes: int, id_col: str, text_col: str) -> tuple[int, Iterator[list]]:
    """The number of blocks of about ``block_bytes`` at most, and the items
    block by block, each collected when it is asked for."""
    require(benchmark, [id_col, text_col])
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = -(-size // block_bytes)

    def blocks() -> Iterator[list]:
        for k in range(n):
            block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
            yield [tuple(r) for r in block.collect()]

    return n, blocks()


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, cut: bool = False,
    rate: int = 16, block_bytes: int = 16 << 20, id_col: str = "item_id", text_col: str = "text",
) -> tuple[DataFrame, list[str]]:
    """Every column of ``docs`` but the text, and three more whose names are
    returned: the word count, the merged hit spans (in words, end exclusive)
    and the items found. With ``cut`` the text stays, without the spans."""
    require(docs, ["text"])
    small_batches(docs.sparkSession)
    added = fresh_names(docs.columns, ["n_words", "hit_spans", "hit_items"])
    types = ["long", SPANS, "array<string>"]
    found = docs.withColumn("text", F.col("text").cast("string"))
    for name, kind in zip(added, types):
        found = found.withColumn(name, F.lit(None).cast(kind))
    n, blocks = benchmark_blocks(benchmark, block_bytes, id_col, text_col)
    for k in range(max(n, 1)):
        last = k + 1 >= n
        found = _pass(found, Phrases(next(blocks, []), window), rate, added, keep_text=cut or not last, cut=cut and last)
        if not last:  # this block has done its work before the next one is collected
            found = stored(found, "decontam-pass")
    return found, added


def _pass(found: DataFrame, phrases: Phrases, rate: int, added: list[str], keep_text: bool, cut: bool) -> DataFrame:
    """One search; spans and items of earlier passes are merged in."""
    names = [c for c in found.columns if keep_text or c != "text"]
    schema = T.StructType([found.schema[c] for c in names])
    shared = found.sparkSession.sparkContext.broadcast(phrases)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            n_words, spans, items = _search_shard(texts, shared.value, rate)
            for i, (s, x) in enumerate(zip(b.column(added[1]).to_pylist(), b.column(added[2]).to_pylist())):
                if s:
                    spans[i] = merged([(y["start"], y["end"]) for y in s], spans[i])
                items[i].update(x or [])
            new = {
                added[0]: pa.array(n_words),
                added[1]: pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span),
                added[2]: pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            }
            if cut:
                new["text"] = pa.array([cut_words(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays([new[c] if c in new else b.column(c) for c in names], names=names)

    return found.mapInArrow(run, schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per document: counts of words, hit words and items, a digest of the
    items, and whether any word is hit."""
    found, (n_words, spans, items) = contamination(docs.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id", F.col(n_words).alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(joined_by_comma(F.array_sort(items)), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with the hit spans cut from the texts; ``n_chars``, if there,
    follows the new text. Documents without a hit are unchanged."""
    found, (_, spans, _) = contamination(docs, benchmark, window, cut=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(docs.columns)
