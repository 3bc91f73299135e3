"""SimHash near-duplicate detection with pigeonhole blocks.

A document's fingerprint has a bit set when more than half of its shingle
hashes have it. Two fingerprints that differ in at most ``max_bits`` bits
and are cut into ``max_bits + spare`` blocks agree on at least ``spare``
whole blocks. Every choice of ``spare`` blocks is therefore a key: linked
fingerprints meet under at least one key, and those that meet are verified
by their Hamming distance.

Work is done on distinct fingerprints, so a group of exact copies is one
vertex. Under a key the verified links are reduced to a spanning forest
before they leave the task; the components stay the same and a group of
near copies never becomes all of its pairs. A key with more than ``chunk``
fingerprints is dealt over several tasks as pairs of chunks.

Defined results: a null or empty text has fingerprint zero and links like
any other; a null ``doc_id`` gets its fingerprint, is never linked and has
a null component; repeated rows all appear in the result; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SHORT_BATCH_BYTES, fresh_names, require, small_batches, stored
from tessera.llm.components import connected_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
HASH_BLOCK = 1 << 15  # shingles whose bits are unpacked at a time


def simhash(text: str | None, shingle: int) -> int:
    """64-bit fingerprint. Words are runs of bytes other than 0x20 and
    0x09-0x0D after A-Z are lower-cased; a text of fewer than ``shingle``
    words is one shingle, one without words has fingerprint zero."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    size = min(shingle, len(words))
    spans = zip(starts, ends[size - 1 :])
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    total = 0
    while True:
        hashes = [digest(joined[s : e - 1], SEED) for s, e in islice(spans, HASH_BLOCK)]
        if not hashes:
            break
        total += len(hashes)
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``fp``, the fingerprint as a signed
    long."""
    require(docs, [id_col, text_col])
    small_batches(docs.sparkSession, SHORT_BATCH_BYTES)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return slim.mapInArrow(run, schema)


def block_masks(max_bits: int, spare: int) -> list[int]:
    """Bit masks of all choices of ``spare`` out of ``max_bits + spare``
    blocks, as signed 64-bit values."""
    n = max_bits + spare
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, spare)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def spare_blocks(n_fingerprints: int, max_bits: int) -> int:
    """The smallest number of spare blocks whose keys have about as many
    values as there are fingerprints. It sets the cost only: the links are
    the same with any number."""
    for spare in range(2, 9):
        if 64 * spare / (max_bits + spare) >= np.log2(max(n_fingerprints, 2)):
            return spare
    return 8


def _forest(x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph that links the values of
    ``x`` that differ in at most ``max_bits`` bits."""
    rest = x
    left, right = [], []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            seed = todo.pop()
            near = np.bitwise_count(rest ^ seed) <= max_bits
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), seed))
                right.append(found)
                todo.extend(found)
                rest = rest[~near]
    if not left:
        return x[:0], x[:0]
    return np.concatenate(left), np.concatenate(right)


SMALL_RUN = 6  # a run of so few has at most 15 pairs


def _links_of_runs(starts: np.ndarray, ends: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    small = ends - starts <= SMALL_RUN
    for d in range(1, SMALL_RUN):
        for o in range(SMALL_RUN - d):
            at = starts[small & (ends - starts > o + d)] + o
            a, b = fp[at], fp[at + d]
            near = np.bitwise_count(a ^ b) <= max_bits
            left.append(a[near])
            right.append(b[near])
    for s, e in zip(starts[~small], ends[~small]):
        a, b = _forest(fp[s:e], max_bits)
        left.append(a)
        right.append(b)
    if not left:
        return fp[:0], fp[:0]
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, n: int, max_bits: int, chunk: int = 2048) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``) at
    ``max_bits`` or fewer bits; enough of them to connect all that are
    connected, each verified. ``n`` is the number of fingerprints."""
    masks = block_masks(max_bits, spare_blocks(n, max_bits))
    keyed = distinct.select(
        F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for j, m in enumerate(masks)])).alias("k"),
        "fp",
    ).select("k.j", "k.key", "fp")
    hot = (
        keyed.groupBy("j", "key").count().filter(F.col("count") > chunk)
        .select("j", "key", F.ceil(F.col("count") / F.lit(chunk // 2)).cast("int").alias("parts"))
    )
    # a hot key's fingerprints go to chunks, and each pair of chunks to a task
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.least(F.col("own"), o) * F.lit(65536) + F.greatest(F.col("own"), o),
    )
    dealt = (
        keyed.join(hot, ["j", "key"], "left")
        .withColumn("own", own)
        .select("j", "key", "fp", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("pair"))
        .repartition("j", "key", "pair")
        .sortWithinPartitions("j", "key", "pair")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 2)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            j, key, pair, fp = cols
            fp = fp.view(np.uint64)  # bit counts of signed values are those of their magnitude
            if not len(fp):
                continue
            new = np.flatnonzero((j[1:] != j[:-1]) | (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
            bounds = np.concatenate([[0], new, [len(fp)]])
            held = [c[bounds[-2] :] for c in cols]
            yield edges(bounds[:-2], bounds[1:-1], fp)
        if held is not None:
            yield edges(np.array([0]), np.array([len(held[3])]), held[3].view(np.uint64))

    def edges(starts: np.ndarray, ends: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        several = ends - starts > 1
        a, b = _links_of_runs(starts[several], ends[several], fp, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: ``doc_id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    distinct = stored(fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    n = distinct.count()
    roots = connected_components(links(distinct, n, max_bits))
    linked = stored(distinct.join(roots.withColumnRenamed("node", "fp"), "fp"), "simhash-linked")
    smallest = linked.groupBy("root").agg(F.min("first_id").alias("linked_id"))
    linked_ids = linked.join(smallest, "root").select("fp", "linked_id")
    component = distinct.join(linked_ids, "fp", "left").select("fp", F.coalesce("linked_id", "first_id").alias("component_id"))
    return fps.join(component, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def deduplicated(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near
    duplicates: the one with the smallest ``doc_id`` and, where two texts have
    one id, the smallest hash of its text; once if its row is repeated. Rows
    without a ``doc_id`` stay."""
    (mark,) = fresh_names(docs.columns, ["mark"])
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    marked = docs.withColumn(mark, F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("id"), text.alias("text"))))
    groups = near_duplicates(marked, shingle, max_bits, id_col=mark)
    keep = groups.filter("doc_id = component_id").select(F.col("doc_id").alias(mark)).distinct()
    kept = marked.join(keep, mark, "left_semi").dropDuplicates([mark])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))
