"""Masked pseudo-likelihood scores of documents.

A small network sees ``SIDE`` words on either side of a word and predicts
it; a document's score is the sum of the log-probabilities of all its words,
each given its neighbours. A word's probability is that of its class, from
the network, times its share of the class, from counts over all documents.

* Words are counted over the whole corpus. The most frequent ones have numbers
  of their own, ``vocabulary_size`` of them, which grows with the corpus up
  to what two bytes hold; the others share ``BUCKETS`` numbers by hash. The
  classes hold words of like frequency and about equal mass. Only these
  bounded tables reach the driver.
* A word without a number of its own has its own share of its bucket: its
  count over the bucket's mass, which is one more than the bucket's words; a
  word that was never counted has that one. Up to ``MIDDLE`` of the most
  frequent ones of these are looked up where texts become numbers; the counts
  of the others stay in the shared folder and are joined to the words of the
  documents.
* Texts become numbers once; training and scoring read these. Training does
  not depend on how rows are dealt to tasks: equal texts are one with a
  weight, and a text's hash gives its shard and its round. In a round every
  shard trains from the same weights on its texts of the round in a fixed
  order, about ``LOCAL`` words, and the results are averaged by words in the
  order of the shards. More words make more shards, not longer ones; a task
  takes up to ``FAN_IN`` neighbouring ones and writes only their mean.
* Scoring is a pass without a shuffle, and that join, of the distinct words
  of each text.

Words are runs of characters other than 0x20 and 0x09-0x0D. Defined results:
a null or empty text has no words, score 0 and no mean; repeated rows have
equal scores; words of equal count are numbered by their bytes; a null id is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import require, stored

SIDE = 2
VOCABULARY = 8191  # words with numbers of their own, at least
MIDDLE = 1 << 18  # other words whose counts every task has
BUCKETS = 1024
CLASSES = 64
WIDTH = 12  # of a word's embedding
HIDDEN = 32
ROUNDS = 8
LOCAL = 1 << 19  # words of a shard in a round
BATCH = 8192  # words a step is computed on
RATE = 0.1
FAN_IN = 16  # weights averaged by one task, and by the driver


@dataclass(frozen=True)
class Words:
    """Numbers of words (0 stands outside of a document), their classes and
    log shares of them, and per number the log share of it that a word never
    counted has; 0 where the number is one word's own. ``middle`` has the
    counts of some words without a number of their own."""

    numbers: dict[bytes, int]
    class_of: np.ndarray
    log_share: np.ndarray
    log_unseen: np.ndarray
    middle: dict[bytes, int] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.class_of)

    def encode(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        known, first = self.numbers.get, self.size - BUCKETS
        return np.fromiter((known(w) or first + zlib.crc32(w) % BUCKETS for w in words), dtype=np.int32, count=len(words))


def vocabulary_size(n_words: int) -> int:
    """Words with numbers of their own for a corpus of ``n_words``: twice its
    root, as vocabularies grow, between ``VOCABULARY`` and what two bytes
    hold beside the shared numbers."""
    return min(max(VOCABULARY, 2 * math.isqrt(n_words)), (1 << 16) - 1 - BUCKETS)


def word_table(top: list[tuple[bytes, int]], bucket_counts: np.ndarray, middle: dict[bytes, int] | None = None) -> Words:
    """``top``: the most frequent words with their counts; ``bucket_counts``:
    of the others by hash, ``middle`` of some of them. Every number counts
    once more than it occurs."""
    counts = np.concatenate([[0], [n + 1 for _, n in top], bucket_counts + 1]).astype(float)
    order = np.argsort(-counts, kind="stable")[: len(counts) - 1]  # without 0
    mass = np.cumsum(counts[order])
    centre = mass - counts[order] / 2
    class_of = np.zeros(len(counts), dtype=np.int64)
    class_of[order] = np.minimum((centre / mass[-1] * CLASSES).astype(np.int64), CLASSES - 1)
    class_mass = np.bincount(class_of[1:], weights=counts[1:], minlength=CLASSES)
    log_share = np.zeros(len(counts))
    log_share[1:] = np.log(counts[1:] / class_mass[class_of[1:]])
    log_unseen = np.concatenate([np.zeros(len(top) + 1), -np.log(bucket_counts + 1.0)])
    return Words({w: i + 1 for i, (w, _) in enumerate(top)}, class_of, log_share, log_unseen, middle or {})


def count_words(docs: DataFrame, text_col: str = "text") -> Words:
    """The word table of all documents."""
    return counted_words(docs, text_col)[0]


def counted_words(docs: DataFrame, text_col: str = "text") -> tuple[Words, DataFrame]:
    """The word table of all documents, and ``word``, ``n`` of every word."""
    words = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[ \t\n\x0B\f\r]+")
    found = docs.select(F.explode(words).alias("word")).where("word != ''")
    counts = stored(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "lm-words")
    size = vocabulary_size(counts.agg(F.sum("n")).first()[0] or 0)
    least_top, least_middle = _least_counts(counts, size)
    frequent = counts.where(F.col("n") >= least_top).orderBy(F.desc("n"), "word").limit(size)
    top = [(r.word.encode("utf-8", "surrogatepass"), r.n) for r in frequent.collect()]
    # no more than the top words and ``MIDDLE``
    known = counts.where(F.col("n") >= least_middle).select(F.col("word").cast("binary"), "n").toArrow()
    middle = dict(zip(known.column(0).to_pylist(), known.column(1).to_pylist()))
    buckets = np.zeros(BUCKETS, dtype=np.int64)
    per_bucket = counts.groupBy(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(BUCKETS)).alias("b")).agg(F.sum("n").alias("n"))
    for r in per_bucket.collect():
        buckets[r.b] = r.n
    for w, n in top:
        buckets[zlib.crc32(w) % BUCKETS] -= n
        middle.pop(w, None)
    return word_table(top, buckets, middle), counts


def _least_counts(counts: DataFrame, size: int) -> tuple[int, int]:
    """A count that the ``size`` most frequent words all reach, and one that
    no more than ``MIDDLE`` words reach, 2 at least: from a table of the
    counts, large ones to about a hundredth."""
    step = F.floor(F.log2("n") * 64)
    per_step = counts.groupBy(F.when(F.col("n") < 128, F.col("n")).otherwise(128 + step).alias("b"))
    least_top, least_middle, reached = 1, 1 << 62, 0
    for r in sorted(per_step.agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r.n):
        if reached < size:
            least_top = r.n
        reached += r.words
        if reached <= MIDDLE and r.n > 1:
            least_middle = r.n
    return least_top, least_middle


class Network:
    """Embeddings of the neighbours, a hidden layer, a softmax over classes."""

    def __init__(self, weights: list[np.ndarray], seen: list[np.ndarray] | None = None):
        self.weights = weights
        self.seen = seen or [np.full_like(w, 1e-3) for w in weights]  # sums of squared gradients

    @classmethod
    def fresh(cls, n_words: int, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        shapes = [(n_words, WIDTH), (2 * SIDE * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]
        return cls([(rng.standard_normal(s) * (0.3 if len(s) == 2 else 0.0)).astype(np.float32) for s in shapes])

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, hidden values and class log-probabilities."""
        embed, w1, b1, w2, b2 = self.weights
        x = np.take(embed, around, axis=0).reshape(len(around), -1)
        h = x @ w1
        h += b1
        np.tanh(h, out=h)
        z = h @ w2
        z += b2
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return x, h, z

    def step(self, around: np.ndarray, classes: np.ndarray, copies: np.ndarray | None = None) -> None:
        """One step of descent on the mean negative log-probability, each
        weight at a rate that falls with its past gradients; ``copies``
        counts each word as often. Of the embeddings only the neighbours'
        change, so a step takes as long with any vocabulary."""
        x, h, d = self.forward(around)
        n = len(around)
        np.exp(d, out=d)
        d[np.arange(n), classes] -= 1
        d *= np.float32(1 / n) if copies is None else (copies / copies.sum()).astype(np.float32)[:, None]
        dh = d @ self.weights[3].T
        dh *= 1 - h * h
        dx = (dh @ self.weights[1].T).reshape(-1, WIDTH)
        flat = around.ravel()
        near = np.flatnonzero(np.bincount(flat, minlength=len(self.weights[0])))
        place = np.zeros(len(self.weights[0]), dtype=np.intp)
        place[near] = np.arange(len(near))
        at = place[flat]
        de = np.stack([np.bincount(at, weights=column, minlength=len(near)) for column in dx.T.astype(np.float64, order="C")], axis=1)
        g = de.astype(np.float32)
        (w, *weights), (s, *seen) = self.weights, self.seen
        others = (x.T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))
        s[near] += g * g
        w[near] -= RATE * g / np.sqrt(s[near])
        for w, s, g in zip(weights, seen, others):
            s += g * g
            w -= RATE * g / np.sqrt(s)

    def copy(self) -> Network:
        return Network([w.copy() for w in self.weights], [w.copy() for w in self.seen])

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights + self.seen]).astype(np.float64)

    def from_flat(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for w in self.weights + self.seen:
            out.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
            at += w.size
        return Network(out[: len(self.weights)], out[len(self.weights) :])


def neighbours(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The neighbours of all words of all texts, and the words; 0 where a
    text ends."""
    gap = np.zeros(SIDE, np.int32)
    row = np.concatenate([gap, *(x for t in texts for x in (t, gap))])
    at = np.flatnonzero(row)
    around = np.stack([row[at + k] for k in range(-SIDE, SIDE + 1) if k], axis=1) if len(at) else np.zeros((0, 2 * SIDE), np.int32)
    return around, row[at]


NUMBERS = np.dtype("<u2")


def encoded_rows(docs: DataFrame, words: Words, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts as numbers, written once: ``row``, ``doc_id``, ``n_words``,
    ``numbers``, ``more``, the sum of the logs of the counts of the words in
    ``middle``, and ``tail``, the other distinct words that have no number of
    their own, with how often they occur."""
    require(docs, [id_col, text_col])
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        slim.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("numbers", T.BinaryType()),
        T.StructField("more", T.DoubleType()),
        T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.IntegerType())]))),
    ])
    table = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = table.value.size
        first, missed = size - BUCKETS, []

        class Numbers(dict):
            def __missing__(self, w: bytes) -> int:
                missed.append(w)
                return first + zlib.crc32(w) % BUCKETS

        # words in the middle are numbered after the others
        number_of = Numbers(table.value.numbers)
        middle = table.value.middle
        number_of.update(zip(middle, range(size, size + len(middle))))
        bucket_of = np.fromiter((first + zlib.crc32(w) % BUCKETS for w in middle), dtype=np.int32, count=len(middle))
        log_count = np.log(np.fromiter(middle.values(), dtype=np.float64, count=len(middle)))
        for b in batches:
            for part in (b.slice(i, 1000) for i in range(0, b.num_rows, 1000)):
                sizes, numbers, more, tail_words, tail_counts, ends = [], [], [], [], [], [0]
                for t in part.column(1):
                    split = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
                    found = np.fromiter(map(number_of.__getitem__, split), dtype=np.int32, count=len(split))
                    at = np.flatnonzero(found >= size)
                    in_middle = found[at] - size
                    found[at] = bucket_of[in_middle]
                    tail = Counter(missed)
                    missed.clear()
                    sizes.append(len(split))
                    numbers.append(found.astype(NUMBERS).tobytes())
                    more.append(log_count[in_middle].sum())
                    tail_words += tail
                    tail_counts += tail.values()
                    ends.append(len(tail_words))
                tails = pa.StructArray.from_arrays([pa.array(tail_words, pa.binary()), pa.array(tail_counts, pa.int32())], ["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(numbers, pa.binary()), pa.array(more, pa.float64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tails)], names=schema.names
                )

    return stored(slim.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-rows")


def _texts(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), NUMBERS).astype(np.int32) if x.is_valid else np.zeros(0, np.int32) for x in column]


def _mean_of(rows: DataFrame, net: Network) -> Network:
    """Weighted mean of the shards' weights, ``FAN_IN`` neighbouring shards at
    a time; sums are in the order of the shards."""
    def mean(table: pa.Table) -> pa.Table:
        total, n = None, 0
        for row in sorted(table.to_pylist(), key=lambda r: r["shard"]):
            w = np.frombuffer(row["weights"], "<f4").astype(np.float64) * row["n"]
            total, n = (w if total is None else total + w), n + row["n"]
        return pa.table({"shard": [table.column("shard")[0].as_py() // FAN_IN], "weights": [(total / n).astype("<f4").tobytes()], "n": [n]})

    rows = stored(rows, "lm-weights")
    while (n := rows.count()) > FAN_IN:
        grouped = rows.groupBy(F.expr(f"shard div {FAN_IN}").alias("g"))
        rows = stored(grouped.applyInArrow(mean, "shard long, weights binary, n long"), "lm-weights")
    found = sorted(rows.collect(), key=lambda r: r.shard)
    if not found:
        return net
    total = sum(np.frombuffer(r.weights, "<f4").astype(np.float64) * r.n for r in found)
    return net.from_flat(total / sum(r.n for r in found))


def train(docs: DataFrame, words: Words, text_col: str = "text") -> Network:
    """Weights trained on all documents."""
    slim = docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text"))
    return trained(encoded_rows(slim, words), words)


def trained(rows: DataFrame, words: Words) -> Network:
    """Weights trained on all ``encoded_rows``, the same for any partitioning."""
    net = Network.fresh(words.size)
    # equal texts by 128 bits of hash: their numbers are not shuffled for that
    h1, h2 = F.xxhash64("numbers"), F.xxhash64("numbers", F.lit(1))
    some_words = rows.filter("n_words > 0")
    one = some_words.groupBy(h1.alias("h1"), h2.alias("h2")).agg(
        F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"), F.first("n_words").alias("n_words"))
    one = stored(one, "lm-texts")
    total = one.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // (ROUNDS * LOCAL)))
    # a task's shards: what it writes is as large as all weights
    together = max(1, min(FAN_IN, -(-shards // FAN_IN)))
    part = lambda h: F.pmod(h, F.lit(ROUNDS))
    classes_of = rows.sparkSession.sparkContext.broadcast(words.class_of)
    for r in range(ROUNDS):
        start = rows.sparkSession.sparkContext.broadcast(net)

        def run(table: pa.Table) -> pa.Table:
            shard, sums, n = table.column("shard"), None, 0
            for i in sorted(shard.unique().to_pylist()):
                own, words_of = one_shard(table.filter(pc.equal(shard, i)))
                w = own.flat() * words_of
                sums, n = (w if sums is None else sums + w), n + words_of
            return pa.table({"shard": [i // together], "weights": [(sums / n).astype("<f4").tobytes()], "n": [n]})

        def one_shard(table: pa.Table) -> tuple[Network, int]:
            own, rng = start.value.copy(), np.random.default_rng(3)
            table = table.sort_by("numbers")  # distinct
            copies, encoded = table.column("copies").to_numpy(), _texts(table.column("numbers").combine_chunks())
            around, targets = neighbours(encoded)
            each = np.repeat(copies, [len(t) for t in encoded]).astype(np.float64)
            classes = classes_of.value[targets]
            mixed = rng.permutation(len(targets))
            for i in range(0, len(mixed), BATCH):
                at = mixed[i : i + BATCH]
                own.step(around[at], classes[at], each[at])
            return own, int(each.sum())

        dealt = one.filter(part(F.col("h2")) == r).select("row", "copies", F.pmod("h1", F.lit(shards)).alias("shard"))
        some = some_words.filter(part(h2) == r).select("row", "numbers").join(dealt, "row").drop("row")
        grouped = some.groupBy(F.expr(f"shard div {together}").alias("g"))
        net = _mean_of(grouped.applyInArrow(run, "shard long, weights binary, n long"), net)
    return net


def log_probabilities(net: Network, words: Words, texts: list[np.ndarray]) -> np.ndarray:
    """Log-probability of every word of the texts given its neighbours."""
    around, targets = neighbours(texts)
    out = words.log_share[targets]
    for i in range(0, len(targets), BATCH):
        _, _, z = net.forward(around[i : i + BATCH])
        out[i : i + BATCH] += z[np.arange(len(z)), words.class_of[targets[i : i + BATCH]]]
    return out


def scores(
    docs: DataFrame, net: Network, words: Words, id_col: str = "doc_id", text_col: str = "text", counts: DataFrame | None = None
) -> DataFrame:
    """Per input row: ``doc_id``, ``n_words``, ``log_prob`` (the sum),
    ``mean_log_prob``. ``counts`` has ``word``, ``n`` of the words that
    ``words`` was counted from; without it, words that have no number of
    their own are all taken as never counted."""
    return scored(encoded_rows(docs, words, id_col, text_col), net, words, counts)


def scored(rows: DataFrame, net: Network, words: Words, counts: DataFrame | None = None) -> DataFrame:
    """The scores of ``encoded_rows``."""
    counted = counts is not None
    table = rows.sparkSession.sparkContext.broadcast((words.class_of, words.log_share, words.log_unseen, net.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, log_share, log_unseen, weights = table.value
        model, words_ = Network(weights), Words({}, class_of, log_share, log_unseen)
        for b in batches:
            for part in (b.slice(i, 1000) for i in range(0, b.num_rows, 1000)):
                texts = _texts(part.column("numbers"))
                each = log_probabilities(model, words_, texts)
                if len(each):
                    each += log_unseen[np.concatenate(texts)]
                sums = np.bincount(np.repeat(np.arange(len(texts)), [len(t) for t in texts]), weights=each, minlength=len(texts)).astype(float)
                if counted:
                    sums += part.column("more").to_numpy()
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sums)], names=["row", "doc_id", "n_words", "log_prob"])

    schema = T.StructType([T.StructField("row", T.LongType()), rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("log_prob", T.DoubleType())])
    found = rows.select("row", "doc_id", "n_words", "numbers", "more").mapInArrow(run, schema)
    if counted:
        # a counted word's share is n times that of one never counted
        several = counts.filter("n > 1").select(F.col("word").cast("binary").alias("word"), F.log("n").alias("more"))
        tails = rows.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
        more = tails.join(several, "word").groupBy("row").agg(F.sum(F.col("more") * F.col("times")).alias("more"))
        found = found.join(more, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("more", F.lit(0.0)))
    return found.select(
        "doc_id", "n_words", "log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("mean_log_prob")
    )


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Counts, trains and scores over the same documents."""
    words, counts = counted_words(docs)
    rows = encoded_rows(docs, words)
    return scored(rows, trained(rows, words), words, counts)
