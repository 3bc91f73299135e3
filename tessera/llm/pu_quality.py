"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled good; all documents together are
the unlabelled text; labels of bad documents are not used. A document is a
set of shape measures of its text, each in one of a few fixed intervals, and
the model is additive over the intervals. Its risk needs no negatives: with
the class prior p, that of the positives is p * E_P[l(g)], and that of the
negatives E_U[l(-g)] - p * E_P[l(-g)], which is held at zero or more, since a
model that makes an estimated loss negative has only learnt the sample. With
the logistic loss the minimum gives the probability of good.

The prior is estimated first: a model that parts positives from unlabelled
text orders the documents, and the share of unlabelled text in the top of
that order, against the share of positives there, is least where the top is
pure (with a bound for chance at either size). Each half of the documents, by
a hash of their measures, is ordered by the model of the other half; the
estimate is the mean of both.

Intervals are computed once per document and stored; every step of Newton's
method sums gradients and curvature over all of them in Spark, and the driver
gets sums of a fixed size. No row is sampled.

Defined results: a null or empty text has no measures and gets the score of
its own interval; equal texts get equal scores; a document without an id has
no label and is not held out; an id with contradicting labels is no trusted
positive; repeated rows count again; without any trusted positive every score
is 0.5; an empty table gives an empty result; other columns, and those named
like results, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import require, small_batches, stored
from tessera.llm.quality import repeated_words

_SYMBOLS = b"#*$%&<>"
_LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
_DIGITS = b"0123456789"
_ENDS = (b".", b"!", b"?", b'"', b"'", b")", b":", b";")
_SHARES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75)

#: Measures and the limits of their intervals.
MEASURES: dict[str, tuple[float, ...]] = {
    "log2 of words": (3, 4, 5, 6, 7, 8, 9, 11),
    "bytes a word": (3, 4, 5, 6, 7, 8, 10, 14),
    "log2 of longest word": (2, 3, 3.5, 4, 4.5, 5, 6, 8),
    "symbols a word": (0.005, 0.02, 0.05, 0.1, 0.2, 0.5, 1, 2),
    "bars a word": _SHARES,
    "other bytes than letters": _SHARES,
    "digits": _SHARES,
    "words in capitals": _SHARES,
    "words with a capital": _SHARES,
    "words before exclamation marks": _SHARES,
    "words before stops": _SHARES,
    "words before commas": _SHARES,
    "words of three bytes or less": _SHARES,
    "words of ten bytes or more": _SHARES,
    "distinct words": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8),
    "most frequent word": _SHARES,
    "words equal to the one before": _SHARES,
    "words in repeated windows": _SHARES,
    "repeated lines": _SHARES,
    "ended lines": (0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95),
}
_LIMITS = [np.array(v) for v in MEASURES.values()]
#: Weights of a measure: one per interval and one for texts without words.
WIDTH = max(map(len, _LIMITS)) + 2
SIZE = WIDTH * len(MEASURES)


def intervals(text: str | None) -> bytes:
    """The interval of each measure of a text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return bytes([WIDTH - 1]) * len(MEASURES)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    size = int(lengths.sum())
    counts = Counter(words)
    last = bytes([w[-1] for w in words])
    lines = [x.rstrip() for x in data.split(b"\n")]
    lines = [x for x in lines if x]

    def without(drop: bytes) -> int:
        return len(data.translate(None, drop))

    values = (
        np.log2(n),
        size / n,
        np.log2(lengths.max()),
        (len(data) - without(_SYMBOLS)) / n,
        data.count(b"|") / n,
        (without(_LETTERS) - (len(data) - size)) / size,
        (len(data) - without(_DIGITS)) / size,
        sum(map(bytes.isupper, words)) / n,
        sum(65 <= w[0] <= 90 for w in words) / n,
        last.count(b"!") / n,
        (last.count(b".") + last.count(b"?")) / n,
        (last.count(b",") + last.count(b";") + last.count(b":")) / n,
        int((lengths <= 3).sum()) / n,
        int((lengths >= 10).sum()) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        repeated_words(words) / n,
        (len(lines) - len(set(lines))) / len(lines),
        sum(x.endswith(_ENDS) for x in lines) / len(lines),
    )
    return bytes(int(np.searchsorted(limits, v, side="right")) for limits, v in zip(_LIMITS, values))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``bins``, the intervals of the text."""
    require(docs, ["text", *keep])
    small_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "bins binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = pa.array([intervals(t.as_py()) for t in b.column(len(keep))], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], bins], names=[*keep, "bins"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def places(bins: pa.Array) -> np.ndarray:
    """A row of weight numbers per document."""
    found = np.frombuffer(b"".join(bins.to_pylist()), dtype=np.uint8).reshape(-1, len(MEASURES))
    return found.astype(np.int64) + np.arange(len(MEASURES)) * WIDTH


@dataclass(frozen=True)
class Sums:
    """Sums over one side, positives or unlabelled text, under given weights:
    documents, losses as good and as bad, features, features times the
    probability of good, and curvature."""

    n: float
    as_good: float
    as_bad: float
    features: np.ndarray
    slope: np.ndarray
    curve: np.ndarray

    @staticmethod
    def of(at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        g = weights[at].sum(axis=1)
        p = 1 / (1 + np.exp(-g))
        each = np.zeros((len(at), SIZE), dtype=np.float64)
        np.put_along_axis(each, at, 1.0, axis=1)
        return np.concatenate([
            [len(at), np.logaddexp(0, -g).sum(), np.logaddexp(0, g).sum()],
            each.sum(axis=0), p @ each, ((each * (p * (1 - p))[:, None]).T @ each).ravel(),
        ])

    @staticmethod
    def read(v: np.ndarray) -> "Sums":
        n = max(v[0], 1.0)
        a, b, c = v[3 : 3 + SIZE], v[3 + SIZE : 3 + 2 * SIZE], v[3 + 2 * SIZE :]
        return Sums(v[0], v[1] / n, v[2] / n, a / n, b / n, c.reshape(SIZE, SIZE) / n)


LENGTH = 3 + 2 * SIZE + SIZE * SIZE
BLOCK = 8192
#: Tasks that add up the sums of all others, so that the driver gets these only.
ADDERS = 8


def sums(rows: DataFrame, weights: np.ndarray) -> tuple[Sums, Sums]:
    """Sums over the positives and over all rows (``bins``, ``positive``)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, LENGTH))
        for b in batches:
            at = places(b.column("bins"))
            good = b.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            for i in range(0, len(at), BLOCK):
                total[1] += Sums.of(at[i : i + BLOCK], weights)
                total[0] += Sums.of(at[i : i + BLOCK][good[i : i + BLOCK]], weights)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * LENGTH)
        for b in batches:
            for v in b.column("v"):
                total += np.frombuffer(v.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    parts = rows.select("bins", "positive").mapInArrow(each, "v binary").repartition(ADDERS).mapInArrow(added, "v binary").collect()
    total = np.sum([np.frombuffer(bytes(r.v)) for r in parts], axis=0).reshape(2, LENGTH)
    return Sums.read(total[0]), Sums.read(total[1])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    prior: float
    risk: float


def _step(slope: np.ndarray, curve: np.ndarray, ridge: float) -> np.ndarray:
    """A Newton step, no longer than two in any weight."""
    step = np.linalg.solve(curve + ridge * np.eye(SIZE), slope)
    return step / max(1.0, np.abs(step).max() / 2)


def positives_against_all(rows: DataFrame, ridge: float, rounds: int = 8) -> np.ndarray:
    """Weights that order documents by how like the positives they are."""
    w = np.zeros(SIZE)
    for _ in range(rounds):
        p, u = sums(rows, w)
        slope = p.slope - p.features + u.slope + ridge * w
        step = _step(slope, p.curve + u.curve, ridge)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return w


def top_share(rows: DataFrame, weights: np.ndarray, cells: int = 1000, doubt: float = 0.1) -> float:
    """The share of good documents among ``rows``, from the purest top of the
    order by ``weights``. The driver gets one row per cell of the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = 1 / (1 + np.exp(-weights[places(b.column("bins"))].sum(axis=1)))
            yield pa.RecordBatch.from_arrays([pa.array((p * cells).astype(np.int32)), b.column("positive")], names=["cell", "positive"])

    found = rows.select("bins", "positive").mapInArrow(run, "cell int, positive boolean").groupBy("cell").agg(
        F.count(F.lit(1)).alias("u"), F.count_if("positive").alias("p")).collect()
    top = sorted(((r.cell, r.u, r.p) for r in found), reverse=True)
    u, p = np.cumsum([x[1] for x in top]), np.cumsum([x[2] for x in top])
    chance = np.sqrt(np.log(4 / doubt) / 2) * (1 / np.sqrt(u[-1]) + 1 / np.sqrt(p[-1]))
    some = p > 0
    share_u, share_p = u[some] / u[-1], p[some] / p[-1]
    best = np.argmin((share_u + chance) / share_p)
    return float(min(share_u[best] / share_p[best], 1 - 1 / (u[-1] + 1)))


def estimated_prior(rows: DataFrame, ridge: float) -> float:
    """The share of good documents. When a half has no positive, all rows are
    ordered by their own model."""
    side = F.pmod(F.xxhash64("bins"), F.lit(2))
    known = {r.side: r.p for r in rows.groupBy(side.alias("side")).agg(F.count_if("positive").alias("p")).collect()}
    if not (known.get(0) and known.get(1)):
        return top_share(rows, positives_against_all(rows, ridge))
    halves = [rows.filter(side == h) for h in (0, 1)]
    return float(np.mean([top_share(halves[1 - h], positives_against_all(halves[h], ridge)) for h in (0, 1)]))


def fitted(rows: DataFrame, ridge: float = 1e-2, rounds: int = 12) -> Model | None:
    """The model of rows (``bins``, ``positive``); None without positives."""
    if rows.filter("positive").isEmpty():
        return None
    prior = estimated_prior(rows, ridge)
    w, best = np.zeros(SIZE), None
    for _ in range(rounds):
        p, u = sums(rows, w)
        negatives = u.as_bad - prior * p.as_bad
        risk = prior * p.as_good + max(negatives, 0.0)
        if best is None or risk < best.risk:
            best = Model(w, prior, risk)
        if negatives >= 0:
            slope = u.slope - prior * p.features + ridge * w
        else:  # the estimated loss of the negatives is raised to zero again
            slope = prior * p.slope - u.slope
        step = _step(slope, u.curve, ridge)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    return best


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows`` with ``score`` in place of ``bins``."""
    keep = [c for c in rows.columns if c != "bins"]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), "score double"])
    weights = np.zeros(SIZE) if model is None else model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = 1 / (1 + np.exp(-weights[places(b.column("bins"))].sum(axis=1)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(p, pa.float64())], names=[*keep, "score"])

    return rows.mapInArrow(run, schema)


def held_out(id: Column) -> Column:
    """The quarter of the ids whose labels are never read."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per document ``held_out``, ``score`` and ``predicted``, learnt from the
    labels ``quality`` of the ids that are not held out."""
    require(labels, ["doc_id", "quality"])
    bins = measured(docs, ["doc_id"])
    trusted = labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("quality").alias("least")).filter("least = 1").select("doc_id", F.lit(True).alias("positive"))
    rows = stored(bins, "quality-intervals").join(trusted, "doc_id", "left")
    rows = stored(rows.select("doc_id", "bins", F.coalesce("positive", F.lit(False)).alias("positive")), "quality-rows")
    found = scored(rows.select("doc_id", "bins"), fitted(rows))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
