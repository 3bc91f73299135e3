"""Quality rules as weak supervision.

Each rule looks at one measure of a document and votes good, bad or
abstains between its two limits. Votes are counted over all documents by
pattern; there are at most 3 ** rules of them, however large the corpus, so
expectation-maximisation runs on the counts. It estimates how often each
rule says good of good documents and of each kind of bad ones, and the
shares of the kinds, without labels; a document's votes then give the
probability that it is good.

Words are runs of characters other than 0x20 and 0x09-0x0D. Defined results:
a null or empty text has no words and fails; equal rows get equal verdicts;
an empty table gives an empty result; a null id is kept as it is; other
columns are ignored, or passed through by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SHORT_BATCH_BYTES, fresh_names, require, small_batches, stored

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: ASCII letters and the bytes of characters beyond ASCII.
LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
LINE_ENDS = (b".", b"!", b"?", b'"', b"'", b")", b":", b";")
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_ended_lines", "n_letters", "n_word_bytes", "n_upper", "n_exclaims", "n_distinct",
)
MEASURED = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows that occur twice or more. Windows are numbered
    by joining the numbers of their two overlapping halves."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    first = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    if len(numbers) == len(words):
        return 0
    ranks, size = first, 1
    while size < window:
        step = min(size, window - size)
        key = ranks[: len(ranks) - step] * (len(words) + 1) + ranks[step:]
        _, ranks, counts = np.unique(key, return_inverse=True, return_counts=True)
        size += step
    twice = np.flatnonzero(counts[ranks] > 1)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    change[twice] += 1
    change[twice + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES``."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    spaces = len(data) - len(data.translate(None, SPACE))
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    return (
        len(words),
        len(text) - spaces,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(x.rstrip().endswith(LINE_ENDS) for x in lines),
        len(data) - len(data.translate(None, LETTERS)),
        len(data) - spaces,
        sum(map(str.isupper, text.split())),
        data.count(b"!"),
        len(set(words)),
    )


def measured(docs: DataFrame, keep: list[str], into: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and a struct of measures."""
    require(docs, ["text", *keep])
    small_batches(docs.sparkSession, SHORT_BATCH_BYTES)
    columns = [*keep, *(["text"] if "text" not in keep else [])]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(into, MEASURED)])
    kind = pa.struct([(m, pa.int64()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_py()) for t in b.column("text")]
            values = zip(*rows) if rows else [[] for _ in MEASURES]
            found = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), found], names=schema.names)

    return docs.select(columns).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Votes on ``measure / per``. ``good`` and ``bad`` are its limits: the
    value votes good on its side of ``good``, bad on the far side of
    ``bad``, and abstains between them, without ``per``, and where ``per``
    is under ``least``."""

    name: str
    measure: str
    per: str | None
    good: float
    bad: float
    least: int = 1

    def vote(self, m: str) -> Column:
        base = F.col(f"{m}.{self.per}") if self.per else F.lit(1)
        value = F.col(f"{m}.{self.measure}") / base
        low_is_good = self.good < self.bad
        good = value <= self.good if low_is_good else value >= self.good
        bad = value > self.bad if low_is_good else value < self.bad
        return F.when(base < self.least, 0).when(good, 1).when(bad, -1).otherwise(0)


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.1),
    Rule("repeated words", "n_repeat_words", "n_words", 0.1, 0.2),
    Rule("repeated lines", "n_dup_lines", "n_lines", 0.1, 0.3, least=3),
    Rule("long words", "word_chars", "n_words", 10.0, 15.0),
    Rule("short words", "word_chars", "n_words", 3.0, 2.0),
    Rule("letters", "n_letters", "n_word_bytes", 0.9, 0.7),
    Rule("capitals", "n_upper", "n_words", 0.2, 0.5, least=5),
    Rule("exclamations", "n_exclaims", "n_words", 0.1, 0.3),
    Rule("ended lines", "n_ended_lines", "n_lines", 0.6, 0.2),
    Rule("distinct words", "n_distinct", "n_words", 0.3, 0.1, least=50),
)


@dataclass(frozen=True)
class VoteModel:
    """Estimated kinds of documents, the first of them good and one bad kind
    per rule: ``shares[k]``, and ``says_good[k][j]``, how often rule j, if it
    votes, says good of kind k."""

    shares: tuple[float, ...]
    says_good: tuple[tuple[float, ...], ...]

    def probability(self, votes: list[Column]) -> Column:
        """Probability of the good kind after independent votes (columns of
        -1, 0, 1); an abstention says nothing."""
        up = [F.when(v == 1, 1.0).otherwise(0.0) for v in votes]
        down = [F.when(v == -1, 1.0).otherwise(0.0) for v in votes]
        against = F.lit(0.0)
        for share, says in zip(self.shares[1:], self.says_good[1:]):
            odds = F.lit(float(np.log(share / self.shares[0])))
            for u, d, good, bad in zip(up, down, self.says_good[0], says):
                odds = odds + u * float(np.log(bad / good)) + d * float(np.log((1 - bad) / (1 - good)))
            against = against + F.exp(odds)
        return F.lit(1.0) / (F.lit(1.0) + against)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, false_alarms: float = 0.01) -> VoteModel:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and
    their numbers of documents.

    Bad documents are bad in different ways, and rules that look at one way
    agree; a bad kind for each rule lets their votes depend on each other.
    A single rule's bad votes, which no other rule supports, could as well be
    false alarms of it: the rules are written to give at most
    ``false_alarms`` of these among good documents, and the estimate is held
    to that. Accuracies stay a small count away from 0 and 1.
    """
    n_rules = patterns.shape[1]
    up, down = (patterns == 1).astype(float), (patterns == -1).astype(float)
    says = np.full((n_rules + 1, n_rules), 0.8)
    says[0] = 1 - false_alarms
    says[np.arange(1, n_rules + 1), np.arange(n_rules)] = 0.1
    shares = np.array([0.8, *[0.2 / n_rules] * n_rules])
    for _ in range(rounds):
        fitness = np.log(shares) + up @ np.log(says.T) + down @ np.log(1 - says.T)
        p = np.exp(fitness - fitness.max(axis=1, keepdims=True)) if len(patterns) else fitness
        p *= (counts / p.sum(axis=1))[:, None] if len(patterns) else 1.0
        new_says = (p.T @ up + 0.5) / (p.T @ (up + down) + 1)
        new_says[0] = np.maximum((p[:, 0] @ up + 99.0) / (p[:, 0] @ (up + down) + 100.0), 1 - false_alarms)
        new_shares = (p.sum(axis=0) + 1) / (counts.sum() + n_rules + 1)
        moved = max(np.abs(new_says - says).max(), np.abs(new_shares - shares).max())
        says, shares = new_says, new_shares
        if moved < 1e-7:
            break
    return VoteModel(tuple(shares.tolist()), tuple(map(tuple, says.tolist())))


def voted(rows: DataFrame, m: str, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, list[str]]:
    """``rows`` with a column per rule, whose names are returned. Later
    expressions read the votes many times, so they are columns first."""
    names = fresh_names(rows.columns, [f"vote_{j}" for j in range(len(rules))])
    return rows.select("*", *[r.vote(m).alias(n) for r, n in zip(rules, names)]), names


def fit_votes(rows: DataFrame, m: str) -> VoteModel:
    """The model of all rows; the driver gets one row per vote pattern."""
    with_votes, names = voted(rows, m)
    found = with_votes.groupBy(names).count().collect()
    patterns = np.array([r[:-1] for r in found], dtype=np.int64).reshape(len(found), len(names))
    return fit(patterns, np.array([r[-1] for r in found], dtype=float))


def judged(rows: DataFrame, m: str, model: VoteModel, least: float = 0.5) -> tuple[DataFrame, tuple[Column, Column, Column]]:
    """``rows`` with votes, and what follows from them: ``base_failed``, the
    probability of good, and ``kept``."""
    with_votes, names = voted(rows, m)
    n, repeated = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    failed = (n < 10) | (repeated * 100 > n * 20)
    p = model.probability([F.col(v) for v in names])
    return with_votes, (failed, p, ~failed & (p >= least))


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document the measures, the verdict of the fixed rule and of the
    vote model."""
    rows = stored(measured(docs, ["doc_id"], "m"), "quality")
    found, (failed, p, kept) = judged(rows, "m", fit_votes(rows, "m"))
    base = [F.col(f"m.{x}").alias(x) for x in MEASURES[:5]]
    return found.select("doc_id", *base, failed.alias("base_failed"), kept.alias("kept"), p.alias("quality"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept. Documents are measured twice, to
    fit the votes and to judge, and never shuffled."""
    (m,) = fresh_names(docs.columns, ["measures"])
    model = fit_votes(measured(docs, [], m), m)
    found, (_, _, kept) = judged(measured(docs, docs.columns, m), m, model)
    return found.filter(kept).select(docs.columns)
