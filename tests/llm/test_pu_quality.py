"""The classifier on labels that it never sees, the risk against plain sums,
the prior on planted shares."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import pu_quality as P

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, score string, bins string, positive int"


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_labels_are_predicted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = P.quality_scores(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == is_held(r.doc_id) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    held = [(r.quality, got[r.doc_id].score) for r in labels.collect() if is_held(r.doc_id)]
    good, bad = ([s for q, s in held if q == k] for k in (1, 0))
    order = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    right = np.mean([(s >= 0.7) == (q == 1) for q, s in held])
    assert order > 0.95 and right > 0.9


def test_only_trusted_positives_matter(spark):
    """Held out and bad labels can be anything."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("doc_id < 300")
    changed = labels.select(
        "doc_id", F.when(P.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    scores = [{r.doc_id: r.score for r in P.quality_scores(docs, x).collect()} for x in (labels, changed, labels.where("quality = 1"))]
    for other in scores[1:]:
        assert max(abs(scores[0][k] - other[k]) for k in scores[0]) < 1e-6


def test_empty_null_repeated_and_long_texts(spark):
    rng = random.Random(1)
    clean = [" ".join(rng.choice(["the", "of", "and", "winter", "garden"]) for _ in range(60)) + "." for _ in range(60)]
    data = [(i, t, "en", "s", "b", 1) for i, t in enumerate(clean)]
    data += [(100 + i, "BUY!! NOW!! " * 30, "en", "s", "b", 1) for i in range(20)]
    data += [(None, clean[0], None, None, None, None), (200, None, None, None, None, None), (201, "", None, None, None, None),
             (202, " \n\t", None, None, None, None), (203, "word " * 300_000, None, None, None, None), (3, clean[3], "en", "s", "b", 1)]
    docs = spark.createDataFrame(data, DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(1, 0), (None, 1), (7, None)], "doc_id long, quality int")
    got = P.quality_scores(docs, labels).collect()
    assert len(got) == len(data)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.held_out for r in by[None]] == [False]
    assert by[None][0].score == by[0][0].score  # equal texts
    assert len(by[3]) == 2 and by[3][0].score == by[3][1].score
    assert by[200][0].score == by[201][0].score == by[202][0].score
    unlabelled, spam = ([r.score for i in span for r in by[i]] for span in (range(50, 60), range(100, 120)))
    assert min(unlabelled) > max(spam)


def test_no_positive_and_no_row(spark):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "a", "en", "", "", 0), (2, "b", "en", "", "", 0)], DOCS)
    assert {(r.score, r.predicted) for r in P.quality_scores(docs, labels).collect()} == {(0.5, 0)}
    assert P.quality_scores(docs.limit(0), labels).collect() == []


def test_sums_match_plain_ones(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "Bb", "ccc!", "|", "dd."], rng.integers(0, 30))) for _ in range(200)]
    good = rng.random(200) < 0.3
    rows = spark.createDataFrame([(bytearray(P.intervals(t)), bool(g)) for t, g in zip(texts, good)], "bins binary, positive boolean").repartition(5)
    w = rng.normal(size=P.SIZE)
    at = np.array([[i * P.WIDTH + v for i, v in enumerate(P.intervals(t))] for t in texts])
    x = np.zeros((200, P.SIZE))
    for row, places in zip(x, at):
        row[places] = 1
    g = x @ w
    p = 1 / (1 + np.exp(-g))
    for found, some in zip(P.sums(rows, w), (good, np.ones(200, bool))):
        assert found.n == some.sum()
        assert np.isclose(found.as_good, np.log1p(np.exp(-g[some])).mean()) and np.isclose(found.as_bad, np.log1p(np.exp(g[some])).mean())
        assert np.allclose(found.features, x[some].mean(axis=0)) and np.allclose(found.slope, (p[some, None] * x[some]).mean(axis=0))
        assert np.allclose(found.curve, (x[some] * (p * (1 - p))[some, None]).T @ x[some] / some.sum())


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_prior_of_planted_shares(spark, share):
    """Bad documents differ; positives are a random part of the good ones."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(6000):
        is_good = rng.random() < share
        level = rng.integers(0, 5) if is_good else rng.integers(3, 8)
        bins = [int(min(max(level + rng.integers(-1, 2), 0), 8)) if j < 4 else 2 for j in range(len(P.MEASURES))]
        rows.append((bytearray(bins), bool(is_good and rng.random() < 0.4)))
    df = spark.createDataFrame(rows, "bins binary, positive boolean")
    prior = P.estimated_prior(df, 1e-2)
    assert abs(prior - share) < 0.1


def test_negative_risk_is_not_followed(spark):
    """With a prior far too high the estimated loss of the negatives would go
    below zero; the model kept is one whose corrected risk is least."""
    rng = np.random.default_rng(6)
    rows = [(bytearray([int(rng.integers(0, 9)) for _ in P.MEASURES]), i < 12) for i in range(60)]
    model = P.fitted(spark.createDataFrame(rows, "bins binary, positive boolean"))
    assert np.isfinite(model.weights).all() and model.risk >= 0
