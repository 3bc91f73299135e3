"""Quality measures against their definitions; the vote model on planted
accuracies and on labels that it never sees."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality as Q

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    repeat = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))


def test_measures_match_definitions():
    rng = random.Random(1)
    parts = ["a", "b", "é", "\x85", "\xa0", " ", " ", "\n", "\t", "\x1c", "#", "|", "<", "日本", "X!"]
    texts = [None, "", " \n ", "one two three four five", "a b c d e " * 2, "x\nx\n x\nx"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(800)]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(4, 40))) for _ in range(300)]
    for t in texts:
        assert Q.measure(t)[:5] == brute(t), repr(t)


def test_votes_recover_planted_kinds():
    """Good documents and two bad kinds that each trip two rules together."""
    rng = np.random.default_rng(3)
    n = 40_000
    kind = rng.choice(3, n, p=[0.85, 0.1, 0.05])
    says_good = np.array([[0.995] * 5, [0.1, 0.2, 0.95, 0.95, 0.9], [0.95, 0.95, 0.1, 0.1, 0.9]])
    votes = np.where(rng.random((n, 5)) < says_good[kind], 1, -1) * (rng.random((n, 5)) >= 0.15)
    patterns, back, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = Q.fit(patterns, counts.astype(float))
    assert abs(model.shares[0] - 0.85) < 0.02
    assert np.abs(np.array(model.says_good[0]) - 0.995).max() < 0.01
    up, down = (patterns == 1).astype(float), (patterns == -1).astype(float)
    says = np.array(model.says_good)
    fit = np.exp(np.log(model.shares) + up @ np.log(says.T) + down @ np.log(1 - says.T))
    p = (fit[:, 0] / fit.sum(axis=1))[back.ravel()]
    assert ((p >= 0.5) == (kind == 0)).mean() > 0.97


def test_probability_column_is_the_posterior(spark):
    model = Q.VoteModel((0.7, 0.2, 0.1), ((0.99, 0.98), (0.2, 0.6), (0.7, 0.1)))
    votes = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    df = spark.createDataFrame(votes, "a int, b int")
    for r in df.select("a", "b", model.probability([F.col("a"), F.col("b")]).alias("p")).collect():
        like = [s * (g[0] if r.a == 1 else 1 - g[0] if r.a else 1) * (g[1] if r.b == 1 else 1 - g[1] if r.b else 1)
                for s, g in zip(model.shares, model.says_good)]
        assert abs(r.p - like[0] / sum(like)) < 1e-12


def test_agrees_with_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    report = Q.quality_report(docs).withColumnRenamed("quality", "p").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in report.filter("n_words >= 10").groupBy("quality", "kept").count().collect()}
    assert n.get((1, True), 0) > 0.97 * (n.get((1, True), 0) + n.get((1, False), 0))
    assert n.get((0, False), 0) > 0.9 * (n.get((0, True), 0) + n.get((0, False), 0))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in report.collect():
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_cases(spark):
    clean = "Here is an ordinary sentence with some words that differ from each other, ended well."
    rows = [(1, None, 1), (2, "", 1), (None, clean, 1), (3, clean, 1), (3, clean, 1), (4, "## $$ %% " * 20, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long").withColumn("measures", F.lit("own"))
    kept = {(r.doc_id, r.kept) for r in Q.quality_report(df).collect()}
    assert kept == {(1, False), (2, False), (None, True), (3, True), (4, False)}
    out = Q.accepted(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.measures) for r in out.collect()) == [(0, "own"), (3, "own"), (3, "own")]
    assert Q.quality_report(df.limit(0)).count() == 0 and Q.accepted(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [4, 5, 6, 7, 60])
def test_repeated_words_windows(n):
    rng = random.Random(n)
    for _ in range(50):
        words = [rng.choice([b"a", b"b"]) for _ in range(n)]
        assert Q.repeated_words(words) == brute(b" ".join(words).decode())[4]


def test_long_text(spark):
    rng = random.Random(6)
    text = "\n".join(" ".join(rng.choices([f"w{i}" for i in range(5000)], k=20)) + "." for _ in range(12_000))
    assert Q.measure(text)[:5] == brute(text)
    got = Q.quality_report(spark.createDataFrame([(1, text), (2, "x " * 500_000)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.base_failed) for r in got} == {1: (240_000, False), 2: (500_000, True)}


def test_batches_of_long_texts_are_small(spark):
    """Workers hold several batches, with the texts in them, at a time."""
    Q.measured(spark.createDataFrame([("a b",)], "text string"), [], "m")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
