"""Pseudo-likelihood: exact sums against loops, gradients against
differences, and held-out gain over word frequencies."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lm_score as L

SCHEMA = "doc_id long, text string"


def small_words(texts):
    counts = Counter(w for t in texts for w in (t or "").encode().split())
    return L.word_table([(w, n) for w, n in counts.most_common(20)], np.zeros(L.BUCKETS, dtype=np.int64))


def test_word_counts_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(L, "vocabulary_size", lambda n: 3)
    texts = ["a a a b b c", "a\tb\x0bd e  f", None, "", "b é é"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    words = L.count_words(df)
    assert words.numbers == {b"a": 1, b"b": 2, "é".encode(): 3}
    counts = np.zeros(words.size)
    for w, n in {b"a": 4, b"b": 4, "é".encode(): 2}.items():
        counts[words.numbers[w]] = n
    for w in ["c", "d e", "f"]:
        counts[4 + zlib.crc32(w.encode()) % L.BUCKETS] += 1
    mass = np.bincount(words.class_of[1:], weights=counts[1:] + 1, minlength=L.CLASSES)
    assert np.allclose(np.exp(words.log_share[1:]), (counts[1:] + 1) / mass[words.class_of[1:]])
    assert words.encode("a zz b").tolist() == [1, 4 + zlib.crc32(b"zz") % L.BUCKETS, 2]


def test_probabilities_sum_to_one():
    words = small_words(["a b c d e f g", "a a b"])
    net = L.Network.fresh(words.size)
    _, _, z = net.forward(np.array([[1, 2, 3, 4], [0, 0, 5, 6]]))
    for row in z:
        assert np.exp(row[words.class_of[1:]] + words.log_share[1:]).sum() == pytest.approx(1, abs=1e-4)


def test_words_beyond_the_vocabulary_have_their_own_share(spark, monkeypatch):
    """All words of a bucket and the one never counted make up the bucket."""
    monkeypatch.setattr(L, "vocabulary_size", lambda n: 2)
    bucket = lambda w: zlib.crc32(w.encode()) % L.BUCKETS
    c, d, e, unseen = [w for w in (f"w{i}" for i in range(9000)) if bucket(w) == 5][:4]
    other = next(w for w in (f"w{i}" for i in range(9000)) if bucket(w) != 5)
    texts = [f"a a a a b b b b {c} {c} {c} {d} {d} {e} {other}", c, d, e, other, unseen, f"{d} a {e} {c}", None]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    words, counts = L.counted_words(df.filter("doc_id = 0"))
    net = L.Network.fresh(words.size)
    got = {r.doc_id: r.log_prob for r in L.scores(df, net, words, counts=counts).collect()}
    own = {c: 3 / 7, d: 2 / 7, e: 1 / 7, unseen: 1 / 7, other: 1 / 2}
    for i, t in enumerate(texts):
        of_buckets = L.log_probabilities(net, words, [words.encode(t)]).sum()
        assert got[i] == pytest.approx(of_buckets + sum(math.log(own.get(w, 1)) for w in (t or "").split()), abs=1e-5)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    net = L.Network.fresh(30)
    around, classes = rng.integers(0, 30, (200, 4)), rng.integers(0, 5, 200)
    loss = lambda: -net.forward(around)[2][np.arange(200), classes].mean()
    before = loss()
    old = [w.copy() for w in net.weights]
    net.step(around, classes)
    moved = [w - o for w, o in zip(net.weights, old)]
    net.weights = old
    for k, (i, d) in enumerate((int(np.abs(m).argmax()), m) for m in moved):  # against finite differences
        flat = net.weights[k].reshape(-1)
        flat[i] += 1e-2
        up = loss()
        flat[i] -= 2e-2
        down = loss()
        flat[i] += 1e-2
        assert np.sign(d.reshape(-1)[i]) == -np.sign(up - down)
    for _ in range(60):
        net.step(around, classes)
    assert loss() < before - 0.3


def test_scores_equal_loops(spark):
    texts = ["a b c a b", None, "", "one", "a b c d e f g h " * 400, "x y"]
    words = small_words(texts)
    net = L.Network.fresh(words.size)
    df = spark.createDataFrame([*enumerate(texts), (None, "a b")], SCHEMA)
    got = {r.doc_id: r for r in L.scores(df, net, words).collect()}
    assert len(got) == 7
    for d, t in enumerate(texts):
        ids = [0, 0, *words.encode(t).tolist(), 0, 0]
        want = 0.0
        for i in range(2, len(ids) - 2):
            z = net.forward(np.array([[ids[i - 2], ids[i - 1], ids[i + 1], ids[i + 2]]]))[2][0]
            want += z[words.class_of[ids[i]]] + words.log_share[ids[i]]
        assert got[d].n_words == len(ids) - 4
        assert got[d].log_prob == pytest.approx(want, rel=1e-4, abs=1e-3)
        assert got[d].mean_log_prob == (pytest.approx(want / got[d].n_words, rel=1e-4) if got[d].n_words else None)


def test_training_beats_frequencies_on_unseen_text(spark, monkeypatch):
    """Sentences of a fixed order; the same words shuffled score lower."""
    monkeypatch.setattr(L, "FAN_IN", 2)
    rng = random.Random(2)
    order = [f"w{i}" for i in range(40)]

    def sentence():
        s = rng.randrange(20)
        return " ".join(order[s : s + 18])

    train = [" ".join(sentence() for _ in range(6)) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(train)), SCHEMA).repartition(5)
    words = L.count_words(df)
    net = L.train(df, words)
    unseen = [sentence() for _ in range(40)]
    mixed = [" ".join(rng.sample(t.split(), 18)) for t in unseen]
    ordered = L.log_probabilities(net, words, [words.encode(t) for t in unseen]).mean()
    shuffled = L.log_probabilities(net, words, [words.encode(t) for t in mixed]).mean()
    counts = Counter(w for t in train for w in t.split())
    by_frequency = np.mean([np.log(counts[w] / sum(counts.values())) for t in unseen for w in t.split()])
    assert ordered > by_frequency + 0.5 and ordered > shuffled + 0.5


def test_empty_table(spark):
    assert L.pseudo_likelihood(spark.createDataFrame([], SCHEMA)).count() == 0
    one = L.pseudo_likelihood(spark.createDataFrame([(1, None), (1, None)], SCHEMA)).collect()
    assert [(r.n_words, r.log_prob, r.mean_log_prob) for r in one] == [(0, 0.0, None)] * 2


def test_vocabulary_grows_with_the_corpus():
    sizes = [L.vocabulary_size(n) for n in (0, 10**6, 10**8, 4 * 10**8, 10**9, 10**13)]
    assert sizes == [8191, 8191, 20000, 40000, 63244, 64511] and sizes[-1] + L.BUCKETS + 1 <= 1 << 16


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """2 and 32 partitions of rows in other orders, several shards, a text
    that is a third of all rows, clashing names, a long text."""
    monkeypatch.setattr(L, "LOCAL", 400)
    monkeypatch.setattr(L, "FAN_IN", 3)
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(60)], k=rng.randrange(1, 40))) for _ in range(300)] + ["the same text"] * 150
    texts += ["", None, "long text " * 20_000]
    data = [(i, t, "row", "numbers", 1) for i, t in enumerate(texts)]
    found = []
    for parts, seed in ((2, 1), (32, 2)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA + ", row string, numbers string, n long").repartition(parts)
        rows = L.pseudo_likelihood(df).collect()
        found.append({r.doc_id: (r.n_words, r.log_prob) for r in rows})
    assert len(found[0]) == len(texts) and found[0].keys() == found[1].keys()
    for i, (n, p) in found[0].items():
        assert found[1][i][0] == n and found[1][i][1] == pytest.approx(p, rel=1e-6, abs=1e-6)
    assert found[0][len(texts) - 1][0] == 40_000


def test_copies_weigh_as_often():
    rng = np.random.default_rng(1)
    around, classes = rng.integers(0, 30, (50, 4)), rng.integers(0, 5, 50)
    copies = rng.integers(1, 4, 50)
    a, b = L.Network.fresh(30), L.Network.fresh(30)
    a.step(around, classes, copies)
    b.step(np.repeat(around, copies, axis=0), np.repeat(classes, copies))
    for x, y in zip(a.weights, b.weights):
        assert np.allclose(x, y, atol=1e-4)


def test_frequent_words_beyond_the_vocabulary_are_not_joined(spark, monkeypatch):
    """Their counts go to every task, as many as ``MIDDLE`` allows; only rarer
    words are left to the join, and the scores are the same."""
    monkeypatch.setattr(L, "vocabulary_size", lambda n: 2)
    texts = ["a a a a a a b b b b b c c c c d d d e e f", "a c d e f zz", "b b", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    net, found = L.Network.fresh(3 + L.BUCKETS), []
    for most, left in ((4, {b"e", b"f", b"zz"}), (0, {b"c", b"d", b"e", b"f", b"zz"})):
        monkeypatch.setattr(L, "MIDDLE", most)
        words, counts = L.counted_words(df)
        assert list(words.numbers) == [b"a", b"b"] and len(words.middle) <= most
        rows = L.encoded_rows(df, words)
        assert {bytes(t.word) for r in rows.collect() for t in r.tail} == left
        found.append({r.doc_id: r.log_prob for r in L.scored(rows, net, words, counts).collect()})
        without = {r.doc_id: r.log_prob for r in L.scored(rows, net, words).collect()}
        assert without[1] == pytest.approx(found[-1][1] - math.log(5 * 4 * 3 * 2), abs=1e-9)
    assert found[0].keys() == found[1].keys()
    assert all(found[0][i] == pytest.approx(p, rel=1e-12) for i, p in found[1].items())


def test_least_counts_of_frequent_words(spark, monkeypatch):
    counts = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([10**9, 10**9 + 1, 5000, 300, 7, 7, 7, 2, 1, 1])], "word string, n long")
    n_of = lambda least: counts.filter(f"n >= {least}").count()
    for size, most in ((1, 0), (3, 1), (4, 6), (6, 7), (9, 8), (99, 99)):
        monkeypatch.setattr(L, "MIDDLE", most)
        top, middle = L._least_counts(counts, size)
        assert n_of(top) >= min(size, 10) and n_of(middle) <= most and middle > 1


def test_a_task_writes_one_mean_of_its_shards(spark, monkeypatch):
    """The weights that a round writes do not grow with the shards, as long as
    these are few."""
    monkeypatch.setattr(L, "LOCAL", 30)
    monkeypatch.setattr(L, "FAN_IN", 4)
    written, plain = [], L._mean_of

    def mean_of(rows, net):
        written.append(rows.count())
        return plain(rows, net)

    monkeypatch.setattr(L, "_mean_of", mean_of)
    df = spark.createDataFrame([(i, f"w{i} w{i % 7} w{i % 5} x y") for i in range(700)], SCHEMA)
    L.train(df, L.count_words(df))
    assert len(written) == L.ROUNDS and 2 <= max(written) <= 4
