"""Decontamination against a scan of every window of every document."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam as D
from tessera.llm.fm_index import FMIndex, Wavelet, suffix_array


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, window):
    w = brute_words(text)
    hit, found = set(), set()
    for item, t in items:
        p = brute_words(t)
        for i in range(max(1, len(p) - window + 1) if p else 0):
            s = p[i : i + window]
            for k in range(len(w) - len(s) + 1):
                if w[k : k + len(s)] == s:
                    hit.update(range(k, k + len(s)))
                    if item is not None:
                        found.add(str(item))
    return len(w), hit, sorted(found)


def corpus(rng, n_docs):
    vocab = [f"w{i}" for i in range(12)] + ["É1", "été"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 3, 10, 11, 16])))) for i in range(12)]
    items += [(3, items[5][1]), (None, "w1 w2 w3 w4"), (77, None), (78, "...")]
    texts = [None, "", "--- ... !", "w1"]
    for _ in range(n_docs):
        parts = [rng.choice([" ".join(rng.choices([*vocab, "other"], k=9)), rng.choice(items)[1] or ""]) for _ in range(6)]
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts).upper() if rng.random() < 0.3 else "; ".join(parts))
    return items, texts


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 37, 1000)
    w = Wavelet(seq, 37)
    at = rng.integers(0, 1001, 300)
    sym = rng.integers(0, 37, 300)
    assert [int((seq[:a] == s).sum()) for a, s in zip(at, sym)] == w.rank(sym, at).tolist()
    assert (w.access(np.arange(1000)) == seq).all()


def test_suffix_array_and_locate():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 500)
    text[rng.integers(0, 500, 30)] = 0
    text[[0, 499]] = [1, 0]
    text[np.flatnonzero((text[1:] == 0) & (text[:-1] == 0)) + 1] = 2
    text[499] = 0
    if text[498] == 0:
        text[498] = 1
    order = suffix_array(text)
    key = lambda i: [(0, j) if text[j] == 0 else (int(text[j]), 0) for j in range(i, 500)]
    assert order.tolist() == sorted(range(500), key=key)
    fm = FMIndex(text, 4, rate=7)
    phrases = np.array([[0, 1, 2], [3, 3, 1], [1, 1, 1], [0, 0, 2]])
    lengths = np.array([2, 3, 3, 1])
    lo, hi = fm.search(phrases, lengths)
    for p, n, a, b in zip(phrases, lengths, lo, hi):
        want = [i for i in range(500 - n + 1) if (text[i : i + n] == p[3 - n :]).all()]
        assert sorted(fm.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_matches_brute_force(spark, block_bytes):
    """One block of phrases, and several passes."""
    items, texts = corpus(random.Random(4), 60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hit_spans", F.lit(1))
    found, (n, s, i) = D.contamination(docs, bench, 10, block_bytes=block_bytes)
    for r in found.collect():
        want = brute(texts[r["doc_id"]], items, 10)
        got = {k for x in r[s] for k in range(x["start"], x["end"])}
        assert (r[n], got, r[i]) == want, texts[r["doc_id"]]


def test_report_digest_and_cut(spark):
    items, texts = corpus(random.Random(8), 40)
    docs = spark.createDataFrame([(k, t, -1) for k, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    docs = docs.withColumn("n_words", F.lit("own"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    report = {r.doc_id: r for r in D.contamination_report(docs, bench).collect()}
    cut = {r.doc_id: r for r in D.decontaminated(docs, bench).collect()}
    for k, t in enumerate(texts):
        n, hit, found = brute(t, items, 10)
        r = report[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        rest = [w for j, w in enumerate(brute_words(t)) if j not in hit]
        assert brute_words(cut[k].text) == rest and cut[k].n_words == "own"
        assert (cut[k].text, cut[k].n_chars) == (t, -1) if not hit else cut[k].n_chars == len(cut[k].text)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [r.contaminated for r in D.contamination_report(docs, bench.limit(0)).collect()] == [False]
    assert [r.contaminated for r in D.contamination_report(docs, bench).collect()] == [True]
    assert D.contamination_report(docs.limit(0), bench).count() == 0


def test_long_text(spark):
    """A window at the start, in the middle and at the end of 200,000 words."""
    item = " ".join(f"leak{i}" for i in range(10))
    filler = "plain words that are in no item " * 14_000
    docs = spark.createDataFrame([(1, f"{item} {filler} {item}, {filler} {item.upper()}"), (2, filler)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in D.contamination_report(docs, bench).collect()}
    assert got == {1: (30 + 2 * 7 * 14_000, 30, 1), 2: (7 * 14_000, 0, 0)}
