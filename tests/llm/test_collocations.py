"""Phrases against plain counting of strings; colliding fingerprints; blocks."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as C

SCHEMA = "doc_id long, lang string, text string, n int, phrase string, rank string"


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(docs, least, inside=80, top=2000):
    f, n, first = defaultdict(Counter), Counter(), {}
    for doc_id, lang, text, *_ in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    key = tuple(w[i : i + k])
                    f[lang][key] += 1
                    if doc_id is not None:
                        first[lang, key] = min(first.get((lang, key), doc_id), doc_id)
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        rows = []
        for p, a in often.items():
            if p in longest and 100 * longest[p] >= inside * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s, first.get((lang, tuple(p.decode().split(" "))))))
    return sorted(out)


def result(spark, docs, **kw):
    return sorted(map(tuple, C.collocations(spark.createDataFrame(docs, SCHEMA), **kw).collect()))


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "The", "ÄB", "äb", "x\x00y", "日本", "c-d", "\x85", "e\xa0f", "ſ", "it's"]
    docs = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "?!"]) for _ in range(rng.randrange(0, 40)))
        docs.append((i, rng.choice([None, "und", "en", "hot", "hot", "hot"]), rng.choice([text, text, text, text, "", None]), 1, "p", "r"))
    return docs + docs[:20] + [(None, "en", "a b a b", 1, "", "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_match_plain_counts(spark, seed):
    docs = corpus(seed)
    assert result(spark, docs, least=6) == brute(docs, 6)
    assert len(brute(docs, 6)) > 50


def test_top_and_empty(spark):
    docs = corpus(5)
    assert result(spark, docs, least=4, inside=60, top=7) == brute(docs, 4, 60, 7)
    assert result(spark, [], least=1) == []
    assert result(spark, [(1, None, None, 0, "", ""), (2, "en", "", 0, "", "")], least=1) == []


def test_one_language_of_a_long_text_in_small_blocks(spark, monkeypatch):
    """Blocks of 64 bytes, words longer than a block, no sentence ends."""
    rng = random.Random(4)
    words = ["a", "bb", "ccc", "w" * 200, "é" * 70]
    data = "".join(rng.choice(words) + rng.choice([" ", "  ", " ", "."]) for _ in range(3000)).encode()
    monkeypatch.setattr(C, "BLOCK", 64)
    for n in range(1, 5):
        found = Counter()
        for _, block in C.blocks(data):
            at, _ = block.grams(n)
            found.update(block.phrases(at, n))
        want = Counter(" ".join(w[i : i + n]).encode() for w in pieces(data.decode()) for i in range(len(w) - n + 1))
        assert found == want


def test_long_text(spark):
    docs = [(1, "en", "one two three " * 400_000, 0, "", ""), (2, "en", "z" * 3_000_000 + " one two", 0, "", "")]
    assert result(spark, docs, least=30) == brute(docs, 30)


def test_fingerprints_of_equal_phrases_do_not_depend_on_place():
    rng = random.Random(2)
    words = [rng.choice(["x", "yy", "zzz", "\x00"]) for _ in range(500)]
    block = C.Block(" ".join(words).encode(), 10_000)
    for n in range(1, 5):
        at, prints = block.grams(n)
        by = {}
        for phrase, p in zip(block.phrases(at, n), prints):
            assert by.setdefault(phrase, p) == p
        assert len(set(by.values())) == len(by)


def test_colliding_fingerprints_change_no_result(spark, monkeypatch):
    """Seven fingerprints for all words and phrases: every count is still that of
    the text."""
    docs = corpus(3, 120)
    data = "a b c a b d e a c".encode()
    block = C.Block(data, len(data))
    block.words = block.words % np.uint64(2)
    ids = block.exact()
    words = data.split()
    assert all((ids[i] == ids[j]) == (words[i] == words[j]) for i in range(9) for j in range(9))
    first, counts, _ = C.distinct_phrases(ids, np.arange(8), np.zeros(8, np.uint64), np.zeros(8, np.int64), 2)
    got = dict(zip(block.phrases(first, 2), counts))
    assert got == {b"a b": 2, b"b c": 1, b"c a": 1, b"b d": 1, b"d e": 1, b"e a": 1, b"a c": 1}
    # a bitmap of 64 bits lets nearly everything through
    low = C.frequent_phrases(spark.createDataFrame(docs, SCHEMA), least=3, filter_bits=6).counts.orderBy("lang", "phrase").collect()
    full = C.frequent_phrases(spark.createDataFrame(docs, SCHEMA), least=3).counts.orderBy("lang", "phrase").collect()
    assert low == full and len(low) > 100


def test_scores_of_counts_beyond_64_bits(spark):
    row = spark.range(1).select(
        F.expr("(2000000BD * CAST(4000000000000000000 AS DECIMAL(19,0))) div (CAST(9000000000000000000 AS DECIMAL(19,0)) + CAST(9000000000000000001 AS DECIMAL(19,0)))").alias("s")
    ).first()
    assert row.s == 2000000 * 4000000000000000000 // 18000000000000000001
