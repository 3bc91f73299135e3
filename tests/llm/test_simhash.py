"""SimHash near-dedup against brute force over all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash as S
from tessera.llm.components import connected_components

SCHEMA = "doc_id long, text string"


def brute_fp(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, max_bits):
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_fingerprint_matches_definition():
    for text in [None, "", " \n\t", "One", "a b c", "A b C d", "a b c d e f " * 9, "É é\x85x y\x0bz w q", "x " * 70_000]:
        assert S.simhash(text, 4) == brute_fp(text, 4)


@pytest.mark.parametrize("shingles", [S.HASH_BLOCK, S.HASH_BLOCK + 1, 70_000])
def test_every_shingle_counts(shingles, monkeypatch):
    text = " ".join(f"w{i}" for i in range(shingles + 3))
    seen = []
    digest = xxhash.xxh64_intdigest
    monkeypatch.setattr(S.xxhash, "xxh64_intdigest", lambda data, seed: seen.append(data) or digest(data, seed))
    fp = S.simhash(text, 4)
    monkeypatch.undo()
    words = text.encode().split()
    assert seen == [b" ".join(words[i : i + 4]) for i in range(shingles)]
    assert fp == brute_fp(text, 4)


def test_queries_match_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocab, k=60)) for _ in range(25)]
    texts = []
    for t in base:
        for _ in range(6):  # near copies, some of them exact
            w = t.split()
            w[rng.randrange(60)] = rng.choice(vocab)
            texts.append(" ".join(w))
        texts.append(t)
    texts += ["", None, "hi", "hi", "HI"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    fps = {i: brute_fp(t, 4) for i, t in enumerate(texts)}
    want = brute_components(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(set(want.values())) < len(texts) - 10


@pytest.mark.parametrize("chunk", [4, 64])
def test_hot_keys_are_dealt_in_chunks(spark, chunk):
    """A dense ball of fingerprints, sign bit included, and distant ones."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(120):
        v = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 6])):
            v ^= 1 << b
        values.add(v)
    values |= {rng.getrandbits(64) for _ in range(50)}
    values |= {centre ^ 1 << 63, 0, (1 << 64) - 1}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    roots = connected_components(S.links(df, len(values), 4, chunk))
    got = {r.node: r.root for r in roots.collect()}
    want = brute_components({s: v for v, s in signed.items()}, 4)
    sizes = {}
    for r in want.values():
        sizes[r] = sizes.get(r, 0) + 1
    assert got == {n: r for n, r in want.items() if sizes[r] > 1}


def test_spare_blocks_change_cost_only(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(63) for _ in range(30)]
    values += [v ^ 0b1111 << 20 for v in values[:10]]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    a = {tuple(sorted(r)) for r in S.links(df, 2, 4).collect()}
    b = {tuple(sorted(r)) for r in S.links(df, 1 << 31, 4).collect()}
    assert a == b and len(a) == 10


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (2, ""), (2, ""), (3, "a b")], SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, None), (1, 1), (2, 1), (2, 1), (3, 3)], key=str)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_deduplicated_keeps_one_of_each_group(spark):
    df = spark.createDataFrame([(5, "x y z"), (4, "x y z"), (4, "x y z"), (None, "x y z"), (9, "other words")], SCHEMA)
    df = df.withColumns({"fp": F.lit("own"), "root": F.lit(1), "component_id": F.lit(7)})
    got = S.deduplicated(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 4, 9]


def test_two_texts_of_one_id_are_two_documents(spark):
    a, b, c = ("one two three four five six " * 4, "other words stand here in their own order " * 3, "and a third text without any of them " * 3)
    rows = [(5, a), (5, b), (5, b), (6, a), (7, b), (2, c), (None, a), (None, a)]
    got = S.deduplicated(spark.createDataFrame([(d, t, "m") for d, t in rows], "doc_id long, text string, mark string"))
    assert got.columns == ["doc_id", "text", "mark"]
    assert sorted((d or 0, t) for d, t, _ in got.collect()) == sorted([(5, a), (5, b), (2, c), (0, a), (0, a)])
