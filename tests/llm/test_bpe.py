"""Prefix encodings against plain merges and the public library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tessera.llm import bpe as B

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMOKE = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def encoder():
    return B.text_encoder(FILE, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def random_bytes(rng, n):
    parts = [b"the", b"ing", b"aa", b"a", b" ", "é".encode(), "日本".encode(), b"\xff\x00", b"ther", b"zz", b"1", b"-"]
    return b"".join(rng.choices(parts, k=n))


def test_pairs_stay_apart_as_merging_says(encoder):
    v, rng = encoder.vocabulary, random.Random(1)
    short = [t for t, b in enumerate(v.bytes) if 0 < len(b) < 4]
    for _ in range(6000):
        a, b = rng.choice(short if rng.random() < 0.7 else range(len(v.bytes))), rng.choice(short)
        assert v.stay_apart(a, b) == (v.merge(v.bytes[a] + v.bytes[b]) == [a, b]), (a, b)


def test_every_prefix_append_and_edit(encoder):
    v, rng = encoder.vocabulary, random.Random(2)
    for _ in range(120):
        data = random_bytes(rng, 12)
        table = B.PrefixEncoding(v, data[:5])
        table.append(data[5:])
        for i in range(len(data) + 1):
            assert table.tokens(i) == v.merge(data[:i])
        s = rng.randrange(len(data))
        e = rng.randrange(s, len(data) + 1)
        new = random_bytes(rng, rng.randrange(4))
        table.replace(s, e, new)
        assert table.data == data[:s] + new + data[e:]
        assert table.tokens() == v.merge(table.data)
        assert table.last == B.PrefixEncoding(v, table.data).last


def test_edit_far_from_the_end_keeps_the_rest(encoder):
    v = encoder.vocabulary
    data = b"thndblering" * 400
    table = B.PrefixEncoding(v, data)
    calls = []
    real, v.stay_apart = v.stay_apart, lambda a, b: calls.append(1) or real(a, b)
    try:
        table.replace(10, 13, b"xyzzy")
    finally:
        del v.stay_apart
    assert table.last == B.PrefixEncoding(v, table.data).last
    assert len(calls) < 2000


def texts():
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "　", "a", "don't", "THE'LL", "é", "日本語", "😀",
             "x1", "42", "...", "<|endoftext|>", "The", "the,", "\x00", "ﬀ", "ǅ", "²", "​", "_"]
    out = ["", " ", "\n", "a", " a", "a ", "\na", "a\n", "'s", "aaaa" * 200]
    return out + ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(4000)]


def test_texts_equal_the_library(encoder, library):
    wrong = [t for t in texts() if encoder.encode(t) != library.encode_ordinary(t)]
    assert not wrong, wrong[:5]


def test_long_texts_and_small_tables(library, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_CHARS", 50)
    monkeypatch.setattr(B, "CACHED", 5)
    e = B.TextEncoder(library._mergeable_ranks, public_tokenizers.PATTERN)
    for t in [" ".join(texts()[:300]), "ab" * 1000, " " * 300, "word " * 100, "\n".join(["a b"] * 90)]:
        assert e.encode(t) == library.encode_ordinary(t)
        assert e.decode(e.encode(t)) == t.encode()


def test_given_documents_and_round_trip(spark, library):
    docs = spark.read.parquet(SMOKE)
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in B.encoding_digests(docs, FILE, public_tokenizers.PATTERN).collect():
        ids = library.encode_ordinary(given[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(given[r.doc_id].encode()).hexdigest()


def test_table_cases(spark):
    rows = [(1, None, "k"), (None, "", "k"), (2, "a b", None), (2, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    enc = B.encoded(df, FILE, public_tokenizers.PATTERN)
    back = B.decoded(enc, FILE, public_tokenizers.PATTERN)
    assert back.columns == ["doc_id", "text", "token_ids", "decoded"]
    assert sorted(bytes(r.decoded) for r in back.collect()) == [b"", b"", b"a b", b"a b"]
    assert sorted(r.n_tokens for r in B.encoding_digests(df, FILE, public_tokenizers.PATTERN).collect()) == [0, 0, 2, 2]
    assert B.encoding_digests(df.limit(0), FILE, public_tokenizers.PATTERN).count() == 0
