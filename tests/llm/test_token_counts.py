"""Token counts against the library over whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import token_counts as C

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
SMOKE = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def counter():
    return C.PieceCounter(MODEL)


def random_texts(n):
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\n ", " \n", "\n\n", "\t", "\r\n", "▁", "a", "the", " the", "Été", "日本", "<s>", "</s>",
             "<0x0A>", "\x00", "😀", "ing", "s.", "1234", ",", " ", "　", "thndble"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(n)]


def test_counts_equal_the_library(counter):
    texts = ["", " ", "\n", "a", " a", "a ", "\na", "a\n", "  ", "▁", *random_texts(8000)]
    wrong = [t for t in texts if counter.count(t) != len(LIBRARY.encode(t))]
    assert not wrong, wrong[:5]


def test_small_tables_and_long_texts(monkeypatch):
    monkeypatch.setattr(C, "CACHED", 7)
    monkeypatch.setattr(C, "PIECES_AT_A_TIME", 11)
    counter = C.PieceCounter(MODEL)
    text = "\n".join(random_texts(300)).replace("  ", " ").replace(" \n", "\n").replace("▁", "").strip()
    for t in [text, text * 50, "x y " * 400_000 + " ", "a" * 5000]:
        assert counter.count(t) == len(LIBRARY.encode(t))


def test_whole_tokens_are_proved(counter):
    assert "the" in counter.whole and "thndble" not in counter.whole
    assert all(len(LIBRARY.encode(w)) == 1 for w in list(counter.whole)[:500])


def test_table(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "the end", "x"), (2, "the end", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, C.token_counts(df, MODEL, 1).collect()), key=str)
    n = len(LIBRARY.encode("the end"))
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (None, 7, n, n > 1), (2, 7, n, n > 1)], key=str)
    assert C.token_counts(df.limit(0), MODEL, 1).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet(SMOKE)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in C.token_counts(docs, MODEL, 4096).collect():
        n = len(LIBRARY.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)
