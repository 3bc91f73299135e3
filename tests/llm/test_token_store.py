"""Elias-Fano sequences and token files: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import token_store as S
from tessera.llm.elias_fano import EliasFano

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
SMOKE = "/root/testdata/sf0.001/documents.parquet"


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("n,most", [(0, 0), (1, 0), (1, 9), (64, 3), (65, 10**6), (3000, 10**13), (1000, 2**63), (200, 1)])
def test_elias_fano_round_trip(n, most):
    rng = random.Random(n)
    values = np.array(sorted(rng.randrange(most + 1) for _ in range(n)), dtype=np.uint64)
    data = b"xy" + EliasFano.of(values).to_bytes() + b"rest"
    back, at = EliasFano.from_buffer(memoryview(data), 2)
    assert data[at:] == b"rest"
    assert (back.get(np.arange(n)) == values).all()
    pick = np.array([rng.randrange(n) for _ in range(50)] if n else [], dtype=np.int64)
    assert (back.get(pick) == values[pick]).all()


def test_elias_fano_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(EliasFano.of(values).to_bytes()) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


def random_texts(n):
    rng = random.Random(7)
    parts = [" ", "  ", "\n", " \n", "\t", "\x1c", "\xa0", "<|endoftext|>", "<|endoftext|> ", "a", "don't", "é日", "the,", "42", "\x00", "😀"]
    return ["", " ", "\n", "a ", *("".join(rng.choices(parts, k=rng.randrange(1, 10))) for _ in range(n))]


def test_encoder_equals_the_library(monkeypatch):
    texts = random_texts(3000)
    encoder = S.LibraryEncoder(FILE)
    assert [list(memoryview(x).cast("H")) for x in encoder.encode_all(texts)] == [ids_of(t) for t in texts]
    monkeypatch.setattr(S, "BLOCK_CHARS", 30)
    monkeypatch.setattr(S, "CACHED", 3)
    encoder = S.LibraryEncoder(FILE)
    texts = [" ".join(texts[i : i + 9]) for i in range(0, 900, 9)] + ["word " * 50]
    assert [list(memoryview(x).cast("H")) for x in encoder.encode_all(texts)] == [ids_of(t) for t in texts]


def check(report, given):
    """``given``: (doc_id, text) in file order."""
    start, want = 0, []
    for d, t in given:
        ids = np.array([*ids_of(t), 0], dtype="<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in report.collect()), key=lambda r: r[1])
    assert got == want


def test_given_documents(spark):
    docs = spark.read.parquet(SMOKE).repartition(3)
    check(S.token_file_report(docs, FILE), sorted((r.doc_id, r.text) for r in docs.collect()))


def test_cases_and_many_files(spark, monkeypatch, tmp_path):
    rows = [(5, "a b"), (-3, None), (None, "x"), (5, "a b"), (2**62, ""), (0, "<|endoftext|>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"tie": F.lit(1), "start": F.lit("x")})
    check(S.token_file_report(df, FILE), [(None, "x"), (-3, ""), (0, "<|endoftext|>"), (5, "a b"), (5, "a b"), (2**62, "")])
    assert S.token_file_report(df.limit(0), FILE).count() == 0


def test_random_access(tmp_path):
    numbers = [np.array(ids_of(t) + [0], dtype="<u2") for t in random_texts(40)]
    data = b"".join(S.file_bytes([None, *range(len(numbers) - 1)], [n.tobytes() for n in numbers], np.dtype("<u2")))
    f = S.TokenFile(data)
    assert f.doc_ids() == [None, *range(len(numbers) - 1)]
    assert all((f.document(i) == n).all() for i, n in enumerate(numbers))
    with pytest.raises(ValueError):
        S.TokenFile(b"x" * 100)
    wide = S.TokenFile(b"".join(S.file_bytes([1], [np.array([70_000], dtype="<u4").tobytes()], np.dtype("<u4"))))
    assert wide.document(0).tolist() == [70_000]
