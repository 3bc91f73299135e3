"""The pipeline's rows against brute force over the same documents."""

import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as C
from tessera.llm import bpe, quality
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_decontam import brute_words
from tests.llm.test_pii import BASE, brute_terms, entities_of, valid
from tests.llm.test_quality import brute as base_measures
from tests.llm.test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def votes(m):
    out = []
    for r in quality.RULES:
        base = m[r.per] if r.per else 1
        x = m[r.measure] / base if base else 0
        if base < r.least:
            out.append(0)
        elif r.good < r.bad:
            out.append(1 if x <= r.good else -1 if x > r.bad else 0)
        else:
            out.append(1 if x >= r.good else -1 if x < r.bad else 0)
    return tuple(out)


def kept_by_quality(texts):
    measures = {d: dict(zip(quality.MEASURES, quality.measure(t))) for d, t in texts.items()}
    patterns = Counter(votes(m) for m in measures.values())
    model = quality.fit(np.array(list(patterns)), np.array(list(patterns.values()), dtype=float))
    out = {}
    for d, t in texts.items():
        n, _, _, _, repeated = base_measures(t)
        fit = []
        for share, says in zip(model.shares, model.says_good):
            p = share
            for v, g in zip(votes(measures[d]), says):
                p *= g if v == 1 else 1 - g if v == -1 else 1
            fit.append(p)
        if n >= 10 and 100 * repeated <= 20 * n and fit[0] / sum(fit) >= 0.5:
            out[d] = t
    return out


def cut(text, hit):
    places = [m.span() for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]
    out, at, k = "", 0, 0
    while k < len(places):
        if k in hit:
            out += text[at : places[k][0]]
            while k + 1 in hit:
                k += 1
            at = places[k][1]
        k += 1
    return out + text[at:]


def places(text):
    for kind, p in BASE.items():
        for m in re.finditer(p, text):
            if valid(kind, m.group()):
                yield m.start(), kind, m.end()


def sanitised(texts):
    disclosing = {}
    for v, w in brute_terms(list(texts.values())):
        disclosing.setdefault(v, set()).add(w)
    out = {}
    for d, t in texts.items():
        spans = sorted((s, list(BASE).index(k), e, f"<{k.upper()}>") for s, k, e in places(t))
        gone = set().union(*(disclosing.get(v, set()) for v in entities_of(t)))
        for m in re.finditer(r"[^\W\d_]+", t):
            if m.group().lower() in gone and not any(s < m.end() and m.start() < e for s, _, e, _ in spans):
                spans.append((m.start(), 9, m.end(), ""))
        new, at = "", 0
        for s, _, e, label in sorted(spans):
            if s >= at:
                new += t[at:s] + label
            at = max(at, e)
        out[d] = new + t[at:]
    return out


def test_rows_against_brute_force(spark):
    con = duckdb.connect()
    texts = dict(con.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    items = con.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = kept_by_quality(texts)
    groups = brute_components({d: brute_fp(t, 4) for d, t in want.items()}, 4)
    want = {d: t for d, t in want.items() if groups[d] == d}
    dirty = {d: leaks(t, items, 10)[1] for d, t in want.items()}
    assert any(dirty.values())
    want = sanitised({d: cut(t, dirty[d]) for d, t in want.items()})
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = C.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(want) and len(got) == len(want) < len(texts)
    for r in got:
        assert r.text == want[r.doc_id], r.doc_id
        assert r.token_ids == library.encode_ordinary(r.text) and r.n_tokens == len(r.token_ids)
        assert not leaks(r.text, items, 10)[1] or not dirty[r.doc_id]


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.limit(5).unionByName(spark.createDataFrame([(None, None, None, None, None)] * 2, docs.schema))
    for name, stage in C.STAGES:
        out = stage(spark, rows, SF)
        assert name == "encoding" or out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert out.count() <= 7


def test_brute_cut_agrees():
    assert cut("a b, c d", {1, 2}) == "a  d" and brute_words("A-b é1") == ["a", "b", "é1"]
