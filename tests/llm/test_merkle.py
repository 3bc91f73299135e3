"""Merkle manifests against a plain recursive tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, hash string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """Last node, and per node its siblings (before, after) in every run."""
    paths = [[] for _ in nodes]
    spans = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(i, min(i + fanout, len(nodes)))) for i in range(0, len(nodes), fanout)]
        for run in runs:
            for i in run:
                step = ("".join(nodes[j] for j in run if j < i), "".join(nodes[j] for j in run if j > i))
                for k in spans[i]:
                    paths[k].append(step)
        spans = [[k for i in run for k in spans[i]] for run in runs]
        nodes = [sha(*(nodes[i] for i in run)) for run in runs]
    return (nodes[0] if nodes else None), paths


def brute(docs, fanout=3):
    groups = defaultdict(list)
    for d in docs:
        groups[d[1]].append((d, leaf(*d[:5])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for s in names:
        found = sorted(groups[s], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made.append((found, *climb([h for _, h in found], fanout)))
    root, above = climb([top for _, top, _ in made], fanout)
    out = []
    for (found, top, paths), upper in zip(made, above):
        for (d, h), path in zip(found, paths):
            whole = path + upper
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0
            end = leaf(*d[:4], d[4].replace("\n", "") if hit and d[4] is not None else d[4])
            for b, a in whole:
                end = sha(b, end, a)
            out.append((d[0], h, top, root, sha(*(b + a for b, a in whole)), end, end == root))
    return sorted(out, key=str)


def result(spark, docs):
    return sorted(map(tuple, M.manifest_report(spark.createDataFrame(docs, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_report_is_that_of_a_plain_tree(spark, seed):
    """Groups of 1 to 60 rows, one of a third of all; null and empty fields,
    equal keys, repeated rows, clashing names."""
    rng = random.Random(seed)
    sources = [None, "", "a", "ä", "z", "日本", "=", "b\n"]
    docs = []
    for i in range(180):
        s = "hot" if i % 3 == 0 else rng.choice(sources)
        text = rng.choice([None, "", "x\ny", "no line end", "\n", "é\n" * 3, f"text {i}\n"])
        docs.append((rng.choice([None, i, i // 2, -i]), s, rng.choice([None, "en", ""]), rng.choice([None, 0, i]), text, "t", 1, "h"))
    docs += docs[:7]
    assert result(spark, docs) == brute(docs)


def test_sizes_around_powers_of_the_fanout(spark):
    docs = [(i, f"s{n:02}", "en", 1, f"{i}\n", "", 0, "") for n in (1, 2, 3, 4, 8, 9, 10, 27, 28) for i in range(n)]
    assert result(spark, docs) == brute(docs)


def test_one_row_and_no_row(spark):
    one = [(5, "s", "en", 3, "a\nb", "", 0, "")]
    assert result(spark, one) == brute(one)
    empty = M.manifest_report(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"


def test_long_text(spark):
    docs = [(i, "s", "en", 1, "word \n" * 300_000 + str(i), "", 0, "") for i in range(3)]
    assert result(spark, docs) == brute(docs)


def test_general_manifest_detects_any_change(spark):
    """Other fields, two key columns and a fanout of four; a changed row,
    alone, no longer leads to the root."""
    docs = [(i % 5, f"g{i % 3}", None, i, f"t{i}", "", 0, "") for i in range(50)]
    df = spark.createDataFrame(docs, SCHEMA)
    changed = M.leaf(F.when(F.col("n_chars") == 17, "other").otherwise(F.col("text")), F.col("n_chars"))
    m = M.manifest(df, ["text", "n_chars"], "source", ["doc_id", "n_chars"], keep=["n_chars", changed.alias("now")], fanout=4)
    found = m.proofs().select("kept.n_chars", M.folded(F.col("path"), F.col("kept.now")).alias("end")).collect()
    assert len(found) == 50
    assert [r.n_chars for r in found if r.end != m.root] == [17]


def test_a_plan_has_one_level(spark):
    """The plan of the proofs, which the driver holds, doesn't grow with the
    number of levels."""
    def joins(n):
        docs = spark.createDataFrame([(i, f"s{i % 3}", None, i, f"t{i}", "", 0, "") for i in range(n)], SCHEMA)
        plan = M.manifest(docs, ["text"], "source", ["doc_id"]).proofs()._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Join ")

    assert joins(15) == joins(300)
