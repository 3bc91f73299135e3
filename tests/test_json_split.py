"""A document read by many tasks equals the document read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.flatten import flatten
from tessera.plans.registrations import flat_registrations, large_document_lines, write_large_documents
from tessera.sources.json_docs import ingest_json
from tessera.sources.json_split import read_split_json

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture
def small_splits(spark):
    """Splits of 200 bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def whole(spark, path):
    rows = flatten(ingest_json(spark, str(path), AS_OF)).select("source_file", "pos", F.to_json("value").alias("v"))
    return sorted(map(tuple, rows.collect()))


def split(spark, path):
    return sorted(map(tuple, read_split_json(spark, str(path)).select("source_file", "pos", F.to_json("value").alias("v")).collect()))


def element(rng, deep=0):
    kinds = [None, 1, -2.5, True, "", "plain", "],[", '"quoted"', "back\\slash", '\\"]', "[[{", "é日\n\t]", "}" * 5, '"data": [']
    if deep < 3:
        kinds += [element(rng, deep + 1), {"data": element(rng, deep + 1), "a]": [1, {"b": "]"}]}, []]
    return [rng.choice(kinds) for _ in range(rng.randrange(0, 7))]


def document(rng, n):
    meta = {"view": {"data": [[1], "]"], "columns": [{"name": 'x"]'}, [2, [3]]]}, "note": '"data": [[0]]'}
    fields = [("meta", meta), ("tags", [1, "]", 2]), ("data", [element(rng) for _ in range(n)]), ("after", [[9], [8]]), ("end", {"data": [[7]]})]
    return dict(rng.sample(fields, len(fields)))


@pytest.mark.parametrize("seed", range(1))
def test_equals_the_whole_document(tmp_path, spark, small_splits, seed):
    rng = random.Random(seed)
    land = tmp_path / "landing"
    land.mkdir()
    for i, indent in enumerate((None, 1, None)):
        (land / f"f {i}.json").write_text(json.dumps(document(rng, 60), indent=indent, ensure_ascii=i == 2))
    (land / "none.json").write_text('{"data": [ ], "x": [[1]]}')
    (land / "empty.json").write_text('{"tags": [1], "data":[[],[[]]]}\n')
    (land / "other.json").write_text('{"rows": [[1]]}')
    got = split(spark, land)
    assert got == whole(spark, land) and len(got) == 182


def test_one_document_is_read_by_many_tasks(tmp_path, spark, small_splits):
    (tmp_path / "d.json").write_text(json.dumps({"data": [[i, "x" * 30] for i in range(500)]}))
    df = spark.read.option("lineSep", "]").text(str(tmp_path / "d.json"))
    assert df.rdd.getNumPartitions() > 50
    got = split(spark, tmp_path / "d.json")
    assert [p for _, p, _ in got] == list(range(500)) and got == whole(spark, tmp_path / "d.json")


def test_an_element_longer_than_many_splits(tmp_path, spark, small_splits):
    doc = {"data": [["a"], ["b" * 3000, [["]" * 500], {"c": ["d"] * 200}]], ["e"]]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    assert split(spark, tmp_path / "d.json") == whole(spark, tmp_path / "d.json")


def test_elements_that_are_no_arrays_fail_the_read(tmp_path, spark):
    (tmp_path / "d.json").write_text('{"data": [[1], 5, [2]]}')
    with pytest.raises(Exception, match="MALFORMED|parse|JSON"):
        split(spark, tmp_path / "d.json")


def test_elements_are_not_shuffled_to_the_bounds_of_their_file(tmp_path, spark):
    (tmp_path / "d.json").write_text('{"data": [[1], [2]]}')
    plan = read_split_json(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join " in line]
    assert "strategy=broadcast" in join


def test_large_documents_are_made_from_one_scan(tmp_path, spark):
    """The lines are read and joined once, and the documents have the records
    of the flatten, in order."""
    tables = {
        "region": [("r_regionkey int, r_name string", [(0, "ASIA")])],
        "nation": [("n_nationkey int, n_name string, n_regionkey int", [(3, "JAPAN", 0)])],
        "supplier": [("s_suppkey long, s_name string, s_nationkey int", [(i, f'S"{i}', 3) for i in range(3)])],
        "part": [("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(i, f"n]{i}", "B", None, i) for i in range(5)])],
        "lineitem": [(
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            [(i // 3, i % 5, i % 3, i % 3, float(i % 50), 1.5 * i, 0.0, 0.0, "N", "O", None) for i in range(60)])],
    }
    for name, [(schema, data)] in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"sf/{name}.parquet"))
    sf = str(tmp_path / "sf")
    plan = large_document_lines(spark, sf, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 1
    write_large_documents(spark, sf, str(tmp_path / "landed"), 7)
    got = read_split_json(spark, str(tmp_path / "landed")).select("source_file", "pos", F.to_json("value").alias("v")).collect()
    per_file = {}
    for r in sorted(got):
        per_file.setdefault(r.source_file.split("file_key=")[-1][:6], []).append(json.loads(r.v)[21])
    want = [r.dol_vehicle_id for r in sorted(flat_registrations(spark, sf).collect(), key=lambda r: (r.source_file, r.pos))]
    assert sorted(per_file) == ["000000", "000001", "000002"] and sum((per_file[k] for k in sorted(per_file)), []) == want


def test_all_pieces_are_scanned_as_one_by_one():
    import pyarrow as pa

    from tessera.sources.json_split import _bytes_of, scanned, scanned_all

    rng = random.Random(5)
    texts = ["".join(rng.choice(['"', "\\", "[", "]", "{", "}", "a", "é", ",", '\\"', "\\\\"]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for kind in (pa.string(), pa.large_string()):
        for some in (pa.array(texts, kind), pa.array(texts, kind).slice(7, 100), pa.array(["", ""], kind)):
            turns, outside, within = scanned_all(*_bytes_of(some))
            assert [*zip((turns == 1).tolist(), outside.tolist(), within.tolist())] == [scanned(t) for t in some.to_pylist()]


@pytest.mark.parametrize("rows", ["1", "3"])
def test_batches_that_end_within_an_element(tmp_path, spark, small_splits, rows):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    rng = random.Random(int(rows))
    (tmp_path / "d.json").write_text(json.dumps(document(rng, 40)))
    (tmp_path / "e.json").write_text(json.dumps({"data": [["a", [["]" * 50], {"c": ["d"] * 20}]], ["e"], [[[]], []], ["f"], ["g"]]}))
    spark.conf.set(key, rows)
    try:
        assert split(spark, tmp_path) == whole(spark, tmp_path)
    finally:
        spark.conf.set(key, old)


def test_large_documents_land_in_rounds(tmp_path, spark, monkeypatch):
    """A round lands some of the documents and leaves only its records."""
    from tessera.plans import q_incremental as Q
    from tessera.plans.registrations import large_document_rounds
    from tessera.session import scratch_path

    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(3, "JAPAN", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(i, f'S"{i}', 3) for i in range(3)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(i, f"n]{i}", "B", None, i) for i in range(5)]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            [(i // 3, i % 5, i % 3, i % 3, float(i % 50), 1.5 * i, 0.0, 0.0, "N", "O", None) for i in range(60)] + [(None, 0, 0, 0, 1.0, 1.0, 0.0, 0.0, "N", "O", None)]),
    }
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"sf/{name}.parquet"))
    sf = str(tmp_path / "sf")
    numbers = spark.createDataFrame([(n,) for n in range(-1, 4)] + [(None,)], "file_no long")
    for most, want in ((1000, 1), (30, 3), (1, 3)):
        parts = large_document_rounds(spark, sf, 7, most)
        kept = [sorted(r.file_no for r in numbers.where(p).collect()) for p in parts]
        assert len(kept) == want and sorted(sum(kept, [])) == [-1, 0, 1, 2, 3]
    monkeypatch.setattr(Q, "LARGE_DOCUMENT_ORDERS", 7)
    monkeypatch.setattr(Q, "ROUND_LINES", 25)
    lands = []
    real = Q.write_large_documents
    monkeypatch.setattr(Q, "write_large_documents", lambda *a: (lands.append(a[2]), real(*a)))
    got = sorted((r.source_file, r.pos, r.dol_vehicle_id) for r in Q.q_split_document_records(spark, sf).collect())
    want = sorted((int(r.dol_vehicle_id.split("-")[0]) // 7, int(r.dol_vehicle_id.split("-")[0]), r.pos, r.dol_vehicle_id)
                  for r in flat_registrations(spark, sf).where("dol_vehicle_id IS NOT NULL").collect())
    assert [d for *_, d in got] == [d for *_, d in want] and {f for f, *_ in got} == {f"file_key=00000{n}" for n in range(3)}
    assert len(lands) == 3
    fs = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "large-documents"))
    left = fs.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not left.exists(fs) or not list(left.listStatus(fs))
