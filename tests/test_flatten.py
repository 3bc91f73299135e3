"""Raw ingestion, flatten, positional extraction and latest-wins dedup."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.dedup import latest_per_key
from tessera.operators.filters import reject_null_keys
from tessera.operators.flatten import cast_errors, extract_paths, extract_positions, flatten, flatten_nested
from tessera.plans.medallion import clean_registrations
from tessera.plans.registrations import REGISTRATION_POSITIONS
from tessera.sources.json_docs import ingest_json

SPEC = [(0, "vin", "string"), (1, "make", "string"), (2, "model_year", "int"), (3, "range", "int")]


def _write(path, doc):
    path.write_text(json.dumps(doc))


@pytest.fixture()
def raw_small(tmp_path, spark):
    d = tmp_path / "landing"
    d.mkdir()
    _write(d / "a_2024_01.json", {"data": [["V1", "TESLA", "2020", "200"], [None, "KIA", "2021", "100"], ["V2", "BMW"]]})
    _write(d / "b_2024_02.json", {"data": [["V1", "TESLA", "2021", "250"], ["V3", "FORD", None, "x"], ["V4", "AUDI", 2020.6, 10]]})
    return ingest_json(spark, str(d), "2024-01-31 00:00:00")


def test_ingest_keeps_lineage(raw_small):
    got = rows(raw_small.select(F.regexp_extract("source_file", r"[^/]+$", 0).alias("f"), "source_file_row"))
    assert got == [("a_2024_01.json", 1), ("b_2024_02.json", 1)]


def test_flatten_positions_and_short_rows(raw_small):
    flat = extract_positions(flatten(raw_small), SPEC, keep=["pos"], strict=False)
    got = rows(flat, "pos", "vin", "make", "model_year", "range")
    assert (2, "V2", "BMW", None, None) in got  # missing positions read as NULL
    assert (1, None, "KIA", 2021, 100) in got  # JSON null key
    assert (1, "V3", "FORD", None, None) in got  # null year, text in a number slot
    assert (2, "V4", "AUDI", 2021, 10) in got  # 2020.6 rounds like the warehouse cast
    assert len(got) == 6


def test_strict_cast_raises_and_flags(raw_small, spark):
    flat = flatten(raw_small)
    with pytest.raises(Exception):
        extract_positions(flat, SPEC, strict=True).collect()
    bad = flat.where(cast_errors(flat, SPEC)).select(F.try_variant_get("value", "$[0]", "string").alias("vin"))
    assert rows(bad) == [("V3",)]


def test_latest_file_wins(raw_small):
    flat = extract_positions(flatten(raw_small), SPEC, keep=["source_file", "pos"], strict=False)
    keyed = reject_null_keys(flat, ["vin"])
    latest = latest_per_key(keyed, ["vin"], [F.col("source_file").desc_nulls_last(), F.col("pos").desc_nulls_last()])
    got = {r["vin"]: (r["model_year"], r["range"]) for r in latest.collect()}
    assert got == {"V1": (2021, 250), "V2": (None, None), "V3": (None, None), "V4": (2021, 10)}


def test_malformed_document_fails_the_whole_read(tmp_path, spark):
    d = tmp_path / "bad"
    d.mkdir()
    _write(d / "ok.json", {"data": [["V1"]]})
    (d / "broken.json").write_text('{"data": [["V2"]')
    with pytest.raises(Exception):
        ingest_json(spark, str(d), "2024-01-31 00:00:00").collect()


def test_nested_flatten_and_paths(spark):
    log = spark.sql(
        """SELECT 'u' AS user_name, parse_json('[{"objectName":"A","directSources":[{"objectName":"S1"},{"objectName":"S2"}]},
                                              {"objectName":"B","directSources":[]}]') AS om"""
    )
    pairs = flatten_nested(log, "om", "$", "$.directSources", "o", "d")
    got = extract_paths(pairs, "d", [("$.objectName", "src", "string")], keep=["user_name"])
    assert rows(got) == [("u", "S1"), ("u", "S2")]


def test_json_and_typed_flatten_agree(spark):
    from tessera.plans.registrations import flat_registrations

    d = "/root/testdata/sf0.001"
    a = flat_registrations(spark, d, via_json=True).drop("load_timestamp")
    b = flat_registrations(spark, d, via_json=False).drop("load_timestamp").select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert clean_registrations(a).count() == clean_registrations(b).count()
    assert [n for _, n, _ in REGISTRATION_POSITIONS][0] == "vin"
