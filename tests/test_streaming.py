"""Streaming jobs equal their batch counterparts; a repeated batch replaces
its first attempt."""

import json
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import scd2 as S
from tessera.operators.dedup import latest_per_key
from tessera.operators.flatten import extract_positions, flatten
from tessera.sources.json_docs import ingest_json
from tessera.streaming.jobs import (
    CdcStream,
    IssueAlerts,
    RegistrationStream,
    dq_after_gold,
    gold_refresh,
    json_document_stream,
    run,
)
from tessera.tables import BatchTable, read_current

SPEC = [(0, "vin", "string"), (1, "make", "string"), (2, "model_year", "int")]
def order():
    return [F.col("source_file").desc_nulls_last(), F.col("pos").desc_nulls_last()]


def _land(d, name, rows_):
    (d / name).write_text(json.dumps({"data": rows_}))


def _spec14():
    return SPEC + [(3, "model", "string"), (4, "ev_type", "string"), (5, "electric_range", "int"), (6, "base_msrp", "double"),
                   (7, "county_name", "string"), (9, "legislative_district", "string"), (10, "dol_vehicle_id", "string"),
                   (11, "vehicle_location", "string"), (12, "electric_utility", "string"), (13, "census_tract_2020", "string"),
                   (14, "counties", "string")]


def test_registration_stream_equals_batch(tmp_path, spark):
    land = tmp_path / "landing"
    land.mkdir()
    docs = {
        "f3.json": [["V1", "C", "2023"], ["V2", "B", "2022"]],
        "f1.json": [["V1", "A", "2021"], ["V3", "X", "2020"], [None, "N", "2020"]],
        "f2.json": [["V1", "B", "2022"], ["V3", "Y", "2021"], ["V3", "Z", "2022"]],
        "f4.json": [["V4", "D", "2019"]],
    }
    for name, r in docs.items():
        _land(land, name, r)
    seen = []
    job = RegistrationStream(str(tmp_path / "tables"), SPEC, after_commit=[lambda job, b: seen.append(b)])
    q = run(json_document_stream(spark, str(land), max_files_per_trigger=1, as_of="2024-01-31 00:00:00"),
            job.handle, str(tmp_path / "ckpt"))
    q.awaitTermination()
    flat = extract_positions(flatten(ingest_json(spark, str(land), "2024-01-31 00:00:00")), SPEC, keep=["source_file", "pos"])
    batch = latest_per_key(flat.where("vin IS NOT NULL"), ["vin"], order())
    assert rows(job.clean(spark), "vin", "make", "model_year") == rows(batch, "vin", "make", "model_year")
    assert rows(job.clean(spark), "vin", "make") == [("V1", "C"), ("V2", "B"), ("V3", "Z"), ("V4", "D")]
    assert len(seen) == 4 and job.raw.read(spark).count() == 4
    before = rows(job.clean(spark))
    job.compact(spark)
    assert rows(job.clean(spark)) == before and job.latest.batches(spark) == []
    raw = ingest_json(spark, str(land / "f1.json"), "2024-01-31 00:00:00")
    job.handle(raw, 9)  # older rows after the compaction change nothing
    assert rows(job.clean(spark), "vin", "make") == [("V1", "C"), ("V2", "B"), ("V3", "Z"), ("V4", "D")]


def _tables(spark, job, root):
    out = {n: rows(t.read(spark, with_batch=True).drop("json_data"), *sorted(set(t.read(spark, with_batch=True).columns) - {"json_data"}))
           for n, t in (("raw", job.raw), ("flat", job.flat), ("latest", job.latest))}
    for n in ("fact_registrations", "dim_county_gold", "fact_market_metrics"):
        out[n] = rows(read_current(spark, f"{root}/gold/{n}"))
    for n in ("error_rows", "duplicate_rows", "reconciliation"):
        t = BatchTable(f"{root}/dq/{n}").read(spark, with_batch=True)
        out[n] = [str(r) for r in rows(t)]
    return out


STEPS = ["raw", "flat", "silver", "gold", "dq"]


def test_a_batch_that_fails_after_any_step_is_finished_on_replay(tmp_path, spark):
    """Two micro-batches; the second fails after its first step, then is
    repeated and fails after the next, and so on: in the end every table
    equals that of a run without failure."""
    as_of = "2024-01-31 00:00:00"
    land = tmp_path / "landing"
    land.mkdir()
    _land(land, "f1.json", [["V1", "A", "2021", "m", "e", "900"], ["V1", "A", "2021", "m", "e", "9"], [None, "Q", "2020"], ["V5", None, "2020"]])
    _land(land, "f2.json", [["V1", "C", "2022"], ["V2", "B", "2020", "m", "e", "-4"], ["V2", "B", "2020", "m", "e", "-4"]])
    batches = [ingest_json(spark, str(land / f), as_of) for f in ("f1.json", "f2.json")]
    makers = spark.createDataFrame([("A",)], "manufacturer_name string")

    def job_of(root, failures):
        def after(step, batch_id):
            if failures and batch_id == 1 and step == failures[0]:
                raise RuntimeError(failures.pop(0))

        class Table(BatchTable):
            def write(self, df, batch_id):
                super().write(df, batch_id)
                after(self.root.rpartition("/")[2], batch_id)

        stop = lambda step: lambda job, batch_id: after(step, batch_id)
        job = RegistrationStream(root, _spec14(), after_commit=[
            gold_refresh(root, as_of), stop("gold"), dq_after_gold(root, as_of, makers), stop("dq")])
        job.raw, job.flat, job.latest = Table(f"{root}/raw"), Table(f"{root}/flat"), Table(f"{root}/silver")
        return job

    clean_root, root = str(tmp_path / "clean"), str(tmp_path / "t")
    failures = list(STEPS)
    clean, job = job_of(clean_root, []), job_of(root, failures)
    for n, raw in enumerate(batches):
        clean.handle(raw, n)
        job.handle(raw, n) if n == 0 else None
    for _ in STEPS:
        with pytest.raises(RuntimeError):
            job.handle(batches[1], 1)
    job.handle(batches[1], 1)
    want = _tables(spark, clean, clean_root)
    assert not failures and _tables(spark, job, root) == want
    assert len(want["error_rows"]) == 7 and len(want["duplicate_rows"]) == 2 and len(want["reconciliation"]) == 2


def test_a_second_batch_without_new_content_adds_no_issue(tmp_path, spark):
    as_of = "2024-01-31 00:00:00"
    land = tmp_path / "landing"
    land.mkdir()
    _land(land, "f1.json", [["V1", "A", "2021", "m", "e", "900"], [None, "Q", "2020"], ["V1", "A", "2021", "m", "e", "900"]])
    _land(land, "f2.json", [["V7", "A", "2021", "m", "e", "10"]])
    root = str(tmp_path / "t")
    job = RegistrationStream(root, _spec14(), after_commit=[gold_refresh(root, as_of), dq_after_gold(root, as_of)])
    for n, f in enumerate(("f1.json", "f2.json")):
        job.handle(ingest_json(spark, str(land / f), as_of), n)
    for name in ("error_rows", "duplicate_rows"):
        assert set(spark.read.parquet(f"{root}/dq/{name}").select("batch_id").toPandas().batch_id) <= {0}


def test_a_batch_is_written_by_several_tasks(tmp_path, spark):
    t = BatchTable(str(tmp_path / "t"))
    t.write(spark.range(1000).repartition(4), 0)
    assert len(list((tmp_path / "t" / "batch_id=0").glob("part-*.parquet"))) == 4


def test_cdc_stream_equals_batch_history(tmp_path, spark):
    data = [
        (1, dt(2024, 1, 1), 10, "UPSERT", "a"), (1, dt(2024, 1, 2), 20, "UPSERT", "b"),
        (1, dt(2024, 1, 3), 30, "DELETE", None), (1, dt(2024, 1, 4), 40, "UPSERT", "c"),
        (2, dt(2024, 1, 1), 11, "UPSERT", "x"), (2, dt(2024, 1, 3), 31, "UPSERT", "x"),
        (3, dt(2024, 1, 2), 21, "UPSERT", "q"),
    ]
    schema = "id long, ts timestamp_ntz, lsn long, op string, v string"
    changes = spark.createDataFrame(data, schema)
    land = tmp_path / "cdc"
    # later changes land first: day 4 and 3 before day 1 and 2
    for day in [4, 3, 1, 2]:
        changes.where(F.dayofmonth("ts") == day).coalesce(1).write.parquet(str(land / f"d{day}"))
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(land))
    job = CdcStream(str(tmp_path / "t"), ["id"], ["v"])
    run(src, job.handle, str(tmp_path / "ckpt")).awaitTermination()
    cols = ("id", "v", "effective_start_at", "effective_end_at", "is_current", "closed_by")
    want = rows(S.versions_from_changes(changes, ["id"], ["v"]), *cols)
    assert rows(job.history(spark), *cols) == want
    job.handle(changes.where(F.dayofmonth("ts") == 2), 3)  # the last batch again
    assert rows(job.history(spark), *cols) == want
    job.compact(spark)
    assert rows(job.history(spark), *cols) == want
    job.handle(changes.where("id = 3"), 4)  # redelivered after the compaction
    assert rows(job.history(spark), *cols) == want


def test_issue_alerts(tmp_path, spark):
    alerts = IssueAlerts(str(tmp_path / "alerts"), as_of="2024-01-31 00:00:00")
    issues = spark.createDataFrame([("error",), ("error",), ("duplicate",)], "feed string")
    for _ in range(2):  # a repeated batch writes its alert once
        alerts.handle(issues, 0)
    alerts.handle(issues.limit(0), 1)
    alerts.handle(issues.where("feed = 'duplicate'"), 2)
    got = rows(alerts.alerts.read(spark, with_batch=True), "batch_id", "new_errors", "new_duplicates")
    assert got == [(0, 2, 1), (2, 0, 1)]


def test_gold_and_dq_follow_each_batch(tmp_path, spark):
    land = tmp_path / "landing"
    land.mkdir()
    _land(land, "f1.json", [["V1", "A", "2021"], ["V2", "B", "2020"]])
    _land(land, "f2.json", [["V1", "C", "2022"]])
    root = str(tmp_path / "t")
    job = RegistrationStream(root, _spec14(),
                             after_commit=[gold_refresh(root, "2024-01-31 00:00:00"), dq_after_gold(root, "2024-01-31 00:00:00")])
    run(json_document_stream(spark, str(land), max_files_per_trigger=1), job.handle, str(tmp_path / "ck")).awaitTermination()
    gold = read_current(spark, f"{root}/gold/fact_market_metrics")
    assert rows(gold, "make", "total_vehicles") == [("B", 1), ("C", 1)]
    recon = rows(spark.read.parquet(f"{root}/dq/reconciliation"), "batch_id", "silver_rows", "gold_total_vehicles")
    assert recon == [(0, 2, 2), (1, 2, 2)]
