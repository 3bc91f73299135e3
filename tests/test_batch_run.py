"""End-to-end batch run over landed files, snapshot refresh, open export,
snapshot-based history and streaming watermark helpers."""

import json
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import scd2 as S
from tessera.plans.batch_run import run_batch
from tessera.plans.semantic import consumption_rows, registration_model, suggested_questions
from tessera.streaming.jobs import dedup_cdc_stream, trend_stream
from tessera.tables import read_current, refresh

SPEC = [(8, "vin", "string"), (9, "county_name", "string"), (13, "model_year", "int"), (14, "make", "string"),
        (15, "model", "string"), (16, "ev_type", "string"), (17, "cafv_eligibility", "string"),
        (18, "electric_range", "int"), (19, "base_msrp", "double"), (20, "legislative_district", "string"),
        (21, "dol_vehicle_id", "string"), (22, "vehicle_location", "string"), (23, "electric_utility", "string"),
        (24, "census_tract_2020", "string"), (25, "counties", "string")]


def _row(vin, make, year, rng, county="King", code="53033"):
    r = [None] * 26
    r[8], r[9], r[13], r[14], r[15], r[16], r[18], r[19] = vin, county, year, make, "M", "BEV", rng, "100.0"
    r[17], r[20], r[21], r[23], r[25] = "Eligible", "41", f"id-{vin}", "PSE", code
    return r


def test_run_batch_end_to_end(tmp_path, spark):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "f1.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2020", "200"), _row("V2", "KIA", "2021", "600")]}))
    (land / "f2.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2021", "250"), _row(None, "X", "2020", "1")]}))
    mfg = spark.createDataFrame([("TESLA",)], "manufacturer_name string")
    res = run_batch(spark, str(land), str(tmp_path / "wh"), "2024-01-31 00:00:00", SPEC, mfg)
    assert res.reconciliation["status"] == "PASS"
    assert (res.reconciliation["bronze_flattened_rows"], res.reconciliation["silver_rows"]) == (3, 2)
    clean = spark.read.parquet(res.tables["clean"])
    assert rows(clean, "vin", "model_year", "electric_range") == [("V1", 2021, 250), ("V2", 2021, 600)]
    errs = rows(spark.read.parquet(res.tables["error_rows"]), "error_type", "vin")
    assert errs == [("INVALID_RANGE", "V2"), ("NULL_VIN", None), ("ORPHAN_MAKE", "V2")]
    assert spark.read.parquet(str(tmp_path / "wh/open/fact_registrations")).schema["load_timestamp"].dataType.typeName() == "timestamp_ntz"
    assert spark.read.parquet(res.tables["fact_normalized"]).count() == 3


def test_a_second_run_loads_only_new_files(tmp_path, spark):
    as_of = "2024-01-31 00:00:00"
    land = tmp_path / "landing"
    land.mkdir()
    (land / "f1.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2020", "200"), _row("V2", "KIA", "2021", "600"), _row(None, "X", "2020", "1")]}))
    wh = str(tmp_path / "wh")
    first = run_batch(spark, str(land), wh, as_of, SPEC)
    again = run_batch(spark, str(land), wh, as_of, SPEC)
    assert again.run_no == first.run_no == 0 and again.reconciliation == first.reconciliation
    (land / "f2.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2021", "250"), _row("V3", "KIA", "2020", "-5")]}))
    second = run_batch(spark, str(land), wh, as_of, SPEC, purge=True)
    assert second.run_no == 1 and not land.exists()
    once = tmp_path / "once"
    once.mkdir()
    for n in (0, 1):
        (once / f"f{n + 1}.json").write_text(json.dumps({"data": [
            [_row("V1", "TESLA", "2020", "200"), _row("V2", "KIA", "2021", "600"), _row(None, "X", "2020", "1")],
            [_row("V1", "TESLA", "2021", "250"), _row("V3", "KIA", "2020", "-5")]][n]}))
    whole = run_batch(spark, str(once), str(tmp_path / "wh2"), as_of, SPEC)
    assert second.reconciliation == whole.reconciliation
    for name in ("clean", "fact_registrations", "fact_market_metrics", "dim_county_gold", "fact_normalized", "denorm_base", "mv_market_metrics"):
        a, b = (spark.read.parquet(r.tables[name]).drop("source_file") for r in (second, whole))
        assert rows(a) == rows(b), name
    errors = [rows(spark.read.parquet(r.tables["error_rows"]), "error_type", "vin") for r in (second, whole)]
    assert errors[0] == errors[1] == [("INVALID_RANGE", "V2"), ("INVALID_RANGE", "V3"), ("NULL_VIN", None)]
    raw = spark.read.parquet(second.tables["error_rows"]).where("vin IS NULL").first()["raw_record"]
    assert json.loads(raw)[14] == "X"


@pytest.mark.parametrize("table", ["clean", "fact_market_metrics", "denorm_base"])
def test_an_unfinished_run_is_taken_up_again(tmp_path, spark, monkeypatch, table):
    import tessera.plans.batch_run as B

    land = tmp_path / "landing"
    land.mkdir()
    (land / "f1.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2020", "200"), _row("V1", "KIA", "2021", "600")]}))
    real = B.refresh

    def fails(df, root, **kw):
        if root.endswith(f"/{table}"):
            raise RuntimeError(table)
        return real(df, root, **kw)

    monkeypatch.setattr(B, "refresh", fails)
    with pytest.raises(RuntimeError):
        run_batch(spark, str(land), str(tmp_path / "wh"), "2024-01-31 00:00:00", SPEC)
    monkeypatch.setattr(B, "refresh", real)
    res = run_batch(spark, str(land), str(tmp_path / "wh"), "2024-01-31 00:00:00", SPEC)
    assert res.run_no == 0 and res.reconciliation["status"] == "PASS"
    assert spark.read.parquet(res.tables["error_rows"]).count() == 1
    assert spark.read.parquet(str(tmp_path / "wh/raw")).count() == 1


def test_snapshot_refresh_never_overwrites(tmp_path, spark):
    root = str(tmp_path / "t")
    p1 = refresh(spark.createDataFrame([(1,)], "x int"), root)
    cur = read_current(spark, root)
    p2 = refresh(cur.withColumn("x", F.col("x") + 1), root)  # reads the table it refreshes
    assert p1 != p2 and rows(read_current(spark, root)) == [(2,)]


def test_history_from_snapshots(spark):
    snaps = spark.createDataFrame(
        [
            (dt(2024, 1, 1), 1, "a"), (dt(2024, 1, 1), 2, "x"),
            (dt(2024, 1, 2), 1, "a"), (dt(2024, 1, 2), 2, "y"),
            (dt(2024, 1, 3), 2, "y"),                          # key 1 disappears
            (dt(2024, 1, 4), 1, "b"), (dt(2024, 1, 4), 2, "y"),  # and comes back changed
        ],
        "snapshot_ts timestamp_ntz, id long, v string",
    )
    h = S.scd2_from_snapshots(snaps, ["id"], ["v"])
    got = rows(h, "id", "v", "effective_start_at", "effective_end_at", "closed_by")
    assert got == [
        (1, "a", dt(2024, 1, 1), dt(2024, 1, 3), "DELETE"),
        (1, "b", dt(2024, 1, 4), None, None),
        (2, "x", dt(2024, 1, 1), dt(2024, 1, 2), "UPSERT"),
        (2, "y", dt(2024, 1, 2), None, None),
    ]
    arch = S.history_archive(h, ["id"], ["v"])
    assert set(arch.columns) == {"id", "v", "valid_from", "valid_to", "cdc_operation"}


def test_semantic_guardrails_and_suggestions(spark):
    df = spark.createDataFrame(
        [("V1", "A", "m1", "BEV", 2020, 100, 1.0, "K", "41", "53033", "Eligible"),
         ("V2", "A", "m2", "PHEV", 2021, 20, 2.0, "K", "41", "53033", "Not eligible")],
        "vin string, make string, model string, ev_type string, model_year int, electric_range int, base_msrp double, "
        "county_name string, legislative_district string, counties string, cafv_eligibility string",
    )
    m = registration_model(cafv_label="Eligible")
    got = m.query(df, "fact_registrations", ["make"], ["total_vehicles", "bev_share_pct", "cafv_eligible_pct", "model_diversity"]).collect()
    assert [(r["total_vehicles"], r["bev_share_pct"], r["cafv_eligible_pct"], r["model_diversity"]) for r in got] == [(2, 50.0, 50.0, 2)]
    for bad in [("other_table", ["make"], ["total_vehicles"]), ("fact_registrations", ["secret"], ["total_vehicles"]),
                ("fact_registrations", ["make"], ["drop_table"])]:
        try:
            m.query(df, *bad)
            raise AssertionError("accepted an undeclared name")
        except ValueError:
            pass
    qs = suggested_questions(m, df)
    assert rows(qs["top_districts"], "legislative_district", "total_vehicles") == [("41", 2)]
    versions = spark.createDataFrame([("A", "SUV", dt(2020, 1, 1), None)],
                                     "make string, cls string, effective_start_at timestamp_ntz, effective_end_at timestamp_ntz")
    facts = df.withColumn("ts", F.lit(dt(2021, 1, 1)).cast("timestamp_ntz"))
    out = consumption_rows(facts, versions, "make", "make", "ts", ["cls"], F.lit("FRESH"), F.lit("PASS"))
    assert rows(out, "vin", "cls", "quality_status") == [("V1", "SUV", "PASS"), ("V2", "SUV", "PASS")]


def test_watermarked_stream_helpers(tmp_path, spark):
    schema = "id long, ts timestamp_ntz, lsn long, kind string"
    data = [(1, dt(2024, 1, 1, 0, 10), 1, "a"), (1, dt(2024, 1, 1, 0, 10), 1, "a"), (2, dt(2024, 1, 1, 1, 5), 2, "b")]
    src_dir = tmp_path / "src"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(src_dir))
    stream = spark.readStream.schema(schema).parquet(str(src_dir))
    out = []
    q = (dedup_cdc_stream(stream, ["id"], "ts", "lsn").writeStream.foreachBatch(lambda b, i: out.extend(b.collect()))
         .option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(out) == 2
    agg = []
    q2 = (trend_stream(stream, "ts", ["kind"]).writeStream.outputMode("update")
          .foreachBatch(lambda b, i: agg.extend(b.collect()))
          .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start())
    q2.awaitTermination()
    assert sorted((r["kind"], r["n"]) for r in agg) == [("a", 2), ("b", 1)]


def test_model_from_spec(spark):
    from tessera.plans.semantic import model_from_spec

    spec = {
        "name": "fact_ev_registrations",
        "dimensions": [{"name": "make", "expr": "MAKE"}, {"name": "county_code", "expr": "COUNTIES"}],
        "time_dimensions": [{"name": "model_year", "expr": "MODEL_YEAR"}],
        "measures": [
            {"name": "total_registrations", "expr": "VIN", "default_aggregation": "count"},
            {"name": "max_base_msrp", "expr": "BASE_MSRP", "default_aggregation": "max"},
        ],
    }
    df = spark.createDataFrame([("V1", "A", "C1", 2020, 1.0), ("V2", "A", "C2", 2021, 3.0), (None, "B", "C1", 2020, 2.0)],
                               "vin string, make string, counties string, model_year int, base_msrp double")
    m = model_from_spec(spec)
    got = m.query(df, "fact_ev_registrations", ["make"], ["total_registrations", "max_base_msrp"])
    assert rows(got) == [("A", 2, 3.0), ("B", 0, 2.0)]
    by_code = m.query(df, "fact_ev_registrations", ["county_code", "model_year"], ["total_registrations"])
    assert rows(by_code) == [("C1", 2020, 1), ("C2", 2021, 1)]


def test_catalog_sync_and_enrichment(tmp_path, spark):
    from tessera.plans.catalog import CatalogTables, enriched_metrics, sync_catalog
    from tessera.sources.cdc import CATALOG_CHANGE_SCHEMA

    def land(name, data):
        spark.createDataFrame(data, CATALOG_CHANGE_SCHEMA).write.parquet(str(tmp_path / "landing" / name))

    row = lambda cid, name, cls, ts, op, lsn: (cid, 1, name, "US", cls, "car", "ev", "auto", 5, ts, ts, op, lsn)
    root = str(tmp_path / "catalog")
    land("b1", [row(1, "TESLA", "SUV", dt(2024, 1, 1), "INSERT", 1), row(2, "KIA", "CAR", dt(2024, 1, 1), "INSERT", 2)])
    assert sync_catalog(spark, str(tmp_path / "landing" / "b1"), root)
    assert not (tmp_path / "landing" / "b1").exists()  # consumed
    land("b2", [row(1, "TESLA", "SEDAN", dt(2024, 1, 5), "UPDATE", 3), row(2, "KIA", "CAR", dt(2024, 1, 3), "DELETE", 4),
                row(1, "TESLA", "SUV", dt(2024, 1, 1), "INSERT", 1)])  # redelivered
    assert sync_catalog(spark, str(tmp_path / "landing" / "b2"), root)
    hist = CatalogTables(root).history(spark)
    assert rows(hist, "catalog_id", "vehicle_class", "is_current") == [(1, "SEDAN", True), (1, "SUV", False), (2, "CAR", False)]
    metrics = spark.createDataFrame([("TESLA", "BEV", 3), ("KIA", "BEV", 2)], "make string, ev_type string, total_vehicles long")
    got = rows(enriched_metrics(metrics, hist), "make", "vehicle_class")
    assert got == [("KIA", None), ("TESLA", "SEDAN")]
    empty = tmp_path / "landing" / "b3"
    spark.createDataFrame([], CATALOG_CHANGE_SCHEMA).write.parquet(str(empty))
    assert sync_catalog(spark, str(empty), root) is False


def test_purge_keeps_files_that_no_run_has_loaded(tmp_path, spark, monkeypatch):
    """The run fails after the raw table, another file lands, the next call
    finishes the run; the file that landed between is the next run's."""
    import tessera.plans.batch_run as B

    as_of = "2024-01-31 00:00:00"
    land = tmp_path / "landing" / "a b"
    land.mkdir(parents=True)
    (land / "f[1].json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2020", "200")]}))
    real = B.refresh
    monkeypatch.setattr(B, "refresh", lambda *a, **k: 1 / 0)
    go = lambda: run_batch(spark, str(tmp_path / "landing"), str(tmp_path / "wh"), as_of, SPEC, purge=True)
    with pytest.raises(ZeroDivisionError):
        go()
    monkeypatch.setattr(B, "refresh", real)
    (land / "f%202.json").write_text(json.dumps({"data": [_row("V2", "KIA", "2021", "20")]}))
    assert go().run_no == 0
    assert [p.name for p in land.iterdir() if p.suffix == ".json"] == ["f%202.json"]
    res = go()
    assert res.run_no == 1 and not (tmp_path / "landing").exists()
    assert rows(spark.read.parquet(res.tables["clean"]), "vin") == [("V1",), ("V2",)]
    assert go().run_no == 1  # nothing has landed


def test_loaded_files_are_not_opened_again(tmp_path, spark):
    as_of = "2024-01-31 00:00:00"
    land = tmp_path / "landing"
    land.mkdir()
    (land / "f1.json").write_text(json.dumps({"data": [_row("V1", "TESLA", "2020", "200")]}))
    run_batch(spark, str(land), str(tmp_path / "wh"), as_of, SPEC)
    (land / "f1.json").write_text("{ no document")
    (land / "f2.json").write_text(json.dumps({"data": [_row("V2", "KIA", "2021", "20")]}))
    res = run_batch(spark, str(land), str(tmp_path / "wh"), as_of, SPEC)
    assert rows(spark.read.parquet(res.tables["clean"]), "vin") == [("V1",), ("V2",)]


def test_sync_after_compaction_and_files_that_land_during_a_sync(tmp_path, spark, monkeypatch):
    import tessera.plans.catalog as C
    from tessera.sources.cdc import CATALOG_CHANGE_SCHEMA

    landing, root = str(tmp_path / "landing"), str(tmp_path / "catalog")

    def land(*data):
        full = [(cid, 1, "T", "US", cls, "car", "ev", "auto", 5, ts, ts, "UPDATE", lsn) for cid, cls, ts, lsn in data]
        spark.createDataFrame(full, CATALOG_CHANGE_SCHEMA).write.mode("append").parquet(landing)

    land((1, "SUV", dt(2024, 1, 1), 1), (2, "CAR", dt(2024, 1, 1), 2))
    assert C.sync_catalog(spark, landing, root)
    land((1, "VAN", dt(2024, 1, 2), 3))
    assert C.sync_catalog(spark, landing, root)
    C.CatalogTables(root).compact(spark)
    land((1, "BUS", dt(2024, 1, 3), 4))
    assert C.sync_catalog(spark, landing, root)
    want = [(1, "BUS", True), (1, "SUV", False), (1, "VAN", False), (2, "CAR", True)]
    got = lambda: rows(C.CatalogTables(root).history(spark), "catalog_id", "vehicle_class", "is_current")
    assert got() == want
    land((2, "COUPE", dt(2024, 1, 4), 5))
    real = C.CatalogTables.handle

    def handle(self, changes, batch_id):
        real(self, changes, batch_id)
        land((2, "WAGON", dt(2024, 1, 5), 6))  # lands while the sync runs

    monkeypatch.setattr(C.CatalogTables, "handle", handle)
    assert C.sync_catalog(spark, landing, root)
    monkeypatch.setattr(C.CatalogTables, "handle", real)
    assert C.sync_catalog(spark, landing, root)
    assert got() == [(1, "BUS", True), (1, "SUV", False), (1, "VAN", False), (2, "CAR", False), (2, "COUPE", False), (2, "WAGON", True)]
    # a sync that fails between the log and the history is finished by the next
    land((3, "SUV", dt(2024, 1, 6), 7))
    write = C.CatalogTables(root).versions.write.__func__
    monkeypatch.setattr("tessera.tables.BatchTable.write", lambda self, df, n: 1 / 0 if self.root.endswith("history") else write(self, df, n))
    with pytest.raises(ZeroDivisionError):
        C.sync_catalog(spark, landing, root)
    monkeypatch.setattr("tessera.tables.BatchTable.write", write)
    assert C.sync_catalog(spark, landing, root) and (3, "SUV", True) in got()


def test_many_files_are_removed_in_few_calls(tmp_path, spark):
    """More files than one round of the threads takes, in folders that they
    leave empty or not."""
    from tessera import tables as T

    n = 50
    names = []
    for i in range(n):
        d = tmp_path / "landing" / f"day={i % 2}" / f"file key={i}%"
        d.mkdir(parents=True)
        (d / "a[1].json").write_text("{}")
        names.append((d / "a[1].json").as_uri())
    (tmp_path / "landing" / "day=1" / "late.json").write_text("{}")
    before, T.DELETE_CHUNK, T.DELETE_THREADS = (T.DELETE_CHUNK, T.DELETE_THREADS), 3, 4
    try:
        T.delete_files(spark, iter(names), str(tmp_path / "landing"))
    finally:
        T.DELETE_CHUNK, T.DELETE_THREADS = before
    left = [str(p.relative_to(tmp_path)) for p in sorted(tmp_path.rglob("*")) if not p.name.startswith(".")]
    assert left == ["landing", "landing/day=1", "landing/day=1/late.json"]


def _lines(spark, root, orders=6):
    """Small tables of line items and what they refer to."""
    li = spark.range(orders * 3).selectExpr(
        "id DIV 3 AS l_orderkey", "id % 2 AS l_partkey", "0L AS l_suppkey", "CAST(id % 3 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "0D AS l_discount", "0D AS l_tax", "'A' AS l_returnflag", "'O' AS l_linestatus",
        "TIMESTAMP '2020-01-01' AS l_shipdate")
    tables = {
        "lineitem": li,
        "part": spark.range(2).selectExpr("id AS p_partkey", "'a \"b\" ' || id AS p_name", "'B' AS p_brand", "'T' AS p_type", "1 AS p_size"),
        "supplier": spark.range(1).selectExpr("id AS s_suppkey", "'S' AS s_name", "0 AS s_nationkey"),
        "nation": spark.range(1).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' AS n_name", "0 AS n_regionkey"),
        "region": spark.range(1).selectExpr("CAST(id AS INT) AS r_regionkey", "'R' AS r_name"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}.parquet")


def test_landing_takes_one_shuffle_and_gives_the_same_records(tmp_path, spark):
    from pyspark.sql import functions as F

    from tessera.operators.flatten import extract_positions, flatten
    from tessera.plans import registrations as R
    from tessera.sources.json_docs import ingest_json

    root = str(tmp_path / "t")
    _lines(spark, root)
    for part in (F.col("file_no") > 0, F.col("file_no") <= 0):
        R.write_landing_files(spark, root, str(tmp_path / "landing"), orders_per_file=2, file_filter=part)
    files = [p for p in (tmp_path / "landing").rglob("part-*")]
    assert len(files) == 3 and all(p.name.endswith(".txt.gz") for p in files)
    landed = extract_positions(flatten(ingest_json(spark, str(tmp_path / "landing"), R.AS_OF)), R.REGISTRATION_POSITIONS, keep=["source_file", "pos"])
    want = R.flat_registrations(spark, root, via_json=False)
    cols = [name for _, name, _ in R.REGISTRATION_POSITIONS]
    assert rows(landed, *cols) == rows(want, *cols)
    assert [r.n for r in landed.groupBy("source_file").agg(F.max("pos").alias("n")).collect()] == [5, 5, 5]
    plan = R.typed_lines(spark, root, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_shuffle_partitions_follow_the_input(spark):
    from tessera.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.unset(key)
    try:
        size_shuffles(spark, 1)
        assert spark.conf.get(key, None) is None
        size_shuffles(spark, 400 << 20)
        assert spark.conf.get(key) == "100"
        size_shuffles(spark, 40 << 20)
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_documents_land_in_one_folder(tmp_path, spark):
    """No folder per file; a document may span batches, and what has landed
    before stays."""
    import gzip

    from tessera.sources.json_docs import write_documents

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    land = tmp_path / "landing"
    spark.conf.set(key, "3")
    try:
        for first in (0, 2):
            data = [(n, f'["{n}","é]\\"{i}"]') for n in (first, first + 1) for i in range(5)] + [(None, '["x"]')] * (first == 0)
            write_documents(spark.createDataFrame(data, "file_no long, value string").coalesce(1), str(land))
    finally:
        spark.conf.set(key, old)
    files = sorted(p for p in land.rglob("part-*"))
    assert [p.name.split("-")[1] for p in files] == [f"file_key={n:06d}" for n in range(4)] + ["file_key=__HIVE_DEFAULT_PARTITION__"]
    assert all(p.parent == land for p in files) and not list(land.glob("_part*"))
    for n, p in enumerate(files[:4]):
        assert json.loads(gzip.open(p, "rt").read()) == {"data": [[str(n), f'é]"{i}'] for i in range(5)]}
    assert json.loads(gzip.open(files[4], "rt").read()) == {"data": [["x"]]}


def test_a_landing_without_loaded_files_is_read_as_a_folder(tmp_path, spark):
    """Names of single files go through the driver only where some of the
    landing are loaded; listing and reading small files take few tasks."""
    from tessera.session import size_listings
    from tessera.sources.json_docs import new_files

    land = tmp_path / "landing"
    land.mkdir()
    assert new_files(spark, str(land), None) == []
    (land / "f1.json").write_text("{}")
    purged = spark.createDataFrame([((land / "f0.json").as_uri(),)], "source_file string")
    assert new_files(spark, str(land), None) == new_files(spark, str(land), purged) == [str(land)]
    named = spark.read.format("binaryFile").load(str(land)).select(F.col("_metadata.file_path").alias("source_file"))
    assert new_files(spark, str(land), named) == []
    names = spark.createDataFrame(named.collect(), named.schema)
    (land / "f2.json").write_text("{}")
    assert [f.rpartition("/")[2] for f in new_files(spark, str(land), names)] == ["f2.json"]
    size_listings(spark)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) == 4 * spark.sparkContext.defaultParallelism


def test_local_files_are_removed_with_their_checksums(tmp_path, spark):
    from tessera.tables import delete_files

    land = tmp_path / "landing"
    spark.createDataFrame([("a",)], "v string").coalesce(1).write.text(str(land))
    names = [p.as_uri() for p in land.glob("part-*")]
    assert names and list(land.glob(".part-*.crc"))
    delete_files(spark, [*names, (land / "gone.json").as_uri()], str(land))
    assert not land.exists()


def test_landed_records_are_sorted_once(tmp_path, spark):
    from tessera.plans import registrations as R

    root = str(tmp_path / "t")
    _lines(spark, root)
    lines = R.typed_lines(spark, root, 2).sortWithinPartitions("file_no", "l_orderkey", *R._LINE_ORDER)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Window", 1)[0].count("Sort ") == 0
