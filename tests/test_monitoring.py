"""CDC monitoring operators and CDC landing helpers on small fixtures."""

from datetime import datetime as dt

from conftest import rows
from tessera.operators import monitoring as MON
from tessera.sources.cdc import normalize_ops, read_cdc


def test_lineage_violations(spark):
    consumption = spark.createDataFrame(
        [("b1", "s1", 1), ("b1", "s1", 2), ("b2", "s1", 3), ("b2", "s2", 4), ("b3", "s3", 9)],
        "batch string, sync string, id int")
    landing = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    got = rows(MON.lineage_violations(consumption, landing, "batch", "sync", ["id"]))
    assert got == [("BATCH_NOT_ONE_SYNC", "b2"), ("NO_LANDING_ROW", "9")]


def test_cdc_reconcile_and_monitor(spark):
    a = spark.range(10)
    r = MON.cdc_reconcile(a, a.limit(9), a.limit(6), a.limit(3)).collect()[0]
    assert (r["lost_in_transport"], r["unexplained"], r["status"]) == (1, 0, "FAIL")
    dim = spark.createDataFrame([(dt(2024, 1, 30, 10, 59), True), (dt(2024, 1, 30, 11, 1), False)],
                                "cdc_synced_at timestamp_ntz, is_current boolean")
    m = MON.cdc_monitor(dim, "2024-01-31 00:00:00").collect()[0]
    assert (m["total_records"], m["hours_since_sync"], m["current_records"], m["alert_stale_sync"], m["alert_no_current"]) == (
        2, 13, 1, False, False)


def test_evidence_summary(spark):
    ev = spark.createDataFrame(
        [(dt(2024, 1, 1, 1), "PASS"), (dt(2024, 1, 1, 2), "warning"), (dt(2024, 1, 1, 3), "FAIL"),
         (dt(2024, 1, 2, 1), "BLOCKED"), (dt(2024, 1, 2, 2), "PASS")],
        "timestamp_utc timestamp_ntz, result string")
    got = rows(MON.evidence_summary(ev), "total", "pass", "warning", "fail", "blocked")
    assert got == [(2, 1, 0, 0, 1), (3, 1, 1, 1, 0)]


def test_schema_drift_per_position(spark):
    flat = spark.sql("""SELECT parse_json(j) AS value FROM VALUES ('["a", 1, null]'), ('["b", "2", 3.5]') AS t(j)""")
    got = rows(MON.schema_drift(flat, {0: "STRING", 1: "BIGINT", 2: "DOUBLE"}), "position", "observed_type", "rows")
    assert got == [(1, "STRING", 1), (2, "DECIMAL(2,1)", 1)]


def test_cdc_landing_ops(tmp_path, spark):
    df = spark.createDataFrame(
        [(1, "insert", 10), (1, "UPDATE", 11), (2, None, 12), (3, "delete", 13)], "catalog_id long, cdc_operation string, lsn long")
    assert rows(normalize_ops(df), "catalog_id", "op") == [(1, "UPSERT"), (1, "UPSERT"), (2, "UPSERT"), (3, "DELETE")]
    path = str(tmp_path / "cdc")
    spark.createDataFrame([(7, "Acme", dt(2024, 1, 1), "INSERT", 5)],
                          "catalog_id long, manufacturer_name string, last_updated_at timestamp_ntz, cdc_operation string, lsn long"
                          ).write.parquet(path)
    got = read_cdc(spark, path).select("catalog_id", "manufacturer_name", "seating_capacity", "lsn").collect()
    assert [tuple(r) for r in got] == [(7, "Acme", None, 5)]

