"""Data-quality checks, reconciliation, freshness and boundary counting."""

from datetime import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.scalar import boundaries_between
from tessera.operators import quality as Q


def registrations_dq(spark):
    data = [
        ("V1", "TESLA", "S", 2020, -1), ("V2", "TESLA", "S", 2020, 0), ("V3", "KIA", "E", 2021, 500),
        ("V4", "KIA", "E", 2021, 501), ("V5", "KIA", "E", 2021, None), ("V6", None, "X", 2022, 10),
        ("V7", "ACME", "Z", None, 20),
    ]
    return spark.createDataFrame(
        data, "vin string, make string, model string, model_year int, electric_range int"
    ).withColumn("ev_type", F.lit("BEV")).withColumn("base_msrp", F.lit(1.0)).withColumn("source_file", F.lit("f"))


def test_range_orphan_null_checks(spark):
    df = registrations_dq(spark)
    mfg = spark.createDataFrame([("TESLA",), ("KIA",)], "manufacturer_name string")
    assert rows(Q.dq_out_of_range(df), "vin") == [("V1",), ("V4",)]  # NULL is not out of range
    assert rows(Q.dq_orphan(df, mfg), "vin") == [("V6",), ("V7",)]  # NULL make is an orphan too
    assert rows(Q.dq_null_any(df), "vin") == [("V6",), ("V7",)]
    errors = Q.quarantine([Q.dq_out_of_range(df), Q.dq_orphan(df, mfg), Q.dq_null_any(df)], detected_at="2024-01-31 00:00:00")
    assert errors.count() == 6
    summary = {r["error_type"]: r["error_count"] for r in Q.error_summary(errors).collect()}
    assert summary == {"INVALID_RANGE": 2, "ORPHAN_MAKE": 2, "NULL_CRITICAL_FIELD": 2}
    top = {r["make"]: (r["total_errors"], r["error_types"]) for r in Q.top_offenders(errors).collect()}
    assert top == {"TESLA": (1, ["INVALID_RANGE"]), "KIA": (1, ["INVALID_RANGE"]), "ACME": (2, ["NULL_CRITICAL_FIELD", "ORPHAN_MAKE"])}
    stored = errors.limit(0)
    assert Q.new_errors_only(errors, stored).count() == 6
    assert Q.new_errors_only(errors, errors).count() == 0


def test_duplicates_skip_known_keys(spark):
    flat = spark.createDataFrame(
        [("V1", "A", "m", "f1"), ("V1", "A", "n", "f2"), ("V1", "B", "m", "f2"), ("V2", "C", "m", "f1"), (None, "D", "m", "f1"), (None, "D", "m", "f3")],
        "vin string, make string, model string, source_file string",
    )
    d = Q.dq_duplicates(flat)
    assert rows(d, "vin", "occurrence_count", "make", "model") == [("V1", 3, "B", "n")]
    assert d.collect()[0]["source_files"] == ["f1", "f2"]
    assert Q.dq_duplicates(flat, existing=d.select("vin")).count() == 0


def _layers(spark, gold_rows, silver_vins):
    raw = spark.createDataFrame([("d1",), ("d2",)], "doc string")
    flat = spark.createDataFrame([("V1",), ("V1",), ("V2",), ("V3",), (None,)], "vin string")
    clean = spark.createDataFrame([(v,) for v in silver_vins], "vin string")
    gold = spark.createDataFrame(gold_rows, "make string, total_vehicles long")
    return Q.reconcile(raw, flat, clean, gold).collect()[0]


def test_reconcile_pass_empty_and_drift(spark):
    ok = _layers(spark, [("A", 2), ("B", 1)], ["V1", "V2", "V3"])
    assert (ok["bronze_flattened_rows"], ok["bronze_unique_vins"], ok["duplicates_removed"], ok["status"]) == (4, 3, 1, "PASS")
    empty = _layers(spark, [], ["V1", "V2", "V3"])
    assert empty["gold_total_vehicles"] is None and empty["status"] == "DRIFT_DETECTED"
    drift = _layers(spark, [("A", 2), ("B", 1)], ["V1", "V2"])
    assert (drift["bronze_to_silver_drift"], drift["silver_to_gold_drift"], drift["status"]) == (-1, 1, "DRIFT_DETECTED")


def test_freshness_edges(spark):
    now = dt(2024, 1, 31, 12, 0)
    ages = [5, 6, 60, 61]
    data = [("SILVER", f"t{a}", dt(2024, 1, 31, 12, 0).replace(hour=(12 * 60 - a) // 60, minute=(12 * 60 - a) % 60)) for a in ages]
    data.append(("SILVER", "none", None))
    df = spark.createDataFrame(data, "layer string, table_name string, last_refresh timestamp_ntz")
    got = {r["table_name"]: (r["minutes_since_refresh"], r["freshness_status"]) for r in Q.freshness(df, now).collect()}
    assert got == {"t5": (5, "FRESH"), "t6": (6, "ACCEPTABLE"), "t60": (60, "ACCEPTABLE"), "t61": (61, "STALE"), "none": (None, "STALE")}


def test_boundaries_between_counts_crossings(spark):
    df = spark.createDataFrame([(dt(2024, 1, 1, 0, 59), dt(2024, 1, 1, 1, 1)), (dt(2024, 1, 31), dt(2024, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(*[boundaries_between(u, "a", "b").alias(u) for u in ["minute", "hour", "day", "month", "year"]]).collect()
    assert [tuple(r) for r in got] == [(2, 1, 0, 0, 0), (1440, 24, 1, 1, 0)]


def test_column_tests_and_dashboard(spark):
    df = registrations_dq(spark)
    nn = rows(Q.expect_not_null(df, ["vin", "make", "model_year", "electric_range"]), "column_name", "failures")
    assert nn == [("electric_range", 1), ("make", 1), ("model_year", 1)]
    assert Q.expect_unique(df, "vin").count() == 0
    errors = Q.quarantine([Q.dq_out_of_range(df)], detected_at="2024-01-31 00:00:00")
    dupes = spark.createDataFrame([("V1", 2, dt(2024, 1, 30))], "vin string, occurrence_count long, detected_at timestamp_ntz")
    rec = _layers_df(spark)
    dash = Q.dq_dashboard(errors, dupes, rec, "2024-01-31 00:30:00").collect()
    assert len(dash) == 1 and dash[0]["errors_last_1h"] == 2 and dash[0]["dupes_last_24h"] == 0
    assert Q.dq_dashboard(errors.limit(0), dupes, rec, "2024-01-31 00:30:00").count() == 0


def _layers_df(spark):
    raw = spark.createDataFrame([("d1",)], "doc string")
    flat = spark.createDataFrame([("V1",)], "vin string")
    gold = spark.createDataFrame([("A", 1)], "make string, total_vehicles long")
    return Q.reconcile(raw, flat, flat, gold)


def test_lineage_edges_and_metric_results(spark):
    log = spark.sql(
        """SELECT 'u1' AS user_name, 'q1' AS query_id, TIMESTAMP_NTZ '2024-01-30 10:00:00' AS query_start_time,
                  parse_json('[{"objectDomain":"Table","objectName":"DB.GOLD.F","columns":["a"],
                                "directSources":[{"objectDomain":"Table","objectName":"DB.SILVER.S"}]},
                               {"objectDomain":"View","objectName":"DB.X","directSources":[{"objectName":"DB.Y"}]}]') AS objects_modified
           UNION ALL
           SELECT 'u2', 'q2', TIMESTAMP_NTZ '2023-12-01 10:00:00',
                  parse_json('[{"objectDomain":"Table","objectName":"DB.GOLD.F","directSources":[{"objectName":"DB.S"}]}]')"""
    )
    e = Q.lineage_edges(log, "2024-01-31 00:00:00", "%db.%")
    assert rows(e, "source_object", "target_object", "user_name") == [("DB.SILVER.S", "DB.GOLD.F", "u1")]
    m = spark.createDataFrame(
        [("DB", "S", "T", "DB", "M", "NULL_COUNT", "[a]", 0.0, None, None), ("OTHER", "S", "T", "DB", "M", "X", None, 1.0, None, None)],
        "table_database string, table_schema string, table_name string, metric_database string, metric_schema string, "
        "metric_name string, argument_names string, value double, scheduled_time timestamp, change_commit_time timestamp",
    )
    got = Q.metric_results(m, "DB").collect()
    assert [(r["full_table_name"], r["dmf_name"]) for r in got] == [("DB.S.T", "DB.M.NULL_COUNT")]


def test_detection_run_appends_only_new(tmp_path, spark):
    from tessera.plans.dq_run import detect_errors

    df = registrations_dq(spark).withColumn("pos", F.lit(0))
    flat = df.unionByName(df.where("vin = 'V1'"))  # V1 twice: a duplicate
    gold = df.groupBy("make", "ev_type").agg(F.count("vin").alias("total_vehicles"))
    raw = spark.createDataFrame([("d",)], "doc string")
    root = str(tmp_path / "dq")
    go = lambda new, hour, n, **kw: detect_errors(raw, flat, new, df, gold, root, f"2024-01-31 0{hour}:00:00", n, **kw)
    first = go(flat, 0, 1)
    again = go(flat.limit(0), 1, 2)
    everything = go(flat.limit(0), 2, 3, mode="append_all")
    assert first.checked == {"rows": 7, "INVALID_RANGE": 2, "NULL_CRITICAL_FIELD": 2}
    assert (first.new_duplicates, first.new_errors) == (1, 4)
    assert (again.new_duplicates, again.new_errors) == (0, 0)
    assert everything.new_errors == 4
    assert first.reconciliation["bronze_unique_vins"] == 7
    repeated = go(flat, 0, 1)  # replaces its first attempt
    assert (repeated.new_duplicates, repeated.new_errors) == (1, 4)
    assert spark.read.parquet(f"{root}/error_rows").count() == 8


def test_share_rule_allows_rounding_only(spark):
    shares = [("thirds", 33.33, 1)] * 3 + [("missing", 48.0, 1), ("missing", 48.0, 1), ("negative", 100.0, -1)]
    got = Q.share_rule_violations(spark.createDataFrame(shares, "g string, pct double, n long"), ["g"], "pct", "n")
    assert rows(got, "g") == [("missing",), ("negative",)]


def test_broken_rules_equal_single_checks(spark):
    """One scan gives what one scan per check gives; observed counts are
    those of the rows."""
    from pyspark.sql import Observation

    df = registrations_dq(spark)
    mfg = spark.createDataFrame([("TESLA",), ("KIA",), (None,)], "manufacturer_name string")
    seen = Observation()
    found = Q.broken_rules(Q.with_known(df, mfg), Q.clean_rules("_known"), seen)
    single = Q.dq_out_of_range(df).unionByName(Q.dq_orphan(df, mfg)).unionByName(Q.dq_null_any(df))
    assert rows(found.select(single.columns)) == rows(single)
    assert seen.get == {"rows": 7, "INVALID_RANGE": 2, "NULL_CRITICAL_FIELD": 2, "ORPHAN_MAKE": 2}
    empty = Observation()
    assert Q.broken_rules(df.limit(0), Q.clean_rules(), empty).collect() == [] and empty.get["rows"] == 0


def test_running_duplicates(tmp_path, spark):
    """Three runs, the second repeated: each duplicate is found once, by the
    run that makes it one; counts and files are those of all rows."""
    import random

    from tessera.operators.duplicates import RunningDuplicates

    rng = random.Random(3)
    schema = "vin string, make string, model string, source_file string"
    runs = [[(rng.choice([None, *"ABCDEFGHIJ"]), rng.choice("xy"), rng.choice([None, "m", "n"]), f"f{n}{rng.randrange(2)}") for _ in range(6)] for n in range(3)]
    state = RunningDuplicates(str(tmp_path))
    known, seen = set(), []
    for n, data in enumerate(runs):
        df = spark.createDataFrame(data, schema)
        seen += data
        whole = {r.vin: r for r in Q.dq_duplicates(spark.createDataFrame(seen, schema)).collect()}
        for _ in range(2 if n == 1 else 1):
            got = state.detect(df, n).collect()
        assert {r.vin for r in got} == set(whole) - known
        for r in got:
            w = whole[r.vin]
            assert (r.occurrence_count, r.make, r.model, r.source_file_count) == (w.occurrence_count, w.make, w.model, len(w.source_files))
        known |= set(whole)
        assert rows(state.duplicates(spark), "vin", "occurrence_count") == sorted((k, w.occurrence_count) for k, w in whole.items())
        assert rows(state.duplicate_files(spark), "vin", "source_file") == sorted((k, f) for k, w in whole.items() for f in w.source_files)
        if n == 1:
            state.compact(spark)
    assert len(known) > 3


def test_run_rules(spark):
    from tessera.operators.run_rules import run_metrics, run_violations

    docs = {1: ['{"a": 1, "b": "x"}'] * 10, 2: ['{"a": 1}'] * 7, 3: ['{"a": "1", "b": 2}'] * 6 + ['{"b": null}'], 4: ['{"a": "2", "b": 2}'] * 30}
    df = spark.createDataFrame([(n, t) for n, ts in docs.items() for t in ts], "run int, t string").withColumn("value", F.parse_json("t"))
    m = run_metrics(df, F.lit("T"), F.col("run"), {"a": "$.a", "b": "$.b"})
    assert rows(m.where("run_no = 3"), "field", "n_rows", "n_missing", "types") == [(None, 7, 0, []), ("a", 7, 1, ["STRING"]), ("b", 7, 1, ["BIGINT"])]
    got = rows(run_violations(m), "run_no", "field", "rule", "previous", "current")
    assert got == [(2, None, "ROW_COUNT_DROP", "10", "7"), (2, "b", "FIELD_LOST", "STRING", ""), (3, "a", "MISSING_RISE", "0", "1"),
                   (3, "a", "TYPE_CHANGED", "BIGINT", "STRING"), (3, "b", "FIELD_ADDED", "", "BIGINT")]


def test_layers_are_landed_once(tmp_path, spark):
    """The reconciliation and what carries its status read the written layers,
    the raw documents are counted by the pass that writes them."""
    from tessera.plans.q_operations import q_consumption_rows
    from tessera.plans.q_quality import Layers
    from tests.test_batch_run import _lines

    root = str(tmp_path)
    _lines(spark, root)
    spark.range(40).selectExpr(
        "id AS event_id", "id % 4 AS user_id", "CAST(timestampadd(HOUR, id, TIMESTAMP '2024-01-01') AS TIMESTAMP_NTZ) AS ts",
        "element_at(array('purchase', 'signup', 'error'), CAST(id % 3 + 1 AS INT)) AS event_type", "CAST(id AS DOUBLE) AS value",
        "concat('{\"k\": ', id, '}') AS props").write.parquet(f"{root}/events.parquet")
    layers = Layers(spark, root)
    assert layers.raw_rows == 6
    found = layers.reconciliation().collect()[0]
    assert (found.bronze_raw_rows, found.bronze_flattened_rows, found.silver_rows, found.status) == (6, 18, 2, "PASS")
    rows_ = q_consumption_rows(spark, root)
    assert "l_orderkey" not in rows_._jdf.queryExecution().optimizedPlan().toString()
    assert {r.quality_status for r in rows_.collect()} == {"PASS"} and rows_.count() == 14


def test_only_rows_without_a_key_keep_their_raw_record(tmp_path, spark, monkeypatch):
    from tessera.plans import q_quality as P
    from tests.test_batch_run import _lines

    _lines(spark, str(tmp_path))
    written, plain = [], P.materialize

    def materialize(df):
        written.append(plain(df))
        return written[-1]

    monkeypatch.setattr(P, "materialize", materialize)
    assert {r.error_type: r.error_count for r in P.q_dq_error_trend(spark, str(tmp_path)).collect()}["NULL_VIN"] == 1
    assert [(r.vin is None, r.value is None) for r in written[0].collect()].count((True, False)) == 1
    assert written[0].where("vin IS NOT NULL AND value IS NOT NULL").count() == 0


def test_checks_write_only_the_fields_that_they_read(tmp_path, spark, monkeypatch):
    from tessera.plans import medallion as M
    from tessera.plans import q_quality as P
    from tessera.plans.registrations import flat_registrations
    from tests.test_batch_run import _lines

    root = str(tmp_path)
    _lines(spark, root)
    monkeypatch.setattr(P, "EXCLUDED_BRANDS", ["B"])  # all are orphans
    written, plain = [], P.materialize
    monkeypatch.setattr(P, "materialize", lambda df: written.append(plain(df)) or written[-1])
    got = P.q_dq_error_rows(spark, root)
    flat = flat_registrations(spark, root)
    rules = Q.clean_rules("_known")
    whole = Q.broken_rules(Q.with_known(M.clean_registrations(flat), P.manufacturers(spark, root)), rules)
    assert rows(got) == rows(Q.quarantine([Q.dq_null_key(flat), whole], detected_at=P.AS_OF)) != []
    P.Layers(spark, root)
    read = {"vin", "make", "model", "model_year", "ev_type", "electric_range", "base_msrp", "source_file", "pos"}
    assert len(written) == 3 and all(set(w.columns) <= read for w in written)
