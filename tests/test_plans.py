"""Physical-plan properties that the scale design relies on."""

from pyspark.sql import functions as F

from tessera.operators.aggregates import market_metrics, top_n
from tessera.operators.dedup import latest_per_key
from tessera.plans import star as S
from tessera.plans.registrations import flat_registrations
from tessera.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()  # run through the DataFrame's own execution: AQE's final plan
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_filters_and_columns_reach_the_scan(spark):
    li = read_table(spark, SF, "lineitem")
    q = li.where(F.col("l_quantity") > 10).select("l_orderkey", "l_quantity")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_latest_per_key_limits_before_the_shuffle(spark):
    flat = flat_registrations(spark, SF, via_json=False)
    q = latest_per_key(flat, ["vin"], [F.col("source_file").desc(), F.col("pos").desc()])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_aggregates_combine_map_side(spark):
    flat = flat_registrations(spark, SF, via_json=False)
    plan = market_metrics(flat)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_avg" in plan and "partial_max" in plan


def test_top_n_does_not_sort_everything(spark):
    li = read_table(spark, SF, "lineitem")
    plan = top_n(li, [F.col("l_extendedprice").desc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_star_joins_broadcast_dimensions_of_known_size(spark):
    star = S.build_star(flat_registrations(spark, SF, via_json=False))
    base = S.denorm_base(star)
    planned = base._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in planned  # broadcast chosen up front, not after a shuffle
    plan = final_plan(base)
    assert plan.count("BroadcastHashJoin") >= 16
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:  # no hint: dimensions above the threshold are shuffled
        plan = S.denorm_base(star)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 16 and plan.count("BroadcastHashJoin") == 1  # the offsets of the dense ids
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_single_row_summaries_are_scalar_subqueries(spark):
    from tessera.operators.joins import attach_scalars

    li = read_table(spark, SF, "lineitem")
    q = attach_scalars(li.select("l_orderkey"), li.agg(F.count(F.lit(1)).alias("n")), li.agg(F.max("l_quantity").alias("m")))
    plan = final_plan(q)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Subquery" in plan


def test_asof_join_has_no_range_join(spark):
    from datetime import datetime as dt

    from tessera.operators.joins import effective_join

    events = spark.createDataFrame([(1, dt(2024, 1, 2))], "k long, ts timestamp_ntz")
    versions = spark.createDataFrame([(1, "a", dt(2024, 1, 1), None)],
                                     "k long, v string, effective_start_at timestamp_ntz, effective_end_at timestamp_ntz")
    j = effective_join(events, versions, "k", "k", "ts", attrs=["v"])
    plan = final_plan(j)
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert joins and not any(">=" in line or "<" in line for line in joins)  # equi joins only, no range condition
    assert "NestedLoopJoin" not in plan
    assert [r["v"] for r in j.collect()] == ["a"]


def test_stored_tables_are_read_without_a_shuffle(tmp_path, spark):
    from tessera.plans import consumption as C

    star = S.build_star(flat_registrations(spark, SF, via_json=False), fact_ids=False)
    want = S.denorm_base(star).groupBy("make_name").count().collect()
    C.refresh_consumption(star, str(tmp_path / "c"), 3, buckets=4)
    tables = C.open_consumption(spark, str(tmp_path / "c"), buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q in (C.top_makes(tables), C.repeated_registrations(tables)):
            assert "Exchange" not in final_plan(q)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, C.top_makes(tables).collect())) == sorted(map(tuple, want))
    often = tables.base.groupBy("vin").count().where("count > 1")
    assert C.repeated_registrations(tables).count() == often.selectExpr("sum(`count`)").first()[0]
    n = tables.base.count()
    C.refresh_consumption(star, str(tmp_path / "c"), 3, buckets=4)  # the run again
    assert C.open_consumption(spark, str(tmp_path / "c"), 4).base.count() == n


def test_star_writes_only_the_columns_that_it_reads(spark, monkeypatch):
    flat = flat_registrations(spark, SF, via_json=False)
    written, plain = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df: written.append(plain(df)) or written[-1])
    S.build_star(flat)
    assert set(written[0].columns) == {u.source for u in S.DIM_USES.values()} | set(S.RECORD_COLUMNS)


def test_buckets_grow_with_the_input(tmp_path, spark, monkeypatch):
    from tessera.plans import consumption as C
    from tessera.plans import q_star as P

    assert [C.buckets_for(n << 20) for n in (1, 256, 640, 3840)] == [16, 16, 40, 240]
    monkeypatch.setattr(P, "path_bytes", lambda *_: 320 << 20)
    tables = P._stored(spark, SF)
    assert tables.base.selectExpr("input_file_name() AS f").distinct().count() == 20
    assert "Exchange" not in final_plan(tables.base.groupBy("vin").count())
    assert tables.base.count() == read_table(spark, SF, "lineitem").count()
