"""Metering rollup and upsert, burn rate, projection and status tiers,
the linear forecast against a direct computation, cadence and lag."""

from datetime import date, datetime as dt, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import cost as C
from tessera.operators import monitoring as MON
from tessera.operators.forecast import linear_forecast
from tessera.operators.merge import merge_upsert


def metering(spark):
    start = dt(2023, 12, 23)
    data = []
    for d in range(40):  # 40 days x 2 warehouses, through a month end
        for wh, c in [("WH_A", 1.0), ("WH_B", 2.0)]:
            t = start + timedelta(days=d, hours=3)
            data.append((t, wh, c, c / 10, c * 1.1))
            data.append((t + timedelta(hours=5), wh, c, c / 10, c * 1.1))
    data.append((start, None, 9.0, 0.0, 9.0))
    return spark.createDataFrame(
        data, "start_time timestamp_ntz, warehouse_name string, credits_used_compute double, "
        "credits_used_cloud_services double, credits_used double")


def test_daily_rollup_lookback_and_upsert(spark):
    daily = C.metering_daily(metering(spark), None, 30, "2024-01-31 00:00:00")
    assert daily.where(F.col("warehouse_name").isNull()).count() == 0
    assert rows(daily.groupBy().agg(F.min("usage_date"), F.max("usage_date"))) == [(date(2024, 1, 1), date(2024, 1, 31))]
    a = rows(daily.where("warehouse_name = 'WH_A'").select(F.round("credits_used_total", 6)).distinct())
    assert a == [(2.2,)]
    past = metering(spark).where(F.col("start_time") < F.lit("2024-01-10").cast("timestamp_ntz"))
    target = C.metering_daily(past, None, 30, "2024-01-10 00:00:00")  # what the table held on Jan 10
    merged = C.metering_daily(metering(spark), target, 5, "2024-01-31 00:00:00")
    assert target.count() == 36 and merged.count() == 36 + 12  # Jan 26..31 inserted
    # updated rows carry the new run time, untouched ones the old
    ts = rows(merged.groupBy("last_updated_ts").count())
    assert ts == [(dt(2024, 1, 10), target.count()), (dt(2024, 1, 31), 12)]


def test_merge_upsert_semantics(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    src = spark.createDataFrame([(2, "B", 99), (3, "C", 30)], "k int, v string, n int")
    assert rows(merge_upsert(tgt, src, ["k"])) == [(1, "a", 10), (2, "B", 99), (3, "C", 30)]
    assert rows(merge_upsert(tgt, src, ["k"], update_cols=["v"], insert_cols=["v"])) == [(1, "a", 10), (2, "B", 20), (3, "C", None)]


def test_situation_status_and_zero_quota(spark):
    daily = C.metering_daily(metering(spark), None, 30, "2024-01-31 00:00:00")
    monitors = spark.createDataFrame(
        [("EV_PIPELINE_MONITOR", 20.0, 15.0, 5.0, 75.0, 95.0, 100.0, "o", "WH_A"),
         ("EV_ACCOUNT_MONITOR", 0.0, 3.0, 0.0, 75.0, 90.0, 100.0, "o", None)],
        "monitor_name string, credit_quota double, used_credits double, remaining_credits double, notify_percent double, "
        "suspend_percent double, suspend_immediate_percent double, owner string, warehouses string")
    snap = C.budget_snapshot(monitors, "2024-01-31 00:00:00")
    sit = {r["monitor_name"]: r for r in C.cost_situation(snap, daily, "2024-01-31 00:00:00", "WH_A").collect()}
    p = sit["EV_PIPELINE_MONITOR"]
    assert p["days_left_in_cycle"] == 1 and p["avg_daily_credits_7d"] == pytest.approx(2.2)
    assert (p["pct_used"], p["current_status"]) == (75.0, "MEDIUM")
    assert p["projected_month_end_credits"] == pytest.approx(17.2) and p["projected_status"] == "MEDIUM"
    a = sit["EV_ACCOUNT_MONITOR"]
    assert (a["monitor_level"], a["pct_used"], a["projected_status"]) == ("ACCOUNT", 0.0, "UNKNOWN")
    brief = C.cost_brief(C.latest_situation(C.cost_situation(snap, daily, "2024-01-31 00:00:00", "WH_A"))).collect()
    assert len(brief) == 2 and all(r["recommended_action"].startswith("Recommended action") for r in brief)
    trend = C.cost_trend(daily).where("warehouse_name = 'WH_B'").orderBy("usage_date").collect()
    assert trend[-1]["cumulative_credits"] == pytest.approx(4.4 * 31)


def _py_forecast(points, horizon=3):
    """Direct least squares in exact fractions, half-even rounding (as
    Python's round), clamp at 0; fewer than three points: no forecast."""
    if len(points) < 3:
        return []
    xs = [Fraction(p[0]) for p in points]
    ys = [Fraction(p[1]) for p in points]
    n = len(xs)
    mx, my = sum(xs) / n, sum(ys) / n
    den = sum((x - mx) ** 2 for x in xs)
    slope = Fraction(0) if den == 0 else sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / den
    last = max(p[0] for p in points)
    return [(last + s, max(0, round(my + slope * (last + s - mx)))) for s in range(1, horizon + 1)]


def test_forecast_matches_direct_computation(spark):
    series = {
        "two": [(2020, 5), (2021, 6)],
        "three": [(2019, 10), (2020, 12), (2021, 17)],
        "falling": [(2018, 9), (2019, 5), (2020, 1)],
        "half": [(2020, 1), (2021, 2), (2022, 2)],
        "flat_x": [(2020, 3), (2020, 4), (2020, 6)],
    }
    data = [(g, x, y) for g, pts in series.items() for x, y in pts]
    df = spark.createDataFrame(data, "g string, x int, y long")
    got = rows(linear_forecast(df, ["g"], "x", "y"), "g", "x", "forecast")
    exp = sorted((g, x, v) for g, pts in series.items() for x, v in _py_forecast(pts))
    assert got == exp
    assert all(v >= 0 for _, _, v in got)
    assert ("half", 2023, 2) in got or ("half", 2023, 3) in got


def test_cadence_and_lag(spark):
    base = dt(2024, 1, 28, 0, 0)
    runs = []
    t = base
    for i in range(200):
        t = t + timedelta(minutes=31 if i == 100 else 15)
        runs.append((t, i != 50))
    df = spark.createDataFrame(runs, "run_ts timestamp_ntz, succeeded boolean")
    r = MON.cadence_report(df, "2024-01-31 00:00:00").collect()[0]
    assert r["runs"] == 200 and r["gaps_over_limit"] == 1 and r["success_pct"] == 99.5 and r["cadence_ok"]
    lag = spark.createDataFrame([(dt(2024, 1, 1), dt(2024, 1, 1, 0, 20)), (dt(2024, 1, 1), dt(2024, 1, 1, 0, 31))],
                                "src timestamp_ntz, landed timestamp_ntz")
    assert rows(MON.lag_report(lag, "src", "landed"), "lag_min", "lag_status") == [(20.0, "OK"), (31.0, "BREACH")]


def test_refresh_cost_runs_twice(tmp_path, spark):
    from tessera.plans.cost_refresh import refresh_cost

    monitors = spark.createDataFrame(
        [("EV_PIPELINE_MONITOR", 20.0, 5.0, 15.0, 75.0, 95.0, 100.0, "o", "WH_A")],
        "monitor_name string, credit_quota double, used_credits double, remaining_credits double, notify_percent double, "
        "suspend_percent double, suspend_immediate_percent double, owner string, warehouses string")
    root = str(tmp_path / "cost")
    refresh_cost(spark, monitors, metering(spark), root, "2024-01-20 00:00:00", "WH_A")
    for _ in range(2):  # a repeated run adds nothing
        out = refresh_cost(spark, monitors, metering(spark), root, "2024-01-31 00:00:00", "WH_A")
    brief = out["brief"].collect()
    assert len(brief) == 1 and brief[0]["snapshot_ts"] == dt(2024, 1, 31)
    assert spark.read.parquet(root + "/cost_situation").count() == 2
    assert out["daily"].select("usage_date").distinct().count() == out["daily"].count() / 2


def test_merge_replaces_touched_partitions_only(tmp_path, spark):
    """Older days' files stay; rows of touched days that the source lacks
    stay; a run that fails while it puts partitions in place is finished."""
    from tessera.operators import merge as M

    root, schema = str(tmp_path / "t"), "day int, k string, v int"
    first = [(d, k, d * 10) for d in (1, 2, 3) for k in "ab"]
    M.merge_partitions(spark.createDataFrame(first, schema), root, ["day", "k"], "day", 1)
    files = lambda day: sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / "t/table" / f"day={day}").glob("*.parquet"))
    before = {d: files(d) for d in (1, 2, 3)}
    source = spark.createDataFrame([(3, "a", 99), (4, "c", 1)], schema)
    want = [(1, "a", 10), (1, "b", 10), (2, "a", 20), (2, "b", 20), (3, "a", 99), (3, "b", 30), (4, "c", 1)]
    for _ in range(2):
        assert rows(M.merge_partitions(source, root, ["day", "k"], "day", 2), "day", "k", "v") == want
    assert files(1) == before[1] and files(2) == before[2] and files(3) != before[3]
    # the partitions are lost half way: the staged rows of the run bring them back
    import shutil
    shutil.rmtree(tmp_path / "t/table/day=3")
    assert rows(M.merge_partitions(source, root, ["day", "k"], "day", 2), "day", "k", "v") == want
