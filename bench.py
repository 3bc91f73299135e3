"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up and then $BENCH_REPEATS times; the
median wall time of a full evaluation (noop sink, every row produced) is
reported. One run at a tenth of the size ($BENCH_SMALL_DIR, the sibling
folder by default) gives the ratio of the two, under "times_smaller".
Prints one JSON line.
"""

from __future__ import annotations

import gc
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import registry  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.tables import release_materialized  # noqa: E402

CLEAN_BETWEEN = os.environ.get("BENCH_CLEAN", "1") == "1"

HEADLINE = [
    "clean_registrations",
    "fact_market_metrics",
    "fact_registration_normalized",
    "kpi_make_type_mix",
    "scd2_history",
    "effective_join_purchases",
    "dq_error_rows",
    "dq_reconciliation",
    "cost_situation",
    "forecast_by_make",
    "stream_clean_registrations",
    "stream_scd2_history",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def release(spark) -> None:
    """Between queries: drop the copies that they have written, and let
    Spark's cleaner drop the shuffles that nothing references any more."""
    release_materialized(spark)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_dir(sf_dir: str) -> str | None:
    """The sibling folder of a tenth of the size, if there is one."""
    if "BENCH_SMALL_DIR" in os.environ:
        return os.environ["BENCH_SMALL_DIR"] or None
    folder, name = os.path.split(sf_dir.rstrip("/"))
    try:
        path = os.path.join(folder, f"sf{float(name.removeprefix('sf')) / 10:g}")
    except ValueError:
        return None
    return path if os.path.isdir(path) else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "tessera-bench", shuffle_partitions=max(8, cpus * 2),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "6g")},
    )
    registry.load_all()
    timings = {}
    ratios = {}
    failed = []
    small = small_dir(sf_dir)
    for name in names:
        fn = registry.QUERIES[name]
        try:
            run_once(spark, fn, sf_dir)
            timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 3)
            if small:
                ratios[name] = round(timings[name] / run_once(spark, fn, small), 2)
            if CLEAN_BETWEEN:
                release(spark)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the others
            print(f"bench: {name} failed: {str(e)[:300]}", file=sys.stderr)
            failed.append(name)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        **({"times_smaller": ratios} if ratios else {}),
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
