"""Property tests: SCD2 with a change log gives the same history for any
batch split and order; dense ids equal a global row number."""

from datetime import datetime as dt, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import scd2 as S
from tessera.operators.keys import dense_ids

SCHEMA = "id long, ts timestamp_ntz, lsn long, op string, v string"
COLS = ("id", "v", "effective_start_at", "effective_end_at", "is_current", "closed_by")

change = st.tuples(
    st.integers(1, 3),                 # key
    st.integers(0, 6 * 24),            # hour offset (several day buckets)
    st.sampled_from(["UPSERT", "UPSERT", "DELETE"]),
    st.sampled_from(["a", "b"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(change, min_size=1, max_size=14), st.randoms(use_true_random=False))
def test_scd2_any_split_any_order(spark, changes, rnd):
    data = [
        (k, dt(2024, 1, 1) + timedelta(hours=h), i, op, None if op == "DELETE" else v)
        for i, (k, h, op, v) in enumerate(changes)
    ]
    expected = rows(S.versions_from_changes(spark.createDataFrame(data, SCHEMA), ["id"], ["v"]), *COLS)
    shuffled = data[:]
    rnd.shuffle(shuffled)
    cut = sorted(rnd.sample(range(len(shuffled) + 1), 2))
    batches = [shuffled[: cut[0]], shuffled[cut[0]: cut[1]], shuffled[cut[1]:], shuffled[: cut[0]]]  # plus a redelivery
    log = hist = None
    for b in batches:
        if not b:
            continue
        df = spark.createDataFrame(b, SCHEMA)
        log = S.change_log_merge(log, df, ["id"]).cache()
        hist = S.scd2_apply(hist, df, ["id"], ["v"], log=log).cache()
    assert rows(hist, *COLS) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.text("abc", max_size=3)), st.integers(-5, 5)), min_size=0, max_size=60),
       st.integers(1, 9))
def test_dense_ids_property(spark, data, buckets):
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(data)], "a string, b int, i int")
    got = dense_ids(df, ["a", "b", "i"], "rid", num_partitions=buckets)
    exp = df.withColumn("rid", F.row_number().over(Window.orderBy(
        F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last(), F.col("i").asc_nulls_last())).cast("long"))
    assert rows(got) == rows(exp)
