"""Business codes, dimensions with unknown members, key resolution and
distributed dense ids."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.scalar import business_code
from tessera.operators.joins import Lookup, denormalize, resolve_keys
from tessera.operators.keys import (
    build_child_dim,
    build_dim,
    build_name_dims,
    build_numeric_dim,
    build_pair_dim,
    code_collisions,
    dense_ids,
)


def names_messy(spark):
    data = [
        (" a-b ", "m1", 2020), ("A B", "m1", 2021), ("A  B", "m2", None), ("", "m3", 2020),
        ("UNKNOWN", "m4", 2022), (None, "m5", 2020), ("ZED", "m1", 2019),
    ]
    return spark.createDataFrame(data, "make string, model string, model_year int")


def test_business_code(spark):
    df = spark.createDataFrame([(" a-b ",), ("A B",), ("x.y!",), ("Tesla Inc.",)], "n string")
    assert [r[0] for r in df.select(business_code("n")).collect()] == ["A_B", "A_B", "X_Y_", "TESLA_INC_"]


def test_dim_with_unknown_member(spark):
    dim = build_dim(names_messy(spark), "make", "make")
    assert rows(dim, "make_id", "make_name", "make_code") == [
        (0, "UNKNOWN", "UNK"), (1, "A  B", "A_B"), (2, "A B", "A_B"), (3, "A-B", "A_B"), (4, "UNKNOWN", "UNKNOWN"), (5, "ZED", "ZED")]
    coll = code_collisions(dim, "make").collect()
    assert [(r["make_code"], r["names"]) for r in coll] == [("A_B", 3)]


def test_name_dims_in_one_pass_equal_single_builds(spark):
    df = names_messy(spark).union(spark.createDataFrame([("ZED", "m9", -3)], "make string, model string, model_year int"))
    together = build_name_dims(df, [("make", "make"), ("model", "model")])
    for prefix in ["make", "model"]:
        assert rows(together[prefix]) == rows(build_dim(df, prefix, prefix))
    full = build_name_dims(df, [("make", "make")], child=("model", "model", "make"), numeric=("model_year", "model_year"))
    make = build_dim(df, "make", "make")
    assert rows(full["model"]) == rows(build_child_dim(df, "model", "make", make, "make", "model"))
    assert rows(full["model_year"]) == rows(build_numeric_dim(df, "model_year", "model_year"))
    assert (0, "UNK", None) in rows(full["model_year"], "model_year_id", "model_year_code", "model_year")


def test_child_and_numeric_dims(spark):
    df = names_messy(spark)
    make = build_dim(df, "make", "make")
    model = build_child_dim(df, "model", "make", make, "make", "model")
    got = rows(model, "model_id", "make_id", "model_name")
    # (make id, model) pairs numbered by make id then name; blank/NULL makes have no parent
    assert got == [(0, 0, "UNKNOWN"), (1, 1, "M2"), (2, 2, "M1"), (3, 3, "M1"), (4, 4, "M4"), (5, 5, "M1")]
    years = build_numeric_dim(df, "model_year", "model_year")
    assert rows(years, "model_year_id", "model_year_code", "model_year") == [
        (0, "UNK", None), (1, "2019", 2019), (2, "2020", 2020), (3, "2021", 2021), (4, "2022", 2022)]


def test_resolve_keys_unknown_and_no_double_rows(spark):
    df = names_messy(spark)
    make = build_dim(df, "make", "make")
    model = build_child_dim(df, "model", "make", make, "make", "model")
    fact = resolve_keys(df, [
        Lookup(make, "make", "make_name", "make_id"),
        Lookup(model, "model", "model_name", "model_id", parent_id="make_id"),
    ])
    assert fact.count() == df.count()  # a real "UNKNOWN" value does not double rows
    got = {(r["make"], r["model"]): (r["make_id"], r["model_id"]) for r in fact.collect()}
    assert got[("", "m3")] == (0, 0) and got[(None, "m5")] == (0, 0)
    assert got[("UNKNOWN", "m4")] == (4, 4)
    wide = denormalize(fact, [(make, "make_id", ["make_code"])])
    assert wide.count() == df.count()


def test_pair_dim_nulls_last(spark):
    df = spark.createDataFrame([("C1", "B"), ("C2", None), ("C0", "A"), ("C0", "A")], "code string, name string")
    assert rows(build_pair_dim(df, "code", "name", "county"), "county_id", "county_code", "county_name") == [
        (1, "C0", "A"), (2, "C1", "B"), (3, "C2", None)]


def test_dense_ids_match_global_row_number(spark):
    rnd = random.Random(7)
    data = [(rnd.choice([None, "a", "b", "c", "d"]), rnd.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x long, i long")
    got = dense_ids(df, ["g", "x", "i"], "rid", num_partitions=7)
    exp = df.withColumn("rid", F.row_number().over(Window.orderBy(
        F.col("g").asc_nulls_last(), F.col("x").asc_nulls_last(), F.col("i").asc_nulls_last())).cast("long"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert dense_ids(df.limit(0), ["x"], "rid").count() == 0
    one = dense_ids(df.limit(1), ["x"], "rid", start=10).collect()
    assert one[0]["rid"] == 10


def test_dim_keeps_existing_ids(spark):
    first = build_dim(spark.createDataFrame([("b",), ("d",)], "make string"), "make", "make")
    later = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "make string")
    kept = build_dim(later, "make", "make", existing=first)
    assert rows(kept, "make_id", "make_name") == [(0, "UNKNOWN"), (1, "B"), (2, "D"), (3, "A"), (4, "C")]
    fresh = build_dim(later, "make", "make")
    assert rows(fresh, "make_id", "make_name") == [(0, "UNKNOWN"), (1, "A"), (2, "B"), (3, "C"), (4, "D")]


def test_fanout_keys(spark):
    from tessera.operators.joins import fanout_keys

    dim = spark.createDataFrame([("TESLA", True), ("TESLA", True), ("KIA", True), ("KIA", False)], "name string, is_current boolean")
    assert rows(fanout_keys(dim, "name")) == [("TESLA", 2)]


@pytest.mark.parametrize("partitions", [8, 1100, 4000])
def test_dense_ids_are_exactly_1_to_n(spark, partitions):
    n = 1_500_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"))
    got = dense_ids(df, ["k"], "rid", num_partitions=partitions)
    stats = got.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid"), F.count("rid")).first()
    assert tuple(stats) == (1, n, n, n)
    w = Window.partitionBy((F.col("rid") / 10_000).cast("int")).orderBy("rid")
    assert got.withColumn("p", F.lag("k").over(w)).where("k <= p").count() == 0


def test_registered_ids_stay(tmp_path, spark):
    """Names in three runs, one of them repeated: ids never change, new ones
    follow the highest, children and numbers included."""
    from tessera.operators.key_registry import KeyRegistry

    schema = "make string, model string, model_year int"
    runs = [[("B", "m2", 2021), ("D", "m1", 2019), (None, "m9", 2019)], [("A", "m1", 2020), ("b ", "m1", 2021), ("D", "m1", -5), ("", "x", None)],
            [("C", None, 2018), ("A", "m0", 2020)]]
    reg = KeyRegistry(str(tmp_path), [("make", "make")], child=("model", "model", "make"), numeric=("model_year", "model_year"))
    given = {}
    for n, data in enumerate(runs):
        df = spark.createDataFrame(data, schema)
        reg.register(df, n)
        if n == 1:
            reg.register(df, n)
        dims = reg.dimensions(spark, df)
        now = {p: {r[2:] if p != "model" else (r[1], r[3]): r[0] for r in map(tuple, d.collect())} for p, d in dims.items()}
        for p, ids in now.items():
            assert given.get(p, {}).items() <= ids.items() and sorted(ids.values()) == list(range(len(ids)))
        given = now
    assert given["make"] == {("UNKNOWN",): 0, ("B",): 1, ("D",): 2, ("A",): 3, ("C",): 4}
    assert given["model_year"] == {(None,): 0, (2019,): 1, (2021,): 2, (-5,): 3, (2020,): 4, (2018,): 5}
    # (make id, model): the first run's in the order of their makes' names, then A's and B's of the second
    assert given["model"] == {(0, "UNKNOWN"): 0, (1, "M2"): 1, (2, "M1"): 2, (3, "M1"): 3, (1, "M1"): 4, (3, "M0"): 5}


def test_one_run_of_the_registry_equals_a_plain_build(tmp_path, spark):
    from tessera.operators.key_registry import KeyRegistry

    df = names_messy(spark)
    kw = dict(child=("model", "model", "make"), numeric=("model_year", "model_year"))
    reg = KeyRegistry(str(tmp_path), [("make", "make")], **kw)
    reg.register(df, 0)
    built = build_name_dims(df, [("make", "make")], **kw)
    for prefix, dim in reg.dimensions(spark, df).items():
        assert rows(dim) == rows(built[prefix])
