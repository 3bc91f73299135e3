"""Gold by differences equals gold from scratch after every batch."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.aggregates import market_metrics
from tessera.plans import medallion as M
from tessera.streaming.gold import IncrementalGold
from tessera.streaming.jobs import RegistrationStream
from tessera.tables import materialize

AS_OF = "2024-01-31 00:00:00"
SCHEMA = ("vin string, make string, ev_type string, electric_range int, base_msrp double, counties string, county_name string, "
          "source_file string, pos int")


class Landed(RegistrationStream):
    """Batches of typed rows in place of documents."""

    def handle_rows(self, rows_, batch_id):
        self.latest.write(materialize(M.latest_per_key(rows_.where("vin IS NOT NULL"), [self.key], self.order)), batch_id)
        for cb in self.after_commit:
            cb(self, batch_id)


def batches(seed, n=4, size=60):
    rng = random.Random(seed)
    files = [f"f{i:03}" for i in range(n * 3)]
    rng.shuffle(files)
    out = []
    for b in range(n):
        out.append([
            (f"V{rng.randrange(25)}", rng.choice([None, "A", "B", "C"]), rng.choice([None, "x", "y"]), rng.choice([None, 10, 20, 35]),
             rng.choice([None, 1.5, 7.25, 9.0, 100.0]), rng.choice(["1", "2", None]), rng.choice(["K", "L"]), rng.choice(files[3 * b : 3 * b + 3]), i)
            for i in range(size)
        ])
    return out


@pytest.mark.parametrize("seed", [1])
def test_equals_a_full_refresh_after_every_batch(tmp_path, spark, seed):
    gold = IncrementalGold(str(tmp_path), AS_OF)
    job = Landed(str(tmp_path), [], after_commit=[gold])
    seen = []
    for b, data in enumerate(batches(seed)):
        seen += data
        df = spark.createDataFrame(data, SCHEMA)
        job.handle_rows(df, b)
        if b == 1:
            job.handle_rows(df, b)  # a repeated batch
        clean = M.latest_per_key(spark.createDataFrame(seen, SCHEMA), ["vin"], job.order)
        want = rows(market_metrics(clean))
        assert rows(gold.metrics(spark).drop("load_timestamp")) == want
        assert rows(gold.detail(job, spark).drop("load_timestamp")) == rows(clean)
        pairs = M.dim_county_gold(clean)
        assert rows(gold.county_lookup(spark)) == rows(pairs)
        if b == 2:
            gold.compact(job, spark)
            job.compact(spark)
            assert rows(gold.metrics(spark).drop("load_timestamp")) == want


def test_only_touched_groups_are_read_and_written(tmp_path, spark):
    gold = IncrementalGold(str(tmp_path), AS_OF)
    job = Landed(str(tmp_path), [], after_commit=[gold])
    first = [(f"V{i}", f"M{i % 40}", "x", 10, float(i), "1", "K", "f1", i) for i in range(200)]
    job.handle_rows(spark.createDataFrame(first, SCHEMA), 0)
    # V199 leaves the group M39 of which it holds the maximum
    job.handle_rows(spark.createDataFrame([("V199", "NEW", "x", 5, 1.0, "1", "K", "f2", 0)], SCHEMA), 1)
    wrote = spark.read.parquet(gold.groups.path(1))
    assert rows(wrote, "make", "n_rows", "top") == [("M39", 4, 159.0), ("NEW", 1, 1.0)]
    touched = {r.b for r in wrote.select(F.col("bucket").alias("b")).collect()}
    # state of every other bucket can be missing: nothing reads it
    for table in (gold.groups, gold.prices):
        for folder in (tmp_path / table.path(0).removeprefix(f"{tmp_path}/")).glob("bucket=*"):
            if int(folder.name.removeprefix("bucket=")) not in touched:
                for f in folder.glob("*.parquet"):
                    f.write_bytes(b"not parquet")
    job.handle_rows(spark.createDataFrame([("V199", "M39", "x", 5, 500.0, "1", "K", "f3", 0)], SCHEMA), 2)
    again = spark.read.parquet(gold.groups.path(2))
    assert rows(again, "make", "n_rows", "top") == [("M39", 5, 500.0), ("NEW", 0, None)]


def test_sums_must_return_to_zero(tmp_path, spark):
    gold = IncrementalGold(str(tmp_path), AS_OF, measure="base_msrp")
    job = Landed(str(tmp_path), [], after_commit=[gold])
    with pytest.raises(ValueError, match="integer"):
        job.handle_rows(spark.createDataFrame([("V1", "A", "x", 1, 1.0, "1", "K", "f", 0)], SCHEMA), 0)
