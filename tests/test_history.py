"""History by suffixes and restated facts against one pass over everything."""

import random
from datetime import datetime as dt
from datetime import timedelta

import pytest


from conftest import rows
from tessera.operators import scd2 as S
from tessera.operators.joins import effective_join
from tessera.streaming.enriched import EnrichedFacts
from tessera.streaming.history import CdcStream

SCHEMA = "id long, ts timestamp_ntz, lsn long, op string, v string, w int"
START = dt(2023, 1, 1)


def changes(seed, n=160, days=300, keys=6):
    """Changes with repeated instants, deletes of nothing, updates that change
    nothing and null values; one key has a third of them."""
    rng = random.Random(seed)
    out = []
    for lsn in range(n):
        key = 0 if rng.random() < 0.33 else rng.randrange(1, keys)
        ts = START + timedelta(days=rng.randrange(days), hours=rng.choice([0, 0, 12]))
        if rng.random() < 0.25:
            out.append((key, ts, lsn, "DELETE", None, None))
        else:
            out.append((key, ts, lsn, "UPSERT", rng.choice(["a", "b", None]), rng.choice([1, 2])))
    return out


def split(data, seed, n=4):
    """Batches out of order; some changes are delivered twice."""
    rng = random.Random(seed)
    batches = [[] for _ in range(n)]
    for c in data:
        batches[rng.randrange(n)].append(c)
        if rng.random() < 0.1:
            batches[rng.randrange(n)].append(c)
    return batches


@pytest.mark.parametrize("seed", [1])
def test_equals_one_pass_after_every_batch(tmp_path, spark, seed):
    job = CdcStream(str(tmp_path), ["id"], ["v", "w"])
    seen = []
    for n, batch in enumerate(split(changes(seed), seed)):
        seen += batch
        df = spark.createDataFrame(batch, SCHEMA)
        for _ in range(2 if n == 1 else 1):
            job.handle(df, n)
        want = rows(S.versions_from_changes(spark.createDataFrame(seen, SCHEMA), ["id"], ["v", "w"]))
        cols = S.versions_from_changes(df, ["id"], ["v", "w"]).columns
        assert rows(job.history(spark), *cols) == want
        assert S.scd2_violations(job.history(spark), ["id"]).isEmpty()
        if n == 2:
            job.compact(spark)
            assert rows(job.history(spark), *cols) == want


def corrupt(folder):
    for f in folder.glob("**/*.parquet"):
        f.write_bytes(b"not parquet")


def test_older_partitions_are_not_read(tmp_path, spark):
    """A hot key has a change every hour for a year. A change at its end, and
    a late one some days before, read neither the log nor the history of the
    months before."""
    job = CdcStream(str(tmp_path), ["id"], ["v"])
    hours = [(7, START + timedelta(hours=h), h, "UPSERT", str(h % 3)) for h in range(24 * 365)]
    schema = "id long, ts timestamp_ntz, lsn long, op string, v string"
    job.handle(spark.createDataFrame(hours, schema), 0)
    for table in ("change_log", "history"):
        for part in tmp_path.glob(f"{table}/batch_id=0/key_bucket=*/since=2023-*"):
            if part.name < "since=2023-11":
                corrupt(part)
    end = START + timedelta(days=365)
    job.handle(spark.createDataFrame([(7, end, 10_000, "UPSERT", "new")], schema), 1)
    assert rows(spark.read.parquet(job.versions.path(1)), "v", "is_current") == [(str((24 * 365 - 1) % 3), False), ("new", True)]
    late = end - timedelta(days=3, minutes=30)
    job.handle(spark.createDataFrame([(7, late, 10_001, "UPSERT", "late")], schema), 2)
    put = spark.read.parquet(job.versions.path(2))
    assert put.count() == 3 * 24 + 3  # the version before, the late one, 72 hours and the new one
    assert put.where("v = 'late'").count() == 1  # reading the whole history would open the older months


def test_a_late_change_finds_a_version_of_long_ago(tmp_path, spark):
    job = CdcStream(str(tmp_path), ["id"], ["v"], unit="day")
    schema = "id long, ts timestamp_ntz, lsn long, op string, v string"
    data = [(1, dt(2015, 5, 5), 1, "UPSERT", "old"), (1, dt(2024, 1, 1), 2, "UPSERT", "new"), (2, dt(2024, 1, 2), 3, "UPSERT", "x")]
    late = [(1, dt(2023, 12, 31), 4, "UPSERT", "old"), (1, dt(2023, 12, 30), 5, "DELETE", None), (2, dt(2024, 1, 1), 6, "DELETE", None)]
    job.handle(spark.createDataFrame(data, schema), 0)
    job.handle(spark.createDataFrame(late, schema), 1)
    want = S.versions_from_changes(spark.createDataFrame(data + late, schema), ["id"], ["v"])
    assert rows(job.history(spark), *want.columns) == rows(want)


@pytest.mark.parametrize("seed", [2])
def test_restated_facts_equal_one_join(tmp_path, spark, seed):
    rng = random.Random(seed)
    history = CdcStream(str(tmp_path / "h"), ["id"], ["v", "w"], types={"v": "string", "w": "int"})
    enriched = EnrichedFacts(str(tmp_path / "f"), history, "fact", "fid", "at", ["v", "w"])
    facts = [(i, rng.randrange(7), START + timedelta(days=rng.randrange(300), hours=rng.choice([0, 6, 12]))) for i in range(200)]
    schema = "fact long, fid long, at timestamp_ntz"
    step, seen, landed = 0, [], []
    for n, batch in enumerate(split(changes(seed, 120), seed, 3)):
        some = facts[50 * n : 50 * n + 50]
        enriched.add(spark.createDataFrame(some, schema), step)
        landed += some
        history.handle(spark.createDataFrame(batch, SCHEMA), n)
        seen += batch
        for _ in range(2 if n == 1 else 1):
            enriched.restate(spark, n, step + 1)
        step += 2
        versions = S.versions_from_changes(spark.createDataFrame(seen, SCHEMA), ["id"], ["v", "w"])
        want = effective_join(spark.createDataFrame(landed, schema), versions, "fid", "id", "at", attrs=["v", "w"], version_order="start_lsn")
        assert rows(enriched.read(spark), "fact", "fid", "at", "v", "w") == rows(want)


def test_only_facts_in_changed_intervals_are_restated(tmp_path, spark):
    history = CdcStream(str(tmp_path / "h"), ["id"], ["v"])
    schema = "id long, ts timestamp_ntz, lsn long, op string, v string"
    history.handle(spark.createDataFrame([(1, dt(2023, m, 1), m, "UPSERT", f"m{m}") for m in range(1, 13)], schema), 0)
    enriched = EnrichedFacts(str(tmp_path / "f"), history, "fact", "fid", "at", ["v"])
    enriched.add(spark.createDataFrame([(d, 1, START + timedelta(days=d)) for d in range(365)], "fact long, fid long, at timestamp_ntz"), 0)
    for part in (tmp_path / "f/facts/batch_id=0").glob("fact_bucket=*/since=*"):
        if part.name not in ("since=2023-06-01", "since=2023-07-01"):
            corrupt(part)
    history.handle(spark.createDataFrame([(1, dt(2023, 6, 11), 99, "UPSERT", "june")], schema), 1)
    enriched.restate(spark, 1, 1)
    again = spark.read.parquet(enriched.rows.path(1))
    # the version of June now ends on the 11th; July's is the same as before
    assert rows(again.groupBy("v").count()) == [("june", 20), ("m6", 10)]
