"""SCD2 from change feeds: versions, no-ops, deletes, ties, out-of-order
batches, idempotent re-apply, integrity checks, effective-date joins."""


from datetime import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import scd2 as S
from tessera.operators.joins import as_of, effective_join, enrich_current

SCHEMA = "id long, ts timestamp_ntz, lsn long, op string, v string"
KEYS, TRACKED = ["id"], ["v"]

CDC_SEQ = [
    (1, dt(2024, 1, 1), 10, "UPSERT", "a"),   # insert
    (1, dt(2024, 1, 2), 20, "UPSERT", "b"),   # update
    (1, dt(2024, 1, 3), 30, "UPSERT", "b"),   # no-op update
    (1, dt(2024, 1, 4), 40, "DELETE", None),  # delete
    (1, dt(2024, 1, 4), 45, "DELETE", None),  # delete with nothing open
    (1, dt(2024, 1, 5), 50, "UPSERT", "c"),   # re-insert
    (2, dt(2024, 1, 1), 11, "UPSERT", "x"),
    (2, dt(2024, 1, 1), 12, "UPSERT", "y"),   # same time, later log position wins
    (2, dt(2024, 1, 1), 12, "UPSERT", "y"),   # exact duplicate delivery
    (3, dt(2024, 1, 2), 13, "DELETE", None),  # delete of an unknown key
]

EXPECTED = [
    (1, "a", dt(2024, 1, 1), dt(2024, 1, 2), False, "INSERT", "UPSERT"),
    (1, "b", dt(2024, 1, 2), dt(2024, 1, 4), False, "UPDATE", "DELETE"),
    (1, "c", dt(2024, 1, 5), None, True, "INSERT", None),
    (2, "x", dt(2024, 1, 1), dt(2024, 1, 1), False, "INSERT", "UPSERT"),
    (2, "y", dt(2024, 1, 1), None, True, "UPDATE", None),
]
COLS = ("id", "v", "effective_start_at", "effective_end_at", "is_current", "cdc_operation", "closed_by")


def feed(spark, data=CDC_SEQ):
    return spark.createDataFrame(data, SCHEMA)


def test_versions_from_sequence(spark):
    h = S.versions_from_changes(feed(spark), KEYS, TRACKED)
    assert rows(h, *COLS) == sorted(EXPECTED, key=lambda t: tuple((v is not None, v) for v in t))
    assert S.scd2_violations(h, KEYS).count() == 0


def test_any_batch_split_and_order_gives_same_history(spark):
    expected = rows(S.versions_from_changes(feed(spark), KEYS, TRACKED), *COLS)
    idx = list(range(len(CDC_SEQ)))
    splits = [
        [idx[:3], idx[3:]],
        [idx[5:], idx[:5]],
        [idx[::2], idx[1::2]],
        [[9, 4, 1], [8, 0], [7, 6, 5, 3, 2]],
    ]
    for split in splits:
        h = None
        for part in split:
            h = S.scd2_apply(h, feed(spark, [CDC_SEQ[i] for i in part]), KEYS, TRACKED)
            h = h.cache()
        assert rows(h, *COLS) == expected, split


def test_reapply_is_idempotent(spark):
    h1 = S.scd2_apply(None, feed(spark), KEYS, TRACKED).cache()
    h2 = S.scd2_apply(h1, feed(spark), KEYS, TRACKED)
    assert rows(h2, *COLS) == rows(h1, *COLS)


def test_violations_detected(spark):
    bad = spark.createDataFrame(
        [
            (1, "a", dt(2024, 1, 1), dt(2024, 1, 5), False, 1, "UPSERT"),
            (1, "b", dt(2024, 1, 3), None, True, 2, None),          # overlaps the first
            (1, "c", dt(2024, 1, 9), None, True, 3, None),          # second current row
            (2, "x", dt(2024, 1, 1), dt(2024, 1, 2), False, 4, "UPSERT"),
            (2, "y", dt(2024, 1, 3), None, True, 5, None),          # gap without a delete
            (3, "z", dt(2024, 1, 1), dt(2024, 1, 2), False, 6, "DELETE"),
            (3, "w", dt(2024, 1, 3), None, True, 7, None),          # gap after a delete: fine
        ],
        "id long, v string, effective_start_at timestamp_ntz, effective_end_at timestamp_ntz, is_current boolean, "
        "start_lsn long, closed_by string",
    )
    got = rows(S.scd2_violations(bad, KEYS), "id", "violation")
    assert got == [(1, "MULTIPLE_CURRENT"), (1, "OVERLAP"), (1, "OVERLAP"), (2, "GAP")]


def test_effective_join_boundaries(spark):
    h = S.versions_from_changes(feed(spark), KEYS, TRACKED)
    events = spark.createDataFrame(
        [
            (100, 1, dt(2024, 1, 1, 23, 59)),  # just before the update
            (101, 1, dt(2024, 1, 2)),          # exactly at the update
            (102, 1, dt(2024, 1, 4, 12)),      # after the delete: no version
            (103, 1, dt(2024, 1, 6)),
            (104, 9, dt(2024, 1, 6)),          # key without catalog row
        ],
        "eid long, key long, at timestamp_ntz",
    )
    j = effective_join(events, h, "key", "id", "at")
    assert rows(j, "eid", "v") == [(100, "a"), (101, "b"), (102, None), (103, "c"), (104, None)]
    assert rows(as_of(h, "2024-01-02 00:00:00"), "id", "v") == [(1, "b"), (2, "y")]
    cur = enrich_current(events.select("eid", "key"), h, "key", "id", attrs=["v"])
    assert rows(cur, "eid", "v") == [(100, "c"), (101, "c"), (102, "c"), (103, "c"), (104, None)]
    defects = S.effective_defects(events, h, "key", "id", "at", TRACKED)
    assert rows(defects, "eid") == [(100,), (101,), (102,)]


def test_classify_counts(spark):
    cls = S.classify_changes(feed(spark), KEYS, TRACKED)
    got = dict(rows(cls.groupBy("effect").count(), "effect", "count"))
    assert got == {"OPEN": 5, "NOOP": 1, "CLOSE": 1, "IGNORED": 2}


def test_hot_key_spread_over_buckets(spark):
    # one key with many versions across days: neighbour windows split by day
    data = [(7, dt(2024, 1, 1 + d // 24, d % 24), d, "UPSERT", str(d % 3)) for d in range(24 * 20)]
    h = S.versions_from_changes(feed(spark, data), KEYS, TRACKED)
    assert h.count() == len(data)
    assert h.where("is_current").count() == 1
    assert S.scd2_violations(h, KEYS).count() == 0
    ends = rows(h.where(F.col("effective_end_at").isNotNull()).select(
        (F.col("effective_end_at") > F.col("effective_start_at")).alias("ok")).distinct())
    assert ends == [(True,)]



def test_late_changes_with_change_log(spark):
    """A delete that found nothing open and an update equal to its
    predecessor become significant once older changes arrive."""
    late_first = [
        (1, dt(2024, 1, 4), 40, "UPSERT", "c"),
        (1, dt(2024, 1, 3), 30, "DELETE", None),
        (1, dt(2024, 1, 3, 12), 35, "UPSERT", "c"),
    ]
    older = [
        (1, dt(2024, 1, 1), 10, "UPSERT", "a"),
        (1, dt(2024, 1, 3, 18), 38, "UPSERT", "z"),
    ]
    expected = rows(S.versions_from_changes(feed(spark, late_first + older), KEYS, TRACKED), *COLS)
    log = S.change_log_merge(None, feed(spark, late_first), KEYS).cache()
    h = S.scd2_apply(None, feed(spark, late_first), KEYS, TRACKED, log=log).cache()
    log2 = S.change_log_merge(log, feed(spark, older), KEYS).cache()
    h2 = S.scd2_apply(h, feed(spark, older), KEYS, TRACKED, log=log2)
    assert rows(h2, *COLS) == expected
    assert [r[1] for r in sorted(expected, key=lambda t: t[2])] == ["a", "c", "z", "c"]


def test_asof_join_matches_range_join_across_buckets(spark):
    """Random changes for a few keys over weeks (one hot key) and events
    between them: the bucketed as-of join equals the plain range join."""
    import random

    rnd = random.Random(3)
    changes = []
    for i in range(400):
        key = 1 if i % 3 else rnd.choice([2, 3, 4])  # key 1 holds two thirds
        t = dt(2024, 1, 1) + __import__("datetime").timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        op = "DELETE" if rnd.random() < 0.2 else "UPSERT"
        changes.append((key, t, i, op, None if op == "DELETE" else rnd.choice("abcd")))
    h = S.versions_from_changes(feed(spark, changes), KEYS, TRACKED).cache()
    ev = []
    for i in range(300):
        t = dt(2023, 12, 31) + __import__("datetime").timedelta(minutes=rnd.randint(0, 60 * 24 * 23))
        ev.append((1000 + i, rnd.choice([1, 1, 2, 3, 4, 5]), t))
    events = spark.createDataFrame(ev, "eid long, key long, at timestamp_ntz")
    got = effective_join(events, h, "key", "id", "at", attrs=["v", "effective_start_at"])
    cond = (
        (events.key == h.id) & (events.at >= h.effective_start_at)
        & (h.effective_end_at.isNull() | (events.at < h.effective_end_at))
    )
    exp = events.join(h, cond, "left").select("eid", "key", "at", "v", "effective_start_at")
    assert rows(got, "eid", "v", "effective_start_at") == rows(exp, "eid", "v", "effective_start_at")


def test_one_key_holds_a_third_of_the_rows_on_one_day(spark, monkeypatch):
    """The hot key's day is cut finer, with the same results."""
    import tessera.operators.sequence as SEQ
    from tessera.operators.joins import effective_join

    rows_ = [(1, 60 * i, i, "UPSERT", "abc"[i % 3]) for i in range(400)]
    rows_ += [(k, 86_400 * (k % 9), 1000 + k, "UPSERT", "x") for k in range(2, 800)]
    changes = spark.createDataFrame(rows_, "id long, s long, lsn long, op string, v string").select(
        "id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "lsn", "op", "v")
    facts = changes.select(F.col("lsn").alias("e"), F.col("id").alias("u"), (F.col("ts") + F.expr("INTERVAL 30 SECONDS")).alias("t"))
    plain = rows(S.versions_from_changes(changes, ["id"], ["v"]))
    joined = rows(effective_join(facts, S.versions_from_changes(changes, ["id"], ["v"]), "u", "id", "t", attrs=["v"]))
    monkeypatch.setattr(SEQ, "MOST_PER_BUCKET", 70)
    assert SEQ.bucket_unit(changes, ["id"], "ts") == "hour"
    hist = S.versions_from_changes(changes, ["id"], ["v"])
    assert rows(hist) == plain
    assert rows(effective_join(facts, hist, "u", "id", "t", attrs=["v"])) == joined
