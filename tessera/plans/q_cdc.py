"""Registered queries: change feed -> SCD2 history, effective-date joins
and CDC monitoring, over the feeds derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import monitoring as MON
from tessera.operators import scd2 as S
from tessera.operators.dedup import dedup_cdc
from tessera.operators.joins import as_of, effective_join, enrich_current
from tessera.plans import feeds
from tessera.plans.registry import query
from tessera.tables import materialize

KEYS = ["catalog_id"]
TRACKED = ["tracked_value", "k"]
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
MID_SQL = "TIMESTAMP '2024-01-15 12:00:00'"

HIST_CTE = """
ch AS (
  SELECT user_id AS catalog_id, ts, event_id AS lsn,
         CASE WHEN event_type = 'signup' THEN 'UPSERT' ELSE 'DELETE' END AS op,
         CASE WHEN event_type = 'signup' THEN value END AS tracked_value,
         CASE WHEN event_type = 'signup' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
  FROM events WHERE event_type IN ('signup', 'error')
),
seq AS (
  SELECT *, lag(op) OVER w AS p_op, lag(tracked_value) OVER w AS p_value, lag(k) OVER w AS p_k
  FROM ch WINDOW w AS (PARTITION BY catalog_id ORDER BY ts, lsn)
),
cls AS (
  SELECT *,
         CASE WHEN op = 'UPSERT' AND (p_op IS NULL OR p_op = 'DELETE' OR p_value IS DISTINCT FROM tracked_value OR p_k IS DISTINCT FROM k) THEN 'OPEN'
              WHEN op = 'UPSERT' THEN 'NOOP'
              WHEN p_op IS NULL OR p_op = 'DELETE' THEN 'IGNORED'
              ELSE 'CLOSE' END AS effect,
         CASE WHEN p_op IS NULL OR p_op = 'DELETE' THEN 'INSERT' ELSE 'UPDATE' END AS cdc_operation
  FROM seq
),
kept AS (
  SELECT *, lead(ts) OVER w2 AS n_ts, lead(lsn) OVER w2 AS n_lsn, lead(op) OVER w2 AS n_op
  FROM cls WHERE effect IN ('OPEN', 'CLOSE') WINDOW w2 AS (PARTITION BY catalog_id ORDER BY ts, lsn)
),
hist AS (
  SELECT catalog_id, tracked_value, k, ts AS effective_start_at, n_ts AS effective_end_at,
         n_ts IS NULL AS is_current, cdc_operation, lsn AS start_lsn, n_lsn AS end_lsn, n_op AS closed_by
  FROM kept WHERE op = 'UPSERT'
),
purch AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
"""


def with_hist(body: str) -> str:
    return f"WITH {HIST_CTE}\n{body}"


def history(spark, sf_dir):
    return S.versions_from_changes(feeds.catalog_changes(spark, sf_dir), KEYS, TRACKED)


@query("scd2_history", with_hist("SELECT * FROM hist"))
def q_scd2_history(spark, sf_dir):
    return history(spark, sf_dir)


@query("scd2_incremental", with_hist("SELECT * FROM hist"))
def q_scd2_incremental(spark, sf_dir):
    """Two interleaved batches (morning changes, then afternoon changes,
    many of them older than changes already applied) and a redelivery of
    the first batch, each applied with the stored change log: must give
    the history of one in-order batch."""
    changes = feeds.catalog_changes(spark, sf_dir).select("catalog_id", "ts", "lsn", "op", *TRACKED)
    morning = changes.where(F.hour("ts") < 12)
    afternoon = changes.where(F.hour("ts") >= 12)
    log, hist = None, None
    for batch in [morning, afternoon, morning]:
        log = materialize(S.change_log_merge(log, batch, KEYS))
        hist = materialize(S.scd2_apply(hist, batch, KEYS, TRACKED, log=log))
    return hist


@query("scd2_current", with_hist("SELECT * FROM hist WHERE is_current"))
def q_scd2_current(spark, sf_dir):
    return S.current(history(spark, sf_dir))


@query(
    "scd2_as_of",
    with_hist(f"SELECT * FROM hist WHERE effective_start_at <= {MID_SQL} AND (effective_end_at IS NULL OR {MID_SQL} < effective_end_at)"),
)
def q_scd2_as_of(spark, sf_dir):
    return as_of(history(spark, sf_dir), "2024-01-15 12:00:00")


@query(
    "scd2_violations",
    with_hist(
        """, bad AS (SELECT * REPLACE (is_current OR catalog_id % 5 = 0 AS is_current,
                                       if(catalog_id % 7 = 0, effective_end_at + INTERVAL 1 DAY, if(catalog_id % 7 = 1 AND closed_by = 'UPSERT',
                                          effective_end_at - INTERVAL 1 SECOND, effective_end_at)) AS effective_end_at) FROM hist),
        following AS (SELECT *, lead(effective_start_at) OVER (PARTITION BY catalog_id ORDER BY effective_start_at, start_lsn) AS nxt FROM bad)
        SELECT catalog_id, 'MULTIPLE_CURRENT' AS violation, min(effective_start_at) AS effective_start_at
        FROM bad GROUP BY catalog_id HAVING count(*) FILTER (is_current) > 1
        UNION ALL SELECT catalog_id, 'OVERLAP', effective_start_at FROM following WHERE nxt < coalesce(effective_end_at, TIMESTAMP '9999-01-01')
        UNION ALL SELECT catalog_id, 'GAP', effective_start_at FROM following WHERE nxt > effective_end_at AND closed_by IS DISTINCT FROM 'DELETE'"""
    ),
)
def q_scd2_violations(spark, sf_dir):
    """A history damaged for some keys: versions that end a day late or a
    second early, and closed versions marked current."""
    key, end = F.col("catalog_id"), F.col(S.END)
    damaged = history(spark, sf_dir).withColumns({
        S.CURRENT: F.col(S.CURRENT) | (key % 5 == 0),
        S.END: F.when(key % 7 == 0, end + F.expr("INTERVAL 1 DAY"))
        .when((key % 7 == 1) & (F.col("closed_by") == S.UPSERT), end - F.expr("INTERVAL 1 SECOND")).otherwise(end),
    })
    return S.scd2_violations(materialize(damaged), KEYS)  # checked twice over


@query(
    "effective_join_purchases",
    with_hist(
        """SELECT p.event_id, p.user_id, p.ts, p.value, h.tracked_value, h.k, h.effective_start_at
           FROM purch p LEFT JOIN hist h ON p.user_id = h.catalog_id AND p.ts >= h.effective_start_at
                AND (h.effective_end_at IS NULL OR p.ts < h.effective_end_at)"""
    ),
)
def q_effective_join(spark, sf_dir):
    j = effective_join(
        feeds.purchases(spark, sf_dir), history(spark, sf_dir), "user_id", "catalog_id", "ts",
        attrs=["tracked_value", "k", "effective_start_at"], version_order="start_lsn",
    )
    return j.select("event_id", "user_id", "ts", "value", "tracked_value", "k", "effective_start_at")


@query(
    "enrich_current_purchases",
    with_hist(
        """, m AS (SELECT user_id, CAST(count(*) AS BIGINT) AS purchases, round(sum(value), 2) AS total_value FROM purch GROUP BY user_id)
        SELECT m.user_id, m.purchases, m.total_value, h.tracked_value, h.k
        FROM m LEFT JOIN hist h ON m.user_id = h.catalog_id AND h.is_current"""
    ),
)
def q_enrich_current(spark, sf_dir):
    m = feeds.purchases(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("purchases"), F.round(F.sum("value"), 2).alias("total_value")
    )
    return enrich_current(m, history(spark, sf_dir), "user_id", "catalog_id", attrs=TRACKED)


@query(
    "effective_defects",
    with_hist(
        """SELECT p.event_id, p.user_id, p.ts, p.value, e.tracked_value AS eff_tracked_value, e.k AS eff_k,
                  c.tracked_value AS cur_tracked_value, c.k AS cur_k
           FROM purch p
           LEFT JOIN hist e ON p.user_id = e.catalog_id AND p.ts >= e.effective_start_at
                AND (e.effective_end_at IS NULL OR p.ts < e.effective_end_at)
           LEFT JOIN hist c ON p.user_id = c.catalog_id AND c.is_current
           WHERE NOT (e.tracked_value IS NOT DISTINCT FROM c.tracked_value AND e.k IS NOT DISTINCT FROM c.k)"""
    ),
)
def q_effective_defects(spark, sf_dir):
    hist = materialize(history(spark, sf_dir))  # the stored history, read twice (effective and current)
    return S.effective_defects(feeds.purchases(spark, sf_dir), hist, "user_id", "catalog_id", "ts", TRACKED)


@query(
    "cdc_monitor",
    with_hist(
        f"""SELECT 'catalog' AS source, CAST(count(*) AS BIGINT) AS total_records,
                   max(effective_start_at) AS last_sync_time,
                   date_diff('hour', max(effective_start_at), {AS_OF_SQL}) AS hours_since_sync,
                   CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_records,
                   date_diff('hour', max(effective_start_at), {AS_OF_SQL}) > 13 AS alert_stale_sync,
                   sum(CASE WHEN is_current THEN 1 ELSE 0 END) = 0 AS alert_no_current
            FROM hist"""
    ),
)
def q_cdc_monitor(spark, sf_dir):
    dim = history(spark, sf_dir).withColumn("cdc_synced_at", F.col("effective_start_at"))
    return MON.cdc_monitor(dim, feeds.AS_OF)


@query(
    "cdc_reconcile",
    with_hist(
        """SELECT e.extracted, l.landed, m.merged, r.rejected, e.extracted - l.landed AS lost_in_transport,
                  l.landed - m.merged - r.rejected AS unexplained,
                  CASE WHEN e.extracted - l.landed = 0 AND l.landed - m.merged - r.rejected = 0 THEN 'PASS' ELSE 'FAIL' END AS status
           FROM (SELECT CAST(count(*) AS BIGINT) AS extracted FROM ch) e,
                (SELECT CAST(count(*) AS BIGINT) AS landed FROM (SELECT DISTINCT catalog_id, ts, lsn FROM ch)) l,
                (SELECT CAST(count(*) AS BIGINT) AS merged FROM cls WHERE effect IN ('OPEN', 'CLOSE')) m,
                (SELECT CAST(count(*) AS BIGINT) AS rejected FROM cls WHERE effect IN ('NOOP', 'IGNORED')) r"""
    ),
)
def q_cdc_reconcile(spark, sf_dir):
    changes = feeds.catalog_changes(spark, sf_dir)
    landed = dedup_cdc(changes, KEYS, "ts", "lsn")
    cls = S.classify_changes(landed, KEYS, TRACKED)
    return MON.cdc_reconcile(
        changes, landed, cls.where(F.col("effect").isin("OPEN", "CLOSE")), cls.where(F.col("effect").isin("NOOP", "IGNORED"))
    )


@query(
    "cdc_cadence",
    f"""WITH r AS (SELECT user_id, ts AS run_ts, value >= 1.0 AS succeeded FROM events
                   WHERE event_type = 'view' AND ts >= {AS_OF_SQL} - INTERVAL 72 HOUR AND ts <= {AS_OF_SQL}),
         g AS (SELECT *, (epoch_us(run_ts) - epoch_us(lag(run_ts) OVER (PARTITION BY user_id ORDER BY run_ts))) / 6e7 AS gap_min FROM r)
    SELECT user_id, CAST(count(*) AS BIGINT) AS runs,
           round(CAST(count(CASE WHEN succeeded THEN 1 END) AS DOUBLE) * 100.0 / count(*), 2) AS success_pct,
           round(avg(gap_min), 4) AS mean_interval_min,
           CAST(count(CASE WHEN gap_min > 30 THEN 1 END) AS BIGINT) AS gaps_over_limit,
           round(max(gap_min), 4) AS max_gap_min,
           abs(round(avg(gap_min), 4) - 15.0) <= 3.0 AS cadence_ok
    FROM g GROUP BY user_id""",
)
def q_cdc_cadence(spark, sf_dir):
    return MON.cadence_report(feeds.sync_runs(spark, sf_dir), feeds.AS_OF, key=["user_id"])


@query(
    "cdc_lag_report",
    """SELECT event_id, ts, round((epoch_us(ts + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT))) - epoch_us(ts)) / 6e7, 4) AS lag_min,
              CASE WHEN round((epoch_us(ts + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT))) - epoch_us(ts)) / 6e7, 4) <= 30 THEN 'OK' ELSE 'BREACH' END AS lag_status
       FROM events""",
)
def q_cdc_lag(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    landed = ev.select(
        "event_id", "ts", (F.col("ts") + F.make_dt_interval(secs=(F.col("value") * 60).cast("decimal(18,6)"))).alias("landed_ts")
    )
    return MON.lag_report(landed, "ts", "landed_ts").select("event_id", "ts", "lag_min", "lag_status")


@query(
    "cdc_evidence_summary",
    """SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS total,
              CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS BIGINT) AS pass,
              CAST(count(CASE WHEN event_type = 'view' THEN 1 END) AS BIGINT) AS warning,
              CAST(count(CASE WHEN event_type = 'error' THEN 1 END) AS BIGINT) AS fail,
              CAST(count(CASE WHEN event_type = 'signup' THEN 1 END) AS BIGINT) AS blocked
       FROM events GROUP BY CAST(ts AS DATE)""",
)
def q_cdc_evidence(spark, sf_dir):
    ev = feeds.events(spark, sf_dir)
    result = (
        F.when(F.col("event_type") == "purchase", "PASS")
        .when(F.col("event_type") == "view", "WARNING")
        .when(F.col("event_type") == "error", "FAIL")
        .when(F.col("event_type") == "signup", "BLOCKED")
        .otherwise("OTHER")
    )
    return MON.evidence_summary(ev.select(F.col("ts").alias("timestamp_utc"), result.alias("result")))
