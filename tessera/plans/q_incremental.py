"""Registered queries over state that is kept between runs: registered keys,
restated facts, rules over runs, and one huge document read in splits."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.flatten import extract_positions
from tessera.operators.run_rules import run_metrics, run_violations
from tessera.plans import feeds
from tessera.plans import star as S
from tessera.plans.oracle_sql import file_flat_cte, with_flat
from tessera.plans.q_cdc import KEYS, TRACKED, with_hist
from tessera.plans.registrations import REGISTRATION_POSITIONS, flat_registrations, large_document_rounds, write_large_documents
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources.json_split import read_split_json
from tessera.streaming.enriched import EnrichedFacts
from tessera.streaming.history import CdcStream
from tessera.tables import BatchTable, delete_path, materialize, path_bytes

_ORDER = "CAST(substr(source_file, 15, 12) AS BIGINT)"
_MEMBERS_SQL = "\n  UNION ALL ".join(
    [f"SELECT n, '{prefix}' AS d, {column} AS a, '' AS b FROM runs WHERE trim({column}) <> ''" for prefix, column in S.NAME_DIMS]
    + ["SELECT n, 'model', make, model FROM runs WHERE trim(make) <> '' AND trim(model) <> ''",
       "SELECT n, 'model_year', CAST(model_year + 2147483648 AS VARCHAR), '' FROM runs WHERE model_year IS NOT NULL"]
)


@query(
    "dim_key_registry",
    with_flat(f""", runs AS (SELECT *, if({_ORDER} > (SELECT max(l_orderkey) // 2 FROM lineitem), 0, 1) AS n FROM flat WHERE vin IS NOT NULL),
    members AS (SELECT d, upper(trim(a)) AS a, upper(trim(b)) AS b, min(n) AS n FROM ({_MEMBERS_SQL}) GROUP BY ALL),
    ids AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY n, a, b) AS id FROM members)
    SELECT i.d AS dimension, i.a AS member, i.b AS child, i.id, p.id AS parent_id
    FROM ids i LEFT JOIN ids p ON i.d = 'model' AND p.d = 'make' AND p.a = i.a"""),
)
def q_dim_key_registry(spark, sf_dir):
    """All dimensions' keys after two runs, the newer half of the orders
    first: the names of the first keep their ids (KEY-3..5)."""
    flat = materialize(flat_registrations(spark, sf_dir).where("vin IS NOT NULL"))
    order = F.substring("source_file", 15, 12).cast("long")
    last = flat.agg(F.max(order)).first()[0]  # one row
    registry = S.key_registry(scratch_path(spark, "keys", uuid.uuid4().hex))
    for n, part in enumerate((order > last // 2, order <= last // 2)):
        registry.register(flat.where(part), n)
    return registry.names.read(spark).select(
        F.col("_dim").alias("dimension"), F.col("_k1").alias("member"), F.col("_k2").alias("child"), F.col("_id").alias("id"), F.col("_pid").alias("parent_id"))


@query(
    "restated_purchases",
    with_hist(
        """SELECT p.event_id, p.user_id, p.ts, p.value, h.tracked_value, h.k, h.effective_start_at
           FROM purch p LEFT JOIN hist h ON p.user_id = h.catalog_id AND p.ts >= h.effective_start_at
                AND (h.effective_end_at IS NULL OR p.ts < h.effective_end_at)"""
    ),
)
def q_restated_purchases(spark, sf_dir):
    """Purchases are enriched while half of the catalog's changes are known;
    older changes land afterwards, more purchases, and changes again. Each
    time the facts inside changed intervals are restated; in the end every
    purchase has what one join over everything gives (JN-9, SEM-4)."""
    root = scratch_path(spark, "restated", uuid.uuid4().hex)
    changes, facts = feeds.catalog_changes(spark, sf_dir), feeds.purchases(spark, sf_dir)
    day = F.dayofmonth("ts")
    history = CdcStream(f"{root}/catalog", KEYS, TRACKED)
    enriched = EnrichedFacts(root, history, "event_id", "user_id", "ts", [*TRACKED, "effective_start_at"])
    history.handle(changes.where(day.between(11, 20)), 0)
    enriched.add(facts.where(F.col("event_id") % 2 == 0), 0)
    history.handle(changes.where(day <= 10), 1)  # older than what is known
    enriched.restate(spark, 1, 1)
    enriched.add(facts.where(F.col("event_id") % 2 != 0), 2)
    history.handle(changes.where(day > 20), 2)
    enriched.restate(spark, 2, 3)
    return enriched.read(spark)


LARGE_DOCUMENT_ORDERS = 20_000
#: Lines that land at a time, some 7 GB of text.
ROUND_LINES = 24_000_000
_LARGE_FLAT_CTE = file_flat_cte(LARGE_DOCUMENT_ORDERS)


@query(
    "split_document_records",
    f"""WITH {_LARGE_FLAT_CTE}
    SELECT source_file, pos, vin, make, model, model_year, ev_type, electric_range, base_msrp, dol_vehicle_id, counties FROM flat""",
)
def q_split_document_records(spark, sf_dir):
    """A few large documents, each read by many tasks: the same records as
    from many small ones (SRC-1, PRJ-1). They land and are read in rounds, as
    the documents, which only plain text lets many tasks read, take many times
    the room of their records."""
    root = scratch_path(spark, "large-documents", uuid.uuid4().hex)
    conf = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)
    rounds = []
    for part in large_document_rounds(spark, sf_dir, LARGE_DOCUMENT_ORDERS, ROUND_LINES):
        write_large_documents(spark, sf_dir, f"{root}/documents", LARGE_DOCUMENT_ORDERS, part)
        # splits of a megabyte, as documents here are of some ten; up to 32 of
        # them where many documents keep all tasks busy
        spark.conf.set(conf, str(min(max(1 << 20, path_bytes(spark, f"{root}/documents") >> 7), 1 << 25)))
        try:
            records = read_split_json(spark, f"{root}/documents", copies=f"{root}/copies")
            rounds.append(materialize(extract_positions(records, REGISTRATION_POSITIONS, keep=["source_file", "pos"])))
        finally:
            spark.conf.set(conf, old)
        delete_path(spark, root)
    found = reduce(DataFrame.unionAll, rounds)
    return found.select(
        F.regexp_extract("source_file", "file_key=[0-9]+", 0).alias("source_file"), "pos", "vin", "make", "model", "model_year", "ev_type",
        "electric_range", "base_msrp", "dol_vehicle_id", "counties")


_RUN_TYPES_SQL = """
seen AS (
  SELECT event_type AS table_name, day(ts) AS run_no,
         if(day(ts) % 11 = 0, NULL, if(day(ts) % 10 = 0 AND user_id % 2 = 0, 'STRING', 'BIGINT')) AS k_type FROM events
  WHERE day(ts) % 7 <> 0 OR user_id % 3 <> 0),
counted AS (
  SELECT table_name, run_no, count(*) AS n_rows, count(*) FILTER (k_type IS NULL) AS missing,
         array_to_string(list_sort(list(DISTINCT k_type) FILTER (k_type IS NOT NULL)), '|') AS types FROM seen GROUP BY ALL),
compared AS (
  SELECT *, coalesce(types, '') AS t, coalesce(lag(types) OVER w, '') AS p, lag(n_rows) OVER w AS rows_before, lag(missing) OVER w AS missing_before
  FROM counted WINDOW w AS (PARTITION BY table_name ORDER BY run_no))
"""


@query(
    "dq_run_rules",
    f"""WITH {_RUN_TYPES_SQL.strip()}
    SELECT table_name, run_no, NULL AS field, 'ROW_COUNT_DROP' AS rule, rows_before::VARCHAR AS previous, n_rows::VARCHAR AS current
    FROM compared WHERE n_rows < rows_before * (1 - 0.2::DOUBLE)
    UNION ALL SELECT table_name, run_no, 'k', 'FIELD_LOST', p, '' FROM compared WHERE rows_before IS NOT NULL AND t = '' AND p <> ''
    UNION ALL SELECT table_name, run_no, 'k', 'FIELD_ADDED', '', t FROM compared WHERE rows_before IS NOT NULL AND t <> '' AND p = ''
    UNION ALL SELECT table_name, run_no, 'k', 'TYPE_CHANGED', p, t FROM compared WHERE t <> '' AND p <> '' AND t <> p
    UNION ALL SELECT table_name, run_no, 'k', 'MISSING_RISE', missing_before::VARCHAR, missing::VARCHAR FROM compared
    WHERE t <> '' AND missing / n_rows > missing_before / rows_before + 0.1::DOUBLE""",
)
def q_dq_run_rules(spark, sf_dir):
    """Each day's events as a run whose measured rows are stored; on some
    days a third of the users is missing, the field is, or it is text for
    half of them (DQ-8, CDC-16)."""
    table = BatchTable(scratch_path(spark, "run-metrics", uuid.uuid4().hex))
    day, user = F.dayofmonth("ts"), F.col("user_id")
    k = F.regexp_extract("props", "[0-9]+", 0)
    text = F.when(day % 11 == 0, F.lit("{}")).when((day % 10 == 0) & (user % 2 == 0), F.concat(F.lit('{"k": "'), k, F.lit('"}'))).otherwise(F.col("props"))
    landed = feeds.events(spark, sf_dir).where((day % 7 != 0) | (user % 3 != 0)).select("event_type", day.alias("run_no"), F.parse_json(text).alias("value"))
    metrics = materialize(run_metrics(landed, F.col("event_type"), F.col("run_no"), {"k": "$.k"}))
    # written run by run, as the runs write them; ten days a batch here
    for n in range(4):
        table.write(metrics.where(F.floor(F.col("run_no") / 10) == n), n)
    return run_violations(table.read(spark))
