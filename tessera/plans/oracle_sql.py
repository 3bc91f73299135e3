"""Independent SQL formulations (DuckDB dialect) of the registered
queries, used as the correctness oracle. They compute the same result
directly from the benchmark tables, without the JSON round trip."""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

LINE_ORDER_SQL = (
    "l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, "
    "l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate"
)

_FIELDS_SQL = """
         'VIN' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS vin,
         n_name AS county_name,
         CAST(year(l_shipdate) AS INTEGER) AS model_year,
         p_brand AS make,
         p_name AS model,
         p_type AS ev_type,
         l_returnflag AS cafv_eligibility,
         CAST(l_quantity AS INTEGER) * 11 - 20 AS electric_range,
         l_extendedprice AS base_msrp,
         r_name AS legislative_district,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(pos AS VARCHAR) AS dol_vehicle_id,
         CAST(NULL AS VARCHAR) AS vehicle_location,
         s_name AS electric_utility,
         CAST(p_size AS VARCHAR) AS census_tract_2020,
         'C' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS counties"""


def flat_cte(source_file_sql: str, file_pos_sql: str) -> str:
    """lines (joined, per-order ``pos``) -> flat (registration fields,
    ``source_file`` and the element position ``pos`` inside the file) ->
    clean (latest per VIN)."""
    return f"""
lines AS (
  SELECT l.*, p.p_name, p.p_brand, p.p_type, p.p_size, s.s_name, s.s_nationkey, n.n_name, r.r_name,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {LINE_ORDER_SQL}) - 1 AS INTEGER) AS pos
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
flat AS (
  SELECT {source_file_sql} AS source_file,
         {file_pos_sql} AS pos,
         {_FIELDS_SQL}
  FROM lines l
),
clean AS (
  SELECT vin, county_name, make, model, model_year, ev_type, electric_range, base_msrp,
         legislative_district, dol_vehicle_id, vehicle_location, electric_utility,
         census_tract_2020, counties, source_file
  FROM (
    SELECT *, row_number() OVER (PARTITION BY vin ORDER BY source_file DESC NULLS LAST, pos DESC NULLS LAST) AS rn
    FROM flat WHERE vin IS NOT NULL
  ) WHERE rn = 1
)
"""


FLAT_CTE = flat_cte("'landing/order_' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '.json'", "pos")

def file_flat_cte(orders_per_file: int) -> str:
    """``flat`` / ``clean`` for documents of ``orders_per_file`` orders each."""
    n = int(orders_per_file)
    return flat_cte(
        f"'file_key=' || lpad(CAST(l_orderkey // {n} AS VARCHAR), 6, '0')",
        f"CAST(row_number() OVER (PARTITION BY l_orderkey // {n} ORDER BY l_orderkey, {LINE_ORDER_SQL}) - 1 AS INTEGER)",
    )


FILE_FLAT_CTE = file_flat_cte(1000)


def with_flat(body: str) -> str:
    return f"WITH {FLAT_CTE}\n{body}"


# The star's oracle numbers all members in one table of (dimension, parent,
# label) and gives every record its ids by one join over its labels in long
# form; names and codes of the wide rows come from the records themselves.

#: dimension -> (label of a record, label of its parent) in SQL
_LABELS = {
    "make": ("upper(trim(make))", "''"),
    "model": ("upper(trim(model))", "upper(trim(make))"),
    "ev_type": ("upper(trim(ev_type))", "''"),
    "cafv": ("upper(trim(cafv_eligibility))", "''"),
    "model_year": ("lpad(CAST(model_year AS VARCHAR), 6, '0')", "''"),
    "utility": ("upper(trim(electric_utility))", "''"),
    "legislative_district": ("upper(trim(legislative_district))", "''"),
    "county": ("upper(trim(counties))", "''"),
}


def _code(label: str) -> str:
    return f"regexp_replace({label}, '[^A-Z0-9]+', '_', 'g')"


def _members_of(dim: str) -> str:
    """A dimension with its unknown member, from the member table."""
    if dim == "model_year":
        rows = "SELECT id, ltrim(label, '0'), CAST(label AS INTEGER) FROM members WHERE dim = 'model_year'"
        return f"dim_model_year(model_year_id, model_year_code, model_year) AS (VALUES (CAST(0 AS BIGINT), 'UNK', CAST(NULL AS INTEGER)) UNION ALL {rows})"
    if dim == "model":
        rows = (
            f"SELECT c.id, p.id, {_code('c.label')}, c.label FROM members c, members p "
            "WHERE c.dim = 'model' AND p.dim = 'make' AND p.label = c.parent"
        )
        return f"dim_model(model_id, make_id, model_code, model_name) AS (VALUES (CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'UNK', 'UNKNOWN') UNION ALL {rows})"
    rows = f"SELECT id, {_code('label')}, label FROM members WHERE dim = '{dim}'"
    return f"dim_{dim}({dim}_id, {dim}_code, {dim}_name) AS (VALUES (CAST(0 AS BIGINT), 'UNK', 'UNKNOWN') UNION ALL {rows})"


def _wide(dim: str) -> str:
    """Code and name of a record's member, by the record's own label."""
    label, parent = _LABELS[dim]
    known = f"coalesce({label}, '') <> ''" + (f" AND coalesce({parent}, '') <> ''" if parent != "''" else "")
    return f"if({known}, {_code(label)}, 'UNK') AS {dim}_code, if({known}, {label}, 'UNKNOWN') AS {dim}_name"


STAR_CTE = f"""
records AS (
  SELECT rank() OVER (ORDER BY vin, coalesce(dol_vehicle_id, ''), coalesce(source_file, '')) AS record_no, *
  FROM flat WHERE vin IS NOT NULL),
labelled AS (
  {" UNION ALL ".join(
      f"SELECT record_no, '{dim}' AS dim, {parent} AS parent, {label} AS label FROM records" for dim, (label, parent) in _LABELS.items())}),
members AS (
  SELECT dim, parent, label, CAST(rank() OVER (PARTITION BY dim ORDER BY parent, label) AS BIGINT) AS id
  FROM (SELECT DISTINCT dim, parent, label FROM labelled WHERE label <> '' AND (dim <> 'model' OR parent <> ''))),
{", ".join(map(_members_of, _LABELS))},
record_ids AS (
  SELECT record_no, {", ".join(f"coalesce(max(id) FILTER (dim = '{dim}'), 0) AS {dim}_id" for dim in _LABELS)}
  FROM labelled LEFT JOIN members USING (dim, parent, label) GROUP BY record_no),
fact AS (
  SELECT CAST(record_no AS BIGINT) AS registration_fact_id, vin, dol_vehicle_id, record_ids.* EXCLUDE (record_no),
         CAST(electric_range AS BIGINT) AS electric_range, base_msrp, source_file
  FROM records JOIN record_ids USING (record_no)),
base AS (
  SELECT CAST(record_no AS BIGINT) AS registration_fact_id, vin, dol_vehicle_id, model_year,
         {", ".join(_wide(dim) for dim in _LABELS if dim != "model_year")},
         CAST(electric_range AS BIGINT) AS electric_range, base_msrp, source_file
  FROM records),
mv_metrics AS (
  SELECT make_code, make_name, ev_type_code, ev_type_name, model_year, county_code, county_name,
         count(*) AS total_vehicles, avg(electric_range) AS avg_electric_range, max(base_msrp) AS max_base_msrp
  FROM base GROUP BY ALL)"""


def with_star(body: str) -> str:
    return f"WITH {FLAT_CTE},\n{STAR_CTE}\n{body}"
