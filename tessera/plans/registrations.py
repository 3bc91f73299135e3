"""Registration records derived from the benchmark tables.

The pipeline's input is a feed of vehicle-registration records. On the
TPC-H-like tables a registration is a line item joined to its part,
supplier, nation and region:

    make / model / ev_type         <- p_brand / p_name / p_type
    model_year                     <- year(l_shipdate)
    electric_range                 <- l_quantity * 11 - 20  (spans -9..530,
                                      so both range rules fire)
    base_msrp                      <- l_extendedprice
    county name / county code      <- n_name / 'C' + nation key
    electric utility               <- s_name
    legislative district           <- r_name
    CAFV eligibility               <- l_returnflag
    vin                            <- 'VIN' + part key (repeats across
                                      orders, so latest-wins dedup matters)
    dol_vehicle_id                 <- '<order key>-<position>' (unique)

Each order becomes one landed JSON document ``{"data": [[...], ...]}``
whose rows are positional string arrays, the source's wire format, with
its own file name, so the raw -> flatten -> extract -> dedup path runs on
every line item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.flatten import extract_positions, flatten
from tessera.session import size_shuffles
from tessera.sources.json_docs import write_documents
from tessera.sources.tables import read_table
from tessera.tables import path_bytes

AS_OF = "2024-01-31 00:00:00"

# Array positions of the registration fields in a source row
# (position, column, type), as the source format defines them.
REGISTRATION_POSITIONS = [
    (8, "vin", "string"),
    (9, "county_name", "string"),
    (13, "model_year", "int"),
    (14, "make", "string"),
    (15, "model", "string"),
    (16, "ev_type", "string"),
    (17, "cafv_eligibility", "string"),
    (18, "electric_range", "int"),
    (19, "base_msrp", "double"),
    (20, "legislative_district", "string"),
    (21, "dol_vehicle_id", "string"),
    (22, "vehicle_location", "string"),
    (23, "electric_utility", "string"),
    (24, "census_tract_2020", "string"),
    (25, "counties", "string"),
]
ROW_WIDTH = 26

# line item columns that order the lines of one order (a total order here)
_LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _joined_lines(spark: SparkSession, sf_dir: str, place: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    """Line items with the columns of their part, supplier, nation and region.
    ``place`` may shuffle them before the supplier's names are added, which
    are the same text on many lines."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation / region are fixed-size code tables (25 and 5 rows at any
    # scale), so broadcasting them is bounded; part and supplier grow with
    # the data and are left to the planner / AQE.
    return (
        place(li.join(part, li.l_partkey == part.p_partkey).drop("p_partkey"))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _fields(src) -> dict[str, Column]:
    """Registration fields of one joined line (``src`` maps a column name to
    a Column, so the same rules serve rows and array elements)."""
    return {
        "vin": F.concat(F.lit("VIN"), F.lpad(src("l_partkey").cast("string"), 7, "0")),
        "county_name": src("n_name"),
        "model_year": F.year(src("l_shipdate")),
        "make": src("p_brand"),
        "model": src("p_name"),
        "ev_type": src("p_type"),
        "cafv_eligibility": src("l_returnflag"),
        "electric_range": src("l_quantity").cast("int") * F.lit(11) - F.lit(20),
        "base_msrp": src("l_extendedprice"),
        "legislative_district": src("r_name"),
        "vehicle_location": F.lit(None).cast("string"),
        "electric_utility": src("s_name"),
        "census_tract_2020": src("p_size").cast("string"),
        "counties": F.concat(F.lit("C"), F.lpad(src("s_nationkey").cast("string"), 2, "0")),
    }


def _faulty(fields: dict[str, Column]) -> dict[str, Column]:
    """Fixed test parameters: records of every 17th electric range come
    without a VIN, of every 13th without a make, and of model year 1995
    without a model, so that the checks have something to find."""
    rng = fields["electric_range"]
    out = dict(fields)
    out["vin"] = F.when(F.pmod(rng, F.lit(17)) != 0, fields["vin"])
    out["make"] = F.when(F.pmod(rng, F.lit(13)) != 0, fields["make"])
    out["model"] = F.when(fields["model_year"] != 1995, fields["model"])
    return out


def source_file_of(orderkey: Column) -> Column:
    return F.concat(F.lit("landing/order_"), F.lpad(orderkey.cast("string"), 12, "0"), F.lit(".json"))


def _row_array(dol: Column, faulty: bool = False) -> Column:
    """One source row: the registration fields as strings at their
    positions, NULL elsewhere (the source's wire format)."""
    f = _faulty(_fields(F.col)) if faulty else _fields(F.col)
    f["dol_vehicle_id"] = dol
    by_pos = {pos: name for pos, name, _ in REGISTRATION_POSITIONS}
    return F.array(*[
        f[by_pos[p]].cast("string") if p in by_pos else F.lit(None).cast("string") for p in range(ROW_WIDTH)
    ])


def landing_documents(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, faulty: bool = False) -> DataFrame:
    """Raw layer: one VARIANT document per order with file lineage. The
    per-order position comes from a window on the order key and the
    grouping reuses that partitioning (one shuffle)."""
    lines = typed_lines(spark, sf_dir)
    dol = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("pos").cast("string"))
    # rows are gathered as text, not as arrays of their fields
    keyed = lines.select("l_orderkey", F.struct("pos", F.to_json(_row_array(dol, faulty)).alias("row")).alias("s"))
    docs = keyed.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("s")).alias("rows"))
    body = F.concat(F.lit('{"data":['), F.array_join(F.transform("rows", lambda x: x["row"]), ","), F.lit("]}"))
    return docs.select(
        F.parse_json(body).alias("json_data"),
        source_file_of(F.col("l_orderkey")).alias("source_file"),
        F.lit(1).cast("long").alias("source_file_row"),
        F.lit(as_of).cast("timestamp").alias("load_timestamp"),
    )


def flat_registrations(spark: SparkSession, sf_dir: str, via_json: bool = True, as_of: str = AS_OF,
                       counted: Observation | None = None) -> DataFrame:
    """Flattened, typed registration rows (the unfiltered flatten, one row
    per source record) with ``source_file`` and the element ``pos``.

    ``via_json`` runs the documented path (landing documents -> flatten ->
    positional extract); without it the same rows are built directly from
    the joined tables, which the tests prove equal. ``counted`` gets the
    number of documents (``rows``), once the result is used.
    """
    if via_json:
        raw = landing_documents(spark, sf_dir, as_of)
        if counted is not None:
            raw = raw.observe(counted, F.count(F.lit(1)).alias("rows"))
        return extract_positions(
            flatten(raw, "json_data", "$.data"),
            REGISTRATION_POSITIONS,
            keep=["source_file", "load_timestamp", "pos"],
        )
    lines = typed_lines(spark, sf_dir)
    f = _fields(F.col)
    f["dol_vehicle_id"] = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("pos").cast("string"))
    cols = [f[name].cast(_spark_type(kind)).alias(name) for _, name, kind in REGISTRATION_POSITIONS]
    return lines.select(
        source_file_of(F.col("l_orderkey")).alias("source_file"),
        F.lit(as_of).cast("timestamp").alias("load_timestamp"),
        F.col("pos"),
        *cols,
    )


def faulty_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flatten of documents with faults, with the raw element."""
    raw = landing_documents(spark, sf_dir, faulty=True)
    return extract_positions(flatten(raw, "json_data", "$.data"), REGISTRATION_POSITIONS, keep=["source_file", "load_timestamp", "pos", "value"])


def _spark_type(kind: str) -> str:
    return {"int": "int", "double": "double", "string": "string"}[kind]


def typed_lines(spark: SparkSession, sf_dir: str, orders_per_file: int | None = None,
                file_filter: Column | None = None) -> DataFrame:
    """Joined line items with their per-order position (``pos``). With
    ``orders_per_file`` the lines of the files that ``file_filter`` (over
    ``file_no``) keeps, those of a file in one partition: positions, documents
    and files all follow from that one shuffle."""
    size_shuffles(spark, path_bytes(spark, f"{sf_dir}/lineitem.parquet"))

    def by_file(lines: DataFrame) -> DataFrame:
        numbered = lines.withColumn("file_no", (F.col("l_orderkey") / F.lit(orders_per_file)).cast("long"))
        return (numbered if file_filter is None else numbered.where(file_filter)).repartition("file_no")

    if orders_per_file is None:
        lines, keys = _joined_lines(spark, sf_dir), ["l_orderkey"]
    else:
        lines, keys = _joined_lines(spark, sf_dir, by_file), ["file_no", "l_orderkey"]
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in _LINE_ORDER])
    return lines.withColumn("pos", (F.row_number().over(order) - 1).cast("int"))


def file_key_of(orderkey: Column, orders_per_file: int) -> Column:
    return F.concat(F.lit("file_key="), F.lpad((orderkey / F.lit(orders_per_file)).cast("long").cast("string"), 6, "0"))


def write_landing_files(spark: SparkSession, sf_dir: str, path: str, orders_per_file: int = 1000,
                        file_filter: Column | None = None) -> None:
    """Land the registrations as JSON files, one document per file, each
    holding the lines of ``orders_per_file`` consecutive orders in
    (order, line) order - the input of the file-arrival stream.
    ``file_filter`` (over ``file_no``) lands a subset of the files, so
    files can be landed in several rounds. They are compressed; readers tell
    by the name. All stand in one folder: at this number of files a folder
    for each costs more than its document."""
    # the order in which the positions were counted, so there is nothing to sort again
    lines = typed_lines(spark, sf_dir, orders_per_file, file_filter).sortWithinPartitions("file_no", "l_orderkey", *_LINE_ORDER)
    dol = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("pos").cast("string"))
    write_documents(lines.select("file_no", F.to_json(_row_array(dol)).alias("value")), path)


def large_document_rounds(spark: SparkSession, sf_dir: str, orders_per_file: int, round_lines: int) -> list[Column]:
    """Filters over ``file_no``, each of about ``round_lines`` lines where they
    are spread evenly over the documents, of a document at least; together
    they keep every document once."""
    row = read_table(spark, sf_dir, "lineitem").agg(F.min("l_orderkey").alias("a"), F.max("l_orderkey").alias("b"), F.count(F.lit(1)).alias("n")).first()
    file_no = F.col("file_no")
    if row.a is None:
        return [file_no.isNotNull()]
    first, last = int(row.a / orders_per_file), int(row.b / orders_per_file)
    rounds = min(-(-row.n // round_lines), last - first + 1)
    bounds = [first + (last - first + 1) * i // rounds for i in range(1, rounds)]
    low = [file_no.isNotNull(), *(file_no >= F.lit(b) for b in bounds)]
    high = [*(file_no < F.lit(b) for b in bounds), file_no.isNotNull()]
    return [a & b for a, b in zip(low, high)]


def large_document_lines(spark: SparkSession, sf_dir: str, orders_per_file: int, file_filter: Column | None = None) -> DataFrame:
    """The lines (``value``) of few large JSON documents (``file_key``), sorted
    into their place: a record a line, the first after the fields before the
    records, which have brackets of their own, the last with what follows.
    The lines are joined once, and the shuffle that numbers them places them
    too. ``file_filter`` (over ``file_no``) keeps some of the documents."""
    lines = typed_lines(spark, sf_dir, orders_per_file, F.col("file_no").isNotNull() if file_filter is None else file_filter)
    dol = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("pos").cast("string"))
    in_file = Window.partitionBy("file_no").orderBy("l_orderkey", "pos")
    head = '{"meta": {"columns": [["id", "a]b"], ["\\\\"data\\\\": ["]], "data": [1, [2]]}, "data": [\n'
    before = F.when(F.lag("pos").over(in_file).isNull(), F.lit(head)).otherwise(F.lit(","))
    after = F.when(F.lead("pos").over(in_file).isNull(), F.lit('\n], "count": [0]}')).otherwise(F.lit(""))
    records = lines.select(
        F.lpad(F.col("file_no").cast("string"), 6, "0").alias("file_key"), F.col("l_orderkey").alias("a"), F.col("pos").alias("b"),
        F.concat(before, F.to_json(_row_array(dol)), after).alias("value"))
    return records.sortWithinPartitions("file_key", "a", "b").select("file_key", "value")


def write_large_documents(spark: SparkSession, sf_dir: str, path: str, orders_per_file: int, file_filter: Column | None = None) -> None:
    """Land the registrations as few large JSON documents; none is held as one
    value."""
    large_document_lines(spark, sf_dir, orders_per_file, file_filter).write.mode("append").partitionBy("file_key").text(path)
