"""Normalized star model: eight dimensions with unknown members, the
registration fact resolved to surrogate ids, the denormalized base and the
consumption aggregates built on it (KEY-1..5, JN-2, JN-3, AGG-3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import Lookup, denormalize, resolve_keys
from tessera.operators.key_registry import KeyRegistry
from tessera.operators.keys import build_name_dims, dense_ids
from tessera.tables import materialize

# (dimension prefix, source column) for the name dimensions
NAME_DIMS = [
    ("make", "make"),
    ("ev_type", "ev_type"),
    ("cafv", "cafv_eligibility"),
    ("utility", "electric_utility"),
    ("legislative_district", "legislative_district"),
    ("county", "counties"),
]


@dataclass
class Star:
    dims: dict[str, DataFrame]
    fact: DataFrame


class Dims(dict):
    """Dimensions built on first use, all in one pass. With
    ``materialize_dims`` they are written once: a dimension is a table,
    joined by the fact and again by the denormalized base. Whether one is
    broadcast is left to the planner, which knows the size of the written
    table in bytes."""

    def __init__(self, flat: DataFrame, materialize_dims: bool = False, names: Sequence[str] | None = None):
        super().__init__()
        self._flat = flat
        self._materialize = materialize_dims
        self._names = ALL_DIMS if names is None else list(names)

    def __missing__(self, prefix: str) -> DataFrame:
        if prefix not in self._names:
            raise KeyError(prefix)
        together = build_name_dims(
            self._flat, [(p, c) for p, c in NAME_DIMS if p in self._names or p == "make" and "model" in self._names],
            materialize if self._materialize else None,
            child=("model", "model", "make") if "model" in self._names else None,
            numeric=("model_year", "model_year") if "model_year" in self._names else None,
        )
        self.update(together)
        return together[prefix]


ALL_DIMS = [*(p for p, _ in NAME_DIMS), "model", "model_year"]


def build_dims(flat: DataFrame, materialize_dims: bool = False, names: Sequence[str] | None = None) -> Dims:
    """The dimensions ``names`` (all by default)."""
    return Dims(flat, materialize_dims, names)


@dataclass(frozen=True)
class DimUse:
    """How a dimension is looked up by the records and what it adds to the
    denormalized base."""

    source: str
    key: str
    attributes: tuple[str, ...]


def _named(prefix: str, source: str) -> DimUse:
    return DimUse(source, f"{prefix}_name", (f"{prefix}_code", f"{prefix}_name"))


#: in the order of the fact's ids
DIM_USES = {
    "make": _named("make", "make"),
    "model": _named("model", "model"),
    "ev_type": _named("ev_type", "ev_type"),
    "cafv": _named("cafv", "cafv_eligibility"),
    "model_year": DimUse("model_year", "model_year", ("model_year",)),
    "utility": _named("utility", "electric_utility"),
    "legislative_district": _named("legislative_district", "legislative_district"),
    "county": _named("county", "counties"),
}
RECORD_COLUMNS = ["vin", "dol_vehicle_id", "electric_range", "base_msrp", "source_file", "load_timestamp"]


def build_fact(flat: DataFrame, dims: dict[str, DataFrame], with_ids: bool = True, names: Sequence[str] | None = None) -> DataFrame:
    """One row per flattened source record (duplicates included), with the
    surrogate ids of the dimensions ``names`` (all by default; 0 = unknown)
    and a dense fact id (left out with ``with_ids=False`` for consumers that
    never read it)."""
    names = [n for n in DIM_USES if names is None or n in names]
    # a model is looked up within its make
    looked_up = [n for n in DIM_USES if n in names or (n == "make" and "model" in names)]
    lookups = [
        Lookup(dims[n], DIM_USES[n].source, DIM_USES[n].key, f"{n}_id", numeric=n == "model_year",
               parent_id="make_id" if n == "model" else None)
        for n in looked_up
    ]
    order = [F.coalesce(F.col(c), F.lit("")) for c in ("vin", "dol_vehicle_id", "source_file")]
    # the id order uses source columns only, so rows are numbered before
    # the lookups and the numbering does not re-run the dimension joins
    numbered = resolve_keys(dense_ids(flat, order, "registration_fact_id") if with_ids else flat, lookups)
    return numbered.select(
        *(["registration_fact_id"] if with_ids else []), "vin", "dol_vehicle_id", *[f"{n}_id" for n in names],
        F.col("electric_range").cast("long").alias("electric_range"), "base_msrp", "source_file",
        *(["load_timestamp"] if "load_timestamp" in flat.columns else []),
    )


def key_registry(root: str) -> KeyRegistry:
    """The registry of all eight dimensions."""
    return KeyRegistry(root, NAME_DIMS, child=("model", "model", "make"), numeric=("model_year", "model_year"))


def build_star(flat: DataFrame, materialize_flat: bool = True, fact_ids: bool = True, names: Sequence[str] | None = None,
               dims: dict[str, DataFrame] | None = None) -> Star:
    """Dimensions ``names`` (all by default) and fact from the flattened
    records with a VIN. ``dims`` are dimensions that exist already (of a
    ``key_registry``); otherwise they are numbered from the records. The records feed the dimensions and the fact, so the
    columns that these read are written once, unless the input is a stored
    table already."""
    used = [u.source for n, u in DIM_USES.items() if names is None or n in names or (n == "make" and "model" in names)]
    base = flat.where(F.col("vin").isNotNull()).select(*[c for c in flat.columns if c in used or c in RECORD_COLUMNS])
    if materialize_flat:
        base = materialize(base)
    if dims is None:
        dims = build_dims(base, materialize_dims=True, names=names)
    return Star(dims, build_fact(base, dims, with_ids=fact_ids, names=names))


def denorm_base(star: Star) -> DataFrame:
    """The fact with codes and names in place of ids, for the dimensions
    that it has."""
    names = [n for n in DIM_USES if f"{n}_id" in star.fact.columns]
    wide = denormalize(star.fact, [(star.dims[n].select(f"{n}_id", *DIM_USES[n].attributes), f"{n}_id", DIM_USES[n].attributes) for n in names])
    optional = lambda c: [c] if c in star.fact.columns else []
    return wide.select(
        *optional("registration_fact_id"), "vin", "dol_vehicle_id", *[a for n in names for a in DIM_USES[n].attributes],
        "electric_range", "base_msrp", "source_file", *optional("load_timestamp"),
    )


def market_metrics_wide(base: DataFrame, avg_scale: int | None = None) -> DataFrame:
    """Consumption metrics at the 7-column grain (AGG-3)."""
    avg = F.avg("electric_range")
    if avg_scale is not None:
        avg = F.round(avg, avg_scale)
    return base.groupBy(
        "make_code", "make_name", "ev_type_code", "ev_type_name", "model_year", "county_code", "county_name"
    ).agg(
        F.count(F.lit(1)).alias("total_vehicles"),
        avg.alias("avg_electric_range"),
        F.max("base_msrp").alias("max_base_msrp"),
    )
