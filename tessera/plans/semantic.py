"""Metric registry (SEM-1..4): declared dimensions, time dimensions and
measures over one table; a metric query is compiled to
``groupBy(dims).agg(measures)`` and refuses names that are not declared.
Answers can carry context columns (freshness, quality, exclusions)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import attach_scalars

from tessera.operators.aggregates import count_if


@dataclass
class SemanticModel:
    table: str
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Callable[[], Column]]
    time_dimensions: Mapping[str, Column] = field(default_factory=dict)

    def query(
        self,
        source: DataFrame,
        table: str,
        dims: Sequence[str],
        measures: Sequence[str],
        filters: Sequence[Column] = (),
        order: Sequence[Column] = (),
        limit: int | None = None,
    ) -> DataFrame:
        if table != self.table:
            raise ValueError(f"table {table!r} is not part of the semantic model")
        known = {**self.dimensions, **self.time_dimensions}
        unknown = [d for d in dims if d not in known] + [m for m in measures if m not in self.measures]
        if unknown:
            raise ValueError(f"undeclared names: {unknown}")
        df = source
        for f in filters:
            df = df.where(f)
        out = df.groupBy(*[known[d].alias(d) for d in dims]).agg(*[self.measures[m]().alias(m) for m in measures])
        if order:
            out = out.orderBy(*order)
        if limit is not None:
            out = out.limit(limit)
        return out


_AGGREGATIONS = {
    "count": F.count,
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


def model_from_spec(table: dict) -> SemanticModel:
    """A metric registry from a declarative table spec - ``name``,
    ``dimensions`` / ``time_dimensions`` (``name``, ``expr``) and
    ``measures`` (``name``, ``expr``, ``default_aggregation``), the layout
    of a semantic-model file. Expressions are Spark SQL text."""
    dims = {d["name"]: F.expr(d["expr"]) for d in table.get("dimensions", [])}
    times = {d["name"]: F.expr(d["expr"]) for d in table.get("time_dimensions", [])}
    measures = {}
    for m in table.get("measures", []):
        agg = _AGGREGATIONS[m.get("default_aggregation", "sum").lower()]
        measures[m["name"]] = (lambda a, e: (lambda: a(F.expr(e))))(agg, m["expr"])
    return SemanticModel(table["name"], dims, measures, times)


def load_models(path: str) -> dict[str, SemanticModel]:
    """All tables of a semantic-model YAML file (needs PyYAML)."""
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - optional dependency
        raise RuntimeError("reading a semantic-model file needs PyYAML") from e
    with open(path) as fh:
        doc = yaml.safe_load(fh)
    return {t["name"]: model_from_spec(t) for t in doc.get("tables", [])}


def registration_model(bev_label: str = "BEV", phev_label: str = "PHEV", cafv_label: str = "ELIGIBLE") -> SemanticModel:
    """Model over the gold registration detail: the declared dimensions,
    the three measures of the source model plus the documented market
    metrics (BEV/PHEV counts and share, CAFV eligible %, model diversity)."""
    dims = {
        n: F.col(n)
        for n in ["vin", "county_name", "make", "model", "ev_type", "legislative_district", "electric_utility", "counties"]
    }
    measures = {
        "total_vehicles": lambda: F.count("vin"),
        "avg_electric_range": lambda: F.avg("electric_range"),
        "max_base_msrp": lambda: F.max("base_msrp"),
        "bev_count": lambda: count_if(F.col("ev_type") == bev_label),
        "phev_count": lambda: count_if(F.col("ev_type") == phev_label),
        "bev_share_pct": lambda: F.round(count_if(F.col("ev_type") == bev_label) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 2),
        "cafv_eligible_pct": lambda: F.round(count_if(F.col("cafv_eligibility") == cafv_label) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 2),
        "model_diversity": lambda: F.countDistinct("model"),
        "county_coverage": lambda: F.countDistinct("county_name"),
    }
    return SemanticModel("fact_registrations", dims, measures, {"model_year": F.col("model_year")})


def with_context(answer: DataFrame, freshness_status: Column, quality_status: Column,
                 exclusions: str = "", assumptions: str = "", surface: str = "gold") -> DataFrame:
    """Context columns on an answer (SEM-2); status columns come from
    one-row DQ results attached by the caller."""
    return answer.select(
        "*",
        freshness_status.alias("freshness_status"),
        quality_status.alias("quality_status"),
        F.lit(exclusions).alias("exclusions"),
        F.lit(assumptions).alias("assumptions"),
        F.lit(surface).alias("source_surface"),
    )


def market_share(model: SemanticModel, source: DataFrame, dims: list[str]) -> DataFrame:
    """Vehicles by ``dims`` and their share of all vehicles in percent."""
    parts = model.query(source, model.table, dims, ["total_vehicles"])
    whole = source.agg(F.count("vin").alias("_all"))
    share = F.round(F.col("total_vehicles") * 100.0 / F.nullif(F.col("_all"), F.lit(0)), 2)
    return attach_scalars(parts, whole).withColumn("market_share_pct", share).drop("_all")


def suggested_questions(model: SemanticModel, source: DataFrame) -> dict[str, DataFrame]:
    """The starter analyses offered to users (SEM-3), as metric queries."""
    return {
        "avg_range_by_year": model.query(source, model.table, ["model_year"], ["avg_electric_range", "total_vehicles"],
                                         order=[F.col("model_year").asc()]),
        "top_districts": model.query(source, model.table, ["legislative_district"], ["total_vehicles"],
                                     order=[F.col("total_vehicles").desc(), F.col("legislative_district").asc()], limit=10),
        "counties_with_codes": model.query(source, model.table, ["county_name", "counties"], ["total_vehicles"],
                                           order=[F.col("county_name").asc_nulls_last()]),
    }


def consumption_rows(facts: DataFrame, versions: DataFrame, fact_key: str, key: str, fact_ts: str,
                     attrs: list[str], freshness_status: Column, quality_status: Column) -> DataFrame:
    """Consumption rows carrying the catalog attributes effective at the
    fact time plus freshness and quality markers (SEM-4)."""
    from tessera.operators.joins import effective_join

    j = effective_join(facts, versions, fact_key, key, fact_ts, attrs=attrs)
    return j.withColumn("freshness_status", freshness_status).withColumn("quality_status", quality_status)
