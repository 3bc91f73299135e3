"""Surrogate keys that stay (KEY-3..5): an append-only map from (dimension,
parent, name) to id.

A run looks its own names up; those that the registry does not hold get ids
after the highest of their dimension, in the order of their names. Ids that
were given stay, so facts of earlier runs need no second look, and older names
are neither sorted nor numbered again. Child members (a model within its make)
and numeric ones (model years) are registered the same way.

Every run writes the names that it adds under its number; a repeated run finds
the same new names and gives them the same ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keys import dense_ids, dimension_members, dimensions_of, with_parent_ids
from tessera.tables import BatchTable

MEMBER = ["_dim", "_k1", "_k2"]


class KeyRegistry:
    """``specs``, ``child`` and ``numeric`` as in ``keys.build_name_dims``."""

    def __init__(self, root: str, specs: Sequence[tuple[str, str]], child: tuple[str, str, str] | None = None,
                 numeric: tuple[str, str] | None = None):
        self.names = BatchTable(root)
        self.specs, self.child, self.numeric = list(specs), child, numeric

    def register(self, records: DataFrame, run_no: int) -> None:
        """Add the members that ``records`` bring and no earlier run has."""
        spark = records.sparkSession
        members = dimension_members(records, self.specs, self.child, self.numeric)
        known = self.names.read(spark, run_no - 1)
        if known is None:
            numbered = dense_ids(members, MEMBER, "_gid")
            tops = None
        else:
            numbered = dense_ids(members.join(known.select(*MEMBER), MEMBER, "left_anti"), MEMBER, "_gid")
            tops = known.groupBy("_dim").agg(F.max("_id").alias("_top"))
        offsets = numbered.groupBy("_dim").agg(F.min("_gid").alias("_first"))  # one row per dimension, as tops
        offsets = offsets.withColumn("_top", F.lit(0)) if tops is None else offsets.join(F.broadcast(tops), "_dim", "left")
        added = numbered.join(F.broadcast(offsets), "_dim").select(
            *MEMBER, (F.col("_gid") - F.col("_first") + 1 + F.coalesce("_top", F.lit(0))).cast("long").alias("_id"))
        # the parent of a new member may be an older one
        parents = added.select(*MEMBER, "_id", F.lit(True).alias("_new"))
        if known is not None and self.child is not None:
            older = known.where(F.col("_dim") == self.child[2])
            parents = parents.unionByName(older.select(*MEMBER, "_id", F.lit(False).alias("_new")))
        self.names.write(with_parent_ids(parents, self.child).where("_new").drop("_new"), run_no)

    def dimensions(self, spark: SparkSession, records: DataFrame, upto: int | None = None) -> dict[str, DataFrame]:
        """The dimensions after run ``upto``, as ``build_name_dims`` lays them
        out; ``records`` gives the type of the numeric one."""
        return dimensions_of(self.names.read(spark, upto), records, self.specs, self.child, self.numeric)
