"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf, the digest of its fields. The leaves of a group stand
in the order of their key, and runs of ``fanout`` consecutive nodes become
their parent until one node is left. A level is one pivot: conditional
aggregates spread the children of a parent over ``fanout`` slot columns, the
digest of the slots in order is the parent, and the slots without a child's
own are its siblings. The last nodes of the groups, in the order of the
groups, are the leaves of a second tree of the same kind, whose last node is
the root of the manifest.

Places come from a range partitioning by (group, key) that is written once,
so a group of any size is spread over many tasks, in every level. A level is
a written table; only the greatest size of a group and the root reach the
driver.

Defined results: a null field is ``-``, a null group is a group of its own
that comes first, null keys come first in theirs. Rows with equal keys are
ordered by leaf; equal rows are equal leaves side by side, each with its own
proof. Texts are hashed whole at any length. An empty table has no leaf and
a null root. Columns that are neither field, group, key nor kept are
ignored; kept ones travel inside a struct, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import require, stored


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value as text: no two
    rows of fields give the same bytes."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (with ``tree`` and the ``order`` columns) with ``pos``, their
    place in their tree from 0, and ``n``, the number of its nodes. The copy
    sorted by range has one run of rows per tree and partition; places are
    counted inside runs, and runs are summed per tree."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by)
    copy = stored(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "merkle-nodes")
    runs = copy.groupBy("tree", "part").agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first_at")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    return copy.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _slots(fanout: int) -> list[str]:
    return [f"slot_{k}" for k in range(fanout)]


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per parent: its children in slot columns (structs of ``hash``
    and what they carry), and its own hash."""
    child = F.struct("hash", *(["kept"] if "kept" in nodes.columns else []))
    pivot = nodes.filter("n > 1").groupBy("tree", F.expr(f"pos div {fanout}").alias("pos"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"))
    wide = pivot.agg(*[F.first(F.when(F.col("pos") % fanout == k, child), ignorenulls=True).alias(s) for k, s in enumerate(_slots(fanout))])
    return wide.withColumn("hash", F.sha2(F.concat_ws("", *[f"{s}.hash" for s in _slots(fanout)]), 256))


def _climb(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The written levels from ``nodes`` up, until every tree has one node."""
    levels = [nodes]
    left = nodes.agg(F.max("n")).first()[0] or 0
    while left > 1:
        levels.append(stored(_parents(levels[-1], fanout), f"merkle-level-{len(levels)}"))
        left = -(-left // fanout)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The last node of every tree: ``tree``, ``hash``."""
    found = [t.filter("n = 1").select("tree", "hash") for t in levels]
    out = found[0]
    for t in found[1:]:
        out = out.unionByName(t)
    return out


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """The rows of ``parents`` (with ``path``) for each of their children:
    ``child``, its ``pos`` and its path, which starts with its siblings
    before and after it."""
    slots = _slots(fanout)

    def one(k: int) -> Column:
        def joined(some: list[str]) -> Column:
            return F.concat_ws("", *[f"{s}.hash" for s in some])

        siblings = F.struct(joined(slots[:k]).alias("before"), joined(slots[k + 1 :]).alias("after"))
        made = F.struct(F.col(slots[k]).alias("child"), (F.col("pos") * fanout + k).alias("pos"), siblings.alias("step"))
        return F.when(F.col(slots[k]).isNotNull(), made)

    each = parents.select("tree", "path", "top", F.explode(F.array_compact(F.array(*map(one, range(fanout))))).alias("c"))
    return each.select("tree", "c.pos", "c.child", F.concat(F.array("c.step"), "path").alias("path"), "top")


def _descend(levels: list[DataFrame], ends: DataFrame, fanout: int) -> DataFrame:
    """The nodes of ``levels[0]`` with ``path``, their siblings level by level
    up to the end of their tree and then the path of that (``ends``: ``tree``,
    ``path``, ``top``), and ``top``, the last node of their tree. The paths of
    every level but the lowest are written, so that a plan, which the driver
    holds, has one level and not all of them."""
    paths = None
    for i in range(len(levels) - 1, -1, -1):
        last = levels[i].filter("n = 1").join(ends, "tree")
        if i == 0:
            child = F.struct("hash", *(["kept"] if "kept" in levels[0].columns else [])).alias("child")
            lone = last.select("tree", "pos", child, "path", "top")
            return lone if paths is None else paths.unionByName(lone)
        here = last.select("tree", "pos", "path", "top")
        if paths is not None:
            here = here.unionByName(paths)
        paths = _children(levels[i].join(here, ["tree", "pos"]), fanout)
        if i > 1:
            paths = stored(paths.select("tree", "pos", "path", "top"), f"merkle-paths-{i}")


@dataclass(frozen=True)
class Manifest:
    """``levels[0]`` are the leaves (``tree``, ``pos``, ``n``, ``hash``, ``kept``),
    the others their parents; ``group_levels`` the tree over the groups;
    ``root`` its last node, null without rows."""

    levels: list[DataFrame]
    group_levels: list[DataFrame]
    root: str | None
    fanout: int

    def proofs(self) -> DataFrame:
        """Per leaf ``kept``, ``leaf``, ``subroot`` (the last node of its
        group) and ``path``, its siblings ``before`` and ``after`` it in every
        run from the leaf to the root."""
        start = _tops(self.group_levels).select("tree", F.expr(f"CAST(array() AS {PATH})").alias("path"), F.col("hash").alias("top"))
        groups = _descend(self.group_levels, start, self.fanout)
        groups = stored(groups.select(F.col("child.kept.tree").alias("tree"), "path", F.col("child.hash").alias("top")), "merkle-group-paths")
        found = _descend(self.levels, groups, self.fanout)
        return found.select("child.kept", F.col("child.hash").alias("leaf"), F.col("top").alias("subroot"), "path")


PATH = "array<struct<before:string,after:string>>"


def siblings(path: Column) -> Column:
    """All siblings of a path, concatenated from the leaf to the root."""
    return F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"])))


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda below, s: digest(s["before"], below, s["after"]))


def manifest(docs: DataFrame, fields: Sequence[str], group: str, key: Sequence[str], keep: Sequence[str | Column] = (), fanout: int = 3) -> Manifest:
    """The manifest of ``docs``: leaves of ``fields``, ordered by ``key``
    within ``group``. ``keep`` are columns to find beside the proofs."""
    if fanout < 2:
        raise ValueError("a parent has at least two slots")
    require(docs, [*fields, group, *key])
    # null first, then the groups by their bytes
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    order = [f"key_{i}" for i in range(len(key))]
    kept = F.struct(*keep) if keep else F.struct(F.lit(None).cast("string").alias("nothing"))
    rows = docs.select(
        tree.alias("tree"), *[F.col(k).alias(o) for k, o in zip(key, order)],
        leaf(*map(F.col, fields)).alias("hash"), kept.alias("kept"),
    )
    # digests first: the range partitioning samples its input
    leaves = stored(_placed(stored(rows, "merkle-leaves"), [*order, "hash"]).drop(*order), "merkle-level-0")
    levels = _climb(leaves, fanout)
    groups = _tops(levels).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash", F.struct("tree").alias("kept"))
    group_levels = _climb(stored(_placed(groups, ["group"]).drop("group"), "merkle-groups"), fanout)
    top = _tops(group_levels).first()
    return Manifest(levels, group_levels, top["hash"] if top else None, fanout)


def manifest_report(docs: DataFrame) -> DataFrame:
    """Per document its leaf, the last node of its source, the root, a digest
    of its proof, and whether a second copy of the document still leads to the
    root. The copies of half the documents (by checksum of their ids) lost
    their line ends."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    damaged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(damaged, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    copy = leaf(*[text if f == "text" else F.col(f) for f in fields])
    made = manifest(docs, fields, "source", ["doc_id"], keep=["doc_id", copy.alias("copy")])
    found = made.proofs().withColumn("folded_root", folded(F.col("path"), F.col("kept.copy")))
    root = F.lit(made.root).cast("string")
    return found.select(
        "kept.doc_id", "leaf", "subroot", root.alias("root"), F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
