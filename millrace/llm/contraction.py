"""Subtree totals of a tree of any shape by parallel contraction.

Rounds of joins alternate two steps on the nodes that are still there:

* *rake*: every leaf goes; its total is known and is added to its parent,
* *compress*: of the nodes with a single child, those that come first among their like neighbours go;
  their child hangs from their parent and carries what they held.

Which node of a chain comes first is told by the trailing zeros of its depth, then by a hash, so a chain of
consecutive depths is halved in every round and one of any depths shrinks by a share. Rounds then
grow with the logarithm of the tree, also for a chain or a comb that holds all nodes. Afterwards the
rounds are undone from the last to the first: a node that was compressed has its own, what its child
carried from nodes between them, and its child's total, known by then. Every round works on what the one before left, so the work is that
of a few passes over the tree.

All joins are by single nodes or single children; a node with any number of children is met only in
sums with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch


def _sums(df: DataFrame, by: str, columns: dict) -> DataFrame:
    return df.groupBy(by).agg(*[F.sum(c).alias(name) for name, c in columns.items()])


def subtree_totals(nodes: DataFrame, values: Sequence[str], scratch: Scratch, seed: int = 41) -> DataFrame:
    """``(id, *values)``: the sums of ``values`` over each node and all below it.

    ``nodes`` have ``id`` (any type, unique), ``parent`` (null for roots; else an ``id`` that is there), ``depth`` and
    ``values``, which must not be null. Several trees may be given at once. An empty table has no totals.
    """
    carried = [f"_w{i}" for i in range(len(values))]
    start = nodes.select("id", "parent", F.col("depth").cast("bigint").alias("depth"), *[F.col(v).cast("bigint").alias(v) for v in values])
    alive = scratch.stage(start.select("*", *[F.lit(0).cast("bigint").alias(w) for w in carried]))
    rounds = []
    while not alive.isEmpty():
        # Rake.
        parents = alive.where(F.col("parent").isNotNull()).select(F.col("parent").alias("id")).distinct().withColumn("_inner", F.lit(True))
        split = scratch.stage(alive.join(parents, "id", "left"))
        leaves, inner = split.where("_inner is null"), split.where("_inner").drop("_inner")
        gained = _sums(leaves.where(F.col("parent").isNotNull()), "parent", {f"_g{i}": F.col(v) + F.col(w) for i, (v, w) in enumerate(zip(values, carried, strict=True))})
        grown = inner.join(gained.withColumnRenamed("parent", "id"), "id", "left")
        sums = [(F.col(v) + F.coalesce(F.col(f"_g{i}"), F.lit(0))).alias(v) for i, v in enumerate(values)]
        grown = scratch.stage(grown.select("id", "parent", "depth", *sums, *carried))
        # Compress: a node's one child, and whether that child also has one.
        ones = grown.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("id")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("id").alias("_child"), *[F.min(w).alias(f"_c{i}") for i, w in enumerate(carried)]
        )
        rank = F.struct(F.expr("bit_count((depth & -depth) - 1)"), F.xxhash64(F.lit(seed + len(rounds)), "id"), "id")
        chain = grown.join(ones.where("_n = 1").drop("_n"), "id").where(F.col("parent").isNotNull()).withColumn("_rank", rank)
        chain = scratch.stage(chain)
        below = chain.select(F.col("id").alias("_child"), F.col("_rank").alias("_below"))
        pairs = chain.join(below, "_child")
        later = pairs.select(F.when(F.col("_rank") < F.col("_below"), F.col("_child")).otherwise(F.col("id")).alias("id")).distinct()
        gone = scratch.stage(chain.join(later, "id", "left_anti").select("id", "parent", "_child", *values, *carried, *[f"_c{i}" for i in range(len(values))]))
        up = gone.select(
            F.col("_child").alias("id"), F.col("parent").alias("_parent"),
            *[(F.col(v) + F.col(w)).alias(f"_m{i}") for i, (v, w) in enumerate(zip(values, carried, strict=True))],
        )
        left = grown.join(gone.select("id"), "id", "left_anti").join(up, "id", "left")
        more = [(F.col(w) + F.coalesce(F.col(f"_m{i}"), F.lit(0))).alias(w) for i, w in enumerate(carried)]
        after = scratch.stage(left.select("id", F.coalesce("_parent", "parent").alias("parent"), "depth", *values, *more))
        rounds.append((split, gone))
        scratch.drop(alive, grown, chain)
        alive = after
    scratch.drop(alive)
    # Expand.
    totals = None
    for split, gone in reversed(rounds):
        known = split.where("_inner is null").select("id", *values)
        if totals is not None:
            child = totals.select(F.col("id").alias("_child"), *[F.col(v).alias(f"_t{i}") for i, v in enumerate(values)])
            opened = gone.join(child, "_child").select("id", *[(F.col(v) + F.col(f"_c{i}") + F.col(f"_t{i}")).alias(v) for i, v in enumerate(values)])
            known = totals.unionByName(known).unionByName(opened)
        before = totals
        totals = scratch.stage(known)
        scratch.drop(split, gone, *([before] if before is not None else []))
    return totals if totals is not None else start.select("id", *values)
