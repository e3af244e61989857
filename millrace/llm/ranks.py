"""Dense numbers within groups, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.sizing import lookup_join

_SHIFT = 33


def numbered(df: DataFrame, group: str, order: Sequence[str], scratch: Scratch, keep: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_pos``, the place of a row in its group from zero, and ``(group, _n)``, the sizes.

    Rows are dealt by ranges of (group, order), so a group with a third of all rows covers a third
    of the partitions. Each partition numbers its own sorted rows; what is added is where its part of
    the group starts, from one row a partition and group. ``group`` must not be null; nulls in
    ``order`` come first. ``keep`` names the columns to go on with after the sort. Rows equal on
    ``order`` are numbered in any way, so give a full order where that matters. ``df`` is read twice.
    """
    kept = [c for c in (keep or df.columns) if c != group]
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = scratch.stage(ranged.select(group, *kept, F.monotonically_increasing_id().alias("_at")))
    placed = placed.withColumn("_part", F.shiftright("_at", _SHIFT))
    runs = scratch.stage(placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(group, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    out = lookup_join(placed, scratch.stage(starts), [group, "_part"])
    return out.select(group, *kept, (F.col("_at") + F.col("_shift")).alias("_pos")), runs.groupBy(group).agg(F.sum("_n").alias("_n"))
