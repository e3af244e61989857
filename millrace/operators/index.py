"""Row numbers, batches and limits over a total order, without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.session import stage

# A larger limit would pass too many rows through the one task that merges them.
LIMIT_IN_ONE_TASK = 100_000
# Rows of order columns looked at to find a bound for a limit.
SAMPLE = 10_000
_SHIFT = 33


def _numbered(df: DataFrame, order: Sequence[str], name: str, partitions: int | None) -> DataFrame:
    """Range-partition, sort and stage the rows with their place, then add where their partition starts.

    The staged places make both reads below see the same partitions, whichever tasks are run
    again. The driver receives one count a partition.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = stage(ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "row-index")
    part = F.shiftright("_place", _SHIFT)
    offsets, total = [], 0
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((row["part"], total))
        total += row["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    index = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row a partition
        .select(*df.columns, index.alias(name))
    )


def _numbered_ties(df: DataFrame, order: Sequence[str], name: str, partitions: int | None) -> DataFrame:
    held = stage(df, "tied-rows")
    hashed = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    dealt = held.withColumn("_hash", hashed).withColumn("_row_id", F.monotonically_increasing_id())
    return _numbered(dealt, [*order, "_hash", "_row_id"], name, partitions).drop("_hash", "_row_id")


def with_row_index(
    df: DataFrame, order: Sequence[str], name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """Number the rows from zero in the order of ``order``; tied rows get numbers in any order.

    Only the order columns are sampled, sorted and staged; the other columns join the numbers
    once, on all order columns, so a key shared by many rows is still spread. ``df`` is read
    for the sample, the sort and the join: stage it first if it is costly to compute. Where the
    order columns don't tell rows apart, the whole rows are staged, numbered and dealt by order,
    a hash of the row and their place in the staged table, so rows of one order value, equal
    ones too, are spread over many tasks; a task that is run again deals them the same way.
    """
    if set(order) == set(df.columns):
        return _numbered_ties(df, order, name, partitions)
    numbers = _numbered(df.select(*order), order, name, partitions)
    if not numbers.groupBy(*order).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        return _numbered_ties(df, order, name, partitions)
    for i, c in enumerate(order):
        numbers = numbers.withColumnRenamed(c, f"_order{i}")
    same = [F.col(c).eqNullSafe(F.col(f"_order{i}")) for i, c in enumerate(order)]
    return df.join(numbers, reduce(and_, same)).select(*df.columns, name)


def with_batch_id(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Number batches of ``size`` consecutive rows from zero."""
    indexed = with_row_index(df, order, "_row")
    return indexed.withColumn("batch_id", F.floor(F.col("_row") / size)).drop("_row")


def _upto(order: Sequence[str], row: Row) -> Column:
    """Rows that do not come after ``row``, nulls first."""
    cond = F.lit(True)
    for c in reversed(order):
        at, value = F.col(f"`{c}`"), F.lit(row[c])
        before = F.lit(False) if row[c] is None else at.isNull() | (at < value)
        cond = before | (at.eqNullSafe(value) & cond)
    return cond


def narrowed(df: DataFrame, order: Sequence[str], n: int, sample: int = SAMPLE) -> DataFrame:
    """``df`` without most of the rows that come after the first ``n`` in order; the first ``n`` are all kept.

    Selection by sampled pivots: a pivot a little beyond the wanted rank is taken from ``sample`` rows (order columns
    only), and the rows up to it are counted; if they are ``n`` at least, the rest can't matter. Each
    round leaves a small share of what it looked at, so a few passes over the order columns
    find a bound close to the rank, and no task gets ``n`` rows of every partition. Stage a costly ``df`` first.
    """
    keys, total, beyond = df.select(*order), df.count(), 3
    while total > 4 * max(n, sample):
        picked = keys.sample(min(1.0, sample / total), seed=total % 1009).orderBy(*order).limit(2 * sample).collect()
        share = len(picked) * n / total
        rank = math.ceil(share + beyond * math.sqrt(share + 1))
        if rank >= len(picked):
            break
        bound = _upto(order, picked[rank])
        left = keys.where(bound).count()
        if left < n:
            beyond *= 4
            continue
        if left > 0.9 * total:  # ties: no pivot parts them
            break
        keys, df, total = keys.where(bound), df.where(bound), left
    return df


def limit_rows(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in order; zero or null means all of them."""
    if not n:
        return df
    if n <= LIMIT_IN_ONE_TASK:
        return narrowed(df, order, n).orderBy(*order).limit(n)
    return with_row_index(df, order, "_row").where(F.col("_row") < n).drop("_row")


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_result(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The earliest value of each key, by partial and final aggregates."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))
