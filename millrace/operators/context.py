"""Order-dependent work inside a key, safe for a key that holds a large share of the rows.

A segmented scan: the order columns and one number a row are dealt by ranges of (key, order), so that a hot key
covers many partitions, and each partition is scanned by itself. One summary row a partition comes to
the driver, where what each partition takes over from those before it is combined; the
results are joined back by (key, order). Texts take no part in it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.arrays import last_n
from millrace.session import stage

BLOCK = 65_536
_SHIFT = 33


def _one_block(df: DataFrame, order: str, block: int) -> bool:
    """True when no key can hold more than ``block`` rows, as (key, order) is unique."""
    if not isinstance(df.schema[order].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return False
    ends = df.agg(F.min(order).alias("a"), F.max(order).alias("b")).first()
    return ends["a"] is None or ends["b"] - ends["a"] < block


def _placed(df: DataFrame, key: str, order: str, value: Column, block: int) -> DataFrame:
    """``_k, _o, _v, _at, _part``: rows of partitions that hold about ``block`` consecutive rows each, staged."""
    narrow = df.select(F.col(key).alias("_k"), F.col(order).alias("_o"), value.alias("_v"))
    parts = max(1, math.ceil(narrow.count() / block))
    ranged = narrow.repartitionByRange(parts, "_k", "_o").sortWithinPartitions("_k", "_o")
    placed = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    return placed.withColumn("_part", F.shiftright("_at", _SHIFT))


def _ends(placed: DataFrame) -> DataFrame:
    """``_part, _first, _last``: the keys a partition begins and ends with."""
    ends = placed.groupBy("_part").agg(F.min("_at").alias("a"), F.max("_at").alias("b"))
    at = F.broadcast(ends.withColumnRenamed("_part", "_p"))  # one row a partition
    edge = placed.join(at, (F.col("_part") == F.col("_p")) & ((F.col("_at") == F.col("a")) | (F.col("_at") == F.col("b"))))
    pick = lambda c, which: F.max(F.when(F.col("_at") == F.col(which), F.struct(c)))[c]
    return edge.groupBy("_part").agg(pick("_k", "a").alias("_first"), pick("_k", "b").alias("_last"), pick("_v", "b").alias("_end"))


def _once(order: Column, before: Column, result: Column) -> Column:
    """``result``, or an error where two rows of a key have the same order."""
    again = F.raise_error(F.lit("two rows of a key have the same order"))
    return F.when(order.eqNullSafe(before), again).otherwise(result)


def _joined_back(df: DataFrame, key: str, order: str, rows: DataFrame, name: str) -> DataFrame:
    found = rows.select("_k", "_o", F.col("_r").alias("_result"))
    same = F.col(key).eqNullSafe(F.col("_k")) & F.col(order).eqNullSafe(F.col("_o"))
    return df.join(found, same).select(*df.columns, F.col("_result").alias(name))


def with_previous(df: DataFrame, key: str, order: str, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Add the previous row's ``value`` within the key; null on its first row.

    ``(key, order)`` must be unique; beyond one block a repeated pair is an error. A null key is a key.
    """
    if _one_block(df, order, block):
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(order)))
    placed = _placed(df, key, order, value, block)
    ends = sorted(_ends(placed).collect())
    carry = [(b["_part"], b["_first"], a["_end"]) for a, b in zip(ends, ends[1:], strict=False) if a["_last"] == b["_first"]]
    kinds = {f.name: f.dataType for f in placed.schema.fields}
    schema = T.StructType([T.StructField("_p", T.LongType()), T.StructField("_f", kinds["_k"]), T.StructField("_c", kinds["_v"])])
    taken = F.broadcast(df.sparkSession.createDataFrame(carry, schema))  # one row a partition at most
    rows = placed.join(taken, (F.col("_part") == F.col("_p")) & (F.col("_at") == F.shiftleft("_part", _SHIFT)), "left")
    inside = Window.partitionBy("_part", "_k").orderBy("_at")
    result = F.coalesce(F.lag("_v").over(inside), F.col("_c"))
    rows = rows.select("_k", "_o", _once(F.col("_o"), F.lag("_o").over(inside), result).alias("_r"))
    return _joined_back(df, key, order, rows, name)


def with_running_sum(df: DataFrame, key: str, order: str, value: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Add the sum of ``value`` over the key's rows up to and including this one; as ``with_previous``."""
    upto = lambda *parts: Window.partitionBy(*parts).rowsBetween(Window.unboundedPreceding, 0)
    if _one_block(df, order, block):
        return df.withColumn(name, F.sum(value).over(upto(key).orderBy(order)))
    placed = _placed(df, key, order, value, block)
    ends = _ends(placed).drop("_end")
    tails = placed.join(F.broadcast(ends), "_part").groupBy("_part", "_first", "_last").agg(F.sum(F.when(F.col("_k").eqNullSafe(F.col("_last")), F.col("_v"))).alias("_tail"))
    carry, held, before = [], 0, None
    for row in sorted(tails.collect(), key=lambda r: r["_part"]):
        # What the partitions before hold of the key that this one begins with.
        held = held if before is not None and before["_last"] == row["_first"] else 0
        if held:
            carry.append((row["_part"], row["_first"], held))
        held, before = (row["_tail"] or 0) + (held if row["_first"] == row["_last"] else 0), row
    kinds = {f.name: f.dataType for f in placed.schema.fields}
    schema = T.StructType([T.StructField("_p", T.LongType()), T.StructField("_f", kinds["_k"]), T.StructField("_c", T.LongType())])
    taken = F.broadcast(df.sparkSession.createDataFrame(carry, schema))
    rows = placed.join(taken, (F.col("_part") == F.col("_p")) & F.col("_k").eqNullSafe(F.col("_f")), "left")
    inside = upto("_part", "_k").orderBy("_at")
    result = F.sum("_v").over(inside) + F.coalesce(F.col("_c"), F.lit(0))
    lagged = F.lag("_o").over(Window.partitionBy("_part", "_k").orderBy("_at"))
    rows = rows.select("_k", "_o", _once(F.col("_o"), lagged, result).alias("_r"))
    return _joined_back(df, key, order, rows, name)


def transcript_delta(df: DataFrame, key: str, order: str, text: str = "text", block: int = BLOCK) -> DataFrame:
    """What each message adds after the length of the message before it, as ``delta``.

    Only the previous length is looked up, so texts are not gathered by key.
    """
    seen = with_previous(df, key, order, F.length(text), "_seen", block)
    delta = F.col(text).substr(F.coalesce(F.col("_seen"), F.lit(0)) + 1, F.length(text))
    return seen.withColumn("delta", delta).drop("_seen")


def context_tail(
    df: DataFrame, key: str, order: str, tokens: str, n: int, name: str = "context", block: int = BLOCK
) -> DataFrame:
    """The last ``n`` tokens of everything said so far under the key, this row included.

    Rows are placed by the running count of tokens. A row's context then lies within the last
    ``n`` places, so the frame holds under ``2 n`` tokens however long the key, and keys are cut
    into tiles of places. A row close to the end of its tile is copied to the next one. Null
    tokens count as none.
    """
    tile = max(block, n)
    size = F.when(F.col(tokens).isNull(), 0).otherwise(F.size(tokens)).cast("bigint")
    placed = with_running_sum(df, key, order, size, "_end", block)
    own = F.floor(F.col("_end") / tile)
    reach = F.floor((F.col("_end") + n - 1) / tile)
    tiled = placed.withColumn("_own", own).withColumn("_tile", F.explode(F.array_distinct(F.array(own, reach))))
    frame = Window.partitionBy(key, "_tile").orderBy("_end").rangeBetween(-(n - 1), 0)
    # Rows without tokens share a place with others and add nothing to the frame.
    seen = F.flatten(F.collect_list(F.when(F.size(tokens) > 0, last_n(F.col(tokens), n))).over(frame))
    rows = tiled.withColumn("_seen", seen).where(F.col("_tile") == F.col("_own"))
    return rows.select(*df.columns, last_n(F.col("_seen"), n).alias(name))
