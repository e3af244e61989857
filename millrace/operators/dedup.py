"""Removal of equal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

_TEXTLIKE = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType, T.DateType)
_ORDERS = (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType, T.TimestampType)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows equal on all columns (nulls equal, NaN equal).

    A hash aggregate with one exchange: copies collapse in each map task, so a row repeated any
    number of times crosses the network at most once a task.
    """
    return df.dropDuplicates()


def _digest(keys: Sequence[str]) -> Column:
    """32 bytes that tell different keys apart: each value with its length before it, null as a mark."""
    coded = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col(f"`{k}`").cast("string") for k in keys)]
    return F.unhex(F.sha2(F.concat(*coded), 256))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows equal on ``keys`` keep the first by ``order``, nulls first; which of rows equal on both is open.

    With one order column of fixed width only digests of the keys and the order are aggregated, by hash and with
    map-side combine, so a group of copies of any size never meets in one task and no text is
    sorted; a hash semi join then fetches the rows. ``df`` is read twice. Other orders and
    keys (floats, arrays) are aggregated as whole rows.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if len(order) != 1 or not isinstance(kinds[order[0]], _ORDERS) or not all(isinstance(kinds[k], _TEXTLIKE) for k in keys):
        first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
        return df.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*df.columns)
    given = F.col(f"`{order[0]}`")
    # Nulls come first: a flag before the order.
    narrow = df.select(_digest(keys).alias("_key"), given.isNotNull().cast("int").alias("_set"), given.alias("_at"))
    each = narrow.groupBy("_key", "_set", "_at").agg(F.count(F.lit(1)).alias("_n"))
    least = each.groupBy("_key").agg(F.min("_set").alias("_set"), F.min("_at").alias("_at"), F.max("_n").alias("_n"))
    least = stage(least.withColumn("_at", F.when(F.col("_set") == 1, F.col("_at"))), "first-of-key").hint("shuffle_hash")
    marked = df.withColumns({"_key": _digest(keys), "_at": given})
    firsts = least.select(F.col("_key").alias("_of"), F.col("_at").alias("_first"), "_n")
    # Joined on key and order, so that the rows of a hot key are spread by their order.
    wanted = marked.join(firsts, (F.col("_key") == F.col("_of")) & F.col("_at").eqNullSafe(F.col("_first")))
    if least.where("_n > 1").isEmpty():
        return wanted.select(*df.columns)
    single = wanted.where("_n = 1").select(*df.columns)
    return single.unionByName(wanted.where("_n > 1").dropDuplicates(["_key"]).select(*df.columns))
