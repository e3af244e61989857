"""Joins against side tables whose size is measured before anything is broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast relation costs a few times its raw bytes in every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


def _column_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)).cast("bigint")
    return F.lit(8).cast("bigint")


def byte_size(df: DataFrame) -> int:
    """Raw bytes of ``df``, counted by one aggregate (16 bytes added for each row)."""
    row = reduce(lambda a, b: a + b, [_column_bytes(f) for f in df.schema.fields], F.lit(16).cast("bigint"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    return byte_size(df) <= limit_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    how: str = "inner",
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` to a side table: broadcast while the side is measured to fit, else shuffle.

    Pass a side that is cheap to read twice (a table or a staged result): it is read once to be
    measured and once to be joined. Beyond the limit this is a shuffle join with ``big`` on the
    left, the side adaptive execution may split, so a key that holds a large share of ``big``
    is spread over many tasks while the few matching side rows are copied to each.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the left side must be the preserved one, not {how!r}")
    if fits_broadcast(small, limit_bytes):
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("merge"), on, how)
