"""Reproducible train and test splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_TEST_SIZE = 0.01
DEFAULT_SEED = 41
_DIGITS = 4
_COLLECT = 10_000


def seeded_hash(key: Sequence[str], seed: int | str) -> Column:
    """32 hex digits that depend on the seed and the key alone, not on partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def _test_rows(test_size: float | int, n: int) -> int:
    return min(n, test_size) if isinstance(test_size, int) else math.ceil(test_size * n)


def split_threshold(df: DataFrame, key: Sequence[str], test_size: float | int, seed: int) -> str:
    """The hash up to which exactly ``test_size`` of the rows lie; empty when that is no row.

    Found by counting hash prefixes, then prefixes within the one prefix that holds the wanted
    rank: three or four scans of the key columns, at most 65,536 counts to the driver in each. Raises
    if a key that several rows share lies across the cut.
    """
    hashes = df.select(seeded_hash(key, seed).alias("h"))
    prefix, rank = "", None
    while True:
        inside = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        length = len(prefix) + _DIGITS
        counts = sorted(inside.groupBy(F.substring("h", 1, length).alias("p")).count().collect())
        if rank is None:
            rank = wanted = _test_rows(test_size, sum(c["count"] for c in counts))
            if rank <= 0:
                return ""
        for c in counts:
            if rank <= c["count"]:
                break
            rank -= c["count"]
        prefix = c["p"]
        if c["count"] <= _COLLECT or length >= 32:
            break
    if len(prefix) < 32:
        prefix = sorted(r["h"] for r in hashes.where(F.col("h").startswith(prefix)).collect())[rank - 1]
    if hashes.where(F.col("h") <= prefix).count() != wanted:
        raise ValueError(f"rows share the key {list(key)}, so no split of exactly {wanted} rows by key exists")
    return prefix


def with_split(
    df: DataFrame,
    key: Sequence[str],
    test_size: float | int = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    name: str = "is_test",
) -> DataFrame:
    """Flag the test rows: the fraction rounded up, or a whole number of rows.

    ``key`` must be unique. Once the threshold is known the split is a plain filter, so neither
    side is sorted, shuffled or joined.
    """
    return df.withColumn(name, seeded_hash(key, seed) <= F.lit(split_threshold(df, key, test_size, seed)))


def train_test_split(
    df: DataFrame, key: Sequence[str], test_size: float | int = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test sides that together hold every row."""
    flagged = with_split(df, key, test_size, seed, "_test")
    return flagged.where(~F.col("_test")).drop("_test"), flagged.where("_test").drop("_test")


def group_holdout(df: DataFrame, group: str, held: Sequence[str], name: str = "is_test") -> DataFrame:
    """Flag the rows of the held-out groups: whole groups go to the test side, null groups to train."""
    return df.withColumn(name, F.coalesce(F.col(group).isin(list(held)), F.lit(False)))


def split_leakage(train: DataFrame, test: DataFrame, text: str = "text", shortest: int = 40) -> DataFrame:
    """``line, n_test, n_train``: lines of ``shortest`` characters or more that lie on both sides.

    Each side's lines are counted by hash with map-side combine, so a license line that a third of
    all documents hold is one row before the join.
    """

    def lines(df: DataFrame, n: str) -> DataFrame:
        rows = df.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
        rows = rows.select(F.trim("line").alias("line")).where(F.length("line") >= shortest)
        return rows.groupBy("line").agg(F.count(F.lit(1)).alias(n))

    return lines(test, "n_test").join(lines(train, "n_train"), "line")
