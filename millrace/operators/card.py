"""Counts that describe a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import paths as P
from millrace.operators.index import with_row_index
from millrace.session import stage
from millrace.sizing import lookup_join


def files_per_repo(df: DataFrame, repo: str = "repo", file: str = "file") -> DataFrame:
    """Count of non-null files in each group."""
    return df.groupBy(repo).agg(F.count(file).alias("file_count"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count of each non-null value, largest first, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column)


def extension_counts(df: DataFrame, file: str = "file") -> DataFrame:
    return value_counts(df.select(P.file_extension(F.col(file)).alias("extension")), "extension")


def corpus_card(df: DataFrame, repo: str = "repo", file: str = "file") -> DataFrame:
    """Files per repository and per extension in long form, from one scan and one exchange."""
    entry = lambda section, key: F.struct(F.lit(section).alias("section"), key.alias("key"))
    entries = F.array(entry("repo", F.col(repo)), entry("extension", P.file_extension(F.col(file))))
    rows = df.where(F.col(file).isNotNull()).select(F.explode(entries).alias("e"))
    return rows.groupBy("e.section", "e.key").agg(F.count(F.lit(1)).alias("n"))


def dataset_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def name_collisions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Names used by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_files")).where("n_files > 1")


def collect_group_files(df: DataFrame, group: str, file: str, part_size: int = 1000) -> DataFrame:
    """The files of each group as sorted lists of at most ``part_size``.

    A group's files are numbered from zero, so its parts depend on that group alone; numbers come from one range
    partitioning of all files, less where the group starts. A group of any size becomes many
    rows and no task holds more than a part of it. A null group is a group.
    """
    known = F.to_json(F.struct(F.col(group).alias("g")))  # null and empty differ
    indexed = with_row_index(df.select(group, file), [group, file], "_row").withColumn("_known", known)
    starts = stage(indexed.groupBy("_known").agg(F.min("_row").alias("_start")), "group-starts")
    parts = lookup_join(indexed, starts, "_known").withColumn("part", F.floor((F.col("_row") - F.col("_start")) / part_size))
    listed = parts.groupBy(group, "part").agg(F.array_sort(F.collect_list(file)).alias("files"))
    return listed.withColumn("n_files", F.size("files").cast("bigint"))


def shape_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shortest, longest and mean length of each array column, from one aggregate."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.count(c).alias("n"),
                F.min(F.size(c)).alias("min_len"),
                F.max(F.size(c)).alias("max_len"),
                F.avg(F.size(c)).alias("avg_len"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))
