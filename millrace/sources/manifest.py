"""Which files belong to a corpus: listing tables, filters and joins to their repositories."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import paths as P
from millrace.sizing import lookup_join


def drop_empty(df: DataFrame, size: Column | str) -> DataFrame:
    """Keep files with at least one byte (or character)."""
    return df.where((F.col(size) if isinstance(size, str) else size) > 0)


def filter_extensions(df: DataFrame, path: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """Keep files whose name ends with a listed suffix; a file matching two suffixes stays one row."""
    return df.where(P.ends_with_any(P.base_name(F.col(path)), extensions or P.DEFAULT_EXTENSIONS))


def include_over_exclude(
    df: DataFrame,
    path: str,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    exclude_globs: Sequence[str] | None = None,
) -> DataFrame:
    """Drop files by name or by glob unless their name is in ``include``, which never adds a file."""
    name = P.base_name(F.col(path))
    excluded = P.matches_any_glob(F.col(path), exclude_globs or [])
    if exclude:
        excluded = excluded | name.isin(list(exclude))
    return df.where(name.isin(list(include or P.DEFAULT_INCLUDE_FILES)) | ~excluded)


def exclude_globs(df: DataFrame, path: str, globs: Sequence[str], across_dirs: bool = False) -> DataFrame:
    return df.where(~P.matches_any_glob(F.col(path), globs, across_dirs))


def exclude_component(df: DataFrame, path: str, word: str = P.METADATA_DIR) -> DataFrame:
    return df.where(~P.has_component(F.col(path), word))


def with_repo_columns(df: DataFrame, url: str = "url", sha: str = "sha", path: str = "path") -> DataFrame:
    """Add ``repo_name`` and ``blob_url``."""
    return df.withColumns(
        {"repo_name": P.repo_name(F.col(url)), "blob_url": P.blob_url(F.col(url), F.col(sha), F.col(path))}
    )


def files_join_repos(files: DataFrame, repos: DataFrame, on: str = "repo_name") -> DataFrame:
    """Attach the address and commit of its repository to each file."""
    return lookup_join(files, repos, on, "inner")


def anti_exclusions(files: DataFrame, excluded: DataFrame, on: str = "path") -> DataFrame:
    """Drop the files listed in a table of exclusions."""
    return lookup_join(files, excluded.select(on), on, "left_anti")


def docs_join_metadata(docs: DataFrame, metadata: DataFrame, on: str | list[str]) -> DataFrame:
    """Pair documents with their sidecar record; both sides grow alike, so Spark picks the join."""
    return docs.join(metadata, on, "left")


def corpus_manifest(
    files: DataFrame,
    repos: DataFrame,
    extensions: Sequence[str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    globs: Sequence[str] | None = None,
    add_included: bool = False,
) -> DataFrame:
    """The corpus files of each repository, one row a path.

    ``files`` holds ``repo_name, path, size`` with paths relative to the repository, ``repos``
    holds ``repo_name, url, sha``. ``add_included`` also admits files whose name is in
    ``include`` though no suffix matches. Every filter runs before the join.
    """
    name = P.base_name(F.col("path"))
    wanted = P.ends_with_any(name, extensions or P.DEFAULT_EXTENSIONS)
    if add_included:
        wanted = wanted | name.isin(list(include or P.DEFAULT_INCLUDE_FILES))
    kept = include_over_exclude(drop_empty(files, "size").where(wanted), "path", include, exclude, globs)
    listed = files_join_repos(kept.select("repo_name", "path").distinct(), repos)
    return listed.select(
        "repo_name", "path", P.blob_url(F.col("url"), F.col("sha"), F.col("path")).alias("blob_url")
    )


def file_inventory(df: DataFrame, path: str = "path") -> DataFrame:
    """Every file with its parent directory as the group; a path ending in a slash is a directory."""
    return df.where(~F.col(path).endswith("/")).select(P.parent_dir(F.col(path)).alias("repo"), F.col(path).alias("file"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Concatenate sources, duplicates kept."""
    return reduce(DataFrame.unionByName, sources)


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
