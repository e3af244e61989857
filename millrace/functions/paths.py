"""File names, paths and addresses as column expressions."""

from __future__ import annotations

import fnmatch
import glob
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes and names a code corpus keeps by default.
DEFAULT_EXTENSIONS = [
    ".py", ".md", ".rst", ".go", ".yaml", ".yml", ".json", ".js", ".tsx", ".ts",
    ".sh", ".txt", ".proto",
]
DEFAULT_INCLUDE_FILES = ["Dockerfile"]
ROOT_URL = "https://github.com/"
METADATA_DIR = "metadata"


def url_path(url: Column) -> Column:
    """Host and path of an address, without scheme, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://", ""), r"[?#].*$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def top_component(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), 1)


def parent_dir(path: Column) -> Column:
    """Everything before the last slash; empty for a bare name."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def has_component(path: Column, word: str) -> Column:
    """True when one path component equals ``word`` (a longer name containing it does not count)."""
    return F.array_contains(F.split(path, "/"), word)


def ends_with_any(name: Column, suffixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [name.endswith(s) for s in suffixes], F.lit(False))


def repo_name(url: Column) -> Column:
    """The last piece of a repository address."""
    return F.element_at(F.split(url, "/"), -1)


def blob_url(url: Column, sha: Column, path: Column) -> Column:
    """Address of one file at one commit; ``path`` is relative to the repository."""
    return F.concat_ws("/", url, F.lit("blob"), sha, path)


def flatten_name(path: Column, root_url: str = ROOT_URL) -> Column:
    """One flat file name for a path: the root address is dropped, slashes become dashes."""
    return F.replace(F.replace(path, F.lit(root_url), F.lit("")), F.lit("/"), F.lit("-"))


def sidecar_name(name: Column) -> Column:
    """Swap the last suffix for ``.metadata.json``; a name without a suffix gets it appended.

    A leading dot or a trailing dot does not start a suffix.
    """
    has_suffix = name.rlike(r"(?s)^.+\.[^./]+$")
    return F.when(has_suffix, F.regexp_replace(name, r"\.[^./]+$", ".metadata.json")).otherwise(
        F.concat(name, F.lit(".metadata.json"))
    )


def file_extension(path: Column) -> Column:
    """Text after the last dot; a path without a dot comes back whole."""
    return F.element_at(F.split(path, r"\."), -1)


def globs_regex(globs: Sequence[str], across_dirs: bool = False) -> str:
    """Compile globs to one pattern, so a filter costs one match per row however many there are.

    By default ``*`` stays inside a path component and ``**`` crosses components. With
    ``across_dirs`` a star crosses slashes too, as in upload ignore lists.
    """
    if across_dirs:
        parts = [fnmatch.translate(g) for g in globs]
    else:
        parts = [glob.translate(g, recursive=True, include_hidden=True, seps="/") for g in globs]
    # Python's end-of-text anchor is spelled differently in Java.
    return "^(?:" + "|".join(re.sub(r"\\[Zz]$", r"\\z", p) for p in parts) + ")"


def matches_any_glob(path: Column, globs: Sequence[str], across_dirs: bool = False) -> Column:
    return path.rlike(globs_regex(globs, across_dirs)) if globs else F.lit(False)
