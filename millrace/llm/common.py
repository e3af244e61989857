"""Row keys, staged tables with an owner, connected components and byte-level numpy helpers.

Documents are told apart by ``(_id, _key)``: the id (nulls as the smallest long) and a 64-bit hash
of id and text. Two rows with the same id and the same text are one document in every operator.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_path
from millrace.sizing import lookup_join

NULL_ID = -(2**63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """``(_id, _key, text)`` of ``docs`` and the columns of ``more``; other columns and their names play no part."""
    ident, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.coalesce(ident, F.lit(NULL_ID)).alias("_id"), F.xxhash64(ident, text).alias("_key"), text.alias("text"),
        *[c.alias(name) for name, c in more.items()],
    )


def plain_id(name: str = "doc_id") -> Column:
    """The id as it was given, from ``_id``."""
    return F.when(F.col("_id") != NULL_ID, F.col("_id")).alias(name)


def _table_name(path: str) -> str:
    return "staged_" + path.rsplit("-", 1)[1]


class Scratch:
    """Tables staged in the shared folder, removed one by one with ``drop`` or all at ``close``.

    What a returned DataFrame still reads has to stay; give it to ``keep`` or leave ``close`` out.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def stage(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, self.label)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def stage_by(self, df: DataFrame, key: str) -> DataFrame:
        """The same, dealt and sorted by ``key``: joins on it move only their other side."""
        path = new_path(self.spark, self.label)
        name, n = _table_name(path), int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        files = df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", "zstd")
        files.option("path", path).format("parquet").saveAsTable(name)
        out = self.spark.table(name)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            folder = self.paths.pop(id(t))[1]
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder)}")  # those of stage_by have an entry in the catalog
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self, *but: DataFrame) -> None:
        kept = {id(t) for t in but}
        self.drop(*[t for k, (t, _) in list(self.paths.items()) if k not in kept])


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``links (a, b)``; root is the smallest node.

    Alternates the large-star and small-star steps until every node but the roots has one edge, to
    its root. Each step is a minimum with map-side combine joined back to the edges, so a node
    with a third of all links sends one row a task to the aggregate, and adaptive execution may
    split it in the join.
    """
    edges = scratch.stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.stage(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(low.hint("merge"), "a")
        small = star.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(star.select("a", F.col("m").alias("b")))
        after = scratch.stage(small.where("a <> b").distinct())
        scratch.drop(edges, large)
        edges = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("a").alias("node"), one.alias("up"), none.alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), none.alias("up"), one.alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or up > 0 and down > 0").isEmpty()


def named_by(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with ``a_root`` and ``b_root``; who is no node of ``roots`` is its own root."""
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        pairs = lookup_join(pairs, named, side, "left").withColumn(f"{side}_root", F.coalesce(f"{side}_root", side))
    return pairs


def stars(forest: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node but the roots of ``forest (a, b)``, where each ``b`` is there once
    and hangs from its ``a``. Pointer doubling: a lookup a round, as many rounds as the depth has bits."""
    out = scratch.stage(forest.select(F.col("b").alias("node"), F.col("a").alias("root"), F.lit(True).alias("deep")))
    while not out.where("deep").isEmpty():
        up = out.select(F.col("node").alias("root"), F.col("root").alias("above"))
        higher = lookup_join(out.select("node", "root"), up, "root", "left")
        after = scratch.stage(higher.select("node", F.coalesce("above", "root").alias("root"), F.expr("above is not null").alias("deep")))
        scratch.drop(out)
        out = after
    return out.select("node", "root")


def merged_stars(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``roots (node, root)``, stars, after ``links (a, b)`` of their nodes or of others are added.

    Only the graph of the roots is looked at: each takes its smallest neighbour, which makes trees but for
    two that take each other, the trees become single nodes, and so on until no link is left. Every
    node with a link finds another, so their number is at least halved each round. A node with a
    third of all links sends one row a task to the minimum. The root is one of the component's
    nodes, any of them.
    """
    moved, pairs = None, named_by(links.select("a", "b"), roots)
    while True:
        edges = scratch.stage(pairs.where("a_root <> b_root").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.stage(both.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("a")))
        back = least.select(F.col("b").alias("a"), F.col("a").alias("back"))
        found = stars(lookup_join(least, back, "a").where("a < b or back <> b").select("a", "b"), scratch)
        moved = found if moved is None else scratch.stage(_moved(moved, found))
        pairs = named_by(edges, found)
    return roots if moved is None else scratch.stage(_moved(roots, moved))


def _moved(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` whose roots hang from others in ``found``, and those."""
    up = found.select(F.col("node").alias("root"), F.col("root").alias("above"))
    after = lookup_join(roots, up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return after.unionByName(found)


def local_roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest of ``n`` nodes that each is connected to by the pairs."""
    root = np.arange(n)
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, int)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, int)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


# ---- bytes and words in numpy ---------------------------------------------------------------

SPACES = [0x20, *range(0x09, 0x0E)]
SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
# Sums of powers modulo 2**64 of longer runs may agree whatever the base; longer words are folded.
_FOLD = 512
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows with about ``limit`` bytes at most.

    Nulls are empty; a single longer text is a slice of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(data: np.ndarray, offs: np.ndarray, spaces: list[int] = SPACES, lower: bool = True):
    """``(hash, row, start, end)`` of every word; words are runs of other bytes than ``spaces``."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z.astype(U), z, z, z
    if lower:
        data = _LOWER[data]
    table = np.ones(256, bool)
    table[spaces] = False
    inside = table[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offs[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]  # a word never runs on into the next text
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    end = np.flatnonzero(last) + 1
    power, back = powers(n)
    total = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:n], out=total[1:])
    stop = np.minimum(end, start + _FOLD)
    h = mix((total[stop] - total[start]) * back[start] + (end - start).astype(U))
    at = np.flatnonzero(end - start > _FOLD)
    while len(at):
        begin = stop[at]
        stop[at] = np.minimum(end[at], begin + _FOLD)
        h[at] = mix(h[at] * U(_BASE) + mix((total[stop[at]] - total[begin]) * back[begin] + U(1)))
        at = at[stop[at] < end[at]]
    return h, np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs))), start, end


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(_BASE, -1, 2**64)
        one = np.ones(1, U)
        _POWERS[:] = [
            np.concatenate([one, np.cumprod(np.full(size - 1, b, U))]) for b in (_BASE, inverse)
        ]
    return _POWERS[0], _POWERS[1]


def per_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets ``(n + 1)`` of the runs of equal, ascending ``rows``."""
    return np.searchsorted(rows, np.arange(n + 1))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
