"""Near-duplicate vectors by int8 tile products with error bounds.

Vectors of one label and length are compared tile by tile. A tile product runs on unit vectors
rounded to ``scale * int8``; with rounding errors ``e`` (length of the difference) the true cosine
of ``u, v`` is within ``e_u * (1 + e_v) + e_v`` of the product. Only pairs whose upper bound
reaches the threshold are computed again from the given values in double precision.

Equal vectors are one class before any tile is made, and a tile returns its vectors' link counts
and one row to its local component root for each vector, never its pairs: a group of near copies
costs rows in proportion to its size. The number of tile products of a label grows with the
square of its distinct vectors (that is the method); each product is a task-sized unit.

Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label,
link with nothing. Rows that repeat an id are separate vectors with one id; null ids count as the
smallest id and stay null in the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, Scratch, components, local_roots, plain_id

TILE = 1536
STRIP = 256
# Far above the rounding of the float operations, far below what would add many pairs.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(int8 values, scale, error length)`` of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1))


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Yield ``(rows of x, rows of y)`` of the pairs with cosine ``threshold`` or more."""
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    (qx, sx, ex), (qy, sy, ey) = quantised(x / nx[:, None]), quantised(y / ny[:, None])
    right = qy.T.astype(np.float32)  # products of int8 values are exact in float32 up to 1,040 terms
    dims = x.shape[1]
    for lo in range(0, len(x), STRIP):
        hi = min(lo + STRIP, len(x))
        product = np.zeros((hi - lo, len(y)))
        for d in range(0, dims, 1024):
            product += qx[lo:hi, d : d + 1024].astype(np.float32) @ right[d : d + 1024]
        product *= sx[lo:hi, None] * sy[None, :]
        product += ex[lo:hi, None] * (1 + ey[None, :]) + ey[None, :] + SLACK
        i, j = np.nonzero(product >= threshold)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 65_536):
            a, b = i[at : at + 65_536], j[at : at + 65_536]
            near = (x[a] * y[b]).sum(axis=1) / (nx[a] * ny[b]) >= threshold
            yield a[near], b[near]


def _tile(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        *_, low, high = key
        first, second = rows[rows.tile == low], rows[rows.tile == high]
        x = np.stack(first.vector.to_numpy()).astype(np.float64) if len(first) else np.zeros((0, 1))
        y = np.stack(second.vector.to_numpy()).astype(np.float64) if len(second) else np.zeros((0, 1))
        same = low == high
        both = first if same else pd.concat([first, second])
        shift = 0 if same else len(first)
        links, pairs = np.zeros(len(both), np.int64), []
        weight = both.copies.to_numpy()
        if len(x) and len(y):
            for a, b in linked_pairs(x, y, threshold, same):
                b = b + shift
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                pairs.append((a, b))
        root = local_roots(len(both), pairs)
        some = links > 0
        node = both.node.to_numpy()
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[root[some]]})

    return run


def embedding_classes(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row a vector.

    ``n_links`` counts the other vectors linked directly, copies included; ``component_id`` is the
    smallest id reachable by links; ``kept`` marks the vectors that carry that id.
    """
    scratch = Scratch(vectors.sparkSession, "embedding")
    vector = F.col(f"`{vector_col}`")
    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = vectors.select(F.coalesce(ident, F.lit(NULL_ID)).alias("_id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector"))
    usable = F.exists("vector", lambda v: v != 0) & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & usable, F.lit(False))
    rows = scratch.stage(rows.select("_id", F.when(usable, F.xxhash64("label", F.size("vector"), "vector")).alias("node"), "label", "vector"))

    named = rows.where(F.col("node").isNotNull())
    copies = named.groupBy("node").agg(F.count("*").alias("copies"), F.min("_id").alias("low"))
    whole = named.select("node", "label", "vector", F.size("vector").alias("dims")).dropDuplicates(["node"]).join(copies.hint("merge"), "node")
    whole = scratch.stage(whole)
    sizes = whole.groupBy("label", "dims").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiled = whole.join(sizes.hint("merge"), ["label", "dims"]).withColumn("tile", F.pmod(F.xxhash64(F.col("node") + 1), "tiles"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    tiled = tiled.select("label", "dims", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "node", "copies", "vector")
    found = tiled.groupBy("label", "dims", "first", "second").applyInPandas(_tile(threshold), "node bigint, links bigint, root bigint")
    found = scratch.stage(found)

    roots = scratch.stage(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = copies.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = scratch.stage(classes)
    lowest = classes.groupBy("root").agg(F.min("low").alias("component"))
    classes = classes.join(lowest.hint("merge"), "root").select("node", "component", (F.coalesce("links", F.lit(0).cast("bigint")) + F.col("copies") - 1).alias("n_links"))
    full = scratch.stage(rows.select("_id", "node").join(classes.hint("merge"), "node", "left"))
    scratch.close(full)
    component = F.coalesce("component", "_id")
    return full.select(
        plain_id("vec_id"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(component != NULL_ID, component).alias("component_id"), (component == F.col("_id")).alias("kept"),
    )
