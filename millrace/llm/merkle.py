"""Merkle manifest of a table: a tree a group, one over their roots, and a proof for every row.

``H`` is SHA-256 as lower-case hex of its inputs put together. A leaf is ``H`` of the row's fields,
each ``-`` if null, else its UTF-8 length, ``:`` and the value as text. The leaves of a group are in
order of ``order``; while several nodes remain, every ``arity`` consecutive ones become their ``H``
(the last run may be shorter, even one node). The roots of the groups, null first and then
bytewise, make the top tree in the same way.

*Trees.* Leaves are numbered by ranges, and blocks of about a thousand consecutive nodes are folded a
block a row, so billions of leaves take four passes, each a thousandth of the one before.

*Proofs* by pointer jumping: a node first holds its own siblings, the segment to its parent. In
each round a node at distance ``2**r`` from its pointer's end joins the node there and takes over its
segment, which doubles the distance. Only levels that are multiples of ``2**r`` are asked again, so
the inner side shrinks to its square in every round, and leaves join it once a round until
the segment ends at the root. A side that has become small is measured and broadcast.

Rows with equal fields are leaves of their own, next to each other. A null in any field has its own
code, null groups are a group, empty texts have length zero; an empty table has no rows
and no root. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.llm.ranks import numbered
from millrace.sizing import BROADCAST_BYTES, lookup_join

BLOCK = 1_024
_SEGMENT = "array<struct<before:binary,after:binary>>"


def encoded(field: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value as text."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to by its siblings."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(_hex(s["before"]), acc, _hex(s["after"])), 256))


def sibling_text(proof: Column) -> Column:
    """All siblings, level by level and left to right, as hex text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(_hex(s["before"]), _hex(s["after"]))), "")


def _depth(size: Column, arity: int) -> Column:
    """Levels above the leaves: the least ``d`` with ``arity ** d >= size``."""
    powers, p = [], 1
    while p < 2**62:
        powers.append(p)
        p *= arity
    return F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in powers]), lambda x: x < size))


def _levels(arity: int) -> int:
    """Levels folded in one row."""
    n = 1
    while arity ** (n + 1) <= BLOCK:
        n += 1
    return n


def _folder(arity: int, steps: int) -> Callable:
    """Arrow step that adds to a block's nodes, ``v0``, the levels above them as lists ``v1`` and on; null above the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [[] for _ in range(steps)]
            for nodes, level, depth in zip(batch["v0"].to_pylist(), batch["level"].to_pylist(), batch["depth"].to_pylist(), strict=True):
                here = [d.hex() for d in nodes]
                for k in range(steps):
                    if level + k >= depth:
                        made[k].append(None)
                        continue
                    above = [sha256("".join(here[i : i + arity]).encode()) for i in range(0, len(here), arity)]
                    here = [h.hexdigest() for h in above]
                    made[k].append([h.digest() for h in above])
            lists = [pa.array(m, pa.list_(pa.binary())) for m in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, *[f"v{k + 1}" for k in range(steps)]])

    return run


def _blocks(nodes: DataFrame, arity: int, payload: Sequence[str]) -> DataFrame:
    """One row for about ``BLOCK`` nodes ``(tree, depth, level, _pos, digest)`` with the levels above them, ``v0`` being the nodes."""
    steps = _levels(arity)
    rows = nodes.groupBy("tree", "depth", "level", F.expr(f"_pos div {arity**steps}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "digest", *payload))).alias("rows")
    )
    rows = rows.withColumn("v0", F.col("rows.digest")).withColumn("rows", F.transform("rows", lambda r: r.dropFields("digest")))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(_folder(arity, steps), ", ".join([*types, *[f"v{k + 1} array<binary>" for k in range(steps)]]))


def _siblings(values: Column, i: Column, arity: int) -> Column:
    """What stands before and after node ``i`` in its run, each as one string of digests."""
    start = i - i % arity
    joined = lambda a: F.aggregate(a, F.lit(b""), lambda x, y: F.concat(x, y))
    return F.struct(
        joined(F.slice(values, start + 1, i % arity)).alias("before"),
        joined(F.slice(values, i + 2, arity - 1 - i % arity)).alias("after"),
    )


def _segments(blocks: DataFrame, levels: range, arity: int, payload: Sequence[str]) -> DataFrame:
    """``(tree, level, _pos, segment)`` of the nodes ``levels`` above the blocks' own, and the payload of leaves."""

    def entries(k: int) -> Column:
        nodes, width = F.col("rows") if payload else F.col(f"v{k}"), arity ** (_levels(arity) - k)
        entry = lambda x, i: F.struct(
            (F.col("level") + k).alias("level"), (F.col("block") * width + i).alias("_pos"),
            F.array(_siblings(F.col(f"v{k}"), i, arity)).alias("segment"), *[x[c].alias(c) for c in payload],
        )
        # With the root reached there is no step left to take.
        made = F.transform(nodes, entry)
        return F.coalesce(F.when(F.col("level") + k < F.col("depth"), made), F.slice(F.transform(F.col("rows" if payload else "v0"), entry), 1, 0))

    rows = blocks.select("tree", F.explode(F.concat(*[entries(k) for k in levels])).alias("item"))
    return rows.select("tree", "item.*")


def _jump(rows: DataFrame, inner: DataFrame, distance: int, arity: int) -> DataFrame:
    """Append to each segment that of the node ``distance`` levels up; a segment that ends at the root stays."""
    ends = inner.select("tree", (F.col("level") - distance).alias("level"), F.col("_pos").alias("_up"), F.col("segment").alias("_more"))
    size = F.octet_length("tree") + 48 + F.size("_more") * 32 * (arity + 1)
    small = (ends.agg(F.sum(size).alias("b")).first()["b"] or 0) <= BROADCAST_BYTES
    at = rows.withColumn("_up", F.expr(f"_pos div {arity**distance}L") if arity**distance < 2**63 else F.lit(0).cast("bigint"))
    joined = at.join(F.broadcast(ends) if small else ends.hint("merge"), ["tree", "level", "_up"], "left")
    more = F.coalesce(F.col("_more"), F.array().cast(_SEGMENT))
    return joined.select(*[c for c in rows.columns if c != "segment"], F.concat("segment", more).alias("segment"))


def merkle_trees(leaves: DataFrame, tree: str, order: Sequence[str], payload: Sequence[str], scratch: Scratch, arity: int = 2) -> tuple[DataFrame, DataFrame]:
    """Roots ``(tree, root)`` and proofs ``(tree, *payload, segment)`` of ``leaves``.

    ``leaves`` have a binary ``digest`` and a ``tree`` that is not null; ``payload`` (one column at least) is handed
    through, ``order`` sorts the leaves of a tree.
    """
    ranked, sizes = numbered(leaves, tree, order, scratch, ["digest", *payload])
    sizes = scratch.stage(sizes.select(F.col(tree).alias("tree"), _depth(F.col("_n"), arity).alias("depth")))
    nodes = lookup_join(ranked.withColumnRenamed(tree, "tree"), sizes, "tree").withColumn("level", F.lit(0))
    highest, steps = sizes.agg(F.max("depth")).first()[0] or 0, _levels(arity)
    base, inner, roots = None, [], []
    for bottom in range(0, highest + 1, steps):
        blocks = scratch.stage(_blocks(nodes, arity, payload if base is None else []))
        base = blocks if base is None else base
        inner.append(_segments(blocks, range(0 if bottom else 1, steps), arity, []))
        top = F.get(F.array(*[F.col(f"v{k}") for k in range(steps + 1)]), F.col("depth") - F.col("level"))
        roots.append(blocks.where(F.col("depth") <= F.col("level") + steps).select("tree", F.get(top, F.lit(0)).alias("root")))
        going = blocks.where(F.col("level") + steps < F.col("depth"))
        nodes = going.select("tree", "depth", (F.col("level") + steps).alias("level"), F.col("block").alias("_pos"), F.get(F.col(f"v{steps}"), F.lit(0)).alias("digest"))
    held = scratch.stage(reduce(DataFrame.unionByName, inner))
    # A lone leaf is its tree's root and has an empty proof.
    alone = base.where("depth = 0").select("tree", F.inline("rows")).select("tree", *payload, F.array().cast(_SEGMENT).alias("segment"))
    proofs, distance = _segments(base, range(1), arity, payload), 1
    while distance < highest:
        asked = held.where(F.col("level") % (2 * distance) == distance)
        proofs = _jump(proofs, asked.where(F.col("level") == distance), distance, arity)
        held = scratch.stage(_jump(held.where((F.col("level") > 0) & (F.col("level") % (2 * distance) == 0)), asked, distance, arity))
        distance *= 2
    return scratch.stage(reduce(DataFrame.unionByName, roots)), proofs.select("tree", *payload, "segment").unionByName(alone)


def merkle_manifest(
    docs: DataFrame, fields: Sequence[str], group: str, order: str, arity: int = 2, claims: Sequence[Column] | None = None
) -> DataFrame:
    """``(order, group, leaf, claim, subroot, root, proof)``: one row a row of ``docs``.

    ``proof`` has for each level, from the leaf to the root over all groups, the digests ``before`` and
    ``after`` the node in its run; ``folded(leaf, proof)`` gives back the root. ``claims`` are
    fields as somebody else holds them; ``claim`` is their leaf, to be proven or refuted.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    scratch = Scratch(docs.sparkSession, "merkle")
    col = lambda c: F.col(f"`{c}`")
    leaf = leaf_hash([col(f) for f in fields])
    claimed = leaf_hash(claims) if claims else leaf
    held = docs.select(
        F.coalesce(F.concat(F.lit("="), col(group).cast("string")), F.lit("")).alias("tree"),
        col(order).alias("ident"), F.unhex(leaf).alias("digest"), F.unhex(claimed).alias("claim"),
    )
    held = scratch.stage(held.withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim"))).withColumn("own", F.col("digest")))
    subroots, proofs = merkle_trees(held, "tree", ["ident", "digest"], ["ident", "own", "claim"], scratch, arity)
    over = subroots.select(F.lit("").alias("all"), F.col("root").alias("digest"), "tree", F.col("root").alias("subroot"))
    over = over.withColumnRenamed("tree", "name")
    root, above = merkle_trees(over, "all", ["name"], ["name", "subroot"], scratch, arity)
    top = root.first()
    above = scratch.stage(above.select(F.col("name").alias("tree"), "subroot", F.lit(top and bytes(top["root"])).cast("binary").alias("root"), F.col("segment").alias("upper")))
    whole = lookup_join(proofs, above, "tree")
    return whole.select(
        F.col("ident").alias(order), F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(group),
        _hex(F.col("own")).alias("leaf"), _hex(F.coalesce("claim", "own")).alias("claim"),
        _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), F.concat("segment", "upper").alias("proof"),
    )
