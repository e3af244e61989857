"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

A conversation is its turns in order (null first; equal turns by role and digest of the text). With
``heads`` it is rebuilt: the first ``h`` turns of another conversation, its head, then its own turns
after its first ``h``. Every different sequence of first ``d`` turns, compared by role and text, is a node of depth
``d`` below the textless root; the conversations that begin with it are its members. A node is named by
its smallest member and its depth.

*Prefixes.* A turn's digest depends on its place, and a prefix is the exclusive or of its turns' digests
(two of 64 bits). That is an associative sum, so a conversation of any length is cut into blocks of places
with one carried row a block. Texts stay where they are read; only digests and lengths are shuffled.

*Totals* (leaves below a node, code points saved by storing shared turns once) come from ``contraction``.

*Ends.* The members that end at a node are listed in rows of at most 4,096 ids by their upper bits, and the rows
of a node are read in order into one running hash, so no list is ever whole in memory.

Null roles and texts are empty; a null conversation id is one conversation, first in order, shown as null;
repeated turns are turns. A table without rows has no trie. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, Scratch
from millrace.llm.contraction import subtree_totals
from millrace.llm.ranks import numbered
from millrace.sizing import lookup_join

BLOCK = 4_096
_TURN = ["turn", "role", "digest"]


def ordered_turns(conversations: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(conv, pos, role, digest, size)`` of every turn, ``size`` in code points, and ``(conv, n)``."""
    col = lambda c: F.col(f"`{c}`")
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    turns = conversations.select(
        F.coalesce(col(conv).cast("bigint"), F.lit(NULL_ID)).alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit("")).alias("role"), F.md5(body).alias("digest"), F.length(body).alias("size"),
    )
    placed, sizes = numbered(turns, "conv", _TURN, scratch, ["role", "digest", "size"])
    return scratch.stage(placed.withColumnRenamed("_pos", "pos")), scratch.stage(sizes.withColumnRenamed("_n", "n"))


def rebuilt(turns: DataFrame, convs: DataFrame, head: Column, h: Column, longest: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The turns and sizes of the rebuilt conversations; ``head`` and ``h`` (at most ``longest``) are columns on ``conv``."""
    named = convs.select("conv", "n", head.alias("head"), h.cast("bigint").alias("h"))
    firsts = turns.where(F.col("pos") < longest).groupBy(F.col("conv").alias("head")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "digest", "size"))).alias("firsts")
    )
    joined = named.join(firsts, "head", "left").withColumn("firsts", F.slice(F.coalesce("firsts", F.array().cast(firsts.schema["firsts"].dataType)), 1, F.col("h").cast("int")))
    joined = scratch.stage(joined.withColumn("k", F.size("firsts").cast("bigint")))
    taken = joined.select("conv", F.inline("firsts"))
    shift = joined.where("n > h").select("conv", "h", "k")
    own = lookup_join(turns, shift, "conv").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("k")).select(*turns.columns)
    after = joined.select("conv", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return own.unionByName(taken), after


def prefixes(turns: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``(conv, depth, a, b, pa, pb, size)``: the digest of each prefix and of the one that is a turn shorter."""
    marks = {"a": F.xxhash64("pos", "role", "digest"), "b": F.xxhash64("digest", F.lit("|"), "role", "pos")}
    rows = turns.select("conv", "pos", "size", F.expr(f"pos div {block}").alias("block"), *[c.alias(f"m{k}") for k, c in marks.items()])
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    run = scratch.stage(rows.select("conv", "pos", "size", "block", "ma", "mb", *[F.bit_xor(f"m{k}").over(inside).alias(k) for k in marks]))
    whole = run.groupBy("conv", "block").agg(F.bit_xor("ma").alias("xa"), F.bit_xor("mb").alias("xb"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = whole.select("conv", "block", F.bit_xor("xa").over(before).alias("ca"), F.bit_xor("xb").over(before).alias("cb")).where("block > 0")
    if run.where("block > 0").isEmpty():
        summed = run
    else:
        both = lookup_join(run, scratch.stage(carry), ["conv", "block"], "left")
        summed = both.withColumns({k: F.col(k).bitwiseXOR(F.coalesce(F.col(f"c{k}"), F.lit(0))) for k in marks})
    parents = [F.col(k).bitwiseXOR(F.col(f"m{k}")).alias(f"p{k}") for k in marks]
    return summed.select("conv", (F.col("pos") + 1).alias("depth"), "a", "b", *parents, "size")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node from its id lists, which come in order; only the running hash is held."""
    node, running = None, None
    for batch in batches:
        done = []
        for key, chunk in zip(batch["id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = key, sha256()
            else:
                running.update(b",")
            running.update(chunk.encode())
        if done:
            yield _digests(done)
    if node is not None:
        yield _digests([(node, running.hexdigest())])


def _digests(done: list[tuple[dict, str]]) -> pa.RecordBatch:
    ids = pa.array([d[0] for d in done], pa.struct([("conv", pa.int64()), ("depth", pa.int64())]))
    return pa.RecordBatch.from_arrays([ids, pa.array([d[1] for d in done], pa.string())], ["id", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """``(id, ends_sha256)`` of ``(id, conv)``: the SHA-256 of each node's ids in order with commas between."""
    shown = F.transform("convs", lambda c: F.when(c == NULL_ID, F.lit("")).otherwise(c.cast("string")))
    lists = ends.groupBy("id", F.shiftright("conv", 12).alias("upper")).agg(F.array_sort(F.collect_list("conv")).alias("convs"))
    lists = lists.select("id", "upper", F.array_join(shown, ",").alias("ids"))
    return lists.repartition("id").sortWithinPartitions("id", "upper").select("id", "ids").mapInArrow(
        _hashed, "id struct<conv:bigint,depth:bigint>, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: one row a node.

    ``turns`` are ``(conv, pos, role, digest, size)`` with places from zero, ``convs`` all conversations ``(conv, n)``.
    """
    rows = prefixes(turns, scratch)
    zero = F.lit(0).cast("bigint")
    start = convs.select("conv", *[zero.alias(c) for c in ("depth", "a", "b", "pa", "pb")], F.lit(0).alias("size"))
    rows = scratch.stage(rows.unionByName(start).join(convs, "conv").withColumn("ends", F.col("n") == F.col("depth")).drop("n"))
    key = ["depth", "a", "b"]
    nodes = scratch.stage(rows.groupBy(*key).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("size").alias("size")
    ))
    ident = lambda conv, depth: F.struct(F.col(conv).alias("conv"), F.col(depth).alias("depth"))
    over = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("up"))
    linked = nodes.join(over, ["depth", "pa", "pb"], "left").withColumn("_above", F.col("depth") - 1)
    linked = scratch.stage(linked.select(
        ident("conv", "depth").alias("id"), F.when(F.col("up").isNotNull(), ident("up", "_above")).alias("parent"), "depth", "n_convs", *key[1:],
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    ))
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    known = linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", zero))
    known = scratch.stage(known.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint")))
    totals = subtree_totals(known.select("id", "parent", "depth", "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], scratch)
    last = lookup_join(rows.where("ends").select("conv", *key), known.select("depth", "a", "b", "id"), key).select("id", "conv")
    hashes = scratch.stage(_ends(last))
    out = known.drop("n_leaves", "saved_tokens").join(totals, "id").join(hashes, "id", "left")
    shown = lambda c: F.when(c != NULL_ID, c)
    return out.select(
        shown(F.col("id.conv")).alias("conv_id"), F.col("id.depth").alias("depth"), shown(F.col("parent.conv")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, head: Column | None = None, h: Column | None = None, longest: int = 0) -> DataFrame:
    """The trie of a table ``(conv_id, turn, role, text)``; ``head``, ``h`` and ``longest`` as for ``rebuilt``."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns, convs = ordered_turns(conversations, scratch)
    if head is not None:
        turns, convs = rebuilt(turns, convs, head, h, longest, scratch)
        turns, convs = scratch.stage(turns), scratch.stage(convs)
    return prefix_trie(turns, convs, scratch)
