"""Batches of documents of similar length: optimal length buckets, token-budget batches inside.

Lengths are rounded up to eight significant bits, so the global histogram has at most some
thousand points whatever the corpus; a dynamic programme over it picks the bucket bounds (points
of that grid) with the least padding. Inside a bucket every batch holds
``max(1, token_budget // bound)`` documents, so it fits the budget padded to the bound; a document
longer than the budget is a batch by itself. Nothing is cut or dropped.

Batches are cut from one running number a bucket. Documents are numbered in shards by hash, of
about ``SHARD_ROWS`` each, and a shard starts after the sum of those before it: no bucket is sorted
in one task, and only the last batch of a bucket can be short. Null and empty texts have length
0 and take one place of padding. Rows that repeat id and text are separate documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, keyed, plain_id

SHARD_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def rounded_up(length: Column) -> Column:
    """``length``, at least 1, up to the next number with eight significant bits."""
    length = F.greatest(length, F.lit(1).cast("bigint"))
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(length)) - 8, F.lit(0))).cast("bigint")
    return (F.ceil(length / step) * step).cast("bigint")


def best_bounds(points: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` of the ascending ``points``, the last among them, that minimise
    ``sum(count * (smallest chosen point >= its point))``."""
    if not points:
        return []
    size = np.asarray(points, float)
    upto = np.concatenate([[0.0], np.cumsum(np.asarray(counts, float))])
    n = len(size)
    best = size * upto[1:]  # one bucket over the first i + 1 points
    back = [np.full(n, -1)]
    totals = [best]
    for _ in range(1, min(buckets, n)):
        now, come = np.full(n, np.inf), np.full(n, -1)
        for i in range(1, n):
            cost = best[:i] + size[i] * (upto[i + 1] - upto[1 : i + 1])
            come[i] = int(np.argmin(cost))
            now[i] = cost[come[i]]
        back.append(come)
        totals.append(now)
        best = now
    k = int(np.argmin([t[-1] for t in totals]))
    out, i = [], n - 1
    while i >= 0:
        out.append(points[i])
        i = back[k][i]
        k -= 1
    return out[::-1]


def length_batches(
    docs: DataFrame, token_budget: int = 16_384, buckets: int = 16, length: Column | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(_id, _key, doc_id, n_tokens, bucket, bucket_length, batch_id, slot)``: one row a document.

    ``length`` is a long expression over ``docs`` (words of the text if not given). ``batch_id`` is
    ``bucket`` and the batch's number in it; ``slot`` the place in the batch.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    count = word_count(F.col(f"`{text_col}`").cast("string")) if length is None else length
    rows = keyed(docs, id_col, text_col, n_tokens=count).drop("text")
    rows = scratch.stage(rows.withColumn("point", rounded_up(F.col("n_tokens"))))
    histogram = sorted(map(tuple, rows.groupBy("point").count().collect()))  # bounded by the grid of points
    bounds = best_bounds([p for p, _ in histogram], [n for _, n in histogram], buckets)
    if not bounds:
        bounds, sizes = [1], [0]
    else:
        sizes = [sum(n for p, n in histogram if (p <= b) and all(p > c for c in bounds if c < b)) for b in bounds]

    of = lambda values, at: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), at + 1)
    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]), lambda b: b < F.col("point")))
    rows = rows.withColumn("bucket", bucket).withColumn("bucket_length", of(bounds, F.col("bucket")))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("_id", "_key"), of([-(-n // SHARD_ROWS) or 1 for n in sizes], F.col("bucket"))))
    starts = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("_id", "_key")) - 1
    rows = rows.withColumn("number", number).join(starts.hint("merge"), ["bucket", "shard"])
    place = F.col("number") + F.col("start")
    capacity = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(token_budget) / F.col("bucket_length")))
    return rows.select(
        "_id", "_key", plain_id(id_col), "n_tokens", "bucket", "bucket_length",
        F.concat_ws("-", "bucket", F.floor(place / capacity)).alias("batch_id"), (place % capacity).alias("slot"),
    )


def batch_texts(docs: DataFrame, batches: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(batch_id, bucket_length, ids, texts)`` in order of slots; a batch is bounded by its budget."""
    texts = keyed(docs, id_col, text_col).dropDuplicates(["_id", "_key"])
    rows = batches.select("batch_id", "bucket_length", "slot", "_id", "_key", F.col(id_col).alias("id")).join(texts, ["_id", "_key"])
    rows = rows.groupBy("batch_id", "bucket_length").agg(F.sort_array(F.collect_list(F.struct("slot", "id", "text"))).alias("items"))
    return rows.select("batch_id", "bucket_length", F.col("items.id").alias("ids"), F.col("items.text").alias("texts"))
