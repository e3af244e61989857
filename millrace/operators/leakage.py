"""Held-out documents that share passages with training documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.tokens import words
from millrace.session import stage
from millrace.sizing import lookup_join

PASSAGE_WORDS = 16
GRAM_WORDS = 8


_MASK = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15
#: Words that are hashed at once in a task; a longer text is one piece.
_PIECE = 1 << 18


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` items."""
    out = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for j in range(size):
        out *= np.uint64(_ODD)
        out += hashes[j : len(out) + j]
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(factor & _MASK)
    return out ^ (out >> np.uint64(32))


def _marked_runs(hashes: np.ndarray, counts: np.ndarray, passage: int, gram: int) -> tuple[np.ndarray, ...]:
    """``row, at, mark, first, hash``: for each run of neighbouring passages with one mark its text, place, mark and the
    index of its first hash; and the hash of each passage of all runs."""
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.flatnonzero(at + passage <= counts[row])
    grams = _rolled(hashes, gram)
    least = grams[: max(0, len(hashes) - passage + 1)].copy()
    for j in range(1, passage - gram + 1):
        np.minimum(least, grams[j : len(least) + j], out=least)
    mark, row = least[places], row[places]
    new = np.ones(len(places), dtype=bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], at[places][first], mark[first].view(np.int64), first, _rolled(hashes, passage)[places].view(np.int64)


def _marked(docs: DataFrame, ids: list[str], text: str, passage: int, gram: int, full: bool = True) -> DataFrame:
    """``ids, mark`` and, in the full form, ``_at, _hashes``: the mark of neighbouring passages, the least hash of the grams
    in each, with the place of the first and the hashes of all of them."""
    rows = docs.select(*ids, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_words")).where(F.size("_words") >= passage)

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(batch["_words"]).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[start:]), _PIECE)))
            part = batch.slice(start, n)
            hashes = part["_words"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            row, at, mark, first, found = _marked_runs(hashes, sizes[start : start + n].astype(np.int64), passage, gram)
            start += n
            columns = {c: part[c].take(pa.array(row)) for c in ids} | {"mark": pa.array(mark)}
            if full:
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(found)).astype(np.int32)), pa.array(found))
                columns |= {"_at": pa.array(at.astype(np.int64)), "_hashes": lists}
            yield pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from pieces(batch)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_words"]
    return rows.mapInArrow(run, ", ".join([*kinds, "mark bigint", *(["_at bigint", "_hashes array<bigint>"] if full else [])]))


def passage_leakage(
    train: DataFrame, test: DataFrame, key: str = "doc_id", text: str = "text", passage: int = PASSAGE_WORDS, gram: int = GRAM_WORDS
) -> DataFrame:
    """``key, n_passages, first_word``: held-out documents that share a passage with training documents.

    A passage is a run of ``passage`` words, whatever white space stands between them, so it is found across line ends
    and when it is wrapped anew. ``n_passages`` counts the places in the held-out text where one begins and
    ``first_word`` is the first of these, in words from zero. Texts with fewer words have no passage; null texts have no
    words; rows that repeat a key are one document each.

    Each passage is marked by the least of the hashes of its ``gram``-word runs (winnowing): neighbouring passages mostly
    have the same mark, and equal passages always do. First the different marks of both sides are joined, a few
    for each hundred words, and a license that a third of all documents hold is one row on each side. Only passages
    under a shared mark go on: those of the training side once each, to be looked up by mark and hash
    from the held-out side. A row is a run of passages with one mark and their hashes, so no document
    and no pair of documents is shuffled or copied.
    """
    if not 0 < gram <= passage:
        raise ValueError("a passage has at least one gram")
    held = test.select(F.col(key).alias("_key"), text).withColumn("_row", F.monotonically_increasing_id())
    held = stage(_marked(held, ["_row", "_key"], text, passage, gram), "held-passages")
    marks = lambda df: df.select("mark").distinct()
    learned = marks(_marked(train, [], text, passage, gram, full=False))
    shared = stage(lookup_join(learned, stage(marks(held), "held-marks"), "mark", "left_semi"), "shared-marks")

    def passages(df: DataFrame, *ids: str) -> DataFrame:
        kept = lookup_join(df, shared, "mark", "left_semi").select(*ids, "mark", "_at", F.posexplode("_hashes").alias("_i", "hash"))
        return kept.select(*ids, "mark", (F.col("_at") + F.col("_i")).alias("_at"), "hash")

    known = stage(passages(_marked(train, [], text, passage, gram)).select("mark", "hash").distinct(), "known-passages")
    found = lookup_join(passages(held, "_row", "_key"), known, ["mark", "hash"], "left_semi")
    sums = found.groupBy("_row", "_key").agg(F.count(F.lit(1)).alias("n_passages"), F.min("_at").cast("bigint").alias("first_word"))
    return sums.select(F.col("_key").alias(key), "n_passages", "first_word")
