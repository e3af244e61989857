"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes (``h = 2h + gear[byte]`` in 32 bits, so it depends on the last 32
bytes); a chunk ends where its leading bits are zero, no sooner than ``LEAST`` bytes and no later
than ``MOST``, and never inside a character. Insertions move the chunks after them only up to the next
common cut. Chunks are compared by a 64-bit digest and their length, which stand for the bytes.

Of equal chunks the first stays: smallest id, then row key, then place. Any other is removed, however
short. With ``shortest``, off by default, runs of removable chunks of fewer bytes stay too. One exchange by digest finds the removable chunks; in each slice of documents
all but the first of equal chunks are known at once, so a chunk that a third of all documents
holds sends one row a slice to its digest's task.

Null and empty texts have no chunks. Rows that repeat id and text are one document and get the same
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, U, keyed, mix, plain_id, powers, signed, text_slices
from millrace.sizing import lookup_join

LEAST, MOST, BITS = 24, 512, 5
WINDOW = 32
SHORTEST = 0


def gear_table() -> np.ndarray:
    return (mix(np.arange(256).astype(U) + U(0x5EED)) >> U(32)).astype(np.uint32)


_GEAR = gear_table()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """The gear hash at every byte; over the last 32 bytes by doubling the span five times."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        more = h.copy()
        more[span:] += h[:-span] << np.uint32(span)
        h = more
        span *= 2
    return h


def cuts_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ends of all chunks, first chunk of each text)``."""
    n = len(data)
    can = gear_hash(data) >> np.uint32(32 - BITS) == 0
    fresh = np.append((data & 0xC0) != 0x80, True)
    ends = np.flatnonzero(can & fresh[1:]) + 1
    row = np.searchsorted(offs, ends, "left") - 1
    ends = ends[(ends - offs[row] >= WINDOW) & (ends < offs[row + 1])].tolist()
    out, first, k = [], [0], 0
    for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()):
        at = lo
        while at < hi:
            while k < len(ends) and ends[k] < at + LEAST:
                k += 1
            end = min(ends[k] if k < len(ends) else hi, hi, at + MOST)
            while end < hi and end > at + 1 and not fresh[end]:
                end -= 1
            out.append(end)
            at = end
        first.append(len(out))
    return np.asarray(out, np.int64), np.asarray(first, np.int64)


def digests_of(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, back = powers(len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=total[1:])
    starts = np.append(0, ends[:-1])
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(U) * U(0xC2B2AE3D27D4EB4F))


CHUNKS = "digest bigint, _id bigint, _key bigint, number int, known boolean"


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = (batch[c].to_numpy(zero_copy_only=False) for c in ("_id", "_key"))
        for lo, hi, data, offs in text_slices(batch["text"]):
            ends, first = cuts_of(data, offs)
            if not len(ends):
                continue
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            number = np.arange(len(ends)) - first[row]
            i, k, digest = ids[lo:hi][row], keys[lo:hi][row], digests_of(data, ends)
            order = np.lexsort((number, k, i, digest))
            digest = digest[order]
            known = np.zeros(len(order), bool)
            known[1:] = digest[1:] == digest[:-1]
            i, k, number = i[order], k[order], number[order]
            again = np.zeros(len(order), bool)  # the same chunk of a repeated row
            again[1:] = known[1:] & (i[1:] == i[:-1]) & (k[1:] == k[:-1]) & (number[1:] == number[:-1])
            cols = [signed(digest[~again]), pa.array(i[~again]), pa.array(k[~again]), pa.array(number[~again].astype(np.int32)), pa.array(known[~again])]
            yield pa.RecordBatch.from_arrays(cols, ["digest", "_id", "_key", "number", "known"])


REMOVABLE = "_id bigint, _key bigint, number int"


def _removable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by digest, id, key and number: all but the first of each digest, and the known ones."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        digest, i, k, number, known = (batch[c].to_numpy(zero_copy_only=False) for c in ("digest", "_id", "_key", "number", "known"))
        head = np.flatnonzero(~known)
        out = np.asarray(known, bool).copy()
        if len(head):
            d = digest[head]
            first = np.ones(len(head), bool)
            first[1:] = d[1:] != d[:-1]
            if last is not None and d[0] == last[0]:
                first[0] = False
            lead = np.maximum.accumulate(np.where(first, np.arange(len(head)), -1))
            own = [(i[head[x]], k[head[x]], number[head[x]]) if x >= 0 else last[1:] for x in lead[[-1]].tolist()]
            same = (lead >= 0) & (i[head] == i[head[lead]]) & (k[head] == k[head[lead]]) & (number[head] == number[head[lead]])
            if last is not None:
                same |= (lead < 0) & (i[head] == last[1]) & (k[head] == last[2]) & (number[head] == last[3])
            out[head] = ~first & ~same
            last = (d[-1], *own[0])
        yield pa.RecordBatch.from_arrays([batch["_id"].filter(pa.array(out)), batch["_key"].filter(pa.array(out)), batch["number"].filter(pa.array(out))], ["_id", "_key", "number"])


def kept_runs(sizes: np.ndarray, gone: np.ndarray, shortest: int) -> np.ndarray:
    """``gone`` without the runs of fewer than ``shortest`` bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    upto = np.append(0, np.cumsum(sizes))
    out = gone.copy()
    for a, b in zip(edge[::2], edge[1::2]):
        if upto[b] - upto[a] < shortest:
            out[a:b] = False
    return out


def _cleaned(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch["numbers"]
            for lo, hi, data, offs in text_slices(batch["text"]):
                ends, first = cuts_of(data, offs)
                sizes = np.diff(np.append(0, ends))
                out = []
                for r in range(hi - lo):
                    a, b = first[r], first[r + 1]
                    text = data[offs[r] : offs[r + 1]]
                    gone = np.zeros(b - a, bool)
                    gone[numbers[lo + r].as_py() or []] = True
                    gone = kept_runs(sizes[a:b], gone, shortest)
                    kept = text[~np.repeat(gone, sizes[a:b])] if gone.any() else text
                    spans = int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum())
                    out.append((len(text), int(b - a), len(text) - len(kept), spans, kept.tobytes()))
                cut = batch.slice(lo, hi - lo)
                cols = [cut["_id"], cut["_key"], *[pa.array([o[c] for o in out], pa.int64()) for c in range(4)], pa.array([o[4] for o in out], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["_id", "_key", "n_bytes", "n_chunks", "n_removed", "n_spans", "text"])

    return run


def substring_deduped(docs: DataFrame, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _key, doc_id, n_bytes, n_chunks, n_removed, n_spans, text)``: one row a document, ``text``
    without its removed chunks, ``n_removed`` their bytes and ``n_spans`` their runs."""
    scratch = Scratch(docs.sparkSession, "chunks")
    rows = keyed(docs, id_col, text_col)
    dealt = rows.mapInArrow(_chunk_rows, CHUNKS).withColumn("lead", F.when(F.col("known"), F.xxhash64("_key", "number")))
    dealt = dealt.repartition("digest", "lead").drop("lead").sortWithinPartitions("digest", "_id", "_key", "number")
    gone = dealt.mapInArrow(_removable, REMOVABLE).groupBy("_id", "_key").agg(F.collect_set("number").alias("numbers"))
    gone = scratch.stage(gone)
    out = lookup_join(rows, gone, ["_id", "_key"], "left").select("_id", "_key", "text", "numbers")
    schema = "_id bigint, _key bigint, n_bytes bigint, n_chunks bigint, n_removed bigint, n_spans bigint, text string"
    return out.mapInArrow(_cleaned(shortest), schema).select("_id", "_key", plain_id(id_col), "n_bytes", "n_chunks", "n_removed", "n_spans", "text")
