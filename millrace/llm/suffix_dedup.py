"""Removal of every byte that lies in a repeated string of ``LENGTH`` bytes, by interleave refinement.

**Which suffixes can repeat.** Every string of ``LENGTH`` bytes has a key: the least hash of the
``GRAM``-byte strings in it. Equal strings have equal keys, and neighbouring strings mostly share
one, so a document is a row of *runs*, each some dozens of starts with one key. A run whose key
occurs nowhere else holds no repeat. That leaves a fraction of the text; the rest never moves.

**Refinement.** The runs of a key, with the bytes they need, meet in one task. Suffixes are read in
symbols of ``STEP`` bytes. All suffixes of a task form one interleave, sorted by one symbol at first;
each round steps to the suffixes one symbol earlier and sorts them stably by symbol, which is the
interleave by one symbol more. Suffixes left alone in their block are settled and drop out; after
``LENGTH / STEP`` rounds the blocks are the repeated intervals. No two suffixes are ever compared. No
shard has a transform of its own and none are merged: the dealt method is not kept whole, see the README.
Symbols are 64-bit hashes of their bytes (their order is any fixed one, blocks only need equality).

**Skew.** Equal runs are counted and sent once a slice of documents, and equal runs of a key collapse
before that: copies cost nothing. Keys with more than ``HOT`` different runs (the edges
of a passage that many documents share) are dealt by single strings with map-side
combine instead.

Null and empty texts have no bytes. Rows that repeat id and text are two places, and return the
same. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, U, keyed, mix, plain_id, powers, signed, text_slices
from millrace.sizing import lookup_join

LENGTH = 200
GRAM = 32
STEP = 40
LONGEST_RUN = 2_048
FLUSH_BYTES = 1 << 21
HOT = 4_096


def hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from every place that has so many."""
    n = len(data)
    if n < width:
        return np.zeros(0, U)
    power, back = powers(n)
    total = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * back[: n - width + 1])


def sliding(h: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or with ``pick`` the greatest) of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        h = pick(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return pick(h[:-rest], h[rest:]) if rest else h


GRAMS = LENGTH - GRAM + 1  # in a string


def runs_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(key, row, first start, starts, twice)`` of all runs, starts counted within their text.

    ``twice`` marks the runs whose key may occur at two places inside, so that they may repeat themselves.
    """
    none = np.zeros(0, np.int64)
    count = np.maximum(np.diff(offs) - LENGTH + 1, 0)
    if not count.any():
        return none.astype(U), none, none, none, none.astype(bool)
    h = hashes(data, GRAM)
    row = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(count) - count
    place = np.arange(len(row)) - before[row]
    key = sliding(h, GRAMS)[offs[row] + place]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    if count.max() > LONGEST_RUN:
        new |= place % LONGEST_RUN == 0
    at = np.flatnonzero(new)

    # A gram stands for some string if it is as small as the greatest key of the strings that hold it.
    pad = GRAMS - 1
    spread = np.zeros(len(key) + pad * (len(count) + 1), U)
    spread[np.arange(len(key)) + pad * (row + 1)] = key
    most = sliding(spread, GRAMS, np.maximum)
    grams = np.where(count > 0, count + pad, 0)
    of = np.repeat(np.arange(len(count)), grams)
    gram = np.arange(len(of)) - np.repeat(np.cumsum(grams) - grams, grams)
    mine = h[offs[of] + gram]
    stands = np.flatnonzero(mine == most[before[of] + pad * of + gram])
    p, q = stands[:-1], stands[1:]
    again = (mine[p] == mine[q]) & (of[p] == of[q]) & (gram[q] - gram[p] <= GRAMS)
    p, q = p[again], q[again]
    run = np.cumsum(new) - 1
    twice = np.zeros(len(at), bool)
    twice[run[before[of[p]] + np.minimum(gram[p], count[of[p]] - 1)]] = True
    twice[run[before[of[q]] + np.maximum(gram[q] - pad, 0)]] = True
    return key[at], row[at], place[at], np.diff(np.append(at, len(key))), twice


RUNS = "key bigint, _id bigint, _key bigint, at int, starts int, known boolean"


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs; those that share a key within a slice, or hold it twice, are known; one mark (``at`` -1)
    stands for them."""
    for batch in batches:
        ids, keys = (batch[c].to_numpy(zero_copy_only=False) for c in ("_id", "_key"))
        for lo, hi, data, offs in text_slices(batch["text"]):
            key, row, at, starts, twice = runs_of(data, offs)
            if not len(key):
                continue
            order = np.argsort(key, kind="stable")
            key, row, at, starts = key[order], row[order], at[order], starts[order]
            new = np.append(True, key[1:] != key[:-1])
            group = np.cumsum(new) - 1
            known = ((np.bincount(group) > 1) | (np.bincount(group, twice[order]) > 0))[group]
            mark = known & new
            m = int(mark.sum())
            cols = [
                signed(np.append(key, key[mark])), pa.array(np.append(ids[lo:hi][row], np.zeros(m, np.int64))),
                pa.array(np.append(keys[lo:hi][row], np.zeros(m, np.int64))), pa.array(np.append(at, np.full(m, -1)).astype(np.int32)),
                pa.array(np.append(starts, np.zeros(m, np.int64)).astype(np.int32)), pa.array(np.append(known, np.zeros(m, bool))),
            ]
            yield pa.RecordBatch.from_arrays(cols, ["key", "_id", "_key", "at", "starts", "known"])


def _repeated_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: known runs, and runs of keys with another run or a mark."""
    last, sure, waiting = None, False, None
    names = ["_id", "_key", "at", "starts"]
    for batch in batches:
        if not batch.num_rows:
            continue
        known = np.asarray(batch["known"].to_numpy(zero_copy_only=False), bool)
        key, at = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "at"))
        head = np.flatnonzero(~known)
        out = known.copy()
        extra = None
        if len(head):
            k = key[head]
            new = np.append(True, k[1:] != k[:-1])
            group = np.cumsum(new) - 1
            some = (np.bincount(group) > 1) | (np.bincount(group, at[head] < 0) > 0)
            if k[0] == last:
                some[0] = True
                extra, waiting = waiting, None
            out[head] = some[group] & (at[head] >= 0)
            if k[-1] != last or not sure:
                sure = bool(some[-1])
                waiting = None if sure else batch.slice(int(head[-1]), 1)
            last = k[-1]
        pick = batch.filter(pa.array(out))
        yield pa.RecordBatch.from_arrays([pick[c] for c in names], names)
        if extra is not None:
            yield pa.RecordBatch.from_arrays([extra[c] for c in names], names)


CONTEXTS = "key bigint, digest bigint, _id bigint, _key bigint, at int, times int, bytes binary"


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every repeated run; of equal ones in a slice the first has the bytes and how many there are."""
    for batch in batches:
        runs = batch["runs"]
        ids, keys = (batch[c].to_numpy(zero_copy_only=False) for c in ("_id", "_key"))
        for lo, hi, data, offs in text_slices(batch["text"]):
            lists = runs.slice(lo, hi - lo)
            flat = lists.flatten()
            at, starts = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "starts"))
            row = np.repeat(np.arange(hi - lo), np.asarray(pa.compute.list_value_length(lists)))
            least = hashes(data, GRAM)
            power, back = powers(len(data))
            total = np.zeros(len(data) + 1, U)
            np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=total[1:])
            begin = offs[row] + at
            size = starts + LENGTH - 1
            digest = mix((total[begin + size] - total[begin]) * back[begin] + size.astype(U) * U(0xC2B2AE3D27D4EB4F))
            key = np.array([least[b : b + LENGTH - GRAM + 1].min() for b in begin.tolist()], U)
            order = np.lexsort((digest, key))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (digest[order][1:] != digest[order][:-1])
            times = np.zeros(len(order), np.int32)
            times[order[new]] = np.diff(np.append(np.flatnonzero(new), len(order)))
            raw = data.tobytes()
            body = [raw[b : b + s] if t else None for b, s, t in zip(begin.tolist(), size.tolist(), times.tolist())]
            cols = [signed(key), signed(digest), pa.array(ids[lo:hi][row]), pa.array(keys[lo:hi][row]), pa.array(at.astype(np.int32)), pa.array(times), pa.array(body, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "digest", "_id", "_key", "at", "times", "bytes"])


# ---- Interleave refinement over symbols of STEP bytes ----------------------------------------

ROUNDS = LENGTH // STEP


def _repeated_in(order: np.ndarray, *parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(suffixes, block)``: the suffixes of an interleave that share all ``parts`` with a neighbour."""
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in parts])
    alone = new & np.append(new[1:], True)
    return order[~alone], (np.cumsum(new) - 1)[~alone]


def repeated_starts(strings: list[bytes]) -> list[np.ndarray]:
    """For each string, which of its starts open ``LENGTH`` bytes that open elsewhere in ``strings`` too.

    The interleave holds the suffixes of all strings, sorted by as many symbols as rounds are done; a
    round takes the symbol before each in its order and sorts the entries stably.
    A suffix alone in its block is settled and leaves, and so do those it precedes.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(strings), np.uint8)
    place = np.arange(len(data)) - np.repeat(base[:-1], sizes)
    symbol = hashes(data, STEP)
    order = np.flatnonzero(place + STEP <= np.repeat(sizes, sizes))
    order = order[np.argsort(symbol[order])]
    order, block = _repeated_in(order, symbol[order])
    for _ in range(ROUNDS - 1):
        led = place[order] >= STEP
        before, block = order[led] - STEP, block[led]
        sort = np.argsort(symbol[before], kind="stable")
        before, block = before[sort], block[sort]
        order, block = _repeated_in(before, symbol[before], block)
    hit = np.zeros(len(data), bool)
    hit[order] = True
    return [hit[o : o + max(m - LENGTH + 1, 0)] for o, m in zip(base.tolist(), sizes.tolist())]


COVERED = "key bigint, digest bigint, since array<int>, until array<int>"


def _spans(hit: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


def _classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of contexts sorted by key and digest: the repeated starts of every one that has some."""
    held, size, group, out = [], 0, [], []

    def close(group):
        """A key whose contexts are all equal is repeated as a whole; others wait for a merge."""
        nonlocal size
        if len(group) == 1 and group[0][2] > 1:
            key, digest, _, body = group[0]
            out.append((key, digest, [0], [len(body) - LENGTH + 1]))
            return
        held.extend(group)
        size += sum(len(g[3]) for g in group)

    def flush():
        nonlocal size
        hits = repeated_starts([g[3] for g in held])
        for (key, digest, times, body), hit in zip(held, hits):
            since, until = ([0], [len(hit)]) if times > 1 else _spans(hit)
            if since:
                out.append((key, digest, since, until))
        held.clear()
        size = 0

    def rows():
        names = ["key", "digest", "since", "until"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        batch = pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], types[c]) for c in range(4)], names)
        out.clear()
        return batch

    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("key", "digest", "times", "bytes"))):
            if group and group[0][0] != row[0]:
                close(group)
                group = []
                if size >= FLUSH_BYTES:
                    flush()
            if group and group[-1][1] == row[1]:
                group[-1] = (*row[:2], group[-1][2] + row[2], row[3])
            else:
                group.append(row)
        if out:
            yield rows()
    if group:
        close(group)
    if held:
        flush()
    if out:
        yield rows()


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(hash, key, digest, start)`` of every string of the contexts."""
    for batch in batches:
        keys, digests = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "digest"))
        for i, body in enumerate(batch["bytes"].to_pylist()):
            h = hashes(np.frombuffer(body, np.uint8), LENGTH)
            n = len(h)
            cols = [signed(h), pa.array(np.full(n, keys[i])), pa.array(np.full(n, digests[i])), pa.array(np.arange(n, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["hash", "key", "digest", "start"])


def _hot_covered(contexts: DataFrame) -> DataFrame:
    """The same result as ``_classified`` for keys with many contexts, dealt by single strings."""
    times = contexts.groupBy("key", "digest").agg(F.sum("times").alias("times"))
    several = times.where("times > 1").select("key", "digest")
    strings = contexts.dropDuplicates(["key", "digest"]).mapInArrow(_single_strings, "hash bigint, key bigint, digest bigint, start int")
    twice = strings.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    single = strings.join(twice.hint("merge"), "hash").groupBy("key", "digest").agg(F.collect_set("start").alias("since"))
    single = single.select("key", "digest", "since", F.transform("since", lambda s: s + 1).alias("until"))
    bodies = contexts.select("key", "digest", F.octet_length("bytes").alias("size")).distinct()
    whole = bodies.join(several.hint("merge"), ["key", "digest"]).select(
        "key", "digest", F.array(F.lit(0)).alias("since"), F.array(F.col("size") - (LENGTH - 1)).alias("until")
    )
    return single.join(several.hint("merge"), ["key", "digest"], "left_anti").unionByName(whole)


RESULT = "_id bigint, _key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, since array<int>, until array<int>"


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        covered = batch["covered"]
        for lo, hi, data, offs in text_slices(batch["text"]):
            out = []
            for r in range(hi - lo):
                text = data[offs[r] : offs[r + 1]]
                edge = np.zeros(len(text) + 1, np.int64)
                for c in covered[lo + r].as_py() or []:
                    since = c["at"] + np.asarray(c["since"], np.int64)
                    until = c["at"] + np.asarray(c["until"], np.int64) + LENGTH - 1
                    np.add.at(edge, since, 1)
                    np.add.at(edge, until, -1)
                gone = np.cumsum(edge[:-1]) > 0
                since, until = _spans(gone)
                kept = text[~gone] if since else text
                out.append((len(text), len(text) - len(kept), len(since), kept.tobytes(), since, until))
            cut = batch.slice(lo, hi - lo)
            types = [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            cols = [cut["_id"], cut["_key"], *[pa.array([o[c] for o in out], t) for c, t in enumerate(types)]]
            yield pa.RecordBatch.from_arrays(cols, ["_id", "_key", "n_bytes", "n_removed", "n_spans", "kept", "since", "until"])


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _key, doc_id, n_bytes, n_removed, n_spans, kept, since, until)``: one row a document.

    ``kept`` holds the bytes that stay, ``since`` and ``until`` the removed runs.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = keyed(docs, id_col, text_col)
    dealt = rows.mapInArrow(_run_rows, RUNS).withColumn("lead", F.when(F.col("known"), F.xxhash64("_key", "at")))
    dealt = dealt.repartition("key", "lead").drop("lead").sortWithinPartitions("key")
    runs = dealt.mapInArrow(_repeated_runs, "_id bigint, _key bigint, at int, starts int")
    runs = scratch.stage(runs.distinct().groupBy("_id", "_key").agg(F.collect_list(F.struct("at", "starts")).alias("runs")))

    contexts = scratch.stage(rows.join(runs.hint("merge"), ["_id", "_key"]).select("_id", "_key", "text", "runs").mapInArrow(_context_rows, CONTEXTS))
    bodies = contexts.where("times > 0").select("key", "digest", "times", "bytes")
    hot = scratch.stage(bodies.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key"))
    if hot.isEmpty():
        cold, covered = bodies, None
    else:
        cold, covered = lookup_join(bodies, hot, "key", "left_anti"), _hot_covered(lookup_join(bodies, hot, "key", "left_semi"))
    merged = cold.repartition("key").sortWithinPartitions("key", "digest").mapInArrow(_classified, COVERED)
    covered = scratch.stage(merged if covered is None else merged.unionByName(covered))

    places = contexts.select("key", "digest", "_id", "_key", "at").join(covered.hint("merge"), ["key", "digest"])
    places = scratch.stage(places.groupBy("_id", "_key").agg(F.collect_set(F.struct("at", "since", "until")).alias("covered")))
    scratch.close(places)
    out = rows.join(places.hint("merge"), ["_id", "_key"], "left").select("_id", "_key", "text", "covered").mapInArrow(_cleaned, RESULT)
    return out.select("_id", "_key", plain_id(id_col), "n_bytes", "n_removed", "n_spans", "kept", "since", "until")
