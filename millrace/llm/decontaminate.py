"""Benchmark decontamination by latent semantic retrieval.

1. One pass over all documents counts in how many blocks of ``BLOCK`` words each hashed term
   occurs and sketches ``A'A`` of the block-term matrix with a random test matrix. From the sketch
   comes the randomised (Nystrom) decomposition of the tf-idf matrix: its leading right singular
   vectors and values, of a fixed size.
2. A second pass projects every passage (two neighbouring blocks) onto them, each direction scaled
   to unit variance, and takes the benchmark passages with a cosine of ``cosine`` or more. A cosine
   cannot tell that a passage holds no copy, so those that hold enough of an item's rarest words are
   taken too: a leak misses few of the item's words, so it holds some of any larger part of them.
   This route takes every leak, whatever ``cosine`` is.
3. For these, words that the two share bound their longest common subsequence; where the bound
   allows it, the subsequence itself is found with one 64-bit word a passage, all pairs at once.
   It is judged in every run of ``PASSAGE`` words, at any offset, so it does not matter where in
   the document a copy begins: three neighbouring blocks hold all the runs that begin in the first.
   A passage leaks a benchmark item when the subsequence holds the share ``sure`` of the item's
   words, or the share ``likely`` and the item's answer in order.

An item longer than ``CHUNK`` words is asked in even chunks; any of them may leak. The answer is
``answer_col``, or the last ``ANSWER`` words of the item. Benchmark items are held by every task in
blocks of at most ``ITEM_BYTES`` of text, one search a block; documents are never shuffled. Words are runs of
letters and digits, folded to lower case. Null or empty texts and items match nothing; items that
repeat an id are asked one by one and reported once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import U, keyed, per_row, plain_id, text_slices, words_of
from millrace.llm.sums import summed
from millrace.sizing import byte_size

TERMS = 1 << 12
RANK, EXTRA = 64, 16
BLOCK = 32
PASSAGE, SPAN = 2 * BLOCK, 3  # words of a passage, blocks that hold one at any offset
CHUNK = 48
ANSWER = 3
ITEM_BYTES = 8 << 20
HITS = 1 << 22  # counts of rare words held at a time
SKETCHED = 4096  # blocks sketched at a time
OFTEN = 32  # times in them from which a term is summed by a product
RUNS = 4096  # runs of words judged at a time
NOT_WORDS = [b for b in range(128) if not chr(b).isalnum()]


def blocks_of(data: np.ndarray, offs: np.ndarray):
    """``(hash, first word of each block, first block of each text)``; the last ones with an end mark."""
    h, row, _, _ = words_of(data, offs, NOT_WORDS)
    bounds = per_row(row, len(offs) - 1)
    count = -(-np.diff(bounds) // BLOCK)
    first = np.concatenate([[0], np.cumsum(count)])
    starts = np.repeat(bounds[:-1], count) + (np.arange(first[-1]) - np.repeat(first[:-1], count)) * BLOCK
    return h, np.append(starts, len(h)).astype(np.int64), first


def terms(h: np.ndarray) -> np.ndarray:
    return (h >> U(20)).astype(np.int64) & (TERMS - 1)


def test_matrix() -> np.ndarray:
    return np.random.default_rng(11).normal(size=(TERMS, RANK + EXTRA)).astype(np.float32)


def block_sums(matrix: np.ndarray, t: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each block the sum of its terms' rows of ``matrix``, whose last row is zero."""
    out = np.zeros((len(starts) - 1, matrix.shape[1]), matrix.dtype)
    for j in range(BLOCK):
        at = starts[:-1] + j
        out += matrix[np.where(at < starts[1:], t[np.minimum(at, len(t) - 1)], len(matrix) - 1)]
    return out


def with_zero(matrix: np.ndarray) -> np.ndarray:
    return np.concatenate([matrix, np.zeros((1, matrix.shape[1]), matrix.dtype)])


def term_sums(t: np.ndarray, block: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(term, sums, blocks)``: of each term the rows of ``seen`` of its places added up, and the blocks that hold it.

    ``block`` ascends. Places are taken by rounds, the n-th of every term at once; terms with many by a product.
    """
    order = np.argsort(t.astype(np.uint16), kind="stable")
    ranked, owner = t[order], block[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    at = np.flatnonzero(new)
    held = np.add.reduceat((new | np.append(True, owner[1:] != owner[:-1])).astype(np.int64), at)
    count = np.diff(np.append(at, len(t)))
    by = np.argsort(-count, kind="stable")
    at, count, held = at[by], count[by], held[by]
    sums = np.zeros((len(at), seen.shape[1]), np.float32)
    often = int(np.count_nonzero(count > OFTEN))
    if often:
        row = np.repeat(np.arange(often), count[:often])
        place = np.arange(len(row)) + np.repeat(at[:often] - np.append(0, np.cumsum(count[:often])[:-1]), count[:often])
        times = np.bincount(row * len(seen) + owner[place], minlength=often * len(seen))
        sums[:often] = times.reshape(often, len(seen)).astype(np.float32) @ seen
    for k in range(OFTEN):
        upto = int(np.count_nonzero(count > k))
        if upto <= often:
            break
        sums[often:upto] += seen[owner[at[often:upto] + k]]
    return ranked[at], sums, held


def sketch(batch: pa.RecordBatch, total: np.ndarray) -> None:
    """Add ``A'(A R)`` of the batch's blocks, the blocks that hold each term, and their number."""
    r = with_zero(test_matrix())
    width = r.shape[1]
    out, counts = total[: TERMS * width].reshape(TERMS, width), total[TERMS * width : -1]
    for _, _, data, offs in text_slices(batch["text"], 1 << 18):
        h, starts, _ = blocks_of(data, offs)
        t = terms(h)
        for lo in range(0, len(starts) - 1, SKETCHED):
            some = starts[lo : lo + SKETCHED + 1]
            own = t[some[0] : some[-1]]
            term, sums, held = term_sums(own, np.repeat(np.arange(len(some) - 1), np.diff(some)), block_sums(r, own, some - some[0]))
            out[term] += sums
            counts[term] += held
        total[-1] += len(starts) - 1


def word_map(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(map, idf)``: a passage's latent vector is the sum of its words' rows of ``map``."""
    width = RANK + EXTRA
    r = test_matrix().astype(np.float64)
    seen, n = total[TERMS * width : -1].astype(np.float64), float(total[-1])
    idf = np.log((n + 1) / (seen + 1)) + 0.1
    y = total[: TERMS * width].reshape(TERMS, width).astype(np.float64) * idf[:, None]
    omega = r / idf[:, None]
    shift = 1e-7 * max(np.sqrt((y * y).sum()), 1.0)
    y += shift * omega
    gram = omega.T @ y
    values, basis = np.linalg.eigh((gram + gram.T) / 2)
    good = values > values.max() * 1e-10
    u, s, _ = np.linalg.svd(y @ (basis[:, good] / np.sqrt(values[good])), full_matrices=False)
    u, s = u[:, :RANK], s[:RANK]
    keep = s > 1e-6 * s.max()
    return (idf[:, None] * u[:, keep] / s[keep] * s[keep].max()).astype(np.float32), idf


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def common_subsequence(passages: np.ndarray, items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of rows; 64 words of a passage share one state, zeros are none."""
    parts = [passages[:, k : k + 64] for k in range(0, passages.shape[1], 64)]
    bits = [U(1) << np.arange(p.shape[1]).astype(U) for p in parts]
    state = [np.full(len(passages), ~U(0)) for _ in parts]
    for j in range(int(lengths.max(initial=0))):
        word = items[:, j : j + 1]
        carry = U(0)
        for k, p in enumerate(parts):
            match = np.where((p == word) & (word != 0), bits[k], U(0)).sum(axis=1, dtype=U)
            half = state[k] + (state[k] & match)
            total = half + carry
            carry = ((half < state[k]) | (total < half)).astype(U)
            state[k] = total | (state[k] & ~match)
    return sum(np.bitwise_count(~s).astype(np.int64) for s in state)


def item_chunks(items: list[tuple[int, str, str | None]]):
    """``(item ids, word rows, lengths, answer rows, answer lengths)`` of the chunks to ask for."""
    ids, rows, answers = [], [], []
    for ident, text, answer in items:
        h = _words(text)
        if not len(h):
            continue
        last = _words(answer) if answer else h[-ANSWER:]
        for part in np.array_split(h, -(-len(h) // CHUNK)):
            ids.append(ident)
            rows.append(part)
            answers.append(last[:64])
    return ids, *_padded(rows, CHUNK), *_padded(answers, 64)


def _words(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]), NOT_WORDS)[0]


def _padded(rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((len(rows), width), U)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, np.array([len(r) for r in rows], np.int64)


def rare_words(words: np.ndarray, lengths: np.ndarray, need: np.ndarray, idf: np.ndarray):
    """``(sorted words, offsets, chunks, least)``: the chunks that have each word among their rarest.

    ``need`` common words leave ``lengths - need`` of a chunk unmatched at most. Of that many places
    and ``least`` more, the rarest of the chunk, a leak therefore holds ``least`` or more.
    """
    least = np.minimum(need, np.maximum(1, -(-lengths // 10)))
    rarity = np.where(words != 0, idf[terms(words)], -1.0)
    rank = np.argsort(np.argsort(-rarity, axis=1, kind="stable"), axis=1)
    chunk, place = np.nonzero((rank < (lengths - need + least)[:, None]) & (words != 0))
    some, at = np.unique(words[chunk, place], return_inverse=True)
    order = np.argsort(at, kind="stable")
    return some, np.searchsorted(at[order], np.arange(len(some) + 1)), chunk[order], least


def rare_hits(h: np.ndarray, starts: np.ndarray, left: np.ndarray, count: np.ndarray, rare) -> np.ndarray:
    """``(passages, chunks)``: the ``count`` blocks from ``left`` on hold ``least`` or more rare words of the chunk.

    A word that several blocks hold counts in each, so this is an upper bound too.
    """
    some, offs, chunks, least = rare
    width, out = len(least), np.zeros((len(left), len(least)), bool)
    step = max(1, HITS // width)
    for a in range(0, len(left), step):
        at, more = left[a : a + step], count[a : a + step]
        lo, hi = at[0], at[-1] + more[-1]
        words = h[starts[lo] : starts[hi]]
        word = np.minimum(np.searchsorted(some, words), len(some) - 1)
        block = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
        held = some[word] == words
        block, word = np.divmod(np.unique(block[held] * len(some) + word[held]), len(some))
        times = offs[word + 1] - offs[word]
        place = np.arange(times.sum()) + np.repeat(offs[word] - np.append(0, np.cumsum(times)[:-1]), times) if len(times) else times
        hits = np.bincount(np.repeat(block, times) * width + chunks[place], minlength=(hi - lo) * width).astype(np.int32).reshape(-1, width)
        total = hits[at - lo]
        for d in range(1, int(count.max())):
            total += np.where((more > d)[:, None], hits[np.minimum(at - lo + d, len(hits) - 1)], 0)
        out[a : a + step] = total >= least
    return out


def _search(asked, latent: np.ndarray, idf: np.ndarray, cosine: float, sure: float, likely: float) -> Callable:
    ids, words, lengths, answers, answer_lengths = asked
    ids = np.asarray(ids, np.int64)
    mask = words != 0
    queries = unit((latent[terms(words)] * mask[:, :, None]).sum(axis=1))
    held = np.zeros((len(ids), TERMS), np.uint8)
    np.put_along_axis(held, np.where(mask, terms(words), terms(words[:, :1])), 1, axis=1)
    asked_terms = terms(words)
    need = np.ceil(min(likely, sure) * lengths - 1e-9).astype(np.int64)
    rare = rare_words(words, lengths, need, idf)
    rows_of = with_zero(latent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch["text"], 1 << 18):
                h, starts, first = blocks_of(data, offs)
                if not len(h):
                    continue
                t = terms(h)
                sums = block_sums(rows_of, t, starts)
                blocks = np.diff(first)
                windows = np.where(blocks > 0, np.maximum(blocks - 1, 1), 0)
                row = np.repeat(np.arange(hi - lo), windows)
                left = np.repeat(first[:-1], windows) + np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                # Every passage of two blocks' words lies in three blocks, which begin where the latent passage does.
                size = np.minimum(first[1:][row] - left, SPAN)
                vector = unit(sums[left] + np.where((size > 1)[:, None], sums[np.minimum(left + 1, len(sums) - 1)], 0))
                near = vector @ queries.T >= cosine
                near[:-1] |= near[1:] & (row[:-1] == row[1:])[:, None]
                p, q = np.nonzero(near | rare_hits(h, starts, left, size, rare))
                own = np.zeros((len(sums), TERMS), np.uint8)  # the terms of each block
                own[np.repeat(np.arange(len(sums)), np.diff(starts)), t] = 1
                out = []
                for at in range(0, len(p), 16_384):
                    x, y = p[at : at + 16_384], q[at : at + 16_384]
                    # Item words that the span holds, then words of a passage that the item holds: either bounds
                    # the common subsequence.
                    asks = asked_terms[y]
                    held_here = own[left[x][:, None], asks]
                    for d in range(1, SPAN):
                        held_here |= own[(left[x] + np.minimum(d, size[x] - 1))[:, None], asks]
                    some = (held_here & mask[y]).sum(axis=1) >= need[y]
                    x, y = x[some], y[some]
                    begin, end = starts[left[x]], starts[left[x] + size[x]]
                    place = begin[:, None] + np.arange(SPAN * BLOCK)
                    inside = place < end[:, None]
                    place = np.minimum(place, len(h) - 1)
                    upto = np.cumsum(held[y[:, None], t[place]] * inside, axis=1, dtype=np.int32)
                    bound = np.maximum(upto[:, PASSAGE - 1], (upto[:, PASSAGE:] - upto[:, :-PASSAGE]).max(axis=1))
                    some = bound >= need[y]
                    x, y, place, inside = x[some], y[some], place[some], inside[some]
                    span = np.where(inside, h[place], U(0))
                    some = common_subsequence(span, words[y], lengths[y]) >= need[y]
                    x, y, span, count = x[some], y[some], span[some], inside[some].sum(axis=1)
                    shifts = np.arange(SPAN * BLOCK - PASSAGE + 1)
                    runs, shift = np.nonzero((shifts == 0) | (count[:, None] >= shifts + PASSAGE))
                    for k in range(0, len(runs), RUNS):
                        one, first_word = runs[k : k + RUNS], shift[k : k + RUNS]
                        passage, ask = span[one[:, None], first_word[:, None] + np.arange(PASSAGE)], y[one]
                        share = common_subsequence(passage, words[ask], lengths[ask]) / lengths[ask]
                        leak = share >= min(sure, likely)
                        passage, ask, share, one = passage[leak], ask[leak], share[leak], one[leak]
                        found = common_subsequence(passage, answers[ask], answer_lengths[ask]) == answer_lengths[ask]
                        leak = (share >= sure) | (share >= likely) & found
                        out += zip((row[x[one[leak]]] + lo).tolist(), ids[ask[leak]].tolist(), share[leak].tolist(), found[leak].tolist())
                if out:
                    at, item, share, found = zip(*out)
                    pick = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch["_id"].take(pick), batch["_key"].take(pick), pa.array(item, pa.int64()), pa.array(share, pa.float64()), pa.array(found, pa.bool_())],
                        ["_id", "_key", "item_id", "lcs_share", "answer_found"],
                    )

    return run


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, cosine: float = 0.3, sure: float = 0.75, likely: float = 0.6, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """``(_id, _key, doc_id, item_id, lcs_share, answer_found)``: one row for each document and item it leaks."""
    rows = keyed(docs, id_col, text_col)
    answer = F.col(f"`{answer_col}`") if answer_col else F.lit(None)
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("bigint"), F.lit(-1)).alias("i"), F.col(f"`{item_text_col}`").cast("string").alias("t"), answer.cast("string").alias("a"))
    parts = max(1, -(-byte_size(items) // ITEM_BYTES))
    latent, idf = word_map(summed(rows.select("text"), sketch, TERMS * (RANK + EXTRA) + TERMS + 1))
    found = None
    for k in range(parts):
        block = items.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == k) if parts > 1 else items
        asked = item_chunks([tuple(r) for r in block.collect()])  # at most about ITEM_BYTES
        if not asked[0]:
            continue
        one = rows.mapInArrow(_search(asked, latent, idf, cosine, sure, likely), "_id bigint, _key bigint, item_id bigint, lcs_share double, answer_found boolean")
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = rows.limit(0).selectExpr("_id", "_key", "0L as item_id", "0D as lcs_share", "false as answer_found")
    found = found.groupBy("_id", "_key", "item_id").agg(F.max("lcs_share").alias("lcs_share"), F.max("answer_found").alias("answer_found"))
    return found.select("_id", "_key", plain_id(id_col), "item_id", "lcs_share", "answer_found")
