"""Exact n-gram Jaccard join by a partition of the token universe.

A document's set holds its distinct ``words``-word shingles as 64-bit hashes. Two sets of sizes
``r <= s`` with Jaccard similarity ``num/den`` or more differ in at most
``H = (den - num)(r + s) / (den + num)`` shingles. Sizes fall into bands; each band cuts the hash
universe into segments, and a set is indexed by what it holds in each segment (exact subsets, one
point each) or by that and all its one-deletion neighbours (two points: they still meet after one
difference). With more than ``H`` points in all, two linked sets must share an entry. A cost model
chooses for each band how many segments there are and which kind they are.

An empty segment would be an entry that unrelated sets share. It is not indexed: its points are
lost, and the band has spare points to make up for it. A linked pair can then be missed only when
both sets have lost more than the spare; such *weak* sets index their empty segments too.

Shingles of many documents (a common line, a licence) would make entries that unrelated sets share:
a segment that holds nothing else. A count of documents by shingle bucket, of a fixed size, marks the
*heavy* buckets, and sets are first indexed by their other shingles alone. Those differ in no more
shingles than the whole sets do, so a linked pair still meets unless both sets are weak in what is
left, as near copies of a text with many copies are; weak sets are indexed by their whole content
too. What is marked decides which candidates there are, never which links.

Candidates meet in one exchange of ``(entry, set digest)``. Each set is verified against the least
pivot of its entries, so a group of near copies costs one check a member; then against the other
pivots that are in another component. Digests begin with a rank, so that the pivots are sets of
little but heavy shingles: the copies with the fewest changes. Entries of three sets or more whose
members are in different components after that are resolved: the members of entries with pivots in
one component form a group, the sets of large groups are indexed once more, by a second, independent partition of the universe (linked
sets meet there too, sets that only share a passage hardly ever) and checked in the same way; what
is left is verified in tile products that return one row a linked set, never its pairs. Every check
is exact on the shingle sets.

Results for odd cases: null or empty texts and texts without words have an empty set and link with
nothing; fewer words than ``words`` make one shingle of the whole sequence; rows that repeat an id
with the same text count once; equal sets are linked (similarity 1).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, Scratch, U, keyed, local_roots, merged_stars, mix, named_by, per_row, plain_id, signed, stars, text_slices, words_of
from millrace.llm.sums import summed
from millrace.sizing import lookup_join

BAND_RATIO = 1.4
SPARE = 12
SMALL_BUCKET = 64
PIVOT_ROWS = 2_000
TILE_SETS = 1_536
TILE_MEMBERS = 2_000_000
SECOND = 0x5851F42D4C957F2D
BUCKETS = 1 << 18  # of shingles, to count their documents
HEAVY = 64  # documents that a heavy bucket has more than an ordinary one, at least


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct shingles, sorted by both."""
    n = len(offs) - 1
    h, row, _, _ = words_of(data, offs)
    size = np.bincount(row, minlength=n)
    short = np.flatnonzero((size > 0) & (size < words))
    if len(short):  # padded with zeros to one shingle
        pad = np.repeat(short, words - size[short])
        h = np.insert(h, np.cumsum(size)[pad], U(0))
        row = np.insert(row, np.cumsum(size)[pad], pad)
    if len(h) < words:
        return row[:0], h[:0]
    out = np.zeros(len(h) - words + 1, U)
    factor = 1
    for k in range(words):
        factor = factor * 0xD6E8FEB86659FD93 % 2**64
        out += h[k : k + len(out)] * U(factor)
    inside = row[words - 1 :] == row[: len(out)]
    out, row = mix(out[inside]), row[: len(out)][inside]
    sort_rows(out, per_row(row, n))
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return row[fresh], out[fresh]


def sort_rows(values: np.ndarray, bounds: np.ndarray) -> None:
    """Sort each run of ``values`` in place."""
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo > 1:
            values[lo:hi].sort()


def most_differences(small: int, num: int, den: int) -> int:
    """Largest symmetric difference of a linked pair whose smaller set has ``small`` members."""
    return (den - num) * (small + small * den // num) // (den + num)


@functools.lru_cache
def bands(num: int, den: int, largest: int) -> list[tuple[int, int, int, int, int]]:
    """``(low, high, need, exact, deletion)``: sizes, points that force a meeting, segments of each kind.

    Bands in which linked sets must be equal are left out.
    """
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * BAND_RATIO)) if most_differences(low, num, den) else low
        h = most_differences(high, num, den)
        if h:
            out.append((low, high, h + 1, *_segments(low, h + 1)))
        low = high + 1
    return out


def _segments(size: int, need: int) -> tuple[int, int]:
    """The cheapest ``(exact, deletion)`` segments: index rows of a set, and rows lost to weak sets."""
    best = None
    for spare in range(need // 8 + SPARE):
        for exact, deletion in ((need + spare, 0), (0, math.ceil((need + spare) / 2))):
            m = exact + deletion
            mean = size / m
            empty = m * math.exp(-mean) * (1 if exact else 2 + mean)
            left = 2 * deletion + exact - need
            tail, term = 0.0, math.exp(-empty)
            for k in range(left + 1):
                tail += term
                term *= empty / (k + 1)
            cost = exact + deletion * (1 + mean) + 3000 * max(0.0, 1 - tail)
            if best is None or cost < best[0]:
                best = (cost, exact, deletion)
    return best[1:]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & U(BUCKETS - 1)).astype(np.int64)


def _count_documents(words: int) -> Callable:
    def fold(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for _, _, data, offs in text_slices(batch["text"]):
            total += np.bincount(_bucket(shingle_sets(data, offs, words)[1]), minlength=BUCKETS)

    return fold


def heavy_buckets(counts: np.ndarray) -> np.ndarray:
    """The buckets with far more documents than chance gives an ordinary one; one in sixteen at most."""
    usual = float(np.median(counts))
    return counts > max(usual + 8 * math.sqrt(usual) + HEAVY, float(np.quantile(counts, 15 / 16)))


def entries(
    row: np.ndarray, h: np.ndarray, n: int, num: int, den: int, seed: int = 0, heavy: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """``(row, entry)`` of the index rows of all sets; ``h`` is sorted within its row.

    With ``heavy`` buckets marked, those of the shingles in other buckets, and for weak sets of all.
    """
    size = np.bincount(row, minlength=n)
    contents = [(row, h)]
    if heavy is not None:
        light = ~heavy[_bucket(h)]
        contents.insert(0, (row[light], h[light]))
    if seed:
        contents = [(r, mix(x ^ U(seed))) for r, x in contents]
        for r, x in contents:
            sort_rows(x, per_row(r, n))
    rows, keys = [], []
    key = lambda t, tags, c: mix(mix(t + tags) + c.astype(U))
    for b, (low, high, need, exact, deletion) in enumerate(bands(num, den, max(4096, 1 << int(size.max(initial=0)).bit_length()))):
        mine = (size >= low) & (size <= high * den // num)
        m = exact + deletion
        for last, (r, x) in enumerate(contents, 1 - len(contents)):
            if not mine.any():
                break
            pick = mine[r]
            r, x = r[pick], x[pick]
            seg = ((x >> U(32)) * U(m)) >> U(32)
            group = r * m + seg.astype(np.int64)
            first = np.ones(len(group), bool)
            first[1:] = group[1:] != group[:-1]
            at = np.flatnonzero(first)
            g = group[at]
            count = np.diff(np.append(at, len(group)))
            point = mix(x ^ U(0xA0761D6478BD642F))
            total = np.add.reduceat(point, at) if len(at) else point
            tag = mix((g % m).astype(U) + U((b + 1) << 32) + U(seed))
            rows.append(g // m)
            keys.append(key(total, tag, count))
            worth = np.where(count > 1, 1 + (deletion > 0), 1)
            if deletion:
                of = np.repeat(np.arange(len(at)), count)
                shorter = count[of] > 1
                of, t = of[shorter], point[shorter]
                rows.append((g // m)[of])
                keys.append(key(total[of] - t, tag[of], count[of] - 1))
            mine = mine & (np.bincount(g // m, worth, n) < need)  # the weak ones
            if last == 0 and mine.any():
                w = np.flatnonzero(mine)
                full = np.repeat(w * m, m) + np.tile(np.arange(m), len(w))
                gone = full[~np.isin(full, g)]
                few = g[(count == 1) & mine[g // m]] if deletion else gone[:0]
                for e in (gone, few):  # an empty segment, and the empty neighbour of a segment with one member
                    rows.append(e // m)
                    keys.append(key(np.zeros(len(e), U), mix((e % m).astype(U) + U((b + 1) << 32) + U(seed)), np.zeros(len(e), np.int64)))
    if not rows:
        return row[:0], h[:0]
    return np.concatenate(rows), np.concatenate(keys)


def _digests(row: np.ndarray, h: np.ndarray, n: int, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and signed digests: 60 bits of a hash below a rank, so that sets of little but heavy
    shingles, which are in the middle of many near copies, come first and are the pivots."""
    size = np.bincount(row, minlength=n)
    total = np.zeros(n, U)
    np.add.at(total, row, mix(h ^ U(0x8EBC6AF09C88C6E3)))
    light = np.bincount(row, ~heavy[_bucket(h)], n)
    rank = 15 - np.minimum(15, 2 * np.log2(np.maximum(size, 1) / (light + 1)) + 2).clip(0).astype(np.int64)
    return size, ((rank - 8) << 60) + (mix(total + size.astype(U)) >> U(4)).astype(np.int64)


def _set_rows(words: int, heavy: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch["text"]):
                size, digest = _digests(*shingle_sets(data, offs, words), hi - lo, heavy)
                cut = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [cut["_id"], cut["_key"], pa.array(size.astype(np.int64)), pa.array(digest)], ["_id", "_key", "size", "digest"]
                )

    return run


def _entry_rows(words: int, num: int, den: int, heavy: np.ndarray) -> Callable:
    """Index rows ``(entry, a, b)`` with the map-side combine: of the sets of a slice that share an
    entry one (``a``) speaks for it in the exchange by entry, the others (``b``) go along with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch["text"]):
                row, h = shingle_sets(data, offs, words)
                _, digest = _digests(row, h, hi - lo, heavy)
                r, key = entries(row, h, hi - lo, num, den, heavy=heavy)
                yield _combined(key, digest[r])

    return run


def _refined_rows(words: int, num: int, den: int, seed: int) -> Callable:
    """The same for rows ``(digest, text)``: entries of a second partition, of whole sets, as most are weak without heavy shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch["digest"].to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in text_slices(batch["text"]):
                row, h = shingle_sets(data, offs, words)
                r, key = entries(row, h, hi - lo, num, den, seed)
                yield _combined(key, digests[lo:hi][r])

    return run


def _combined(key: np.ndarray, digest: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((digest, key))
    key, digest = key[order], digest[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
    key, digest = key[fresh], digest[fresh]
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    pivot = digest[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))] if len(key) else digest
    return pa.RecordBatch.from_arrays(
        [signed(key), pa.array(pivot), pa.array(digest, mask=head)], ["entry", "a", "b"]
    )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by entry: ``(entry, a, b)`` for all members of entries with two sets or more."""
    entry, pivot = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, a = (batch[c].to_numpy(zero_copy_only=False) for c in ("entry", "a"))
        b = batch["b"]
        along = np.asarray(b.is_valid())
        mate = b.fill_null(0).to_numpy(zero_copy_only=False)
        head = np.flatnonzero(~along)
        out = [np.stack([key[along], a[along], mate[along]])]
        k, x = key[head], a[head]
        if len(k):
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            lead = x[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))]
            if entry == k[0]:
                run = int(np.argmax(k != k[0])) if (k != k[0]).any() else len(k)
                lead[:run] = pivot
            entry, pivot = k[-1], lead[-1]
            differ = lead != x
            out.append(np.stack([k[differ], lead[differ], x[differ]]))
        rows = np.concatenate(out, axis=1)
        if rows.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], ["entry", "a", "b"])


MEMBERS = "entry bigint, a bigint, b bigint"


def _members(rows: DataFrame, scratch: Scratch) -> DataFrame:
    dealt = rows.withColumn("lead", F.coalesce("b", F.lit(0))).repartition("entry", "lead").drop("lead")
    return scratch.stage(dealt.sortWithinPartitions("entry", "a").mapInArrow(_meet, MEMBERS))


def _checked(words: int, num: int, den: int) -> Callable:
    """Of rows ``(a, share, b, text)``, pivots (null ``b``) before their mates: the linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, np.zeros(0, U)
        for batch in batches:
            a = batch["a"].to_pylist()
            b = batch["b"].to_pylist()
            out = []
            for lo, hi, data, offs in text_slices(batch["text"]):
                row, h = shingle_sets(data, offs, words)
                bounds = per_row(row, hi - lo)
                for i in range(lo, hi):
                    mine = h[bounds[i - lo] : bounds[i - lo + 1]]
                    if b[i] is None:
                        pivot, own = a[i], mine.copy()
                    elif pivot == a[i] and len(own):
                        at = np.searchsorted(own, mine)
                        common = int((own[np.minimum(at, len(own) - 1)] == mine).sum())
                        if den * common >= num * (len(own) + len(mine) - common):
                            out.append((a[i], b[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, sizes: DataFrame, words: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The linked ones of distinct ``pairs (a, b)``; sizes too far apart rule a pair out. Each pivot's
    mates are dealt in shares of a bounded size, every share with a copy of the pivot's text."""
    for side in ("a", "b"):
        pairs = lookup_join(pairs, sizes.select(F.col("digest").alias(side), F.col("size").alias(f"{side}_size")), side)
    fit = den * F.least("a_size", "b_size") >= num * F.greatest("a_size", "b_size")
    pairs = scratch.stage(pairs.where(fit).select("a", "b"))
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_ROWS).alias("shares"))
    heads = shares.withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)))
    heads = heads.join(texts, heads["a"] == texts["digest"]).select("a", "share", F.lit(None).cast("bigint").alias("b"), "text")
    mates = pairs.join(shares.hint("merge"), "a").withColumn("share", F.pmod(F.xxhash64("b"), "shares"))
    mates = mates.join(texts, mates["b"] == texts["digest"]).select("a", "share", "b", "text")
    rows = heads.unionByName(mates).repartition("a", "share").sortWithinPartitions("a", "share", "b")
    return scratch.stage(rows.mapInArrow(_checked(words, num, den), "a bigint, b bigint"))


def _parted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs (a, b)`` whose sets are in different components; sets without a link are their own."""
    return named_by(pairs, roots).where("a_root <> b_root").select("a", "b")


def _met(members: DataFrame, roots: DataFrame, checked: DataFrame, verify: Callable, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(roots, open)`` after the members of every entry were checked against its pivots.

    ``checked`` pairs are not checked again, nor are sets that are in one component by now. ``open
    (pivot, digest)`` has the members of the entries that are still in several components, by the
    component of the least of them, as near copies have many entries with pivots that are linked;
    an entry of two sets has no other pair.
    """
    pairs = scratch.stage(_parted(members.select("a", "b").distinct(), roots))
    rest = scratch.stage(lookup_join(pairs, checked, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        roots = merged_stars(roots, verify(rest), scratch)
    still = scratch.stage(_parted(pairs, roots))
    mixed = scratch.stage(lookup_join(members, still, ["a", "b"], "left_semi").select("entry"))
    # The least set of an entry is the least ``a``, the others are its ``b``.
    of = lookup_join(members, mixed, "entry", "left_semi").groupBy("entry")
    of = of.agg(F.min("a").alias("least"), F.min("b").alias("low"), F.max("b").alias("high")).where("low <> high")
    of = lookup_join(of.select("entry", F.col("least").alias("node")), roots, "node", "left")
    of = scratch.stage(of.select("entry", F.col("node").alias("least"), F.coalesce("root", "node").alias("pivot")))
    held = lookup_join(members, of.select("entry", "pivot"), "entry").select("pivot", F.col("b").alias("digest"))
    left = scratch.stage(held.unionByName(of.select("pivot", F.col("least").alias("digest"))).distinct())
    scratch.drop(pairs, rest, still, mixed, of)
    return roots, left


def shared_counts(row_x: np.ndarray, h_x: np.ndarray, n_x: int, row_y: np.ndarray, h_y: np.ndarray, n_y: int) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, by products over their common members."""
    common = np.intersect1d(h_x, h_y)
    counts = np.zeros((n_x, n_y), np.float32)
    for lo in range(0, len(common), 4096):
        part = common[lo : lo + 4096]
        sides = []
        for row, h, n in ((row_x, h_x, n_x), (row_y, h_y, n_y)):
            at = np.minimum(np.searchsorted(part, h), len(part) - 1)
            held = part[at] == h
            side = np.zeros((n, len(part)), np.float32)
            side[row[held], at[held]] = 1
            sides.append(side)
        counts += sides[0] @ sides[1].T
    return counts


def _tile(words: int, num: int, den: int) -> Callable:
    """Links within one tile pair of a group, as one row to its local root for each linked set."""

    def sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows, hashes = [], []
        for lo, _, data, offs in text_slices(table["text"]):
            row, h = shingle_sets(data, offs, words)
            rows.append(row + lo)
            hashes.append(h)
        return (np.concatenate(rows), np.concatenate(hashes)) if rows else (np.zeros(0, np.int64), np.zeros(0, U))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        x = table.filter(pa.compute.equal(table["tile"], low))
        y = x if low == high else table.filter(pa.compute.equal(table["tile"], high))
        (row_x, h_x), (row_y, h_y) = sets(x), sets(y)
        shared = shared_counts(row_x, h_x, len(x), row_y, h_y, len(y))
        union = np.bincount(row_x, minlength=len(x))[:, None] + np.bincount(row_y, minlength=len(y))[None, :] - shared
        i, j = np.nonzero((den * shared >= num * union) & (shared > 0))
        shift = 0 if low == high else len(x)
        digest = np.concatenate([t["digest"].to_numpy() for t in ((x,) if low == high else (x, y))])
        root = local_roots(len(digest), [(i, j + shift)])
        some = root != np.arange(len(root))
        return pa.table({"a": digest[some], "b": digest[root[some]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _within(groups: DataFrame, sizes: DataFrame, texts: DataFrame, words: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Links within groups ``(pivot, digest)``: all pairs, in tile products of bounded size."""
    groups = lookup_join(groups, sizes, "digest")
    tiles = groups.groupBy("pivot").agg(F.ceil(F.greatest(F.count("*") / TILE_SETS, F.sum("size") / TILE_MEMBERS)).alias("tiles"))
    tiled = groups.join(tiles.hint("merge"), "pivot").withColumn("tile", F.pmod(F.xxhash64("digest"), "tiles"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    tiled = tiled.select("pivot", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "digest")
    return scratch.stage(tiled.join(texts, "digest").groupBy("pivot", "low", "high").applyInArrow(_tile(words, num, den), "a bigint, b bigint"))


def jaccard_classes(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(_id, _key, doc_id, n_shingles, component_id, kept)``: one row a document.

    Documents link when ``den * common >= num * union`` of their shingle sets; ``component_id`` is
    the smallest id reachable by links, the document itself included (null ids come first and
    stay null). ``kept`` marks the one of each component with the smallest id and row key.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = keyed(docs, id_col, text_col)
    heavy = heavy_buckets(summed(rows.select("text"), _count_documents(words), BUCKETS))
    sets = scratch.stage(rows.mapInArrow(_set_rows(words, heavy), "_id bigint, _key bigint, size bigint, digest bigint"))
    members = _members(rows.mapInArrow(_entry_rows(words, num, den, heavy), MEMBERS), scratch)

    nodes = members.select(F.col("b").alias("digest")).unionByName(members.select(F.col("a").alias("digest"))).distinct()
    one = sets.groupBy("digest").agg(F.min(F.struct("_id", "_key")).alias("low"), F.min("size").alias("size"))
    one = scratch.stage(one.join(nodes, "digest").select("low._id", "low._key", "digest", "size"))
    texts = scratch.stage_by(lookup_join(rows, one.select("_id", "_key", "digest"), ["_id", "_key"]).select("digest", "text"), "digest")
    if texts.count() != one.count():  # repeated rows
        repeated, texts = texts, scratch.stage_by(texts.dropDuplicates(["digest"]), "digest")
        scratch.drop(repeated)
    sizes = one.select("digest", "size")
    verify = functools.partial(_verify, texts=texts, sizes=sizes, words=words, num=num, den=den, scratch=scratch)

    first = scratch.stage(members.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    roots = stars(verify(first), scratch)  # a set hangs from its least pivot, a smaller digest
    roots, left = _met(members, roots, first, verify, scratch)
    scratch.drop(members)
    many = scratch.stage(left.groupBy("pivot").agg(F.count("*").alias("n")).where(F.col("n") > SMALL_BUCKET).select("pivot"))
    large, groups = lookup_join(left, many, "pivot", "left_semi"), [lookup_join(left, many, "pivot", "left_anti")]
    if not many.isEmpty():
        # A set is indexed once, however many groups it is in: linked sets meet in some entry of the second partition.
        again = large.select("digest").distinct().join(texts, "digest")
        refined = _members(again.mapInArrow(_refined_rows(words, num, den, SECOND), MEMBERS), scratch)
        roots, finer = _met(refined, roots, first, verify, scratch)
        scratch.drop(refined)
        groups.append(finer)
    groups = scratch.stage(functools.reduce(DataFrame.unionByName, groups).distinct())
    if not groups.isEmpty():
        roots = merged_stars(roots, _within(groups, sizes, texts, words, num, den, scratch), scratch)
    scratch.drop(texts, one, first)

    named = sets.join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    full = scratch.stage(named)
    own = F.struct("_id", "_key")
    lowest = full.where("size > 0").groupBy("root").agg(F.min(own).alias("low"), F.count("*").alias("n")).where("n > 1")
    lowest = scratch.stage(lowest.select("root", "low"))
    out = lookup_join(full, lowest, "root", "left")
    out = out.withColumn("low", F.coalesce(F.when(F.col("size") > 0, F.col("low")), own)).withColumn("kept", F.col("low") == own)
    out = out.withColumn("low", F.col("low._id"))
    scratch.close(full, lowest)
    return out.select(
        "_id", "_key", plain_id(), F.col("size").alias("n_shingles"),
        F.when(F.col("low") != NULL_ID, F.col("low")).alias("component_id"), "kept",
    )
