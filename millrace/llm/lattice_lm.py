"""Language-model scores of documents from subword lattices.

The vocabulary is a given one; its scores are the first weights of its pieces. A word's lattice holds all its
segmentations, and a forward recursion in logarithms sums them. Weights are then fitted to the training texts:
each round counts pieces in expectation over all segmentations of the different training words (novel words
are like them), for each class of documents by itself.

A word's probability in a class has three levels, each with the mass that absolute discounting takes off the
one above: the class's counts, all training counts, the lattice. All words and the end are thus covered, and
the probabilities of a class sum to at most one. A document is the marginal over classes: words given the
class are independent, so every segmentation of the whole text is summed. Classes are the most common values
of ``by`` in training rows (``classes`` at most, the last of them all other values); a score does not read the
document's own.

*Spark.* Words are counted with map-side combine and every different word's lattice is summed once, whatever its
number of uses. Documents then need the words' probabilities: the most frequent ones, ``TABLE_BYTES`` at most,
go to the documents; a document's other words go to the table and come back as sums. No document, word or
class has to fit one task, but for one text and one word, which do.

Null and empty texts are the end alone. Rows that repeat id and text get the same score each. Without training rows
the counts are zero and the lattice has the vocabulary's own weights. An empty table has no scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, keyed, plain_id, text_slices, words_of
from millrace.llm.lattice import Trie, expected_pieces, word_masses
from millrace.llm.token_counts import read_vocabulary

TABLE_BYTES = 24 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_TRIES: dict[bytes, Trie] = {}


def read_pieces(vocabulary: bytes) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, a word's start as a blank, and their first weights from the scores of the file.

    Scores that are probabilities in logarithms are used as such; those that are ranks (merges) give ``1 / rank``.
    Pieces that no lower-cased word can hold are left out; every single byte is in.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
    scores: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        name = model.id_to_piece(i)
        piece = bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        if piece and piece.translate(_LOWER) == piece and not set(piece[1:]) & {32, *range(9, 14)}:
            scores[piece] = max(model.get_score(i), scores.get(piece, -math.inf))
    ranks = min(scores.values(), default=0.0) < -100
    logs = {p: -math.log1p(1 - s) if ranks else s for p, s in scores.items()}
    least = min(logs.values(), default=0.0)
    for b in range(256):
        logs.setdefault(bytes([b]), least)
    pieces = sorted(logs)
    start = np.array([logs[p] for p in pieces])
    return pieces, start - np.logaddexp.reduce(start)


def _trie(pieces) -> Trie:
    """The trie of a broadcast list, built once a worker."""
    key = (len(pieces.value), hash(tuple(pieces.value)))
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = Trie(pieces.value)
    return _TRIES[key]


def _taken(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte strings ``data[start:end]`` in lower case."""
    size = end - start
    offs = np.append(0, np.cumsum(size)).astype(np.int32)
    flat = data[np.repeat(start - offs[:-1], size) + np.arange(offs[-1])]
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offs), pa.py_buffer(flat)])


def _counter(k: int) -> Callable:
    """Arrow step ``(text, train, cls)`` to ``(word, c0, c1, ...)``: uses in the training rows of each class; zeros for a word of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch["train"].to_numpy(zero_copy_only=False)
            cls = batch["cls"].to_numpy(zero_copy_only=False)
            hashes, counts, words = [], [], []
            for lo, _, data, offs in text_slices(batch["text"]):
                h, row, start, end = words_of(data, offs)
                u, at, inverse = np.unique(h, return_index=True, return_inverse=True)
                used = train[row + lo]
                hashes.append(u)
                counts.append(np.bincount(inverse[used] * k + cls[row + lo][used], minlength=len(u) * k).reshape(-1, k))
                words.append(_taken(data, start[at], end[at]))
            if not hashes:
                continue
            u, at, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            total = np.zeros((len(u), k), np.int64)
            np.add.at(total, inverse, np.concatenate(counts))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(words).take(pa.array(at)), *[pa.array(total[:, i]) for i in range(k)]], ["word", *[f"c{i}" for i in range(k)]]
            )

    return run


def _marked(words: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), words.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()))


def _expecting(pieces, weights, k: int) -> Callable:
    """Arrow step: expected uses of pieces over the different words of each class, ``(cls, piece, uses)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, weight = _trie(pieces), weights.value
        sums = np.zeros(weight.shape)
        for batch in batches:
            words = _marked(batch["word"])
            for i in range(k):
                mine = words.filter(pa.array(batch[f"c{i}"].to_numpy(zero_copy_only=False) > 0))
                sums[i] += expected_pieces(trie, weight[i], mine, np.ones(len(mine)))
        cls, piece = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cls.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(sums[cls, piece])], ["cls", "piece", "uses"])

    return run


def fitted_weights(words: DataFrame, pieces, start: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Logarithms of the piece weights of each class, ``(classes, pieces)``; the driver gets one number for each."""
    weights, sc = np.tile(start, (k, 1)), words.sparkSession.sparkContext
    known = words.where(" + ".join(f"c{i}" for i in range(k)) + " > 0")
    for _ in range(rounds):
        held = sc.broadcast(weights)
        uses = known.mapInArrow(_expecting(pieces, held, k), "cls int, piece int, uses double").groupBy("cls", "piece").agg(F.sum("uses").alias("uses"))
        table = uses.toPandas()
        sums = np.zeros(weights.shape)
        sums[table["cls"], table["piece"]] = table["uses"]
        prior = np.exp(start) * 100  # so that no piece is lost, and a class without words keeps the first weights
        weights = np.log(sums + prior)
        weights -= np.logaddexp.reduce(weights, axis=1, keepdims=True)
        held.unpersist()
    return weights


def _discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def _scoring(pieces, weights, k: int, stats: Row) -> Callable:
    """Arrow step ``(word, c0, ...)`` to ``(word, c, p0, p1, ...)``: the natural logarithm of its probability in each class."""
    counts = [(stats[f"m{i}"] or 0, stats[f"t{i}"], _discount(stats[f"one{i}"], stats[f"two{i}"])) for i in [*range(k), "all"]]

    def level(c: np.ndarray, below: np.ndarray, m: int, t: int, d: float) -> np.ndarray:
        return np.logaddexp(_log(np.maximum(c - d, 0) / m), below + math.log(d * t / m)) if m else below

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, weight = _trie(pieces), weights.value
        for batch in batches:
            words = _marked(batch["word"])
            each = np.stack([batch[f"c{i}"].to_numpy(zero_copy_only=False) for i in range(k)])
            total = each.sum(axis=0)
            masses = word_masses(trie, weight, words)
            out = [level(each[i], level(total, masses[i], *counts[k]), *counts[i]) for i in range(k)]
            yield pa.RecordBatch.from_arrays([batch["word"], pa.array(total), *[pa.array(p) for p in out]], ["word", "c", *[f"p{i}" for i in range(k)]])

    return run


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(x)


def _summing(table, k: int) -> Callable:
    """Arrow step over documents: sums over the words of the table, and a row for each other word."""
    sums = ["tokens", "known", "base", *[f"s{i}" for i in range(k)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, values = table.value  # values: whether known, log10(c + 1), p0, p1, ...
        for batch in batches:
            ids, keys = batch["_id"].to_numpy(), batch["_key"].to_numpy()
            total = np.zeros((batch.num_rows, len(sums)))
            rare = []
            for lo, hi, data, offs in text_slices(batch["text"]):
                h, row, start, end = words_of(data, offs)
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1) if len(hashes) else np.zeros(len(h), int)
                found = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                total[lo:hi, 0] = np.bincount(row, minlength=hi - lo)
                for j in range(values.shape[1]):
                    total[lo:hi, j + 1] = np.bincount(row[found], values[at[found], j], hi - lo)
                h, row, start, end = h[~found], row[~found], start[~found], end[~found]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, int)
                times = np.diff(np.append(new, len(h)))
                rare.append((row[new] + lo, times, _taken(data, start[order][new], end[order][new])))
            rows = np.concatenate([np.arange(batch.num_rows), *[r[0] for r in rare]])
            none = len(rows) - batch.num_rows
            words = pa.concat_arrays([pa.nulls(batch.num_rows, pa.binary()), *[r[2] for r in rare]])
            times = np.concatenate([np.ones(batch.num_rows, np.int64), *[r[1] for r in rare]])
            full = np.concatenate([total, np.zeros((none, len(sums)))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(keys[rows]), words, pa.array(times), *[pa.array(full[:, j]) for j in range(len(sums))]],
                ["_id", "_key", "word", "n", *sums],
            )

    return run


def _frequent(scored: DataFrame, k: int, limit_bytes: int) -> tuple[int, DataFrame]:
    """The least count whose words fit ``limit_bytes``, from a histogram of counts, and these words."""
    most = limit_bytes // (8 * (k + 3))
    step = F.floor(F.log2(F.col("c").cast("double")) * 8)
    bins = sorted(scored.where("c > 0").groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(), reverse=True)
    least, held = 2**62, 0
    for b in bins:
        held += b["n"]
        if held > most:
            break
        least = b["c"]
    return least, scored.where(F.col("c") >= least)


def lattice_scores(
    docs: DataFrame, vocabulary_path: str, train: Column, by: str = "lang", classes: int = 16, rounds: int = 3,
    id_col: str = "doc_id", limit_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, scores as log10 probabilities; one row a row of ``docs``.

    ``train`` says which rows to learn from. ``base_score`` is that of single words with one added to each count.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lattice")
    pieces, start = read_pieces(read_vocabulary(spark, vocabulary_path))
    shared = spark.sparkContext.broadcast(pieces)
    is_train = F.coalesce(train, F.lit(False))
    group = F.to_json(F.struct(F.col(f"`{by}`").cast("string").alias("v")))  # null and empty differ
    common = docs.where(is_train).groupBy(group.alias("g")).count().orderBy(F.desc("count"), "g").limit(classes)
    sizes = [(r["g"], r["count"]) for r in common.collect()]  # ``classes`` rows at most
    n_train = docs.where(is_train).count()
    if sum(n for _, n in sizes) < n_train:
        sizes = sizes[: classes - 1]
        sizes.append((None, n_train - sum(n for _, n in sizes)))
    k = max(1, len(sizes))
    cls = F.lit(k - 1)
    for i, (name, _) in enumerate(sizes):
        cls = F.when(group == name, F.lit(i)).otherwise(cls) if name is not None else cls
    texts = keyed(docs, id_col, train=is_train, cls=cls)

    cols = [f"c{i}" for i in range(k)]
    made = texts.mapInArrow(_counter(k), "word binary, " + ", ".join(f"{c} bigint" for c in cols))
    words = scratch.stage(made.groupBy("word").agg(*[F.sum(c).alias(c) for c in cols]))
    stats = words.agg(*[
        e for i, c in [*enumerate(cols), ("all", " + ".join(cols))] for e in (
            F.expr(f"sum({c})").alias(f"m{i}"), F.expr(f"count_if({c} > 0)").alias(f"t{i}"),
            F.expr(f"count_if({c} = 1)").alias(f"one{i}"), F.expr(f"count_if({c} = 2)").alias(f"two{i}"),
        )
    ]).first()
    weights = spark.sparkContext.broadcast(fitted_weights(words, shared, start, k, rounds))
    types = "word binary, c bigint, " + ", ".join(f"p{i} double" for i in range(k))
    scored = scratch.stage(words.mapInArrow(_scoring(shared, weights, k, stats), types))

    least, frequent = _frequent(scored, k, limit_bytes)
    held = frequent.toArrow()
    lengths = [len(w) for w in held["word"].to_pylist()]
    joined = np.frombuffer(b" ".join(held["word"].to_pylist()), np.uint8)
    hashes = words_of(joined, np.array([0, len(joined)]))[0] if lengths else np.zeros(0, np.uint64)
    values = np.column_stack([np.ones(len(lengths)), np.log10(held["c"].to_numpy() + 1.0), *[held[f"p{i}"].to_numpy() for i in range(k)]])
    order = np.argsort(hashes)
    table = spark.sparkContext.broadcast((hashes[order], values[order]))

    sums = ["tokens", "known", "base", *[f"s{i}" for i in range(k)]]
    kinds = "_id bigint, _key bigint, word binary, n bigint, " + ", ".join(f"{s} double" for s in sums)
    parts = scratch.stage(texts.select("_id", "_key", "text").mapInArrow(_summing(table, k), kinds))
    n = F.col("n")
    own = parts.where("word is null").select("_id", "_key", n.alias("rows"), *sums)
    looked = parts.where("word is not null").select("_id", "_key", "word", "n").join(scored.where(F.col("c") < least).hint("merge"), "word")
    zero = F.lit(0)
    rare = looked.select(
        "_id", "_key", zero.cast("bigint").alias("rows"), zero.cast("double").alias("tokens"), F.when(F.col("c") > 0, n).otherwise(zero).cast("double").alias("known"),
        (n * F.log10(F.col("c") + 1)).alias("base"), *[(n * F.col(f"p{i}")).alias(f"s{i}") for i in range(k)],
    )
    whole = own.unionByName(rare).groupBy("_id", "_key").agg(F.sum("rows").alias("rows"), *[F.sum(s).alias(s) for s in sums])
    whole = whole.select("_id", "rows", *[(F.col(s) / F.col("rows")).alias(s) for s in sums])

    total = (stats["mall"] or 0) + n_train
    different = stats["tall"] + (1 if n_train else 0)
    ways = []
    for i in range(k):
        docs_in, m = (sizes[i][1] if sizes else 0), stats[f"m{i}"] or 0
        end = (docs_in + 1) / (m + docs_in + 2)
        prior = math.log(docs_in / n_train) if n_train else 0.0
        ways.append(F.col(f"s{i}") + F.col("tokens") * math.log1p(-end) + (prior + math.log(end)))
    best = F.array_max(F.array(*ways))
    score = (best + F.log(sum((F.exp(w - best) for w in ways), F.lit(0.0)))) / math.log(10)
    base = F.col("base") + math.log10(n_train + 1) - (F.col("tokens") + 1) * math.log10(total + different + 1)
    out = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    return out.select(
        plain_id(id_col), (F.round("tokens") + 1).cast("bigint").alias("n_tokens"), (F.round("known") + (1 if n_train else 0)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
    )
