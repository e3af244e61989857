"""A document quality classifier: random-indexing word vectors, a two-layer network, calibrated scores.

1. Tokens are runs of letters (folded to lower case), of capitals, of digits and of other signs. Their
   hashes fall into ``BUCKETS`` rows. Every row gathers the sparse random index vectors of the
   tokens within two places, over the whole corpus: its random-indexing vector.
2. A document is the mean and the deviation of its tokens' vectors, with a few shares of signs and
   repeats of the text. Each of these covers the whole text.
3. A network with one hidden layer is fitted by numpy on labelled documents (at most ``max_train``, a
   bounded sample by hash of the id; the only sample there is). A part that the fit never sees sets
   the temperature that calibrates the probabilities. Weights balance the classes in the fit; an
   offset found with the temperature takes that back, so a score is a probability.

Only the text is an input of a score. Null and empty texts have vectors of zeros and are scored
like any other; documents without any label table rows to learn from score 0.5. Labels for ids that
aren't documents, and null labels, play no part; of repeated labels the largest counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, U, keyed, mix, per_row, plain_id, powers, text_slices
from millrace.llm.sums import summed
from millrace.operators.index import narrowed

BUCKETS = 1 << 14
DIMS = 64
MARKS = 2
REACH = 2
SHARES = 9
HIDDEN = 48
MAX_TRAIN = 20_000

# Classes of bytes. Letters beyond ASCII count as small letters.
_CLASS = np.full(256, 4, np.uint8)
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 5
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def runs(data: np.ndarray, offs: np.ndarray):
    """``(bucket, kind, row, length)`` of the runs of one kind of byte; a capital may open a word."""
    n = len(data)
    kind = _CLASS[data]
    nxt = np.append(kind[1:], 0)
    before = np.append(0, kind[:-1]) if n else kind
    kind = np.where((kind == 2) & (nxt == 1) & (before != 2), 1, kind).astype(np.uint8)
    new = np.ones(n, bool)
    new[1:] = kind[1:] != kind[:-1]
    cuts = offs[1:-1]
    new[cuts[(cuts > 0) & (cuts < n)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], n) if n else start
    row = np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))
    power, back = powers(n)
    total = np.zeros(n + 1, U)
    np.cumsum((_FOLD[data].astype(U) + U(1)) * power[:n], out=total[1:])
    k = kind[start]
    h = mix((total[end] - total[start]) * back[start] + (end - start).astype(U) + (k == 2).astype(U) * U(1 << 40))
    word = (k != 0) & (k != 5)
    return (h[word] >> U(50)).astype(np.int64) % BUCKETS, k[word], row[word], (end - start)[word]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ``MARKS`` non-zero components of every bucket's index vector."""
    h = mix(np.arange(BUCKETS * MARKS).astype(U) + U(0x1234567))
    return (h % U(DIMS)).astype(np.int64).reshape(BUCKETS, MARKS), (1.0 - 2.0 * ((h >> U(32)) & U(1)).astype(float)).reshape(BUCKETS, MARKS)


def gather(batch: pa.RecordBatch, total: np.ndarray) -> None:
    """Add the index vectors of every token's neighbours to the token's row."""
    place, sign = index_vectors()
    for _, _, data, offs in text_slices(batch["text"], 1 << 20):
        bucket, _, row, _ = runs(data, offs)
        at, weight = [], []
        for d in range(1, REACH + 1):
            a, b = bucket[:-d], bucket[d:]
            close = row[:-d] == row[d:]
            a, b = a[close], b[close]
            for m in range(MARKS):
                at += [a * DIMS + place[b, m], b * DIMS + place[a, m]]
                weight += [sign[b, m], sign[a, m]]
        total += np.bincount(np.concatenate(at), np.concatenate(weight), len(total))


def word_vectors(rows: DataFrame) -> np.ndarray:
    """The random-indexing vectors ``(BUCKETS, DIMS)`` of all texts, 4 MB whatever the corpus."""
    out = summed(rows.select("text"), gather, BUCKETS * DIMS).reshape(BUCKETS, DIMS)
    out = np.sign(out) * np.sqrt(np.abs(out))
    out /= np.maximum(np.sqrt((out * out).sum(axis=1)), 1e-9)[:, None]
    return out.astype(np.float32)


def pooled(data: np.ndarray, offs: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``(rows, 2 * DIMS + SHARES)`` features of whole texts."""
    n = len(offs) - 1
    bucket, kind, row, length = runs(data, offs)
    bounds = per_row(row, n)
    count = np.diff(bounds)
    some = count > 0
    mean, square = np.zeros((n, DIMS), np.float32), np.zeros((n, DIMS), np.float32)
    if some.any():
        x = vectors[bucket]
        mean[some] = np.add.reduceat(x, bounds[:-1][some], axis=0)
        x *= x
        square[some] = np.add.reduceat(x, bounds[:-1][some], axis=0)
    div = np.maximum(count, 1)[:, None]
    mean /= div
    deviation = np.sqrt(np.maximum(square / div - mean * mean, 0))
    share = np.zeros((n, SHARES), np.float32)
    for j, k in enumerate((1, 2, 3, 4)):
        share[:, j] = np.bincount(row[kind == k], minlength=n) / div[:, 0]
    share[:, 4] = np.log1p(np.bincount(row, length, n) / div[:, 0])  # float16 holds it however long a run is
    share[:, 5] = np.log1p(count) / 10
    pair = np.unique(row * BUCKETS + bucket)
    share[:, 6] = np.bincount(pair // BUCKETS, minlength=n) / div[:, 0]
    size = np.diff(offs)
    share[:, 7] = np.bincount(row[kind == 4], length[kind == 4], n) / np.maximum(size, 1)
    three = (bucket[:-2] * 31 + bucket[1:-1]) * 31 + bucket[2:] if len(bucket) > 2 else bucket[:0]
    at = row[: len(three)]
    inside = at == row[2:] if len(three) else np.zeros(0, bool)
    three = np.unique(at[inside] * (1 << 40) + three[inside] % (1 << 40))
    share[:, 8] = np.bincount(three >> 40, minlength=n) / np.maximum(count - 2, 1)
    return np.concatenate([mean, deviation, share], axis=1)


def _feature_rows(vectors: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_slices(batch["text"]):
                x = pooled(data, offs, vectors).astype(np.float16)
                cut = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([cut["_id"], cut["_key"], pa.array([r.tobytes() for r in x], pa.binary())], ["_id", "_key", "features"])

    return run


class Network:
    """Two layers: tanh units and one logistic output; scores are calibrated by temperature and offset."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 60):
        rng = np.random.default_rng(seed)
        self.constant = None
        if len(y) == 0:
            self.constant = 0.5
            return
        if y.min() == y.max():
            self.constant = (y.sum() + 1) / (len(y) + 2)
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        held = np.arange(len(y)) % 5 == 4 if min(y.sum(), len(y) - y.sum()) >= 10 else np.zeros(len(y), bool)
        z, t = ((x - self.mean) / self.scale)[~held], y[~held]
        if t.min() == t.max():
            held[:] = False
            z, t = (x - self.mean) / self.scale, y
        balance = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean()))
        w = [rng.normal(size=(z.shape[1], HIDDEN)) / np.sqrt(z.shape[1]), np.zeros(HIDDEN), rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        size = min(256, len(t))
        for _ in range(epochs):
            order = rng.permutation(len(t))
            for lo in range(0, len(t), size):
                i = order[lo : lo + size]
                a = np.tanh(z[i] @ w[0] + w[1])
                g = (1 / (1 + np.exp(-np.clip(a @ w[2] + w[3], -30, 30))) - t[i]) * balance[i] / len(i)
                back = g[:, None] * w[2] * (1 - a * a)
                grads = [z[i].T @ back + 1e-4 * w[0], back.sum(axis=0), a.T @ g + 1e-4 * w[2], g.sum(keepdims=True)]
                step += 1
                for k, d in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    w[k] = w[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.w = w
        self.heat, self.offset = 1.0, 0.0
        part = held if held.any() else np.ones(len(y), bool)
        s, t = self.logit(x[part]), y[part]
        best = None
        for heat in np.geomspace(0.25, 8, 21):
            for offset in np.linspace(-4, 4, 41):
                p = np.clip(1 / (1 + np.exp(-(s / heat + offset))), 1e-6, 1 - 1e-6)
                loss = -(t * np.log(p) + (1 - t) * np.log(1 - p)).mean()
                if best is None or loss < best[0]:
                    best = (loss, heat, offset)
        _, self.heat, self.offset = best

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.heat + self.offset, -30, 30)))


def _unpacked(features: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(features), np.float16).reshape(len(features), -1).astype(np.float64)


def held_out(ident: Column) -> Column:
    """Rows kept from the fit: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.3, max_train: int = MAX_TRAIN,
) -> DataFrame:
    """``(_id, _key, doc_id, held_out, score, predicted)``: one row a document."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = keyed(docs, id_col, text_col)
    vectors = word_vectors(rows)
    features = scratch.stage(rows.mapInArrow(_feature_rows(vectors), "_id bigint, _key bigint, features binary"))
    known = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg(F.max("y").alias("y"))
    # The bound is found first, so that no partition sends ``max_train`` rows of its own.
    joined = scratch.stage(features.join(known.hint("merge"), "_id").withColumn("_h", F.xxhash64("_id")))
    by_hash = ["_h", "_id", "_key"]
    sample = narrowed(joined, by_hash, max_train).orderBy(*by_hash).limit(max_train).select("features", "y").toPandas()
    net = Network(_unpacked(sample["features"]), sample["y"].to_numpy().astype(float)) if len(sample) else Network(np.zeros((0, 1)), np.zeros(0))

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(net.score(_unpacked(column)))

    out = features.select("_id", "_key", plain_id(id_col), score("features").alias("score"))
    return out.select(
        "_id", "_key", id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
