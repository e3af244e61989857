"""Batch scoring, timing and comparison of scoring backends."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import arrays as A
from millrace.session import stage

#: Labels that a model held by every task may have.
MODEL_LABELS = 100_000


@dataclass(frozen=True)
class LinearModel:
    """Scores are ``weights @ x + bias``, one for each label."""

    labels: list[int]
    weights: np.ndarray
    bias: np.ndarray


def class_centroids(df: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Mean vector of each label as ``label, mean``; one row a label and task crosses the network.

    Rows with a null label or vector play no part; vectors of unequal lengths are an error.
    """
    known = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    dense = known.select(label, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    return dense.groupBy(label).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("mean"))


def fit_centroid_model(df: DataFrame, vector: str = "embedding", label: str = "label") -> LinearModel:
    """Nearest-centroid classifier in linear form, from means computed on the cluster.

    The model is what every scoring task holds, so it must be small: one row a label comes to the driver, in
    one job, and more than ``MODEL_LABELS`` labels are an error rather than a driver out of memory.
    """
    rows = class_centroids(df, vector, label).limit(MODEL_LABELS + 1).collect()
    if len(rows) > MODEL_LABELS:
        raise ValueError(f"over {MODEL_LABELS} labels are no linear model to hold in every task")
    means = sorted((r[label], list(r["mean"])) for r in rows)
    if not means:
        raise ValueError("no labelled vectors to fit a model on")
    weights = np.array([m for _, m in means])
    return LinearModel([v for v, _ in means], weights, -0.5 * (weights**2).sum(axis=1))


def request_fanout(df: DataFrame, num_reqs: int) -> DataFrame:
    """Each input ``num_reqs`` times, numbered by ``req_no``, without a cartesian product."""
    return df.withColumn("req_no", F.explode(F.sequence(F.lit(0), F.lit(num_reqs - 1)))) if num_reqs > 0 else df.where("false").withColumn("req_no", F.lit(0))


def batch_score(df: DataFrame, model: LinearModel, vector: str = "embedding", batch_size: int = 1024) -> DataFrame:
    """Add ``scores`` and the best ``predicted`` label.

    The model is set up once in each Python worker and applied to Arrow batches.
    """
    weights, bias = model.weights, model.bias

    def make_predict():
        import numpy as np

        transposed = np.ascontiguousarray(weights.T)

        def predict(inputs):
            return np.asarray(inputs, dtype="float64") @ transposed + bias

        return predict

    score = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[weights.shape[1]]]
    )
    # A null vector is scored as zeros inside and gets null scores.
    zeros = F.array_repeat(F.lit(0.0), weights.shape[1])
    scored = df.withColumn("scores", score(F.coalesce(F.col(vector).cast("array<double>"), zeros)))
    scored = scored.withColumn("scores", F.when(F.col(vector).isNotNull(), F.col("scores")))
    return scored.withColumn("predicted", _label(model))


def batch_score_native(df: DataFrame, model: LinearModel, vector: str = "embedding") -> DataFrame:
    """The same columns without leaving the JVM."""
    dot = lambda w: F.aggregate(
        F.zip_with(F.col(vector), F.lit([float(x) for x in w]), lambda a, b: a.cast("double") * b),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    scores = F.array(*[dot(w) + F.lit(float(b)) for w, b in zip(model.weights, model.bias)])
    return df.withColumn("scores", scores).withColumn("predicted", _label(model))


def _label(model: LinearModel):
    return F.get(F.lit([int(v) for v in model.labels]), A.argmax(F.col("scores")))


def best_labels(
    df: DataFrame, centroids: DataFrame, vector: str = "embedding", label: str = "label", block_labels: int = 4096, slice_rows: int = 4096
) -> DataFrame:
    """Add ``predicted`` and ``best_score``, the best label of a model *table* of any number of labels.

    ``centroids`` is ``label, mean`` as ``class_centroids`` gives it, one row a label; the scores are
    those of ``batch_score``. The labels are dealt into blocks and the different vectors into slices;
    a task multiplies one slice by one block and keeps the best label of each vector, and the best
    over all blocks is a minimum with map-side combine. So no row of the model reaches the driver, no
    task holds more than a block, and equal vectors are scored once however many they are.

    Of equal scores the least label wins. Null vectors have null results, and an empty model is an
    error, as are vectors of another length than the means.
    """
    x = F.col(vector).cast("array<double>")
    model = stage(centroids.select(F.col(label).alias("_label"), F.col("mean").alias("_mean")), "model")
    given = df.where(F.col(vector).isNotNull()).select(x.alias("_x")).distinct()
    vectors = stage(given.select("_x", F.monotonically_increasing_id().alias("_vid")), "vectors")
    blocks, slices = -(-model.count() // block_labels), max(1, -(-vectors.count() // slice_rows))
    if not blocks:
        raise ValueError("no labelled vectors to fit a model on")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.withColumn("_slice", F.pmod(F.xxhash64("_vid"), F.lit(slices)).cast("int")).withColumn("_block", every(blocks))
    right = model.withColumn("_block", F.pmod(F.xxhash64("_label"), F.lit(blocks)).cast("int")).withColumn("_slice", every(slices))

    def product(pairs, held):
        import pandas as pd

        if not len(pairs) or not len(held):
            return pd.DataFrame({"_vid": [], "_loss": [], "_label": []})
        held = held.sort_values("_label")
        weights = np.stack(held["_mean"].to_numpy())
        bias = -0.5 * (weights**2).sum(axis=1)
        rows = pairs["_x"].to_numpy()
        at, top = [], []
        for lo in range(0, len(rows), 512):
            scores = np.stack(rows[lo : lo + 512]) @ weights.T + bias
            best = scores.argmax(axis=1)
            at.append(best)
            top.append(scores[np.arange(len(best)), best])
        return pd.DataFrame({"_vid": pairs["_vid"].to_numpy(), "_loss": -np.concatenate(top), "_label": held["_label"].to_numpy()[np.concatenate(at)]})

    kind = model.schema["_label"].dataType.simpleString()
    local = left.groupBy("_slice", "_block").cogroup(right.groupBy("_slice", "_block")).applyInPandas(product, f"_vid bigint, _loss double, _label {kind}")
    best = local.groupBy("_vid").agg(F.min(F.struct("_loss", "_label")).alias("_best"))
    found = vectors.join(best, "_vid").select("_x", F.col("_best._label").alias("predicted"), (-F.col("_best._loss")).alias("best_score"))
    return df.withColumn("_x", x).join(found.hint("merge"), "_x", "left").drop("_x")


def timed_batch_score(df: DataFrame, model: LinearModel, backend: str, vector: str = "embedding") -> DataFrame:
    """Score with wall time around each model call: ``backend, scores, predicted, elapsed_s``.

    ``elapsed_s`` is the time of the call divided over the rows of its Arrow batch; rows with a null
    vector are not scored and not returned.
    """
    weights, bias, labels = model.weights, model.bias, np.asarray(model.labels)

    def run(batches):
        clock = time.perf_counter
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf[pdf[vector].notna()]
            if not len(pdf):
                continue
            x = np.stack(pdf[vector].to_numpy()).astype("float64")
            start = clock()
            scores = x @ weights.T + bias
            elapsed = clock() - start
            yield pdf.drop(columns=[vector]).assign(
                backend=backend,
                scores=list(scores),
                predicted=labels[scores.argmax(axis=1)],
                elapsed_s=elapsed / len(pdf),
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != vector]
    schema = ", ".join([*kept, "backend string", "scores array<double>", "predicted int", "elapsed_s double"])
    return df.mapInPandas(run, schema)


def _exact_percentiles(times: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``backend, exact``: the percentiles of ``elapsed`` in a backend, between two times where the rank is; pass staged rows.

    Equal times are counted once and dealt by ranges of (backend, time). The counts of the partitions, a row
    each and backend, tell which of them hold the wanted ranks, and only these are numbered.
    """
    counts = times.where(F.col("elapsed").isNotNull()).groupBy("backend", "elapsed").agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange("backend", "elapsed")
    placed = stage(ranged.withColumn("_part", F.spark_partition_id()), "ordered-times")
    parts = stage(placed.groupBy("backend", "_part").agg(F.sum("_n").alias("_in")), "times-of-parts")
    whole = Window.partitionBy("backend")
    upto = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_end", F.sum("_in").over(upto)).withColumn("_all", F.sum("_in").over(whole))
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("_all") - 1) * F.lit(float(q))).alias("at")) for i, q in enumerate(shares)]))
    wanted = parts.withColumn("_p", place).select("*", F.explode(F.array_distinct(F.array(F.floor("_p.at"), F.ceil("_p.at")))).alias("_rank"))
    wanted = wanted.where((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("_in")))
    wanted = stage(wanted.select("backend", "_part", "_p", "_rank", (F.col("_end") - F.col("_in")).alias("_before")), "wanted-ranks")
    # Few rows: two ranks for each share of a backend.
    asked = lambda df: F.broadcast(df.withColumnsRenamed({"backend": "_b", "_part": "_q"}))
    same = F.col("backend").eqNullSafe(F.col("_b")) & (F.col("_part") == F.col("_q"))
    inside = Window.partitionBy("backend", "_part").orderBy("elapsed").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = placed.join(asked(wanted.select("backend", "_part", "_before").distinct()), same).withColumn("_upto", F.sum("_n").over(inside) + F.col("_before")).drop("_b", "_q", "_before")
    found = held.join(asked(wanted.drop("_before")), same & (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    ends = found.groupBy("backend", "_p").agg(F.min("elapsed").alias("lo"), F.max("elapsed").alias("hi"))
    between = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("_p.at") - F.floor("_p.at"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("double")).otherwise(between)
    return ends.groupBy("backend").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p.i", value.alias("v")))), lambda x: x["v"]).alias("exact"))


def backend_timing(
    df: DataFrame, base: str, backend: str = "backend", elapsed: str = "elapsed_s", accuracy: int | None = 100_000
) -> DataFrame:
    """Time spent on each backend, its median and 95th percentile, and its speed relative to ``base``.

    With ``accuracy`` None the percentiles are exact, between the two times next to the rank where it is no whole
    number; no task holds all times of a backend. Else they come from a mergeable sketch of bounded
    size: each is a time that occurs, off by at most ``n / accuracy`` ranks, and the exact one of these while a
    backend has fewer times than ``accuracy``.

    One aggregate with map-side combine gives a row a backend, whichever there are (null among
    them); the speed is null where ``base`` has no times.
    """
    times = df.select(F.col(backend).alias("backend"), F.col(elapsed).alias("elapsed"))
    # Measured times differ when they are taken again.
    times = stage(times, "times") if accuracy is None else times
    e = F.col("elapsed")
    shares = {"p50_s": 0.5, "p95_s": 0.95}
    sketched = [F.percentile_approx(e, q, accuracy).alias(name) for name, q in shares.items()] if accuracy is not None else []
    stats = times.groupBy("backend").agg(
        F.count(e).alias("n"), F.sum(e).alias("total_s"), F.avg(e).alias("mean_s"), F.min(e).alias("min_s"), F.max(e).alias("max_s"), *sketched
    )
    if accuracy is None:
        exact = stage(_exact_percentiles(times, list(shares.values())).withColumnRenamed("backend", "_b"), "percentiles")
        picked = [F.col("exact")[i].alias(name) for i, name in enumerate(shares)]
        stats = stats.join(F.broadcast(exact), F.col("backend").eqNullSafe(F.col("_b")), "left").select(*stats.columns, *picked)
    # Few rows meet here, one a backend; the base is taken from the same pass as the rest.
    whole = stats.agg(F.max(F.when(F.col("backend") == base, F.col("mean_s"))).alias("_base"), F.collect_list(F.struct(*stats.columns)).alias("_rows"))
    rows = whole.select("_base", F.inline("_rows"))
    return rows.withColumn("speedup", F.col("_base") / F.col("mean_s")).drop("_base")


def compare_backends(a: DataFrame, b: DataFrame, key: str, scores: str = "scores") -> DataFrame:
    """Two backends' scores per input: largest absolute difference and whether the best one agrees.

    One row an input on each side, joined on its key; the arrays are compared in place.
    """
    left = a.select(key, F.col(scores).alias("_a"))
    right = b.select(key, F.col(scores).alias("_b"))
    uneven = F.raise_error("scores of unequal length").cast("double")
    diff = F.when(F.size("_a") != F.size("_b"), uneven).otherwise(F.array_max(F.zip_with("_a", "_b", lambda x, y: F.abs(x - y))))
    return left.join(right, key, "inner").select(
        key,
        diff.alias("max_abs_diff"),
        A.argmax(F.col("_a")).alias("argmax_a"),
        A.argmax(F.col("_b")).alias("argmax_b"),
        (A.argmax(F.col("_a")) == A.argmax(F.col("_b"))).alias("agree"),
    )


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Count of each (truth, predicted) pair."""
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: Sequence[int]) -> DataFrame:
    """The wide form: one row a true label, one column a predicted one."""
    return df.groupBy(truth).pivot(predicted, list(labels)).count().na.fill(0)


def scale_vectors(df: DataFrame, vector: str, factor: float, name: str = "batch") -> DataFrame:
    """Values divided by ``factor`` and wrapped in a batch dimension of one."""
    return df.withColumn(name, F.array(A.scale(F.col(vector), factor)))


def matrix_long(df: DataFrame, matrix: str, key: Sequence[str]) -> DataFrame:
    """A matrix column as ``key, row, col, value``."""
    rows = df.select(*key, F.posexplode(matrix).alias("row", "_values"))
    return rows.select(*key, "row", F.posexplode("_values").alias("col", "value"))
