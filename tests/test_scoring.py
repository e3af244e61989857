import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import records as R
from millrace.operators import scoring as S
from millrace.plans import flows

RNG = np.random.default_rng(5)
VECTORS = [(i, [float(np.float32(x)) for x in RNG.normal(size=6)], int(i % 3) * 10) for i in range(60)]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, label int").repartition(4).cache()


@pytest.fixture(scope="module")
def model(vectors):
    return S.fit_centroid_model(vectors)


def expected():
    x = np.array([v for _, v, _ in VECTORS])
    y = np.array([lab for _, _, lab in VECTORS])
    weights = np.stack([x[y == lab].mean(axis=0) for lab in (0, 10, 20)])
    return x @ weights.T - 0.5 * (weights**2).sum(axis=1)


def test_scores_in_both_forms(vectors, model):
    want = expected()
    for form in (S.batch_score, S.batch_score_native):
        for r in form(vectors, model).collect():
            assert r["scores"] == pytest.approx(want[r["vec_id"]])
            assert r["predicted"] == int(want[r["vec_id"]].argmax()) * 10


def test_nulls_neither_fit_nor_fail(spark, vectors, model):
    odd = vectors.unionByName(spark.createDataFrame([(900, None, 10), (901, None, None)], vectors.schema))
    assert S.fit_centroid_model(odd).weights == pytest.approx(model.weights)
    got = {r["vec_id"]: r for r in S.batch_score(odd, model).collect()}
    assert got[900]["scores"] is None and len(got) == 62
    assert S.timed_batch_score(odd, model, "a").count() == 60
    with pytest.raises(ValueError, match="no labelled"):
        S.fit_centroid_model(vectors.where("false"))


def test_timed_scores_feed_the_timing_table(vectors, model):
    want = expected()
    timed = S.timed_batch_score(vectors, model, "a").unionByName(S.timed_batch_score(vectors, model, "b"))
    rows = timed.collect()
    assert len(rows) == 120 and all(r["elapsed_s"] >= 0 and r["predicted"] == want[r["vec_id"]].argmax() * 10 for r in rows)
    times = {r["backend"]: r for r in S.backend_timing(timed, "a").collect()}
    assert times["a"]["n"] == times["b"]["n"] == 60 and times["a"]["speedup"] == 1.0


def test_timing(spark):
    df = spark.createDataFrame([("cpu", 4.0), ("cpu", 2.0), ("fast", 1.0), ("other", 9.0)], "backend string, elapsed_s double")
    got = sorted(tuple(r) for r in S.backend_timing(df, "cpu").collect())
    assert got == [
        ("cpu", 2, 6.0, 3.0, 2.0, 4.0, 2.0, 4.0, 1.0), ("fast", 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 3.0), ("other", 1, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 3.0 / 9.0),
    ]


def test_compare(spark):
    a = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 1.0]), (3, [0.0, 0.0])], "k int, scores array<double>")
    b = spark.createDataFrame([(1, [1.5, 5.0]), (2, [1.0, 2.0]), (4, [0.0, 0.0])], "k int, scores array<double>")
    got = sorted(tuple(r) for r in S.compare_backends(a, b, "k").collect())
    assert got == [(1, 0.5, 1, 1, True), (2, 2.0, 0, 1, False)]


def test_compare_precisions(vectors):
    out = flows.compare_precisions(vectors.withColumn("embedding", A.scale(F.col("embedding"), 8.0)), "vec_id", "embedding", "label")
    assert out.count() == 60 and out.agg(F.max("max_abs_diff")).first()[0] < 0.02


def test_confusion(vectors, model):
    scored = S.batch_score(vectors, model)
    pairs = {(r["label"], r["predicted"]): r["n"] for r in S.confusion(scored, "label", "predicted").collect()}
    assert sum(pairs.values()) == 60
    wide = {r["label"]: r for r in S.confusion_matrix(scored, "label", "predicted", [0, 10, 20]).collect()}
    assert all(wide[t][str(p)] == pairs.get((t, p), 0) for t in (0, 10, 20) for p in (0, 10, 20))


def test_fanout(spark):
    df = spark.range(4)
    assert sorted((r["id"], r["req_no"]) for r in S.request_fanout(df, 3).collect()) == [(i, n) for i in range(4) for n in range(3)]
    assert S.request_fanout(df, 0).count() == 0


def test_matrix_and_scale(spark):
    df = spark.createDataFrame([(1, [255.0, 51.0])], "k int, v array<float>")
    rows = S.matrix_long(S.scale_vectors(df, "v", 255.0), "batch", ["k"]).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0, 1.0), (1, 0, 1, 0.2)]


def test_json_records(spark):
    from pyspark.sql import types as T

    inner = T.StructType().add("a", T.IntegerType()).add("b", T.StringType())
    schema = T.StructType().add("n", T.IntegerType()).add("tags", T.ArrayType(T.StringType())).add("inner", inner)
    texts = ['{"n": 1, "zz": 2, "inner": {"a": 5}}', "{}", '{"n": null, "tags": ["x"]}', "not json", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    record = R.parse_json_record(F.col("t"), schema, {"n": 7, "tags": ["q"], "inner": {"b": "d"}})
    got = [r["r"].asDict(True) for r in df.select("i", record.alias("r")).orderBy("i").collect()]
    plain = {"n": 7, "tags": ["q"], "inner": None}
    assert got == [{**plain, "n": 1, "inner": {"a": 5, "b": "d"}}, plain, {**plain, "tags": ["x"]}, plain, plain]


def test_elapsed(spark):
    row = spark.sql(
        """SELECT timestamp_ntz'2024-01-01 00:00:00.000001' a, timestamp_ntz'2024-01-02 00:00:00.5' b,
                  timestamp'2024-01-01 00:00:00' c, timestamp'2024-01-01 00:00:00.25' d, 1.5D e, 2.0D f"""
    ).select(
        R.elapsed_ms(F.col("a"), F.col("b")), R.elapsed_ms(F.col("c"), F.col("d")), R.elapsed_seconds_ms(F.col("e"), F.col("f")),
        R.render_ms(F.lit(0.25)), R.epoch_text(F.lit("1970-01-01 00:00:01.5").cast("timestamp")),
    ).first()
    assert tuple(row) == (86400499.999, 250.0, 500.0, "0.250 ms", "1.500000")


def test_percentiles_are_within_the_stated_rank(spark):
    n, accuracy = 200_000, 1_000
    df = spark.range(0, n, 1, 8).select(F.lit("b").alias("backend"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 1.0).alias("elapsed_s"))
    row = S.backend_timing(df, "b", accuracy=accuracy).first()
    assert abs(row["p50_s"] - 0.5 * n) <= n / accuracy + 1 and abs(row["p95_s"] - 0.95 * n) <= n / accuracy + 1
    exact = S.backend_timing(df.where("elapsed_s < 1000"), "b").first()
    assert (exact["p50_s"], exact["p95_s"]) == (499.0, 949.0)


def test_too_many_labels_for_a_model_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(S, "MODEL_LABELS", 3)
    df = spark.range(8).select((F.col("id") % 4).cast("int").alias("label"), F.array(F.lit(1.0)).alias("embedding"))
    with pytest.raises(ValueError, match="labels"):
        S.fit_centroid_model(df)
    assert S.fit_centroid_model(df.where("label < 3")).labels == [0, 1, 2]


def test_best_labels_in_blocks_are_those_of_the_small_model(spark, vectors, model):
    want = expected()
    odd = vectors.unionByName(vectors).unionByName(spark.createDataFrame([(900, None, 10)], vectors.schema))
    got = S.best_labels(odd, S.class_centroids(vectors), block_labels=1, slice_rows=7).collect()
    assert len(got) == 121 and [(r["predicted"], r["best_score"]) for r in got if r["vec_id"] == 900] == [(None, None)]
    for r in got:
        if r["vec_id"] != 900:
            assert r["predicted"] == want[r["vec_id"]].argmax() * 10 and r["best_score"] == pytest.approx(want[r["vec_id"]].max())


def test_best_labels_takes_models_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(S, "MODEL_LABELS", 3)
    on_circle = lambda angle: F.array(F.cos(angle), F.sin(angle))
    n = 20_000
    centroids = spark.range(n).select(F.concat(F.lit("l"), "id").alias("label"), on_circle(F.col("id") * (2 * np.pi / n)).alias("mean"))
    df = spark.range(0, n, 97).select("id", on_circle((F.col("id") + 0.2) * (2 * np.pi / n)).alias("embedding"))
    rows = S.best_labels(df, centroids, block_labels=1500).collect()
    assert len(rows) == len(range(0, n, 97)) and all(r["predicted"] == f"l{r['id']}" for r in rows)


def test_best_labels_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(300)], "k int, embedding array<double>")
    centroids = spark.createDataFrame([(7, [1.0, 1.0]), (3, [1.0, 1.0]), (9, [1.0, -1.0]), (1, [0.0, 5.0])], "label int, mean array<double>")
    for block in (1, 2, 10):
        rows = S.best_labels(df, centroids, block_labels=block, slice_rows=20).collect()
        assert len(rows) == 300 and {(r["predicted"], r["best_score"]) for r in rows} == {(3, 0.0)}
    assert S.best_labels(df.where("false"), centroids).collect() == []
    with pytest.raises(ValueError, match="no labelled"):
        S.best_labels(df, centroids.where("false"))


def test_exact_percentiles_lie_between_times(spark):
    rng = np.random.default_rng(7)
    times = {"a": rng.normal(size=5001), "b": np.repeat(4.0, 3000), "c": rng.integers(0, 50, 997) / 4, None: np.array([1.0, 3.0])}
    rows = [(b, float(v)) for b, values in times.items() for v in values] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "backend string, elapsed_s double").repartition(5)
    got = {r["backend"]: r for r in S.backend_timing(df, "b", accuracy=None).collect()}
    assert set(got) == {*times, "none"} and got["none"]["n"] == 0 and got["none"]["p50_s"] is None
    for b, values in times.items():
        assert got[b]["n"] == len(values) and got[b]["mean_s"] == pytest.approx(values.mean())
        assert (got[b]["p50_s"], got[b]["p95_s"]) == pytest.approx((np.quantile(values, 0.5), np.quantile(values, 0.95)))


def test_the_registered_timing_is_exact():
    import inspect

    from millrace.plans import catalog, oracles

    assert "quantile_cont" in oracles.ORACLES["backend_timing"]
    assert "accuracy=None" in inspect.getsource(catalog.QUERIES["backend_timing"])
