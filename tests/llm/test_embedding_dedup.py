import numpy as np
from pyspark.sql import types as T

from millrace.llm import embedding_dedup
from millrace.llm.embedding_dedup import embedding_classes, quantised

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())])


def brute(rows, threshold):
    n = len(rows)
    good = [lab is not None and v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v, lab, _ in rows]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i in range(n):
        low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], low[find(i)], low[find(i)] == rows[i][0]) for i in range(n))


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 40)
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), [float(np.float32(v)) for v in base + rng.normal(size=16) * rng.choice([0, 0.15, 0.27, 0.3])], int(rng.integers(0, 2)), None))
    drift = rng.normal(size=16)
    for _ in range(40):
        drift = drift + rng.normal(size=16) * 0.2
        rows.append((len(rows), [float(np.float32(v)) for v in drift], 5, None))
    for v, lab in ((None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([float("inf")] * 16, 1), ([1.0] * 16, None), ([1.0] * 8, 1), ([2.0] * 8, 1), ([1e-30] * 16, 7), ([1e30] * 16, 7)):
        rows.append((len(rows), v, lab, None))
    got = embedding_classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 0.93)


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(200, 24)) * rng.lognormal(0, 2, size=(200, 24))
    u /= np.linalg.norm(u, axis=1)[:, None]
    q, s, e = quantised(u)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(near - u @ u.T) <= e[:, None] * (1 + e[None, :]) + e[None, :] + 1e-12).all()


def test_empty_table_and_repeated_ids(spark):
    assert embedding_classes(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(4, [1.0, 2.0], 1, None)] * 2 + [(None, [1.0, 2.1], 1, None)]
    got = embedding_classes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.n_links for r in got] == [2, 2, 2] and {r.component_id for r in got} == {None}
