import itertools
import random
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import packing
from millrace.llm.packing import batch_texts, best_bounds, length_batches, rounded_up

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("bucket", T.StringType())])


def cost(bounds, points, counts):
    return sum(n * min(b for b in bounds if b >= p) for p, n in zip(points, counts))


def test_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        points = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 50) for _ in points]
        for k in (1, 2, 3, 20):
            best = min(cost((*c, points[-1]), points, counts) for j in range(min(k, len(points))) for c in itertools.combinations(points[:-1], j))
            got = best_bounds(points, counts, k)
            assert len(got) <= k and got[-1] == points[-1] and cost(got, points, counts) == best
    assert best_bounds([], [], 4) == []


def test_rounding(spark):
    got = spark.range(0, 5000).select("id", rounded_up(F.col("id")).alias("r")).collect()
    assert all(r.r >= max(r.id, 1) and r.r <= max(r.id, 1) * (1 + 1 / 128) and (r.id > 256 or r.r == max(r.id, 1)) for r in got)


def test_batches_fit_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 40)
    rng = random.Random(2)
    sizes = [0, None, 500, 900] + [rng.choice([3, 3, 3, rng.randrange(1, 60)]) for _ in range(400)]
    rows = [(i, None if n is None else " ".join(["w"] * n), "x") for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = length_batches(df, token_budget=200, buckets=5).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens == (sizes[r.doc_id] or 0) <= r.bucket_length
        batches[r.batch_id].append(r)
    short = defaultdict(int)
    for rs in batches.values():
        room = max(1, 200 // rs[0].bucket_length)
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and len(rs) <= room and len({r.bucket for r in rs}) == 1
        short[rs[0].bucket] += len(rs) < room
    assert len({r.bucket for r in got}) <= 5 and max(short.values()) <= 1
    texts = batch_texts(df, length_batches(df, 200, 5)).collect()
    assert sum(len(t.ids) for t in texts) == len(rows)


def test_odd_tables(spark):
    assert length_batches(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "a b", None), (1, "a", None), (1, "a", None)]
    assert len(length_batches(spark.createDataFrame(rows, SCHEMA)).collect()) == 3
    own = length_batches(spark.createDataFrame(rows, SCHEMA), length=F.lit(7).cast("bigint"))
    assert {r.n_tokens for r in own.collect()} == {7}
