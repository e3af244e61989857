import random

import pytest

from millrace.operators import context as CX
from pyspark.sql import functions as F


def conversation_rows(offset=0):
    rng = random.Random(3)
    rows = []
    for key in range(12):
        turns = 150 if key == 0 else rng.randint(1, 9)
        for turn in rng.sample(range(400), turns):
            rows.append((key, turn + offset, " ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.choice([0, 0, 1, 2, 3, 9, 40])))))
    return rows


def by_key(rows):
    keys = {}
    for key, turn, text in sorted(rows):
        keys.setdefault(key, []).append((turn, text))
    return keys


@pytest.mark.parametrize("offset", [0, -200])
@pytest.mark.parametrize("block", [5, 64, CX.BLOCK])
def test_transcript_delta(spark, block, offset):
    rows = conversation_rows(offset)
    want = {}
    for key, turns in by_key(rows).items():
        seen = 0
        for turn, text in turns:
            want[key, turn] = text[seen:]
            seen = len(text)
    df = spark.createDataFrame(rows, "k int, t bigint, text string").repartition(5)
    got = {(r["k"], r["t"]): r["delta"] for r in CX.transcript_delta(df, "k", "t", block=block).collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 7, 100])
@pytest.mark.parametrize("block", [5, 64, CX.BLOCK])
def test_context_tail(spark, block, n):
    rows = conversation_rows()
    want = {}
    for key, turns in by_key(rows).items():
        said = []
        for turn, text in turns:
            said += text.split()
            want[key, turn] = said[-n:]
    df = spark.createDataFrame(rows, "k int, t bigint, text string").select(
        "k", "t", F.regexp_extract_all("text", F.lit(r"[^ ]+"), F.lit(0)).alias("words")
    )
    out = CX.context_tail(df, "k", "t", "words", n, block=block)
    got = [((r["k"], r["t"]), r["context"]) for r in out.collect()]
    assert len(got) == len(rows) and dict(got) == want


def test_growing_messages(spark):
    df = spark.createDataFrame([(1, 0, "ab"), (1, 1, "abcd"), (1, 2, "abcd😀")], "k int, t int, text string")
    assert [r["delta"] for r in CX.transcript_delta(df, "k", "t").orderBy("t").collect()] == ["ab", "cd", "😀"]


def test_order_of_any_type(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (1, 9.0, "bcd"), (1, 10.0, "bcdef"), (None, 1.0, "x")], "k int, t double, text string")
    got = {(r["k"], r["t"]): r["delta"] for r in CX.transcript_delta(df, "k", "t", block=2).collect()}
    assert got == {(1, 0.5): "a", (1, 9.0): "cd", (1, 10.0): "ef", (None, 1.0): "x"}


def test_repeated_order_is_an_error(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 10**9, "b"), (1, 10**9, "c")], "k int, t bigint, text string")
    with pytest.raises(Exception, match="same order"):
        CX.transcript_delta(df, "k", "t", block=100).collect()


def spread(spark):
    """A third of the rows under one key, a million apart, in no order; the others under many keys."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(77)).otherwise(F.col("id") % 400)
    df = spark.range(0, 30_000, 1, 6).select(hot.alias("k"), (F.pmod(F.col("id") * 7919, F.lit(30_000)) * 10**6).alias("t"), F.col("id").alias("v"))
    return df.withColumn("text", F.expr("repeat('x', int(v % 13))"))


def test_hot_key_with_gaps_is_spread(spark, monkeypatch):
    df, seen = spread(spark), []
    real = CX.stage
    monkeypatch.setattr(CX, "stage", lambda frame, label: seen.append(real(frame, label)) or seen[-1])
    rows = [tuple(r) for r in df.select("k", "t", "text").collect()]
    want = {}
    for key, turns in by_key(rows).items():
        before = 0
        for t, x in turns:
            want[key, t] = x[before:]
            before = len(x)
    out = CX.transcript_delta(df, "k", "t", block=1000)
    assert {(r["k"], r["t"]): r["delta"] for r in out.collect()} == want
    assert all("text" not in frame.columns for frame in seen)
    sizes = [r["count"] for r in seen[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) == 30 and max(sizes) < 2 * 1000


def test_running_sums_over_partitions(spark):
    df = spread(spark).select("k", "t", F.when(F.col("v") % 5 > 0, F.col("v")).alias("v"))
    want, total = {}, {}
    for k, t, v in sorted(((r["k"], r["t"], r["v"]) for r in df.collect()), key=lambda r: r[:2]):
        total[k] = total.get(k, 0) + (v or 0)
        want[k, t] = total[k]
    out = CX.with_running_sum(df, "k", "t", F.coalesce("v", F.lit(0)), "s", block=700)
    assert {(r["k"], r["t"]): r["s"] for r in out.collect()} == want


def test_empty(spark):
    df = spark.createDataFrame([], "k int, t int, text string")
    assert CX.transcript_delta(df, "k", "t").count() == 0
