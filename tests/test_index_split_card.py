import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import card, index, split
from millrace.operators.dedup import dedup_keep_first, dedup_rows


@pytest.fixture(scope="module")
def hot(spark):
    """A third and more of the rows under one key."""
    rows = [("hot" if i % 5 < 2 else f"k{i % 7}", i, f"v{i % 11}") for i in range(500)]
    return spark.createDataFrame(rows, "k string, i bigint, v string")


@pytest.mark.parametrize("parts", [1, 7])
def test_row_index_follows_order(hot, parts):
    got = {(r["k"], r["i"]): r["row_index"] for r in index.with_row_index(hot.repartition(parts), ["k", "i"]).collect()}
    assert got == {key: n for n, key in enumerate(sorted(got))} and len(got) == 500


def test_row_index_of_nothing(hot):
    assert index.with_row_index(hot.where("false"), ["i"]).count() == 0


def test_batches(hot):
    sizes = index.with_batch_id(hot, ["i"], 8).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [8] * 62 + [4]


def test_limits(hot, monkeypatch):
    first = lambda n: [r["i"] for r in index.limit_rows(hot, ["i"], n).orderBy("i").collect()]
    assert first(5) == list(range(5)) and len(first(0)) == len(first(None)) == 500
    monkeypatch.setattr(index, "LIMIT_IN_ONE_TASK", 3)
    assert first(17) == list(range(17))
    assert [r["i"] for r in index.head_rows(hot, ["i"]).collect()] == list(range(5))


def test_first_result(hot):
    got = {r["k"]: r["v"] for r in index.first_result(hot, "k", "i", "v").collect()}
    want = {}
    for r in hot.orderBy("i").collect():
        want.setdefault(r["k"], r["v"])
    assert got == want


def test_group_files_are_cut_into_parts(hot):
    files = hot.select("k", F.format_string("%05d", "i").alias("file"))
    parts = card.collect_group_files(files, "k", "file", 10).collect()
    assert max(r["n_files"] for r in parts) <= 10
    for k in {r["k"] for r in parts}:
        listed = [f for r in sorted(parts, key=lambda r: r["part"]) if r["k"] == k for f in r["files"]]
        assert listed == sorted(r["file"] for r in files.where(F.col("k") == k).collect())


def test_parts_of_a_group_depend_on_it_alone(spark):
    rows = [("hot" if i % 3 else None if i % 2 else "b", f"{i:04d}") for i in range(900)] + [("", "x"), ("dup", "y"), ("dup", "y"), ("dup", "z")]
    shape = lambda df: {(r["k"], r["part"], tuple(r["files"])) for r in card.collect_group_files(df, "k", "f", 25).collect()}
    df = spark.createDataFrame(rows, "k string, f string")
    whole = shape(df)
    assert ("dup", 0, ("y", "y", "z")) in whole and len([p for p in whole if p[0] == "hot"]) == 24
    assert {p for p in whole if p[0] == "hot"} == shape(df.where("k = 'hot'"))
    for k in ("hot", "b", None, ""):
        assert sorted(p[1] for p in whole if p[0] == k) == list(range(len([p for p in whole if p[0] == k])))


def test_counts(spark):
    df = spark.createDataFrame([("a", "x.py"), ("a", "y.py"), ("b", "z.md"), ("b", None), ("c", "noext")], "repo string, file string")
    assert {tuple(r) for r in card.files_per_repo(df).collect()} == {("a", 2), ("b", 1), ("c", 1)}
    assert [tuple(r) for r in card.extension_counts(df).collect()] == [("py", 2), ("md", 1), ("noext", 1)]
    assert {tuple(r) for r in card.corpus_card(df).collect()} == {
        ("repo", "a", 2), ("repo", "b", 1), ("repo", "c", 1),
        ("extension", "py", 2), ("extension", "md", 1), ("extension", "noext", 1),
    }
    assert card.dataset_size(df).first()[0] == 5
    assert [tuple(r) for r in card.name_collisions(df.where("file is not null"), ["repo"]).collect()] == [("a", 2)]


def test_shape_profile(spark):
    df = spark.createDataFrame([([1, 2], ["a"]), ([], None)], "x array<int>, y array<string>")
    assert [tuple(r) for r in card.shape_profile(df, ["x", "y"]).collect()] == [("x", 2, 0, 2, 1.0), ("y", 1, 1, 1, 1.0)]


# Splits


def ids(df):
    return {r["i"] for r in df.collect()}


@pytest.mark.parametrize("size,want", [(0.01, 5), (0.001, 1), (0.0, 0), (1.0, 500), (7, 7), (0.3, 150)])
@pytest.mark.parametrize("collect", [10_000, 1])
def test_split_is_exact_and_complete(hot, monkeypatch, size, want, collect):
    monkeypatch.setattr(split, "_COLLECT", collect)
    train, test = split.train_test_split(hot, ["i"], size)
    assert len(ids(test)) == want and ids(train) | ids(test) == set(range(500)) and not ids(train) & ids(test)


def test_narrow_prefixes_give_the_same_split(hot, monkeypatch):
    _, wide = split.train_test_split(hot, ["i"], 0.3)
    monkeypatch.setattr(split, "_DIGITS", 1)
    monkeypatch.setattr(split, "_COLLECT", 1)
    _, narrow = split.train_test_split(hot.repartition(7), ["i"], 0.3)
    assert ids(wide) == ids(narrow)


def test_split_depends_on_seed_only(hot):
    pick = lambda df, seed: ids(split.train_test_split(df, ["i"], 0.1, seed)[1])
    assert pick(hot, 1) == pick(hot.repartition(7), 1) == pick(hot.coalesce(1), 1) != pick(hot, 2)


def test_split_of_one_row_and_none(spark):
    one = spark.range(1).toDF("i")
    train, test = split.train_test_split(one, ["i"])
    assert (train.count(), test.count()) == (0, math.ceil(0.01))
    train, test = split.train_test_split(one.where("false"), ["i"])
    assert (train.count(), test.count()) == (0, 0)


# Duplicates


def test_equal_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, None), (1, None), (2, nan), (2, nan), (2, 1.0), (3, 1.0)], "a int, b double")
    once = dedup_rows(df)
    assert once.count() == 4 and dedup_rows(once).count() == 4


def test_first_copy_is_kept(spark):
    rows = [(5, "t", "x"), (2, "t", "y"), (9, None, "z"), (7, None, None), (1, "u", "w")]
    df = spark.createDataFrame(rows, "i int, t string, s string")
    got = sorted(tuple(r) for r in dedup_keep_first(df.repartition(3), ["t"], ["i"]).collect())
    assert got == [(1, "u", "w"), (2, "t", "y"), (7, None, None)]
    assert dedup_keep_first(df.select("t"), ["t"], ["t"]).count() == 3


def test_row_index_orders_nulls_first_and_keeps_columns(spark):
    df = spark.createDataFrame([(None, 1, "x"), ("a", None, "y"), ("a", 0, "z"), (None, 0, None)], "k string, i int, v string")
    got = {r["v"]: r["row_index"] for r in index.with_row_index(df, ["k", "i"], partitions=3).collect()}
    assert got == {None: 0, "x": 1, "y": 2, "z": 3}


@pytest.mark.parametrize("equal", [False, True])
def test_tied_rows_are_spread_over_tasks(spark, equal):
    v = F.lit(1) if equal else F.col("id")
    df = spark.range(0, 200_000, 1, 8).select(F.lit("k").alias("k"), v.alias("v"))
    out = index.with_row_index(df, ["k"], partitions=8)
    ends = out.agg(F.min("row_index"), F.max("row_index"), F.countDistinct("row_index"), F.countDistinct("v")).first()
    assert tuple(ends) == (0, 199_999, 200_000, 1 if equal else 200_000)
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_limits_are_found_without_sorting_all_rows(spark):
    hashed = F.pmod(F.xxhash64("id"), F.lit(5000))
    df = spark.range(0, 60_000, 1, 8).select(F.when(hashed > 20, hashed).alias("a"), F.concat(F.lit("w"), F.col("id") % 977).alias("b"), "id")
    order = ["a", "b", "id"]
    want = [r["id"] for r in df.orderBy(*order).limit(700).collect()]
    few = index.narrowed(df, order, 700, sample=500)
    assert 700 <= few.count() < 4_000
    assert [r["id"] for r in few.orderBy(*order).limit(700).collect()] == want
    assert [r["id"] for r in index.limit_rows(df, order, 700).orderBy(*order).collect()] == want
    tied = spark.range(60_000).select(F.lit(1).alias("k"))
    assert index.narrowed(tied, ["k"], 5, sample=100).count() == 60_000


def test_keep_first_aggregates_digests_and_sorts_no_text(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("hot " * 50)).otherwise(F.concat(F.lit("t"), F.col("id") % 700))
    df = spark.range(0, 9_000, 1, 6).select(text.alias("text"), F.when(F.col("id") % 10 > 0, F.lit("é")).alias("lang"), (8999 - F.col("id")).alias("doc_id"), "id")
    out = dedup_keep_first(df, ["text", "lang"], ["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ObjectHashAggregate" not in plan
    want = {}
    for r in sorted(df.collect(), key=lambda r: r["doc_id"]):
        want.setdefault((r["text"], r["lang"]), r)
    assert sorted(out.collect()[0].asDict()) == sorted(df.columns)
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in want.values()} and out.count() == len(want)


def test_keep_first_with_nulls_ties_and_repeats(spark):
    rows = [("a", None, 5, "x"), ("a", None, None, "null first"), ("a", "", 1, "y"), (None, "a", 2, "z"), ("", "a", 2, "w"), ("1:", "a", 3, "p"), ("t", "t", 1, "r"), ("t", "t", 1, "r"), ("t", "t", 1, "s")]
    df = spark.createDataFrame(rows, "k string, l string, o int, v string")
    got = dedup_keep_first(df, ["k", "l"], ["o"]).collect()
    assert sorted(r["v"] for r in got if r["k"] != "t") == ["null first", "p", "w", "y", "z"] and sum(r["k"] == "t" for r in got) == 1
    assert dedup_keep_first(df.where("false"), ["k", "l"], ["o"]).count() == 0
