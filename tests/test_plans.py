"""What the plans must look like at scale."""

import pytest
from pyspark.sql import functions as F

from millrace import sizing
from millrace.operators import dedup
from millrace.plans import catalog
from millrace.session import new_path, shared_dir, stage
from millrace.sources import manifest, sinks

FOLDER = "/root/testdata/sf0.001"
# Python by nature, or one narrow Arrow step against a vocabulary measured to fit a broadcast.
PYTHON = {
    "batch_score", "best_labels", "timed_batch_score", "map_batches", "chunk_udtf", "confusion_matrix", "compare_backends", "scan_text_tree",
    "tokenize", "pad_truncate", "clm_examples", "decode_ids", "mlm_mask",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm_needlessly(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        assert "Python" not in text and "Arrow" not in text and "MapInPandas" not in text
    assert not ("Window" in text and "SinglePartition" in text)


def test_dedup_is_one_exchange(spark):
    text = plan(dedup.dedup_rows(catalog._read(spark, FOLDER, "documents").drop("doc_id")))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2


@pytest.mark.parametrize("name", ["tokenize", "pad_truncate", "clm_examples", "decode_ids"])
def test_tokenizing_moves_and_explodes_nothing(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "Exchange" not in text and "Generate" not in text and "BatchEvalPython" not in text


def test_chunking_has_no_exchange_and_reads_two_columns(spark):
    text = plan(catalog.QUERIES["chunk_text"](spark, FOLDER))
    assert "Exchange" not in text and "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_filters_reach_the_scan(spark):
    text = plan(catalog.QUERIES["anti_exclusions"](spark, FOLDER))
    assert "EqualTo(toxic,1)" in text and "ReadSchema: struct<doc_id:bigint,source:string>" in text


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_is_the_same_either_way(spark, how):
    big = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    small = spark.createDataFrame([(i, f"v{i}") for i in range(3)], "k bigint, v string")
    near, far = sizing.lookup_join(big, small, "k", how), sizing.lookup_join(big, small, "k", how, limit_bytes=1)
    assert "BroadcastHashJoin" in plan(near)
    assert "SortMergeJoin" in plan(far) and "Broadcast" not in plan(far)
    assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))


def test_lookup_join_keeps_the_left_side(spark):
    with pytest.raises(ValueError):
        sizing.lookup_join(spark.range(1), spark.range(1), "id", "right")


def test_hot_key_of_a_large_lookup_is_split(spark):
    names = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",  # few partitions here
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"))
        small = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        joined = sizing.lookup_join(big, small, "k", "left", limit_bytes=1)
        assert joined.select(F.sum(F.xxhash64("id", "k", "v").bitwiseAND(F.lit(1023)))).collect()
        rows = joined.collect()
        assert len(rows) == 60000 and "skew=true" in plan(joined)
    finally:
        for k in names:
            spark.conf.unset(k)


def test_byte_size(spark):
    df = spark.createDataFrame([("abc", 1, ["x"]), (None, 2, None)], "s string, n int, a array<string>")
    assert 3 + 2 * 8 + 2 * 16 < sizing.byte_size(df) < 100
    assert sizing.byte_size(df.where("false")) == 0


def test_work_folder(spark, monkeypatch):
    assert new_path(spark, "x") != new_path(spark, "x") and new_path(spark, "x").startswith(shared_dir(spark))
    df = spark.createDataFrame([(1, "a", [1.5])], "i int, s string, v array<double>")
    back = stage(df, "round-trip")
    assert back.collect() == df.collect() and back.dtypes == df.dtypes


# Sinks


def test_corpus_keeps_the_last_of_equal_names(spark, tmp_path):
    rows = [("1", "a/b-c.py", 1, "x"), ("1", "a-b/c.py", 2, "y"), ("1", "d.py", 3, "z"), ("2", "d.py", 4, "w")]
    df = spark.createDataFrame(rows, "repo_name string, path string, n int, text string")
    out = sinks.write_corpus(df, str(tmp_path / "c"), order="n")
    assert sorted((r["repo_name"], r["file_name"], r["text"]) for r in out.collect()) == [
        ("1", "a-b-c.py", "y"), ("1", "d.py", "z"), ("2", "d.py", "w"),
    ]
    assert "PartitionFilters: [isnotnull(repo_name" in plan(out.where("repo_name = '2'"))


def test_metadata_keeps_every_path(spark, tmp_path):
    df = spark.createDataFrame([("r", "b.py", "u1"), ("r", "b.md", "u2")], "repo_name string, path string, blob_url string")
    got = sorted(map(tuple, sinks.write_metadata(df, str(tmp_path / "m")).collect()))
    assert got == [("r", "b.md", "b.metadata.json", "u2"), ("r", "b.py", "b.metadata.json", "u1")]


def test_joins_of_files(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, path string")
    gone = spark.createDataFrame([("b",)], "path string")
    assert {r["id"] for r in manifest.anti_exclusions(docs, gone).collect()} == {1, 3}
    notes = spark.createDataFrame([(1, "n")], "id int, note string")
    assert sorted((r["id"], r["note"]) for r in manifest.docs_join_metadata(docs, notes, "id").collect()) == [(1, "n"), (2, None), (3, None)]
    assert manifest.union_sources(notes, notes).count() == 2
    assert manifest.distinct_names(manifest.union_sources(notes, notes), "note").count() == 1
