"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the last
returns the batches. Rows are told apart by id and text, so a repeated id does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, keyed
from millrace.llm.decontaminate import benchmark_leaks
from millrace.llm.jaccard_join import jaccard_classes
from millrace.llm.packing import length_batches
from millrace.llm.pii import pseudonymised
from millrace.llm.quality import quality_scores
from millrace.llm.registry import PII_KEY
from millrace.sizing import lookup_join


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the documents ``(_id, _key)`` of ``rows``, a staged table."""
    marked = keyed(docs, row=F.struct(*[F.col(f"`{c}`") for c in docs.columns])).drop("text")
    return lookup_join(marked, rows.select("_id", "_key"), ["_id", "_key"], "left_anti").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects."""
    scores = quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, Scratch(spark, "rejected").stage(scores.where("predicted = 0").select("_id", "_key")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: smallest id, then row key; of repeated rows one."""
    classes = Scratch(spark, "classes").stage(jaccard_classes(docs).select("_id", "_key", "kept"))
    if classes.groupBy("_id", "_key").count().where("count > 1").isEmpty():
        once = docs
    else:
        once = docs.dropDuplicates(["doc_id", "text"])
    return without(once, Scratch(spark, "copies").stage(classes.where("not kept").select("_id", "_key")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    leaks = benchmark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, Scratch(spark, "leaks").stage(leaks.select("_id", "_key").distinct()))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal values; the length follows the new text."""
    return pseudonymised(docs, PII_KEY, found_col="__found").drop("__found").withColumn("n_chars", F.length("text").cast("bigint"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batches."""
    return length_batches(docs).drop("_id", "_key")


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("pii", pii), ("packing", packing),
]

#: The classifier, the join and the search have no SQL; tests/llm/test_pipeline.py checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
