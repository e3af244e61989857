"""The queries that SQL can express, against their SQL over whole tables."""

import os

import oracle
import pytest

from millrace.llm.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_runs_over_whole_tables(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    table = {"op5_chat_formatting": "conversations", "quoted_links": "conversations", "quoted_threads": "conversations", "op6_embedding_dedup": "embeddings"}.get(name, "documents")
    whole = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    if name == "op13_prefix_trie":  # a row for each node, the root with all conversations
        whole = spark.read.parquet(f"{FOLDER}/conversations.parquet")
        assert rows.where("depth = 0").first()["n_convs"] == whole.select("conv_id").distinct().count()
    elif name == "quoted_threads":  # a row for each part of a thread
        assert rows.agg({"n_messages": "sum"}).first()[0] == whole.count()
    elif name != "op7_decontamination":
        assert rows.count() == whole.count()
