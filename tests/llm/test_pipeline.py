"""The pipeline over a small corpus with known junk, copies, leaks and personal values."""

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
CARD = "4539578763621486"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(1)
    words = [a + b for a in ("the", "ing", "ou", "re", "st", "bl", "an", "er", "mo", "ka") for b in ("ha", "tion", "le", "ea", "on", "is", "or", "at", "ul", "en")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    junk = lambda n: " ".join(rng.choice(words).upper() + rng.choice(["!!", "$$$", "%%%"]) for _ in range(n))
    items = [prose(rng.randrange(20, 40)) for _ in range(8)]
    texts, kind = [], []
    for i in range(360):
        k = "junk" if i % 6 == 5 else "leak" if i % 40 == 0 else "card" if i % 40 == 1 else "copy" if i % 40 in (2, 3) else "plain"
        if k == "copy" and i % 40 == 3:
            w = texts[-1].split(" ")
            w[len(w) // 2] = "changed"
            texts.append(" ".join(w))
        else:
            body = junk(60) if k == "junk" else prose(rng.randrange(60, 120))
            texts.append({"leak": f"{body} {items[i % 8]} {prose(30)}", "card": f"{body} pay {CARD} now"}.get(k, body))
        kind.append(k if not (k == "copy" and i % 40 == 2) else "plain")
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(k != "junk"), 0) for i, k in enumerate(kind) if i % 3], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, kind


def test_stages_decide_and_keep_the_rest(spark, corpus):
    folder, texts, kind = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = set(range(len(texts)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), DOCS)
        left -= {i for i, k in enumerate(kind) if k == {"quality": "junk", "near_duplicates": "copy", "decontaminate": "leak"}.get(name)}
        assert docs.columns == DOCS.names
        assert {r.doc_id for r in docs.collect()} == left, name
    for r in docs.collect():
        assert CARD not in r.text and r.n_chars == len(r.text)
        if kind[r.doc_id] == "card":
            assert re.search(r"pay \d{16} now", r.text)
        else:
            assert r.text == texts[r.doc_id]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == left
    assert {tuple(r) for r in corpus_pipeline.run(spark, folder).collect()} == {tuple(r) for r in packed}


def test_without_takes_odd_rows(spark):
    rows = [(None, "a", None, None, None), (1, None, "x", "y", 0), (1, "b", "x", "y", 1), (1, "b", "x", "y", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    from millrace.llm.common import keyed

    gone = keyed(docs.where("text = 'b' or doc_id is null")).select("_id", "_key")
    assert [tuple(r) for r in corpus_pipeline.without(docs, gone).collect()] == [rows[1]]
