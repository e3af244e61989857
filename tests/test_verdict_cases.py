"""Cases in which rows were once wrong, lost or multiplied."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import chunk as C
from millrace.operators import context, index, split
from millrace.operators import tokens as TK
from millrace.sources import delimited, sinks


def test_csv_quotes_against_pandas(spark, tmp_path):
    rng = random.Random(8)
    pieces = ['"', '""', ",", "a", "b c", '"x"', '"p,q"', "1", " "]
    lines = ['3,5" x,1,"EX,TRA"', '6,a"b,c"d,9', "1,2,3", "   ", '"q,""r""",2,3', "7,8"]
    lines += ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    # Quotes that never close swallow the rest of a file in either reader; such lines are left out.
    lines = [s for s in lines if s.count('"') % 2 == 0 and s.strip()] + ["   "]
    path = tmp_path / "x.csv"
    path.write_text("a,b,c\n" + "\n".join(lines) + "\n")
    kept = {s for s in lines if len(_fields(s)) <= 3 and s.strip()}
    assert delimited.scan_csv(spark, str(path), multi_line=False).count() == sum(s in kept for s in lines)


def _fields(line):
    """Fields of a line as pandas cuts them: a quote opens at the start of a field only."""
    import io

    try:
        return list(pd.read_csv(io.StringIO(line + "\n"), header=None, dtype=str).columns)
    except Exception:
        return []


def test_context_keeps_rows_without_tokens(spark):
    rows = [(1, 0, None), (1, 1, ["a"]), (1, 2, []), (1, 3, ["b", "c"])]
    df = spark.createDataFrame(rows, "k int, t int, w array<string>")
    got = {r["t"]: r["context"] for r in context.context_tail(df, "k", "t", "w", 2).collect()}
    assert got == {0: [], 1: ["a"], 2: ["a"], 3: ["b", "c"]} or got == {0: None, 1: ["a"], 2: ["a"], 3: ["b", "c"]}


def test_ties_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, i) for i in range(10)], "k int, v int")
    assert sorted(r["row_index"] for r in index.with_row_index(df, ["k"]).collect()) == list(range(10))
    assert index.with_batch_id(df, ["k"], 4).count() == 10
    with pytest.raises(ValueError, match="share the key"):
        split.with_split(df, ["k"], 0.1)
    assert split.with_split(df, ["v"], 0.1).where("is_test").count() == 1


def test_equal_names_keep_one_row(spark, tmp_path):
    rows = [("r", "a/b", "one"), ("r", "a/b", "two"), ("r", "a/b", "two"), (None, "x", "n1"), (None, "x", "n2"), ("", "y", "e"), ("r", None, "p"), ("r", None, "q")]
    df = spark.createDataFrame(rows, "repo_name string, path string, text string")
    got = sinks.write_corpus(df, str(tmp_path / "c")).collect()
    assert sorted((r["repo_name"] is None, r["repo_name"] or "", r["path"] or "") for r in got) == [(False, "", "y"), (False, "r", ""), (False, "r", "a/b"), (True, "", "x")]
    meta = sinks.write_metadata(df.withColumn("blob_url", F.lit("u")), str(tmp_path / "m")).collect()
    assert {r["repo_name"] for r in meta} == {"r", None, ""} and len(meta) == 8


def test_repeated_keys_encode_row_by_row(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "b"), (2, None)], "i int, text string")
    vocab = TK.build_vocab(docs, 5)
    got = sorted((r["i"], len(r["ids"])) for r in TK.encode(docs, vocab, ["i"]).collect())
    assert got == [(1, 1), (1, 2), (2, 0)]
    assert all(len(r["ids"]) <= 1 for r in TK.encode(docs, vocab, ["i"], max_tokens=1).collect())
    plan = TK.encode(docs, vocab, ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_null_text_gives_no_chunk(spark):
    df = spark.createDataFrame([(1, None), (2, "ab")], "i int, text string")
    got = C.map_batches(df, C.column_chunker(), "i int, chunk_no int, chunk string", text="text", block_size=4, skip_by=4)
    assert [tuple(r) for r in got.collect()] == [(2, 0, "ab")]


def test_leaked_lines(spark):
    line = "x" * 50
    train = spark.createDataFrame([(f"{line}\nshort",)] * 3 + [(None,)], "text string")
    test = spark.createDataFrame([(f"other\n  {line} ",), ("y" * 60,)], "text string")
    assert [tuple(r) for r in split.split_leakage(train, test).collect()] == [(line, 1, 3)]


def test_masks_and_cuts_keep_the_content(spark):
    docs = spark.range(60).select("id", F.concat(F.lit("text é😀 of "), "id").alias("text"))
    for r in TK.fim_transform(docs, ["id"]).collect():
        if r["is_fim"]:
            pre, rest = r["text"].removeprefix("<fim_prefix>").split("<fim_suffix>")
            suf, mid = rest.split("<fim_middle>")
            assert pre + mid + suf == f"text é😀 of {r['id']}"
        else:
            assert r["text"] == f"text é😀 of {r['id']}"
    ids = spark.range(50).select("id", F.sequence(F.lit(5), F.lit(64)).alias("ids"))
    rows = TK.mlm_mask(ids, ["id"]).collect()
    assert all((x if y == -100 else y) == i and (x == -1) == (y != -100) for r in rows for x, y, i in zip(r["input_ids"], r["labels"], r["ids"]))
    assert 0.1 < sum(x == -1 for r in rows for x in r["input_ids"]) / 3000 < 0.2


def test_prefix_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", None, "t"), (None, None, "u"), ("b", "c", None)], "x string, y string, text string")
    assert [r["text"] for r in C.metadata_prefix(df, ["x", "y"]).collect()] == ["x: a\nt", "u", None]


@pytest.mark.parametrize("values", [["__null__", "__empty__", None, "", "~", "~~x", "__HIVE_DEFAULT_PARTITION__", "a/b=c %", "plain"], ["plain", "x"]])
def test_folder_values_come_back_as_they_went_in(spark, tmp_path, values):
    rows = [(v, n, f"{n}") for n, v in enumerate(values)]
    df = spark.createDataFrame(rows, "repo_name string, n int, path string")
    assert sorted(map(str, sinks.write_table(df, str(tmp_path / "t"), ["repo_name"]).collect())) == sorted(map(str, df.collect()))
    two = df.withColumn("k", F.when(F.col("n") % 2 == 0, F.col("n"))).withColumn("day", F.expr("if(n = 1, null, date'2024-02-29')"))
    back = sinks.write_table(two, str(tmp_path / "u"), ["k", "repo_name", "day"])
    assert back.schema == two.schema and sorted(map(str, back.collect())) == sorted(map(str, two.collect()))
    meta = sinks.write_metadata(df.withColumn("blob_url", F.lit("u")), str(tmp_path / "m")).collect()
    assert sorted(str(r["repo_name"]) for r in meta) == sorted(str(v) for v in values)


def test_a_partitioned_write_reads_its_input_once(spark, tmp_path):
    spark.range(100).select(F.concat(F.lit("r"), F.col("id") % 3).alias("r"), "id").write.parquet(str(tmp_path / "in"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    df = spark.read.parquet(str(tmp_path / "in")).mapInPandas(counted, "r string, id bigint")
    assert sinks.write_table(df, str(tmp_path / "out"), ["r"]).count() == 100 and reads.value == 100
