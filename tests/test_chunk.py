import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import chunk as C


def expected(text, block, step):
    if len(text) < block:
        return [text]
    return [text[i : i + block] for i in range(0, len(text), step)]


CASES = [
    ("", 4, 4, [""]),
    ("abc", 4, 4, ["abc"]),
    ("abcd", 4, 4, ["abcd"]),
    ("abcd", 4, 2, ["abcd", "cd"]),
    ("abcdefgh", 4, 3, ["abcd", "defg", "gh"]),
    ("abcdefgh", 4, 6, ["abcd", "gh"]),
    ("é😀abc", 4, 4, ["é😀ab", "c"]),
]


def native(spark, texts, block, step, page=C.PAGE_CHARS):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = [[] for _ in texts]
    for r in C.chunk_text(df, "text", block, step, page).orderBy("id", "chunk_no").collect():
        assert r["chunk_no"] == len(out[r["id"]])
        out[r["id"]].append(r["chunk"])
    return out


@pytest.mark.parametrize("text,block,step,want", CASES)
def test_cases_in_all_three_forms(spark, text, block, step, want):
    assert expected(text, block, step) == want
    assert native(spark, [text], block, step) == [want]
    df = spark.createDataFrame([(7, text)], "id int, text string")
    batch = C.map_batches(df, C.column_chunker(), "id int, chunk_no int, chunk string", text="text", block_size=block, skip_by=step)
    lateral = C.chunk_lateral(df, ["id"], "text", block, step)
    for form in (batch, lateral):
        assert [(r["id"], r["chunk"]) for r in form.orderBy("chunk_no").collect()] == [(7, c) for c in want]


@pytest.mark.parametrize("block,step,page", [(10, 3, 12), (10, 10, 10), (5, 7, 20), (16, 4, 1), (3, 20, 8), (1, 1, 4), (97, 10, 40), (70, 200, 90), (128, 2, 64)])
def test_pages_do_not_show(spark, block, step, page):
    texts = ["é😀x\ny\r\n" * n for n in range(0, 40)] + ["z" * n for n in range(0, 50)]
    assert native(spark, texts, block, step, page) == [expected(t, block, step) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8), st.integers(1, 12), st.integers(1, 15), st.integers(1, 30))
def test_any_text(spark, texts, block, step, page):
    assert native(spark, texts, block, step, page) == [expected(t, block, step) for t in texts]


def test_blocks_without_overlap_join_back(spark):
    text = "".join(chr(0x1F600 + i % 50) + "ab\n" for i in range(5000))
    assert "".join(native(spark, [text], 1024, 1024)[0]) == text


def test_null_text_and_other_columns(spark):
    df = spark.createDataFrame([(1, "k", None), (2, "m", "abcd")], "id int, other string, text string")
    assert [tuple(r) for r in C.chunk_text(df, "text", 4, 4).collect()] == [(2, "m", 0, "abcd")]
    assert C.chunk_lateral(df, ["id"], "text", 4, 4).count() == 1


def test_bad_sizes(spark):
    with pytest.raises(ValueError):
        C.chunk_text(spark.range(1).withColumn("text", F.lit("a")), "text", 0, 1)


def test_map_batches_may_change_row_count_and_partitions(spark):
    def double(batch, times):
        return {"id": [x for x in batch["id"] for _ in range(times)]}

    out = C.map_batches(spark.range(2500), double, "id bigint", batch_size=7, workers=3, times=2)
    assert out.count() == 5000 and out.rdd.getNumPartitions() == 3


def test_append_eos(spark):
    df = spark.createDataFrame([("a",), ("",)], "text string")
    assert [r[0] for r in C.append_eos(df).collect()] == ["a</s>", "</s>"]


def test_table_function_cuts_pieces_of_any_size(spark, monkeypatch):
    texts = ["", "é" * 5, "a😀b" * 700, None, "ß" * 4, "x" * 3000]
    keys = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([keys, pa.array(texts)], ["k", "_text"])
    want = [(k, n, c) for k, t in enumerate(texts) if t is not None for n, c in enumerate(expected(t, 5, 3))]
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(C, "PIECE_BYTES", size)
        cut = []
        for lo in range(len(texts)):  # slices have offsets of their own
            got = [t for t in texts[lo:] if t is not None]
            pieces = [zip(r.tolist(), n.tolist(), b.to_pylist()) for r, n, b in C._cut(pa.array(["pad", *got]).slice(1), 5, 3)]
            cut.append([x for p in pieces for x in p])
        assert cut[0] == [(i, n, c) for i, t in enumerate(t for t in texts if t is not None) for n, c in enumerate(expected(t, 5, 3))]
    df = spark.createDataFrame(batch.to_pandas().astype({"k": "int64"}))
    assert sorted(tuple(r) for r in C.chunk_lateral(df, ["k"], "_text", 5, 3).collect()) == sorted(want)
