import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.operators import index
from millrace.operators import tokens as TK
from millrace.operators.perplexity import perplexity
from millrace.plans import flows

TEXTS = ["b a\ta\n c", "", "a b  unknown", "   ", "c c c b é x", "a " * 129, "a " * 128]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i bigint, text string")


@pytest.fixture(scope="module")
def vocab(docs):
    return TK.build_vocab(docs, 3)


def split_words(text):
    return re.findall(r"[^ \n\t\r]+", text)


def model():
    counts = Counter(w for t in TEXTS for w in split_words(t))
    best = sorted(counts.items(), key=lambda wc: (-wc[1], wc[0].encode()))[:3]
    return {w: (n, i + 3) for i, (w, n) in enumerate(best)}


def encoded_model(text, eos=False):
    return [model().get(w, (0, 2))[1] for w in split_words(text)] + ([1] if eos else [])


def test_vocab(vocab):
    assert {r["word"]: (r["n"], r["id"]) for r in vocab.collect()} == model()


def test_large_vocab_goes_through_the_row_index(docs, monkeypatch):
    monkeypatch.setattr(TK, "LIMIT_IN_ONE_TASK", 1)
    assert {r["word"]: (r["n"], r["id"]) for r in TK.build_vocab(docs, 3).collect()} == model()


@pytest.mark.parametrize("limit", [10**9, 0])
@pytest.mark.parametrize("eos", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_encode_by_broadcast_or_shuffle(docs, vocab, limit, eos, parts):
    got = {r["i"]: r["ids"] for r in TK.encode(docs.repartition(parts), vocab, ["i"], eos=eos, limit_bytes=limit).collect()}
    assert got == {i: encoded_model(t, eos) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("limit", [10**9, 0])
def test_round_trip(docs, vocab, limit):
    ids = TK.encode(docs, vocab, ["i"], eos=True)
    got = {r["i"]: r["text"] for r in TK.decode(ids, vocab, ["i"], limit_bytes=limit).collect()}
    known = lambda t: [w if w in model() else "<unk>" for w in split_words(t)]
    assert got == {i: " ".join(known(t) + ["</s>"]) for i, t in enumerate(TEXTS)}


def test_decode_of_empty_array(spark, vocab):
    df = spark.createDataFrame([(1, [])], "i bigint, ids array<int>")
    assert [tuple(r) for r in TK.decode(df, vocab, ["i"]).collect()] == [(1, "")]


@pytest.mark.parametrize("side", ["right", "left"])
def test_pad_truncate(spark, side):
    lengths = [0, 1, 127, 128, 129, 300]
    df = spark.createDataFrame([(n, list(range(5, 5 + n))) for n in lengths], "n int, ids array<bigint>")
    ids, mask = A.pad_truncate(F.col("ids"), side=side)
    out = df.select("n", ids.alias("ids"), mask.alias("mask"))
    assert out.schema["ids"].dataType.simpleString() == "array<int>"
    for r in out.collect():
        real, pad = list(range(5, 5 + min(r["n"], 128))), [0] * max(128 - r["n"], 0)
        assert r["ids"] == (real + pad if side == "right" else pad + real)
        ones = [1] * len(real)
        assert r["mask"] == (ones + pad if side == "right" else pad + ones)


@pytest.mark.parametrize("side", ["right", "left"])
def test_collate_masks_by_position(docs, vocab, side):
    ids = TK.encode(docs, vocab, ["i"], eos=True)
    rows = sorted(TK.collate(ids, ["i"], 2, side).collect(), key=lambda r: r["i"])
    for r in rows:
        batch = [encoded_model(t, True) for t in TEXTS[r["batch_id"] * 2 : r["batch_id"] * 2 + 2]]
        own = encoded_model(TEXTS[r["i"]], True)
        n = max(map(len, batch)) - len(own)
        pad = (lambda xs, v: xs + [v] * n) if side == "right" else (lambda xs, v: [v] * n + xs)
        assert r["batch_id"] == r["i"] // 2
        assert (r["input_ids"], r["labels"]) == (pad(own, 0), pad(own, -100))
        assert r["attention_mask"] == pad([1] * len(own), 0)
        assert 1 in r["labels"]


def test_clm_labels_are_inputs(docs, vocab):
    assert all(r["ids"] == r["labels"] for r in TK.clm_examples(TK.encode(docs, vocab, ["i"])).collect())


@pytest.mark.parametrize("by", [[], ["side"]])
def test_perplexity(spark, by):
    train, test = ["a b a c", "a"], [("p", "a zz b"), ("q", "zz zz"), ("p", "a")]
    got = perplexity(
        spark.createDataFrame([(t,) for t in train], "text string"), spark.createDataFrame(test, "side string, text string"), by
    )
    counts = Counter(w for t in train for w in t.split())
    slots = sum(counts.values()) + len(counts) + 1
    for r in got.collect():
        words = [w for s, t in test if not by or s == r["side"] for w in t.split()]
        loss = -sum(math.log((counts[w] + 1) / slots) for w in words) / len(words)
        assert r["n_tokens"] == len(words) and r["perplexity"] == pytest.approx(math.exp(loss))
    assert got.count() == (2 if by else 1)


def test_documents_to_examples(spark):
    docs = spark.createDataFrame([(i, f"w{i % 4} x y " * (i * 10)) for i in range(1, 30)], "doc_id bigint, text string")
    settings = flows.ExampleSettings(block_chars=64, test_size=0.1)
    train, test = flows.documents_to_examples(docs, "doc_id", settings)
    n = sum(math.ceil(len(f"w{i % 4} x y ") * i * 10 / 64) for i in range(1, 30))
    assert test.count() == math.ceil(0.1 * n) and train.count() == n - test.count()
    few, held = flows.documents_to_examples(docs, "doc_id", flows.ExampleSettings(debug=True))
    assert {r["doc_id"] for r in few.unionByName(held).collect()} == {1, 2, 3, 4, 5}


def test_encode_requests(docs, vocab):
    rows = flows.encode_requests(docs, vocab, ["i"], num_reqs=3).collect()
    assert len(rows) == 3 * len(TEXTS) and all(len(r["input_ids"]) == len(r["attention_mask"]) == 128 for r in rows)
    assert {r["req_no"] for r in rows} == {0, 1, 2}


def test_index_limit_is_shared():
    assert TK.VOCAB_SIZE <= index.LIMIT_IN_ONE_TASK


def test_a_batch_is_looked_up_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    steps = []
    kind = type(spark.range(1))
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, step, schema: steps.append(step) or real(self, step, schema))
    monkeypatch.setattr(TK, "PIECE_ITEMS", 10)
    texts = ["a b", None, "", "c " * 25, "a x b " * 3, "b", "b a c", "a " * 10, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    vocab = spark.createDataFrame([("a", 3, 3), ("b", 2, 4), ("c", 1, 5)], "word string, n bigint, id int")
    got = {r["doc_id"]: r["ids"] for r in TK.encode(docs.coalesce(1), vocab, ["doc_id"]).collect()}
    ids = {"a": 3, "b": 4, "c": 5}
    assert got == {i: [ids.get(w, 2) for w in (t or "").split()] for i, t in enumerate(texts)}
    items = [None if t is None else t.split() for t in texts]
    whole = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "_items": pa.array(items, pa.list_(pa.string()))})
    # A sliced batch too, as it starts at another place.
    for start in (0, 3):
        out = list(steps[0](iter([whole.slice(start)])))
        assert [x for b in out for x in b["ids"].to_pylist()] == [got[i] for i in range(start, len(texts))]
        assert all(b.num_rows == 1 or len(b["ids"].flatten()) <= 10 for b in out) and len(out) > 2
