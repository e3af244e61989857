import random

import numpy as np
from pyspark.sql import types as T

from millrace.llm import decontaminate
from millrace.llm.common import U
from millrace.llm.decontaminate import benchmark_leaks, common_subsequence

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("item_id", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_bit_parallel_subsequence():
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 6, (300, 64)).astype(U), rng.integers(1, 6, (300, 48)).astype(U)
    na, nb = rng.integers(1, 65, 300), rng.integers(1, 49, 300)
    a[np.arange(64) >= na[:, None]] = 0
    b[np.arange(48) >= nb[:, None]] = 0
    got = common_subsequence(a, b, nb)
    assert got.tolist() == [lcs(x[:m].tolist(), y[:n].tolist()) for x, y, m, n in zip(a, b, na, nb)]


def test_copies_and_paraphrases_are_found(spark):
    rng = random.Random(5)
    parts = ("the", "ing", "ou", "re", "st", "bl", "an", "er", "tion")
    vocab = [a + b + c for a in parts for b in parts for c in parts]
    weight = [1 / (i + 8) for i in range(len(vocab))]
    prose = lambda n: rng.choices(vocab, weight, k=n)
    items = [prose(rng.randrange(12, 120)) for _ in range(25)]
    docs, leaks = [], set()
    for d in range(300):
        words = prose(rng.randrange(1, 400))
        if d % 10 == 0:
            k = rng.randrange(25)
            item = list(items[k])
            if d % 20 == 0:  # a word in eight changed
                item = [w if rng.random() > 0.125 else rng.choice(vocab) for w in item]
            at = rng.randrange(len(words))
            words[at:at] = item
            leaks.add((d, k))
        docs.append((d, " ".join(w.upper() if rng.random() < 0.1 else w + rng.choice(["", ",", "."]) for w in words), "x"))
    docs += [(900, "", "x"), (901, None, "x"), (902, "one", "x"), (None, " ".join(items[0]), "x")]
    got = benchmark_leaks(spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)], ITEMS))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert (None, 0) in found
    found = {f for f in found if f[0] is not None}
    assert len(found & leaks) >= 0.95 * len(leaks)
    assert len({d for d, _ in found} - {d for d, _ in leaks}) <= 3


def test_blocks_of_items_and_odd_tables(spark, monkeypatch):
    rows = [(1, "a b c d e f g h i j k l m n o p", "x"), (2, "z y x w v u t s r q", "x"), (2, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame([(5, rows[0][1], None), (5, rows[0][1], None), (6, None, None), (None, rows[1][1], None)], ITEMS)
    whole = sorted(map(str, benchmark_leaks(docs, items).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 40)
    assert sorted(map(str, benchmark_leaks(docs, items).select("doc_id", "item_id").collect())) == whole and len(whole) == 2
    assert benchmark_leaks(docs, items.limit(0)).collect() == []
    assert benchmark_leaks(docs.limit(0), items).collect() == []


def test_long_passages_carry_into_the_next_word():
    rng = np.random.default_rng(2)
    a, b = rng.integers(1, 6, (200, 96)).astype(U), rng.integers(1, 6, (200, 48)).astype(U)
    got = common_subsequence(a, b, np.full(200, 48))
    assert got.tolist() == [lcs(x.tolist(), y.tolist()) for x, y in zip(a, b)]


def test_a_paraphrase_is_found_at_any_offset(spark):
    rng = random.Random(12)
    items = [[f"q{i}w{j}" for j in range(48)] for i in range(4)]
    copies = [[f"other{j}" if j % 4 == 0 else w for j, w in enumerate(item)] for item in items]  # 36 of 48, the share 0.75
    prose = lambda n: rng.choices([f"p{i}" for i in range(300)], k=n)
    docs = [(40 * k + at, " ".join(prose(at) + copies[k] + prose(70)), "x") for k in range(4) for at in range(40)]
    docs += [(500 + k, " ".join(copies[k][:30] + prose(30) + copies[k][30:]), "x") for k in range(4)]  # over more words than a passage
    got = benchmark_leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)], ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, d // 40) for d in range(160)}
    assert {r.lcs_share for r in got} == {0.75}


def test_copies_that_the_cosine_prunes_are_found(spark):
    rng = random.Random(8)
    vocab = [a + b for a in ("ka", "lo", "mi", "nu", "re") for b in ("sta", "ber", "tin", "dor", "vel", "qua")]
    other = [f"zx{i}" for i in range(400)]
    items = [rng.choices(vocab, k=15) for _ in range(12)]
    docs = []
    for d in range(120):
        words = rng.choices(other, k=64)
        if d < 24:
            words[40:55] = items[d % 12]
        docs.append((d, " ".join(words), "x"))
    docs, items = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)], ITEMS)
    for cosine in (0.3, 2.0):  # none is as near as 2
        found = {(r.doc_id, r.item_id) for r in benchmark_leaks(docs, items, cosine=cosine).collect()}
        assert {(d, d % 12) for d in range(24)} <= found and {d for d, _ in found} == set(range(24))


def test_sums_of_blocks_and_terms():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 33, 200)
    starts = np.append(0, np.cumsum(size))
    t = np.minimum(rng.integers(0, 60, starts[-1]), rng.integers(0, 60, starts[-1])) * 61
    block = np.repeat(np.arange(200), size)
    matrix = rng.integers(-9, 9, (decontaminate.TERMS, 5)).astype(np.float32)
    seen = decontaminate.block_sums(decontaminate.with_zero(matrix), t, starts)
    assert (seen == np.array([matrix[t[a:b]].sum(axis=0) for a, b in zip(starts, starts[1:])])).all()
    term, sums, held = decontaminate.term_sums(t, block, seen)
    assert sorted(term.tolist()) == sorted(set(t.tolist()))
    for k, total, n in zip(term, sums, held):
        assert (total == seen[block[t == k]].sum(axis=0)).all() and n == len(set(block[t == k].tolist()))


def test_runs_of_a_slice_are_judged_together(monkeypatch):
    """One call for the spans, and two for the runs of words in them, at whatever offset they begin."""
    import pyarrow as pa

    rng = random.Random(3)
    item = [f"q{i}" for i in range(40)]
    texts = [" ".join([f"p{rng.randrange(300)}" for _ in range(at)] + item + [f"p{rng.randrange(300)}" for _ in range(120)]) for at in range(0, 60, 3)]
    batch = pa.RecordBatch.from_pydict({"_id": list(range(20)), "_key": list(range(20)), "text": texts})
    total = np.zeros(decontaminate.TERMS * (decontaminate.RANK + decontaminate.EXTRA) + decontaminate.TERMS + 1)
    decontaminate.sketch(batch, total)
    latent, idf = decontaminate.word_map(total)
    calls, plain = [], decontaminate.common_subsequence
    monkeypatch.setattr(decontaminate, "common_subsequence", lambda *a: calls.append(1) or plain(*a))
    search = decontaminate._search(decontaminate.item_chunks([(7, " ".join(item), None)]), latent, idf, 0.3, 0.75, 0.6)
    found = [r for b in search(iter([batch])) for r in b.to_pylist()]
    assert {r["_id"] for r in found} == set(range(20)) and max(r["lcs_share"] for r in found) == 1.0
    assert len(calls) <= 3
