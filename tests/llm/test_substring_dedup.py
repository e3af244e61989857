import random

import numpy as np
from pyspark.sql import types as T

from millrace.llm.substring_dedup import LEAST, MOST, SHORTEST, cuts_of, gear_hash, gear_table, substring_deduped

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("number", T.StringType())])


def prose(rng, n):
    return " ".join(rng.choice(["of", "the", "thé", "ering", "blehath"]) + str(rng.randrange(900)) for _ in range(n))


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    h, table = 0, gear_table()
    for i, b in enumerate(data.tolist()):
        h = ((h << 1) + int(table[b])) % 2**32
        assert h == int(gear_hash(data)[i])


def brute(rows):
    """First chunk of each digest by (id, place) stays; runs of fewer than SHORTEST bytes stay too."""
    seen, out = set(), []
    for ident, text, _ in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        ends, _ = cuts_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        chunks, at = [], 0
        for e in ends.tolist():
            chunks.append(raw[at:e])
            at = e
        gone = []
        for c in chunks:
            gone.append(c in seen)
            seen.add(c)
        i = 0
        while i < len(chunks):
            j = i
            while j < len(chunks) and gone[j]:
                j += 1
            if j > i and sum(map(len, chunks[i:j])) < SHORTEST:
                gone[i:j] = [False] * (j - i)
            i = max(j, i + 1)
        out.append((ident, len(raw), len(chunks), sum(len(c) for c, g in zip(chunks, gone) if g), b"".join(c for c, g in zip(chunks, gone) if not g).decode()))
    return out


def test_against_sequential_dedup(spark):
    rng = random.Random(4)
    shared = [prose(rng, 60) for _ in range(4)]
    texts = ["", None, "x", "a" * 3000, "é" * 900]
    for _ in range(60):
        texts.append(" ".join(rng.choice(shared) if rng.random() < 0.4 else prose(rng, rng.randrange(1, 90)) for _ in range(3)))
    texts += texts[5:12]
    rows = [(i, t, None) for i, t in enumerate(texts)]
    got = substring_deduped(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_chunks, r.n_removed, r.text) for r in got) == brute(rows)
    sizes = np.diff(np.append(0, cuts_of(np.frombuffer(texts[6].encode(), np.uint8), np.array([0, len(texts[6].encode())]))[0]))
    assert sizes[:-1].min() >= LEAST and sizes.max() <= MOST


def test_insertion_moves_few_chunks(spark):
    rng = random.Random(9)
    text = prose(rng, 400)
    rows = [(1, text, None), (2, text[:700] + "inserted words " + text[700:], None)]
    got = {r.doc_id: r for r in substring_deduped(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed > 0.8 * len(text)


def test_nulls_and_repeated_rows(spark):
    text = prose(random.Random(2), 80)
    rows = [(None, text, None), (3, text, None), (3, text, None), (3, text + " more", None)]
    got = substring_deduped(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in got) == [(0, False), (3, True), (3, True), (3, True)]
    assert substring_deduped(spark.createDataFrame([], SCHEMA)).collect() == []


def test_short_copies_are_removed_unless_a_floor_is_given(spark):
    docs = spark.createDataFrame([(1, "A short text.", None), (2, "A short text.", None), (3, "Another one.", None)], SCHEMA)
    assert sorted((r.doc_id, r.n_removed, r.text) for r in substring_deduped(docs).collect()) == [(1, 0, "A short text."), (2, 13, ""), (3, 0, "Another one.")]
    assert all(r.n_removed == 0 for r in substring_deduped(docs, shortest=100).collect())
