import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from millrace.llm import suffix_dedup
from millrace.llm.suffix_dedup import LENGTH, repeated_starts, repeats_removed

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("bytes", T.StringType())])


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + LENGTH] for r in raw for i in range(len(r) - LENGTH + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - LENGTH + 1):
            if seen[r[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "of", "thé", "ering", "tion", "😀", "a", "blehath", "und", "ñeco"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(n))
    shared = [prose(rng.randrange(30, 90)) for _ in range(6)]
    texts = ["", None, "short", "a" * 199, "b" * 200, "c" * 201, "ab" * 300, prose(300)]
    for _ in range(70):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(prose(rng.randrange(0, 60)) if rng.random() < 0.6 else rng.choice(shared)[rng.randrange(0, 40) :])
        texts.append("".join(parts))
    for _ in range(15):  # near copies
        t = rng.choice(texts[8:])
        at = rng.randrange(len(t) + 1)
        texts.append(t[:at] + "X" + t[at:])
    return texts + texts[8:14]


@pytest.mark.parametrize(("seed", "hot"), [(1, 4096), (2, 3)])
def test_against_all_strings(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = corpus(seed)
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    got = repeats_removed(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got)
    assert got == [(i, *b) for i, b in enumerate(brute(texts))]


def test_merge_of_shards_equals_counting():
    texts = [t.encode() for t in corpus(3) if t and len(t.encode()) >= LENGTH]
    seen = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    for t, hit in zip(texts, repeated_starts(texts)):
        assert hit.tolist() == [seen[t[i : i + LENGTH]] > 1 for i in range(len(t) - LENGTH + 1)]


def test_repeated_rows_and_empty_table(spark):
    text = "".join(chr(97 + (i * i) % 26) + str(i) for i in range(120))
    rows = [(None, text, None), (5, text, None), (5, text, None), (6, text[:150], None)]
    got = repeats_removed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, len(text)), (5, len(text)), (5, len(text)), (6, 0)]
    alone = repeats_removed(spark.createDataFrame([(5, text, None)] * 2, SCHEMA)).collect()
    assert [r.n_removed for r in alone] == [len(text)] * 2
    assert repeats_removed(spark.createDataFrame([], SCHEMA)).collect() == []
