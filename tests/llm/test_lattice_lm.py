"""Lattice sums against all segmentations, scores against plain counting, and likelihood on held-out texts."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import lattice, registry
from millrace.llm.common import words_of
from millrace.llm.lattice import Trie, expected_pieces, word_masses
from millrace.llm.lattice_lm import lattice_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string"


def cuts(word, pieces):
    if not word:
        yield []
    for p in pieces:
        if word.startswith(p):
            for rest in cuts(word[len(p) :], pieces):
                yield [p, *rest]


def test_masses_and_expectations_against_all_segmentations(monkeypatch):
    rng = random.Random(1)
    pieces = sorted({b"a", b"b", b"c", b" ", b"ab", b" a", b"bc", b"abc", b"cab", b" ab", b"\xc3", b"\xa9", b"\xc3\xa9"})
    weight = np.log(np.array([rng.random() for _ in pieces]))
    trie = Trie(pieces)
    words = [b" " + bytes(rng.choice(b"abc") for _ in range(n)) for n in (0, 1, 2, 3, 5, 7, 7, 7)] + [b" \xc3\xa9a", b" " + b"ab" * 4]
    counts = np.array([rng.randrange(4) for _ in words], float)
    got, used = word_masses(trie, np.stack([weight, weight - 1]), pa.array(words)), np.zeros(len(pieces))
    assert (got[1] < got[0]).all()
    got = got[0]
    for w, c, mass in zip(words, counts, got):
        ways = [(math.exp(sum(weight[pieces.index(p)] for p in way)), way) for way in cuts(w, pieces)]
        total = sum(x for x, _ in ways)
        assert mass == pytest.approx(math.log(total))
        for x, way in ways:
            for p in way:
                used[pieces.index(p)] += c * x / total
    for least in (0.0, 500.0):  # in logarithms and in plain sums
        monkeypatch.setattr(lattice, "SAFE_LOG", least)
        assert expected_pieces(trie, weight, pa.array(words), counts) == pytest.approx(used)


def test_long_words_are_summed_whole():
    pieces = [b" ", b"a", b"aa"]
    weight = np.log([0.5, 0.3, 0.2])
    n = 5000
    mass = word_masses(Trie(pieces), weight[None], pa.array([b" " + b"a" * n]))[0, 0]
    a, b = 0.0, math.log(0.3)
    for _ in range(n - 1):
        a, b = b, np.logaddexp(b + math.log(0.3), a + math.log(0.2))
    assert mass == pytest.approx(math.log(0.5) + b)


def test_hashes_of_long_words_differ():
    # Sums of powers modulo 2**64 agree for these two whatever the base.
    thue = "a"
    for _ in range(12):
        thue += thue.translate(str.maketrans("ab", "ba"))
    other = thue.translate(str.maketrans("ab", "ba"))
    data = f"{thue} {other} {thue}".encode()
    h = words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
    assert h[0] != h[1] and h[0] == h[2]


def table(spark):
    rng = random.Random(7)
    vocab = ["the", "The", "of", "étude", "x" * 700, "ab-12", "ΣΙΓΜΑ", "tion", "a b"] + ["".join(rng.choice("abdeiou") for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    rows = [(i, " \t\n"[i % 3].join(rng.choice(vocab) for _ in range(rng.randrange(0, 40))), rng.choice(["en", "fr", None, ""])) for i in range(120)]
    rows += [(500, None, "en"), (501, "", None), (None, "null id", "xx"), (7, "twice", "en"), (7, "twice", "en"), (7, "thrice", "en"), (503, "   ", "en")]
    return rows, spark.createDataFrame(rows, SCHEMA).withColumns({"word": F.lit(1), "c0": F.lit("x"), "_key": F.lit(2)})


def base_scores(rows, train):
    counts, n = Counter(), 0
    for i, text, _ in rows:
        if train(i):
            words = WORD.findall((text or "").translate(LOWER))
            counts.update(words + [None])
            n += len(words) + 1
    out = []
    for i, text, _ in rows:
        words = WORD.findall((text or "").translate(LOWER)) + [None]
        out.append((str(i), len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words), 6)))
    return sorted(out)


def test_base_score_and_both_ways_of_looking_up(spark):
    rows, df = table(spark)
    train = F.col("doc_id") % 3 != 0
    whole = lattice_scores(df, registry.PIECES, train, rounds=1).collect()
    want = base_scores(rows, lambda i: i is not None and i % 3 != 0)
    shown = lambda out: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert shown(whole) == want
    for limit in (0, 2_000):  # words of no or few counts go with the documents, the others are joined
        less = lattice_scores(df, registry.PIECES, train, rounds=1, limit_bytes=limit).collect()
        assert shown(less) == want
        assert sorted(round(r.score, 6) for r in less) == sorted(round(r.score, 6) for r in whole)
    few = lattice_scores(df, registry.PIECES, train, rounds=1, classes=2).collect()
    assert shown(few) == want and all(r.score < 0 for r in few)


def test_probabilities_of_short_texts_sum_to_one_at_most(spark):
    rows, _ = table(spark)
    letters = [chr(c) for c in range(33, 127) if not chr(c).isupper()]
    probes = [(10_000, "", "zz")] + [(10_001 + i, a, "zz") for i, a in enumerate(letters)] + [(20_000 + i, w, "zz") for i, w in enumerate({"the", "of", "tion", "étude"})]
    df = spark.createDataFrame(rows + probes, SCHEMA)
    out = lattice_scores(df, registry.PIECES, F.col("doc_id") < 10_000).where("doc_id >= 10000").collect()
    assert 0 < sum(10**r.score for r in out) < 1


def test_without_training_rows_and_empty(spark):
    rows, df = table(spark)
    out = lattice_scores(df, registry.PIECES, F.lit(None).cast("boolean")).collect()
    assert len(out) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in out)
    assert lattice_scores(df.limit(0), registry.PIECES, F.lit(True)).collect() == []


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    out = registry.op12_lattice_scores(spark, "/root/testdata/sf0.01").toPandas()
    assert (out.held_out == out.doc_id.map(lambda i: crc32(str(i).encode()) % 7 == 2)).all()
    train = out[~out.held_out]
    assert train.score.sum() > 0.95 * train.base_score.sum()  # log10: less negative
