import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm.registry import VOCABULARY
from millrace.llm.token_counts import allocated, encoder, token_counts, token_spans

SCHEMA = T.StructType([T.StructField(c, T.StringType() if c != "doc_id" else T.LongType()) for c in ("doc_id", "lang", "source", "text", "_id")])
TEXTS = ["", None, "one", "Héllo 😀😀 wörld\n\n\n\nnext line\n", "x" * 3000, "\n", " a\n b\n  c  \n", "tokens, 12345 and\r\nmore's <|endoftext|>"]


def vocabulary():
    return open(VOCABULARY, "rb").read()


def test_spans_cover_the_text():
    coder, _ = encoder(vocabulary())
    for text in TEXTS:
        first, last = token_spans(text or "", vocabulary())
        ids = coder.encode_ordinary(text or "")
        assert len(first) == len(ids)
        data = b""
        for i, t in enumerate(ids):
            data += coder.decode_single_token_bytes(t)
        assert data.decode() == (text or "")
        covered = set(itertools_chain(first, last))
        assert covered == set(range(len(text or "")))


def itertools_chain(first, last):
    for a, b in zip(first.tolist(), last.tolist()):
        yield from range(a, b + 1)


@pytest.mark.parametrize("rule", ["start", "end", "most"])
def test_allocation_against_loop(rule):
    rng = np.random.default_rng(1)
    for _ in range(200):
        cuts = np.sort(rng.integers(0, 40, 5))
        bounds = np.concatenate([[0], cuts, [40]])
        first = np.sort(rng.choice(40, 6, replace=False))
        last = np.append(first[1:] - 1, 39)
        got = allocated(first, last, bounds, rule)
        for a, b, s in zip(first, last, got):
            shares = [max(0, min(bounds[k + 1], b + 1) - max(bounds[k], a)) for k in range(6)]
            held = [k for k in range(6) if shares[k]]
            want = {"start": held[0], "end": held[-1], "most": int(np.argmax(shares))}[rule]
            assert s == want


def test_counts_add_up(spark):
    rows = [(i, "en" if i % 2 else None, "src", t, "x") for i, t in enumerate(TEXTS)] + [(None, "a", "b", "c", "d")] * 2
    coder, _ = encoder(vocabulary())
    for rule in ("start", "end", "most"):
        got = token_counts(spark.createDataFrame(rows, SCHEMA), VOCABULARY, rule=rule).collect()
        assert len(got) == len(rows)
        for r in got:
            assert sum(r.field_tokens) == r.n_tokens and sum(r.section_tokens) == r.field_tokens[2]
            if r.doc_id is not None:
                lang, source, text = (rows[r.doc_id][k] or "" for k in (1, 2, 3))
                assert r.n_tokens == len(coder.encode_ordinary(f"{lang}\n{source}\n{text}")) and len(r.section_tokens) == text.count("\n") + 1
    assert token_counts(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []
    with pytest.raises(ValueError):
        token_counts(spark.createDataFrame([], SCHEMA), VOCABULARY, rule="middle")
