"""Roots, proofs and tampering against a plain recursion."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id bigint, lang string, n_chars bigint, text string"
FIELDS = ["doc_id", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def code(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def root_of(nodes, arity):
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0]


def brute(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0), h("".join(code(v) for v in r))))
    subroots = {g: root_of([leaf for _, leaf in sorted(v)], arity) for g, v in groups.items()}
    return subroots, root_of([subroots[g] for g in sorted(subroots, key=lambda g: (g is not None, (g or "").encode()))], arity)


def rows_with_everything():
    rows = [(i if i % 50 else None, ["a", "b", None, "é", ""][i % 5] if i % 3 else "zz", i if i % 7 else None, ["", "x" * 9, "ü\n", None][i % 4]) for i in range(2600)]
    return rows + [rows[1]] * 3 + [(5, "solo", 1, "y" * 300_000)]


@pytest.mark.parametrize("arity", [2, 3])
def test_against_recursion(spark, arity):
    rows = rows_with_everything()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"root": F.lit(1), "tree": F.lit("x"), "leaf": F.lit(0.5)})
    claims = [F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(c) for c in FIELDS]
    out = merkle.merkle_manifest(df, FIELDS, "lang", "doc_id", arity, claims)
    got = out.select("*", merkle.folded(F.col("leaf"), F.col("proof")).alias("back"), merkle.folded(F.col("claim"), F.col("proof")).alias("told")).collect()
    subroots, root = brute(rows, arity)
    assert len(got) == len(rows) and {r.root for r in got} == {root}
    assert all(r.subroot == subroots[r.lang] and r.back == root for r in got)
    assert sorted(r.leaf for r in got) == sorted(h("".join(code(v) for v in r)) for r in rows)
    changed = {h("".join(code(v) for v in r)) for r in rows if r[0] is not None and r[0] % 4 == 0 and r[2] is not None}
    assert all((r.told != root) == (r.leaf in changed) for r in got)


def test_proofs_hold_all_siblings_in_order(spark):
    df = spark.createDataFrame([(i, "g", i, str(i)) for i in range(5)], SCHEMA)
    out = merkle.merkle_manifest(df, FIELDS, "lang", "doc_id").select("doc_id", merkle.sibling_text(F.col("proof")).alias("s")).collect()
    leaf = [h("".join(code(v) for v in (i, "g", i, str(i)))) for i in range(5)]
    two = [h(leaf[0] + leaf[1]), h(leaf[2] + leaf[3]), h(leaf[4])]
    four = [h(two[0] + two[1]), h(two[2])]
    want = {0: leaf[1] + two[1] + four[1], 1: leaf[0] + two[1] + four[1], 2: leaf[3] + two[0] + four[1], 3: leaf[2] + two[0] + four[1], 4: four[0]}
    assert {r.doc_id: r.s for r in out} == want


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.merkle_manifest(empty, FIELDS, "lang", "doc_id").collect() == []
    one = merkle.merkle_manifest(spark.createDataFrame([(None, None, None, None)], SCHEMA), FIELDS, "lang", "doc_id").first()
    assert one.root == one.subroot == one.leaf == h("----") and one.proof == [] and one.lang is None
