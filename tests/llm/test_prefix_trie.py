"""Tree contraction and the prefix trie against plain loops."""

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from millrace.llm import prefix_trie, registry
from millrace.llm.common import NULL_ID, Scratch
from millrace.llm.contraction import subtree_totals


def totals(parent, value):
    depth, out = {}, dict(value)
    for v in parent:
        up, d = v, 0
        while parent[up] is not None:
            up, d = parent[up], d + 1
            out[up] += value[v]
        depth[v] = d
    return depth, out


def shapes():
    rng = random.Random(3)
    chain = {i: i - 1 if i else None for i in range(150)}
    comb = {i: (i - 2 if i > 1 else None) if i % 2 == 0 else i - 1 for i in range(120)}
    star = {i: 0 if i else None for i in range(300)}
    wild = {i: rng.randrange(max(0, i - 6), i) if i else None for i in range(300)}
    forest = {i: rng.choice([None, i // 2, i - 1]) if i else None for i in range(200)}
    return {"chain": chain, "comb": comb, "star": star, "wild": wild, "forest": forest}


def test_contraction(spark):
    # All shapes at once, as one forest of trees with ids of their own.
    rows, want = [], {}
    for at, (name, parent) in enumerate(shapes().items()):
        value = {v: random.Random(v).randrange(9) for v in parent}
        depth, out = totals(parent, value)
        one = totals(parent, dict.fromkeys(parent, 1))[1]
        base = at * 10_000
        rows += [(base + v, None if p is None else base + p, depth[v], value[v], 1) for v, p in parent.items()]
        want |= {base + v: (out[v], one[v]) for v in parent}
    df = spark.createDataFrame(rows, "id bigint, parent bigint, depth bigint, a bigint, b bigint")
    got = {r.id: (r.a, r.b) for r in subtree_totals(df, ["a", "b"], Scratch(spark, "t")).collect()}
    assert got == want


def test_contraction_of_nothing(spark):
    df = spark.createDataFrame([], "id bigint, parent bigint, depth bigint, a bigint")
    assert subtree_totals(df, ["a"], Scratch(spark, "t")).collect() == []


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    lists = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in lists.items():
        h = 0 if c is None else crc32(str(c).encode()) % 6
        whole[c] = (lists.get(c - c % 100, []) if c is not None else [])[:h] + own[h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    order = lambda c: (c is not None, c or 0)
    name = {p: min(m, key=order) for p, m in nodes.items()}
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in nodes) for q in below)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join("" if c is None else str(c) for c in sorted((c for c in members if len(whole[c]) == len(p)), key=order))
        children = sum(len(q) == len(p) + 1 for q in below)
        out.append((name[p], len(p), name[p[:-1]] if p else None, len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie_against_loops(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for c in [None, 0, 1, 2, 3, 4, 5, 100, 101, 102, 103, 207, 208, 300, 301, 302]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, None if rng.random() < 0.2 else t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "", None, "né😀", "x" * 40])))
    rows += [rows[0], rows[0], rows[5]] + [(400, t, "user", "long" * (t % 3)) for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("depth", F.lit(1)).withColumn("n", F.lit("x"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = registry.op13_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_prefixes_do_not_depend_on_blocks(spark, block):
    turns = spark.createDataFrame([(c, p, "u", str(p % 4), 1) for c in (1, 2) for p in range(10)], "conv bigint, pos bigint, role string, digest string, size int")
    rows = prefix_trie.prefixes(turns, Scratch(spark, "t"), block).orderBy("conv", "depth").collect()
    one, two = [[(r.a, r.b) for r in rows if r.conv == c] for c in (1, 2)]
    assert one == two and len(set(one)) == 10
    assert all((r.pa, r.pb) == ((0, 0) if r.depth == 1 else one[r.depth - 2]) for r in rows)


def test_ends_of_a_large_group(spark):
    ids = [NULL_ID, -5, *range(0, 20_000, 3)]
    df = spark.createDataFrame([(c,) for c in ids], "conv bigint").repartition(5).select(F.expr("named_struct('conv', 1L, 'depth', 2L)").alias("id"), "conv")
    row = prefix_trie._ends(df).collect()
    text = ",".join("" if c == NULL_ID else str(c) for c in sorted(ids))
    assert len(row) == 1 and row[0].ends_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert registry.op13_prefix_trie(spark, str(tmp_path)).collect() == []
