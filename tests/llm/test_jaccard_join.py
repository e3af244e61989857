import random
import re

import pytest
from pyspark.sql import types as T

from millrace import sizing
from millrace.llm import common, jaccard_join
from millrace.llm.common import Scratch, merged_stars, stars
from millrace.llm.jaccard_join import jaccard_classes

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("size", T.StringType())])


def brute(rows, words, num, den):
    sets = []
    for _, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _, _) in enumerate(rows))


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(4)
        at = rng.randrange(len(words))
        if k == 0:
            words[at] = f"w{rng.randrange(400)}"
        elif k == 1:
            words.insert(at, f"W{rng.randrange(400)}")
        elif k == 2 and len(words) > 1:
            del words[at]
        else:
            words[at] = words[at].upper()
    return words


@pytest.mark.parametrize(("words", "num", "seed"), [(4, 85, 1), (5, 80, 2), (1, 70, 3)])
def test_against_all_pairs(spark, words, num, seed):
    rng = random.Random(seed)
    rows = [(0, "", "x"), (1, None, "x"), (2, "  \t ", None), (3, "one", "x"), (4, "ONE", "x"), (5, "one two", "x")]
    shared = [f"p{i}" for i in range(30)]
    for _ in range(60):
        size = rng.choice([1, 2, 4, 5, 7, 9, 12, 20, 40, 80, 300])
        base = [f"w{rng.randrange(60 if size < 12 else 400)}" for _ in range(size)]
        if rng.random() < 0.4:
            base = base[: size // 3] + shared + base[size // 3 :]
        for _ in range(rng.choice([1, 2, 5])):
            rows.append((len(rows), " ".join(changed(rng, base, rng.randrange(0, 2 + size // 12))), "x"))
    chain = [f"c{i}" for i in range(120)]
    for _ in range(60):  # a group of near copies that drifts apart
        chain = changed(rng, chain, 2)
        rows.append((len(rows), "\n".join(chain), "x"))
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(5), words, num, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, words, num, 100)


def test_template_group_is_split_and_exact(spark):
    """Many documents share two thirds of their words and don't link; two of them do."""
    rng = random.Random(7)
    shared = [f"s{i}" for i in range(80)]
    rows = [(i, " ".join(shared + [f"u{i}_{k}" for k in range(16)]), None) for i in range(150)]
    rows.append((900, rows[3][1] + " more", None))
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(3), 1, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 1, 85, 100)


def test_groups_of_several_entry_sizes_are_whole(spark):
    """Drifting copies and others that share a passage only: groups over and under the small size share pivots."""
    rng = random.Random(11)
    rows, chain = [], [f"c{i}" for i in range(100)]
    for _ in range(220):
        chain = changed(rng, chain, 1)
        rows.append((len(rows), " ".join(chain), None))
    for k in range(90):
        rows.append((len(rows), " ".join([f"c{i}" for i in range(70)] + [f"z{k}_{i}" for i in range(rng.choice([10, 14, 30]))]), None))
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(4), 2, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 2, 85, 100)


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard_classes(empty).collect() == []
    rows = [(None, "a b c", None), (7, "a b c", None), (7, "a b c", None), (7, "x y z", None)]
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA), 4, 85, 100).collect()
    assert sorted((r.doc_id is None, r.n_shingles, r.component_id) for r in got if r.component_id is not None) == [(False, 1, 7)]
    assert len(got) == 4


def pairs_met(monkeypatch):
    """Counts, filled as the join runs, of the candidate pairs whose components are looked up."""
    counts, parted = [], jaccard_join._parted

    def counted(pairs, roots):
        counts.append(pairs.count())
        return parted(pairs, roots)

    monkeypatch.setattr(jaccard_join, "_parted", counted)
    return counts


def test_a_common_line_makes_no_candidates(spark, monkeypatch):
    rng = random.Random(21)
    line = [f"c{i}" for i in range(14)]
    rows = [(i, " ".join(line + [f"u{i}_{k}" for k in range(rng.randrange(50, 80))]), None) for i in range(500)]
    rows.append((900, rows[3][1] + " more", None))
    counts = pairs_met(monkeypatch)
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(3), 4, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 4, 85, 100)
    assert max(counts) <= 10


def test_candidates_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """Copies with up to eight changes each: those with few are the pivots, so a copy has few pivots."""
    rng = random.Random(22)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(changed(rng, base, rng.randrange(9))), None) for i in range(300)]
    counts = pairs_met(monkeypatch)
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(3), 4, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 4, 85, 100)
    assert sum(counts) <= 20 * len(rows)


@pytest.mark.parametrize("seed", [31, 32, 33])
def test_marks_change_no_link(spark, monkeypatch, seed):
    """With every shingle of several documents marked, most sets are weak or nearly so."""
    monkeypatch.setattr(jaccard_join, "HEAVY", seed % 3)
    rng = random.Random(seed)
    rows = []
    for _ in range(50):
        base = [f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 6, 12, 30, 90]))]
        for _ in range(rng.choice([1, 3, 6])):
            rows.append((len(rows), " ".join(changed(rng, base, rng.randrange(0, 2 + len(base) // 20))), None))
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(4), 2, 80, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 2, 80, 100)


def test_drifting_copies_take_few_exchanges(spark, monkeypatch):
    """Later links are added to the components that are known, so few steps deal out rows anew."""
    exchanges, stage = [], Scratch.stage

    def counted(self, df):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return stage(self, df)

    monkeypatch.setattr(Scratch, "stage", counted)
    rng = random.Random(41)
    rows, chain = [], [f"c{i}" for i in range(100)]
    for _ in range(200):
        chain = changed(rng, chain, 1)
        rows.append((len(rows), " ".join(chain), None))
    got = jaccard_classes(spark.createDataFrame(rows, SCHEMA).repartition(4), 2, 85, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, 2, 85, 100)
    assert sum(exchanges) <= 40, sum(exchanges)


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_stars_of_links_added_in_turn(spark, monkeypatch, limit):
    """Chains, stars and random links, by broadcast and by shuffle joins; a group of two that take each other too."""
    monkeypatch.setattr(common, "lookup_join", lambda *a: sizing.lookup_join(*a, limit_bytes=limit))
    rng = random.Random(42)
    links = [(i, i + 1) for i in range(40)] + [(100, 101)] + [(299, 200 + i) for i in range(60)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(70)]
    rng.shuffle(links)
    scratch = Scratch(spark, "stars")
    table = lambda pairs: spark.createDataFrame(pairs, "a bigint, b bigint")
    roots = stars(table([(i, i + 1) for i in range(600, 633)]), scratch)
    assert {r.root for r in roots.collect()} == {600}
    for part in (links[:90], [(5, 5)], links[90:] + [(633, 7)]):
        roots = merged_stars(roots, table(part), scratch)
    known = dict(roots.select("node", "root").collect())
    assert roots.count() == len(known) and not set(known.values()) & set(known)
    want = [{*range(41), *range(600, 634)}, {100, 101}, {299, *range(200, 260)}]
    for group in want:
        assert len({known.get(n, n) for n in group}) == 1
    assert all(known.get(a, a) == known.get(b, b) for a, b in links)
    low = {n: n for n in range(400, 500)}
    for _ in low:
        for a, b in links:
            if a >= 400:
                low[a] = low[b] = min(low[a], low[b])
    assert len({known.get(n, n) for n in low}) == len(set(low.values()))
