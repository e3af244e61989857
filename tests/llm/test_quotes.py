import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.quotes import linked_messages, reply_threads

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("key", T.StringType()),
])


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return linked_messages(df).orderBy(F.col("conv_id").asc_nulls_first(), F.col("thread").asc_nulls_first(), F.col("turn").asc_nulls_first(), "text").collect()


def test_nested_quotes_are_linked_and_cut(spark):
    rows = [
        (1, 0, "a", "First question here?\nWith a second line."),
        (1, 1, "b", "Another topic altogether.\n\nA second paragraph of it."),
        (1, 2, "c", "On Monday, a wrote:\n> first   QUESTION here?\n> With a second line.\nMy answer is long enough."),
        (1, 3, "d", "> > First question here?\n> My answer is long enough.\nThanks for that."),
        (1, 4, "a", ">>> First question here?\n>> My answer is long enough.\n> Thanks for that.\nWelcome to you."),
        (1, 5, "e", "> a second paragraph\n> of it.\nI agree with it."),
        (1, 6, "f", "> words nobody wrote\nReally not there."),
        (2, 0, "a", "> First question here?\nIn another conversation."),
        (2, 1, None, None),
    ]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert [got[k].reply_to for k in sorted(got)] == [None, None, 0, 2, 3, 1, None, None, None]
    assert [got[k].thread for k in sorted(got)] == [0, 1, 0, 0, 0, 1, 6, 0, 1]
    assert [got[k].n_quotes for k in sorted(got)] == [0, 0, 1, 2, 3, 1, 1, 1, 0]
    assert [got[k].deepest for k in sorted(got)] == [0, 0, 1, 2, 3, 1, 1, 1, 0]
    assert got[1, 2].text == "My answer is long enough." and got[1, 4].text == "Welcome to you."
    assert got[1, 0].text == rows[0][3] and got[2, 1].text == "" and got[2, 1].formatted == "<|unknown|>\n\n<|end|>\n"
    assert [(r.thread, r.turn) for r in run(spark, rows) if r.conv_id == 1] == [(0, 0), (0, 2), (0, 3), (0, 4), (1, 1), (1, 5), (6, 6)]


def test_long_chain_against_walk(spark):
    rng = random.Random(3)
    rows, parent = [], {}
    for t in range(120):
        quote = ""
        if t and rng.random() < 0.9:
            parent[t] = rng.randrange(max(0, t - 3), t)
            quote = f"> This is message number {parent[t]} of all\n"
        rows.append((7, t, "u", f"{quote}This is message number {t} of all"))
    root = lambda t: root(parent[t]) if t in parent else t
    got = run(spark, rows)
    assert {r.turn: r.reply_to for r in got} == {t: parent.get(t) for t in range(120)}
    assert {r.turn: r.thread for r in got} == {t: root(t) for t in range(120)}


def test_all_levels_all_originals_and_short_quotes(spark):
    rows = [
        (1, 0, "a", "yes"),
        (1, 1, "b", "A long original text here"),
        (1, 2, "c", "Something else.\nno"),
        (1, 3, "d", ">> A long original text here\nOnly nested."),
        (1, 4, "e", "> yes\nShort."),
        (1, 5, "f", "> something   else.\n\n> A LONG original text here\n>> yes\nThree of them."),
        (1, 6, "g", "> no\n> words of nobody\nA line of a passage."),
        (1, 7, "h", ">\n> >\nMarks alone."),
        (1, 8, "i", "> Marks alone.\n>>> Marks alone.\nTwice the same, at two levels."),
        (2, 0, "a", "> yes\nNo such original here."),
    ]
    got = {(r.conv_id, r.turn): ([tuple(o) for o in r.originals], r.reply_to, r.thread) for r in run(spark, rows)}
    assert got[1, 3] == ([(2, 1)], 1, 1) and got[1, 4] == ([(1, 0)], 0, 0)
    assert got[1, 5] == ([(1, 1), (1, 2), (2, 0)], 1, 1)
    assert got[1, 6] == ([(1, 2)], 2, 2) and got[1, 7] == ([], None, 7)
    assert got[1, 8] == ([(1, 7), (3, 7)], 7, 7) and got[2, 0] == ([], None, 0)


def test_whole_passages_go_before_their_lines(spark):
    rows = [(1, 0, "a", "}"), (1, 1, "b", "one {\n}"), (1, 2, "c", "> one {\n> }\nThe whole is found."), (1, 3, "d", "> two {\n> }\nOnly a line is.")]
    got = {r.turn: [tuple(o) for o in r.originals] for r in run(spark, rows)}
    assert got == {0: [], 1: [], 2: [(1, 1)], 3: [(1, 0)]}


def brute(rows):
    """Originals and replies by a loop over all earlier messages of a conversation."""
    def flat(s):
        return re.sub(r"\s+", " ", s).strip(" ").lower()

    cut = []
    for conv, turn, _, text in rows:
        lines = []
        for line in text.split("\n"):
            m = re.match(r"\s*>[>\s]*", line)
            lines.append((m.group().count(">"), line[m.end() :]) if m else (0, line))
        passages, last = [], 0
        for level, body in lines:
            if level and level == last:
                passages[-1][1].append(body)
            elif level:
                passages.append((level, [body]))
            last = level
        own = "\n".join(b for level, b in lines if not level).strip()
        cut.append((conv, turn, passages, {flat(p) for p in [own, *own.split("\n"), *re.split(r"\n\s*\n", own)]}))

    def origin(conv, turn, s):
        held = [t for c, t, _, keys in cut if c == conv and s and s in keys]
        return min(held) if held and min(held) < turn else None

    out = {}
    for conv, turn, passages, _ in cut:
        found = []
        for level, body in passages:
            asked = [flat("\n".join(body))]
            if origin(conv, turn, asked[0]) is None:
                asked = [flat(b) for b in body]
            found += [(level, origin(conv, turn, s), len(s)) for s in asked if origin(conv, turn, s) is not None]
        best = min(found, key=lambda f: (f[0], -f[2], -f[1]))[1] if found else None
        out[conv, turn] = (sorted({f[:2] for f in found}), best)
    return out


def test_random_quotes_against_loop(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(6):
        said = []
        for turn in range(25):
            own = "\n".join(rng.choice(["ok", "Yes", "a b  c", "long line of words", "}", ""]) + rng.choice(["", "", str(rng.randrange(9))]) for _ in range(rng.randrange(1, 4)))
            quotes = []
            for _ in range(rng.randrange(0, 3) if said else 0):
                mark = ">" * rng.randrange(1, 4) + " "
                quotes += [mark + line for line in rng.choice(said).split("\n")[: rng.randrange(1, 4)]]
            rows.append((conv, turn, "u", "\n".join([*quotes, own])))
            said.append(own)
    got = {(r.conv_id, r.turn): ([tuple(o) for o in r.originals], r.reply_to) for r in run(spark, rows)}
    assert got == brute(rows)


def test_threads_are_conversations_in_parts(spark):
    rows = [(1, 0, "a", "The first words of all")] + [(1, t, "b", f"> The first words of all\nanswer {t}") for t in range(1, 10)]
    rows += [(1, 10, None, "apart"), (None, None, "c", None), (2, 5, "x", "same"), (2, 5, "x", "same"), (2, 5, "y", "other")]
    linked = linked_messages(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4))
    got = reply_threads(linked, part_size=4).collect()
    parts = {(r.conv_id, r.thread, r.part): [m.turn for m in r.messages] for r in got}
    assert parts == {
        (1, 0, 0): [0, 1, 2, 3], (1, 0, 1): [4, 5, 6, 7], (1, 0, 2): [8, 9], (1, 10, 0): [10], (None, None, 0): [None], (2, 5, 0): [5, 5],
    }
    first = next(r for r in got if (r.conv_id, r.thread, r.part) == (1, 0, 0))
    assert first.n_messages == 4 and [m.reply_to for m in first.messages] == [None, 0, 0, 0]
    assert first.formatted.startswith("<|a|>\nThe first words of all\n<|end|>\n<|b|>\nanswer 1\n<|end|>\n")
    assert reply_threads(linked.where("false")).collect() == []


def test_very_long_text_is_linked_whole(spark):
    long = "\n".join(f"line {i} of a very long message" for i in range(20_000))
    quoted = "\n".join(f"> {line}" for line in long.split("\n"))
    got = {r.turn: r for r in run(spark, [(1, 0, "a", long), (1, 1, "b", quoted + "\nall of it")])}
    assert [tuple(o) for o in got[1].originals] == [(1, 0)] and got[1].text == "all of it" and got[0].text == long


def test_nulls_ties_and_empty(spark):
    assert run(spark, []) == []
    rows = [
        (None, None, "a", "The null turn comes first."), (None, 1, "b", "> The null turn comes first.\nYes it does."),
        (3, 1, "a", "x"), (3, 1, "a", "x"), (3, 1, "b", ">"), (3, 2, "b", "\n> x\r\n y "),
    ]
    got = run(spark, rows)
    assert len(got) == 6 and [r.thread for r in got[:2]] == [None, None]
    assert [r.reply_to for r in got[2:]] == [None, None, None, 1] and [o.turn for o in got[1].originals] == [None]


def test_plan_has_no_python(spark):
    df = linked_messages(spark.createDataFrame([(1, 1, "a", "b", "c")], SCHEMA))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
