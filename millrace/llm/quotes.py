"""Quotation linking: messages without their quotes, in reply order; built-in functions only.

A line that begins with ``>`` marks is quoted at the level of their number; a run of lines of one
level is a passage. Passages and own words are normalised (lower case, white space to one blank,
blanks at the ends off) and compared by hash, however short: an own message is indexed whole, by
paragraph and by line. A passage of any level asks whole; one that is found nowhere whole is
taken apart and asks line by line. The original of a hash is the *earliest* message of the
conversation that holds it, one row a hash from an aggregate with map-side combine, so a much-quoted
line never multiplies rows. An original must be an earlier turn than the message that quotes it.

A message keeps all its originals with the levels at which it quotes them. It replies to the one of
the lowest level; of several, to that of the longest match, then to the latest.

A message that replies to none opens a thread; the others belong to the thread of the message they
reply to, found by doubling steps along the reply links. ``reply_threads`` builds the conversations:
each thread in order of its turns, originals before replies, cut into parts of bounded size.

Null texts are empty messages and quote nothing, empty lines and passages of marks alone have no
original; null conversation ids are one conversation, null turns come first; both stay null in the
result. Rows that repeat a turn are messages of their own; fully repeated rows count as one message
and each returns the same. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NULL_ID, Scratch
from millrace.llm.ranks import numbered

# The marks before quoted lines, and lines that announce a quote.
MARKS = r"^\s*>[>\s]*"
ANNOUNCES = r"^\s*(On .{1,200} wrote|Am .{1,200} schrieb.{0,100}|Le .{1,200} a écrit|El .{1,200} escribió)\s*:\s*$"


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def split_levels(text: Column) -> Column:
    """Array of ``(level, body)`` of the lines; an announcing line before a quote has level -1."""
    lines = F.split(F.coalesce(text, F.lit("")), "\r?\n", -1)
    marked = F.transform(lines, lambda s: F.struct(level_of(s).alias("level"), F.regexp_replace(s, MARKS, "").alias("body")))
    after = F.concat(F.slice(F.transform(lines, level_of), 2, 1_000_000_000), F.array(F.lit(0)))
    return F.zip_with(
        marked, after, lambda s, nxt: F.when((s["level"] == 0) & (nxt > 0) & s["body"].rlike(ANNOUNCES), F.struct(F.lit(-1).alias("level"), s["body"].alias("body"))).otherwise(s)
    )


def runs_of(lines: Column) -> Column:
    """Array of ``(level, body)`` of the maximal runs of lines of one level, bodies joined by line ends.

    Runs are found from the places where the level changes, each sliced once.
    """
    places = F.sequence(F.lit(1), F.size(lines))
    opens = F.filter(places, lambda i: (i == 1) | (F.element_at(lines, i)["level"] != F.element_at(lines, F.greatest(i - 1, F.lit(1)))["level"]))
    ends = F.concat(F.slice(opens, 2, 1_000_000_000), F.array(F.size(lines) + 1))
    return F.zip_with(opens, ends, lambda a, b: F.struct(
        F.element_at(lines, a)["level"].alias("level"),
        F.array_join(F.transform(F.slice(lines, a, b - a), lambda s: s["body"]), "\n").alias("body"),
    ))


def _held(text: Column) -> Column:
    """Distinct hashes of a text whole, by line and by paragraph, normalised."""
    parts = F.transform(F.concat(F.array(text), F.split(text, r"\n"), F.split(text, r"\n\s*\n")), normalised)
    return F.array_distinct(F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.xxhash64(s)))


def _asked(passage: Column) -> Column:
    """``(hash, size, whole)`` of a passage whole and by line, normalised; equal lines are not told apart here."""
    whole = normalised(passage)
    lines = F.filter(F.array_remove(F.transform(F.split(passage, r"\n"), normalised), whole), lambda s: s != "")
    key = lambda s, entire: F.struct(F.xxhash64(s).alias("hash"), F.length(s).alias("size"), F.lit(entire).alias("whole"))
    return F.concat(F.filter(F.array(key(whole, True)), lambda k: k["size"] > 0), F.transform(lines, lambda s: key(s, False)))


def linked_messages(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, turn, role, text, n_quotes, deepest, originals, reply_to, thread, formatted)``: one row a message.

    ``text`` is the message without quotes, ``formatted`` the same in chat markup, ``n_quotes`` the
    number of quoted passages, ``deepest`` the deepest level, ``originals`` all ``(level, turn)`` that
    are quoted, in this order, ``reply_to`` the turn replied to (null if none is found), ``thread`` the
    turn that opens the thread.
    """
    scratch = Scratch(messages.sparkSession, "quotes")
    role, text = (F.col(f"`{c}`").cast("string") for c in (role_col, text_col))
    conv, turn = (F.coalesce(F.col(f"`{c}`").cast("bigint"), F.lit(NULL_ID)) for c in (conv_col, turn_col))
    rows = messages.select(conv.alias("conv"), turn.alias("turn"), F.xxhash64(role, text).alias("key"), role.alias("role"), split_levels(text).alias("lines"))
    rows = rows.select("conv", "turn", "key", "role", "lines", runs_of(F.col("lines")).alias("runs"))
    own = F.array_join(F.transform(F.filter("lines", lambda s: s["level"] == 0), lambda s: s["body"]), "\n")
    quotes = F.filter("runs", lambda r: r["level"] > 0)
    rows = scratch.stage(rows.select(
        "conv", "turn", "key", "role", F.regexp_replace(own, r"\A\s*\n|\s+\z", "").alias("text"), F.size(quotes).alias("n_quotes"),
        F.coalesce(F.array_max(F.transform(quotes, lambda r: r["level"])), F.lit(0)).alias("deepest"),
        quotes.alias("passages"),
    ))

    asked = rows.where(F.size("passages") > 0).distinct().select("conv", "turn", "key", F.posexplode("passages").alias("no", "passage"))
    asked = asked.select("conv", "turn", "key", "no", "passage.level", F.inline(_asked(F.col("passage.body"))))
    held = rows.select("conv", "turn", F.explode(_held(F.col("text"))).alias("hash"))
    held = held.groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    met = asked.join(held.hint("merge"), ["conv", "hash"]).where("origin < turn")
    # One exchange by message serves the three groupings; each holds the lines of one message at most.
    hits = met.repartition("conv", "turn", "key").groupBy("conv", "turn", "key", "no", "level").agg(
        F.max("whole").alias("entire"), F.collect_list(F.struct("whole", "origin", "size")).alias("hits")
    )
    found = hits.select("conv", "turn", "key", "level", F.inline(F.filter("hits", lambda h: h["whole"] == F.col("entire"))))
    found = found.groupBy("conv", "turn", "key", "level", "origin").agg(F.max("size").alias("size"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "size", "origin"))["origin"]
    each = F.array_sort(F.collect_list(F.struct("level", F.col("origin").alias("turn"))))
    replies = scratch.stage(found.groupBy("conv", "turn", "key").agg(best.alias("reply_to"), each.alias("originals")))

    threads = _threads(replies, scratch)
    out = rows.drop("passages").join(replies.hint("merge"), ["conv", "turn", "key"], "left").join(threads.hint("merge"), ["conv", "turn", "key"], "left")
    shown = lambda c: F.when(c != NULL_ID, c)
    return out.select(
        shown(F.col("conv")).alias(conv_col), shown(F.col("turn")).alias(turn_col), F.col("role").alias(role_col), F.col("text").alias(text_col),
        "n_quotes", "deepest",
        F.coalesce(
            F.transform("originals", lambda o: F.struct(o["level"].alias("level"), shown(o["turn"]).alias("turn"))),
            F.array().cast("array<struct<level:int,turn:bigint>>"),
        ).alias("originals"),
        shown(F.col("reply_to")).alias("reply_to"), shown(F.coalesce("thread", "turn")).alias("thread"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("formatted"),
    )


def _threads(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv, turn, key, thread)`` of the replies: the turn at the end of their chain of links.

    A turn told more than once follows the first of its links to an earlier turn. Every step doubles
    the reach of the links, so there are as many joins as the longest chain has binary digits.
    """
    links = scratch.stage(replies.groupBy("conv", "turn").agg(F.min("reply_to").alias("to"), F.lit(True).alias("moved")))
    while not links.where("moved").isEmpty():
        far = links.select("conv", F.col("turn").alias("to"), F.col("to").alias("next"))
        steps = links.drop("moved").join(far.hint("merge"), ["conv", "to"], "left")
        after = scratch.stage(steps.select("conv", "turn", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(links)
        links = after
    ends = links.select("conv", F.col("turn").alias("reply_to"), F.col("to").alias("end"))
    return replies.join(ends.hint("merge"), ["conv", "reply_to"], "left").select("conv", "turn", "key", F.coalesce("end", "reply_to").alias("thread"))


def reply_threads(
    linked: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_size: int = 1000
) -> DataFrame:
    """``(conv_id, thread, part, n_messages, messages, formatted)``: the conversations of ``linked_messages``.

    ``messages`` holds ``(turn, role, text, reply_to)`` in reply order and ``formatted`` is their chat
    markup. A thread of over ``part_size`` messages is cut into parts, numbered from zero, so a
    huge thread is neither one row nor one task. Fully repeated rows are one message.
    """
    scratch = Scratch(linked.sparkSession, "threads")
    name = F.to_json(F.struct(F.col(conv_col).alias("c"), F.col("thread").alias("t")))  # null fields are left out, so null differs
    first = F.coalesce(F.col(turn_col), F.lit(NULL_ID))
    rows = linked.select(
        name.alias("_group"), first.alias("_turn"), F.xxhash64(role_col, text_col, "reply_to").alias("_key"),
        F.col(conv_col).alias("_conv"), "thread", F.struct(
            F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), "reply_to", "formatted"
        ).alias("message"),
    )
    rows = scratch.stage(rows.dropDuplicates(["_group", "_turn", "_key"]))
    placed, _ = numbered(rows, "_group", ["_turn", "_key"], scratch, ["_conv", "thread", "message"])
    parts = placed.groupBy("_group", F.expr(f"_pos div {int(part_size)}").alias("part")).agg(
        F.first("_conv").alias(conv_col), F.first("thread").alias("thread"),
        F.array_sort(F.collect_list(F.struct("_pos", "message"))).alias("placed"),
    )
    return parts.select(
        conv_col, "thread", "part", F.size("placed").alias("n_messages"),
        F.transform("placed", lambda p: p["message"].dropFields("formatted")).alias("messages"),
        F.array_join(F.transform("placed", lambda p: p["message"]["formatted"]), "").alias("formatted"),
    )
