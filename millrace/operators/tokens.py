"""Vocabulary, encoding, padding and decoding of token arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.arrays import (
    EOS_ID,
    FIRST_WORD_ID,
    IGNORED_LABEL,
    PAD_ID,
    UNK_ID,
    mask_to,
    pad_to,
)
from millrace.operators.index import LIMIT_IN_ONE_TASK, narrowed, with_batch_id, with_row_index
from millrace.operators.split import seeded_hash
from millrace.session import stage
from millrace.sizing import BROADCAST_BYTES, fits_broadcast

# Listed because the meaning of white space differs between engines.
SPACES = "\n\t\r"
VOCAB_SIZE = 30_000
# The marks of fill-in-the-middle examples and the id of a hidden token.
FIM_MARKS = ("<fim_prefix>", "<fim_suffix>", "<fim_middle>")
MASK_ID = -1
#: Items that are looked up at once in a task; a longer array is one piece.
PIECE_ITEMS = 1 << 18
MARKERS = {PAD_ID: "<pad>", EOS_ID: "</s>", UNK_ID: "<unk>"}


def words(text: Column) -> Column:
    """Runs of characters other than blank, newline, tab and carriage return.

    Splitting at one plain character takes less time than matching a pattern.
    """
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def word_counts(df: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Count of each word; map tasks count first, so a frequent word is sent once a task."""
    return df.select(*by, F.explode(words(F.col(text))).alias("word")).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(df: DataFrame, size: int = VOCAB_SIZE, text: str = "text") -> DataFrame:
    """The ``size`` most frequent words as ``word, n, id``, staged.

    Ties go by the word itself. Ids below 3 are the padding, end and unknown markers.
    """
    counts = stage(word_counts(df, text).withColumn("_less", -F.col("n")), "word-counts")
    best = [F.desc("n"), F.asc("word")]
    if size <= LIMIT_IN_ONE_TASK:
        # At most ``size`` rows reach the window.
        ranked = narrowed(counts, ["_less", "word"], size).orderBy(*best).limit(size).withColumn("_rank", F.row_number().over(Window.orderBy(*best)) - 1)
    else:
        ordered = counts.select("_less", "word")
        indexed = with_row_index(ordered, ["_less", "word"], "_rank").where(F.col("_rank") < size)
        ranked = indexed.withColumn("n", -F.col("_less"))
    return stage(ranked.select("word", "n", (F.col("_rank") + FIRST_WORD_ID).cast("int").alias("id")), "vocab")


def _matched(df: DataFrame, vocab: DataFrame, key: Sequence[str], items: Column, item: str) -> DataFrame:
    """Explode ``items`` to ``(key, _pos, item)`` rows and look each one up in a large vocabulary."""
    tokens = df.select(*key, F.posexplode_outer(items).alias("_pos", item))
    return tokens.join(vocab.hint("merge"), item, "left")


def _mapped(df: DataFrame, key: Sequence[str], items: Column, table: dict, missing, name: str, kind: pa.DataType) -> DataFrame:
    """Replace the items of an array by what ``table`` has for them, as ``key, name``.

    One narrow step over Arrow columns: the items of a batch are looked up at once and cut into
    lists again at the same places, ``PIECE_ITEMS`` at a time, so a worker holds little besides the batch itself.
    Nothing is exploded or shuffled.
    """
    spark = df.sparkSession
    held = spark.sparkContext.broadcast(table)
    names = list(key)

    def pieces(batch: pa.RecordBatch, have: pa.Array, give: pa.Array) -> Iterator[pa.RecordBatch]:
        sizes = pc.fill_null(pc.list_value_length(batch["_items"]), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_ITEMS, "right")))
            flat = batch["_items"].slice(start, stop - start).flatten()
            at = pc.fill_null(pc.index_in(flat.cast(have.type), value_set=have), len(have))
            counts = np.append(0, ends[start:stop] - before)
            out = pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), give.take(at))
            yield pa.RecordBatch.from_arrays([*[batch[c].slice(start, stop - start) for c in names], out], [*names, name])
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = pa.array(list(held.value))
        give = pa.array([*held.value.values(), missing], kind)
        for batch in batches:
            yield from pieces(batch, have, give)
            # Not to be held while the next one is read.
            del batch

    rows = df.select(*key, items.alias("_items"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    made = "int" if kind == pa.int32() else "string"
    return rows.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in key] + [f"{name} array<{made}>"]))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    key: Sequence[str],
    text: str = "text",
    eos: bool = False,
    limit_bytes: int = BROADCAST_BYTES,
    max_tokens: int | None = None,
) -> DataFrame:
    """Word ids of each document as ``key, ids``; unknown words become the unknown id.

    ``max_tokens`` keeps the first words only, before they are looked up; a null text has no ids.
    With a vocabulary measured to fit a broadcast this is one narrow step. A larger one is
    joined by word and the ids are gathered by ``key``, which must be unique then; position
    and id travel packed in one long, so gathering an array sorts plain numbers.
    """
    found = F.coalesce(words(F.col(text)), F.array().cast("array<string>"))
    found = F.slice(found, 1, max_tokens) if max_tokens else found
    if fits_broadcast(vocab.select("word", "id"), limit_bytes):
        table = {r["word"]: r["id"] for r in vocab.select("word", "id").collect()}
        out = _mapped(df, key, found, table or {"": UNK_ID}, UNK_ID, "ids", pa.int32())
        return out.select(*key, (F.concat("ids", F.array(F.lit(EOS_ID))) if eos else F.col("ids")).alias("ids"))
    found = _matched(df.select(*key, text), vocab.select("word", "id"), key, found, "word")
    packed = F.shiftleft(F.col("_pos").cast("bigint"), 32) + F.coalesce(F.col("id"), F.lit(UNK_ID))
    gathered = found.groupBy(*key).agg(F.sort_array(F.collect_list(packed)).alias("_packed"))
    ids = F.transform("_packed", lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    return gathered.select(*key, (F.concat(ids, F.array(F.lit(EOS_ID))) if eos else ids).alias("ids"))


def decode(
    df: DataFrame, vocab: DataFrame, key: Sequence[str], ids: str = "ids", limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Text of each id array as ``key, text``; marker ids come back as their marker."""
    if fits_broadcast(vocab.select("id", "word"), limit_bytes):
        table = {r["id"]: r["word"] for r in vocab.select("id", "word").collect()} | MARKERS
        out = _mapped(df, key, F.coalesce(F.col(ids), F.array().cast("array<int>")), table, MARKERS[UNK_ID], "_words", pa.string())
        return out.select(*key, F.array_join("_words", " ").alias("text"))
    found = _matched(df.select(*key, ids), vocab.select("id", "word"), key, F.col(ids), "id")
    word = F.coalesce(F.col("word"), F.lit(MARKERS[UNK_ID]))
    for marker_id, marker in MARKERS.items():
        word = F.when(F.col("id") == marker_id, F.lit(marker)).otherwise(word)
    placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", word.alias("word")))
    gathered = found.groupBy(*key).agg(F.array_sort(F.collect_list(placed)).alias("_words"))
    return gathered.select(*key, F.array_join(F.transform("_words", lambda x: x["word"]), " ").alias("text"))


def clm_examples(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Causal examples: the labels are the inputs."""
    return df.withColumn("labels", F.col(ids))


def collate(df: DataFrame, order: Sequence[str], batch_size: int, side: str = "right", ids: str = "ids") -> DataFrame:
    """Batches of consecutive rows, each padded to its longest row; pass staged rows.

    Adds ``batch_id``, ``input_ids``, ``attention_mask`` and ``labels``. Labels are ignored where
    a position is padding, so a real end marker still counts.
    """
    batched = with_batch_id(df, order, batch_size)
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch_id"))  # batch_size rows a group
    wide = batched.withColumn("_longest", longest)
    return wide.select(
        *[c for c in df.columns if c != ids],
        "batch_id",
        pad_to(F.col(ids), F.col("_longest"), side).alias("input_ids"),
        mask_to(F.col(ids), F.col("_longest"), side).alias("attention_mask"),
        pad_to(F.col(ids), F.col("_longest"), side, IGNORED_LABEL).alias("labels"),
    )


def fim_transform(df: DataFrame, key: Sequence[str], text: str = "text", rate: float = 0.5, seed: int = 41, marks: Sequence[str] = FIM_MARKS) -> DataFrame:
    """Fill-in-the-middle examples: of a share ``rate`` of the rows the text is cut at two places into
    prefix, middle and suffix and written prefix, suffix, middle, each after its mark.

    The choice and the cuts come from a seeded hash of the key; one narrow step. Null stays null.
    """
    body = F.col(text)
    pick = lambda what, n: F.pmod(F.conv(F.substring(seeded_hash(key, f"{seed}|{what}"), 1, 12), 16, 10).cast("bigint"), n)
    chosen = pick("fim", F.lit(1_000_000)) < int(rate * 1_000_000)
    a, b = pick("a", F.length(body) + 1), pick("b", F.length(body) + 1)
    lo, hi = F.least(a, b).cast("int"), F.greatest(a, b).cast("int")
    moved = F.concat(
        F.lit(marks[0]), body.substr(F.lit(1), lo), F.lit(marks[1]), body.substr(hi + 1, F.length(body)), F.lit(marks[2]), body.substr(lo + 1, hi - lo)
    )
    return df.withColumn(text, F.when(chosen, moved).otherwise(body)).withColumn("is_fim", chosen)


def mlm_mask(df: DataFrame, key: Sequence[str], ids: str = "ids", rate: float = 0.15, seed: int = 41, mask_id: int = MASK_ID) -> DataFrame:
    """Masked-token examples: of a share ``rate`` of the places the id becomes ``mask_id`` and the label
    keeps it; every other label is ignored. Places come from a seeded hash of key and position."""
    base = seeded_hash(key, f"{seed}|mlm")
    hidden = lambda i: F.conv(F.substring(F.md5(F.concat_ws("|", base, i.cast("string"))), 1, 8), 16, 10).cast("bigint") < int(rate * 2**32)
    masked = F.transform(ids, lambda x, i: F.when(hidden(i), F.lit(mask_id)).otherwise(x))
    labels = F.transform(ids, lambda x, i: F.when(hidden(i), x).otherwise(F.lit(IGNORED_LABEL)))
    return df.withColumn("input_ids", masked).withColumn("labels", labels)
