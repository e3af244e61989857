"""Cutting documents into overlapping character blocks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_SIZE = 1024
SKIP_BY = 128
# Longer texts are expanded a page at a time, so the blocks held at once stay few.
PAGE_CHARS = 65_536
# Most units a block is put together from; see ``_blocks``.
MAX_UNITS = 64


def _blocks(body: Column, own: Column, units: Column, block_size: int, skip_by: int) -> Column:
    """The blocks that start in the first ``own`` characters of ``body``.

    ``units`` are the pieces of ``body`` of the size that divides block and step, and a block is
    a run of them joined. Taking substrings instead would scan ``body`` from its start for each
    block. Where a block would need too many units one pattern walks the body in steps and
    looks ahead for the block.
    """
    unit = math.gcd(block_size, skip_by)
    if block_size // unit <= MAX_UNITS:
        first = F.sequence(F.lit(1), F.ceil(own / unit).cast("int"), F.lit(skip_by // unit))
        return F.transform(first, lambda i: F.array_join(F.slice(units, i, block_size // unit), ""))
    found = F.regexp_extract_all(body, F.lit(f"(?s)(?=(.{{1,{block_size}}})).{{1,{skip_by}}}"), F.lit(1))
    return F.slice(found, F.lit(1), F.ceil(own / skip_by).cast("int"))


def chunk_text(
    df: DataFrame,
    text: str = "text",
    block_size: int = BLOCK_SIZE,
    skip_by: int = SKIP_BY,
    page_chars: int = PAGE_CHARS,
) -> DataFrame:
    """One row for each block of ``block_size`` characters, starting every ``skip_by`` characters.

    A text shorter than a block is one chunk; otherwise the last blocks run short. Other columns
    are kept, ``chunk_no`` counts from zero and ``chunk`` replaces the text; a null text gives
    no chunk. All of it is one narrow stage, and only one page of a long text is expanded at a
    time.
    """
    if block_size < 1 or skip_by < 1:
        raise ValueError("block_size and skip_by must be positive")
    keep = [c for c in df.columns if c != text]
    per_page = math.ceil(max(block_size, page_chars) / skip_by)
    page = per_page * skip_by
    body = F.col(text)

    paged = df.where(body.isNotNull()).select(
        *keep,
        (F.length(body) < block_size).alias("_short"),
        F.when(F.length(body) <= page, F.array(body))
        .otherwise(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{page}}}"), F.lit(0)))
        .alias("_pages"),
    )
    # A block may run on into the next page, so each page carries the head of its successor.
    following = F.concat(F.slice("_pages", F.lit(2), F.size("_pages")), F.array(F.lit("")))
    windows = F.zip_with(
        "_pages",
        following,
        lambda a, b: F.struct(F.length(a).alias("own"), F.concat(a, F.substring(b, 1, block_size)).alias("text")),
    )
    unit = math.gcd(block_size, skip_by)
    pages = paged.select(*keep, "_short", F.posexplode(windows).alias("_page_no", "_page")).select(
        *keep,
        "_short",
        "_page_no",
        F.col("_page.own").alias("_own"),
        F.col("_page.text").alias("_text"),
        F.when(
            ~F.col("_short") & F.lit(block_size // unit <= MAX_UNITS),
            F.regexp_extract_all("_page.text", F.lit(f"(?s).{{1,{unit}}}"), F.lit(0)),
        ).alias("_units"),
    )
    blocks = F.when(F.col("_short"), F.array("_text")).otherwise(
        _blocks(F.col("_text"), F.col("_own"), F.col("_units"), block_size, skip_by)
    )
    return pages.select(*keep, "_page_no", F.posexplode(blocks).alias("_block_no", "chunk")).select(
        *keep, (F.col("_page_no").cast("bigint") * per_page + F.col("_block_no")).alias("chunk_no"), "chunk"
    )


def column_chunker() -> Callable[..., dict[str, list]]:
    """The same cut as a function over a dict of column lists, for ``map_batches``.

    Made inside a function so that it travels to workers by value.
    """

    def chunk(batch: dict[str, list], text: str, block_size: int, skip_by: int) -> dict[str, list]:
        keep = [c for c in batch if c != text]
        out: dict[str, list] = {c: [] for c in [*keep, "chunk_no", "chunk"]}
        for row, body in enumerate(batch[text]):
            if body is None:
                continue
            starts = [0] if len(body) < block_size else range(0, len(body), skip_by)
            for no, start in enumerate(starts):
                for c in keep:
                    out[c].append(batch[c][row])
                out["chunk_no"].append(no)
                out["chunk"].append(body[start : start + block_size])
        return out

    return chunk


def map_batches(
    df: DataFrame,
    fn: Callable[..., dict[str, list]],
    schema: str,
    batch_size: int = 1000,
    workers: int | None = None,
    **kwargs: Any,
) -> DataFrame:
    """Run ``fn(columns, **kwargs)`` over batches of rows; it may return more or fewer rows.

    ``columns`` maps each name to a list of values. Batches travel as Arrow; ``workers`` sets
    the number of partitions, and without it the input's own partitions are used.
    """

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for i in range(0, len(pdf), batch_size):
                part = pdf.iloc[i : i + batch_size]
                out = pd.DataFrame(fn({c: part[c].tolist() for c in part.columns}, **kwargs))
                if len(out):
                    yield out

    return (df.repartition(workers) if workers else df).mapInPandas(run, schema)


#: Text bytes that the table function reads, and block bytes that it returns, at a time.
PIECE_BYTES = 4 << 20


def _cut(texts: pa.Array, block_size: int, skip_by: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """``(row, number, block)`` of all blocks of ``texts`` without nulls, in pieces of bounded size."""
    texts = texts.cast(pa.large_binary())
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offs[0] : offs[-1]]
    offs = offs - offs[0]
    # Characters begin at the bytes that continue none.
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(begins, offs)
    chars = np.diff(first)
    count = np.where(chars < block_size, 1, -(-chars // skip_by))
    row = np.repeat(np.arange(len(chars)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = first[row] + number * skip_by
    since, until = begins[start], begins[np.minimum(start + block_size, first[row + 1])]
    ends = np.cumsum(until - since)
    lo = 0
    while lo < len(row):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + PIECE_BYTES, side="right")))
        bounds = np.append(0, ends[lo:hi] - done)
        source = np.arange(bounds[-1]) + np.repeat(since[lo:hi] - bounds[:-1], np.diff(bounds))
        buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[source])]
        yield row[lo:hi], number[lo:hi], pa.Array.from_buffers(pa.large_utf8(), hi - lo, buffers).cast(pa.string())
        lo = hi


def chunk_udtf(key: T.StructType, block_size: int, skip_by: int):
    """An Arrow table function over a table of the columns of ``key`` and, last, a text.

    It takes whole batches and returns the key with ``chunk_no, chunk``, without a step for each row.
    """
    from pyspark.sql.functions import arrow_udtf

    class Chunks:
        def eval(self, batch: pa.RecordBatch):
            rows = batch.filter(batch.column(batch.num_columns - 1).is_valid())
            texts = rows.column(rows.num_columns - 1)
            total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PIECE_BYTES, side="right")))
                for row, number, block in _cut(texts.slice(lo, hi - lo), block_size, skip_by):
                    keys = [rows.column(i).take(pa.array(row + lo)) for i in range(rows.num_columns - 1)]
                    yield pa.Table.from_arrays([*keys, pa.array(number), block], names=[*rows.schema.names[:-1], "chunk_no", "chunk"])
                lo = hi

    return arrow_udtf(Chunks, returnType=T.StructType([*key.fields, T.StructField("chunk_no", T.LongType()), T.StructField("chunk", T.StringType())]))


def chunk_lateral(df: DataFrame, key: Sequence[str], text: str, block_size: int, skip_by: int) -> DataFrame:
    """Chunks by ``chunk_udtf`` over the table of ``key`` and text; null texts have none, one partition stays one."""
    rows = df.select(*key, F.col(text).cast("string").alias("_text"))
    return chunk_udtf(rows.drop("_text").schema, block_size, skip_by)(rows.asTable())


def append_eos(df: DataFrame, text: str = "text", eos: str = "</s>") -> DataFrame:
    """Put the end marker after every text."""
    return df.withColumn(text, F.concat(F.col(text), F.lit(eos)))


def metadata_prefix(df: DataFrame, columns: Sequence[str], text: str = "text", mark: str = "\n") -> DataFrame:
    """Put ``name: value`` lines of the given columns before every text; null values are left out."""
    parts = [F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in columns]
    head = F.concat_ws(mark, *parts)
    return df.withColumn(text, F.concat(head, F.when(head != "", F.lit(mark)).otherwise(F.lit("")), F.col(text)))
