"""Sums of a fixed-size matrix over all tasks of a job, in two levels with a bounded fan-in.

Every task contributes one matrix, cut into blocks of rows. Blocks meet in groups of about
``FAN_IN``-th of the tasks, then once more, each group added up as a stream with one block in
memory. The size depends on the matrix alone, so the total may come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = 32
FAN_IN = 16
SUMS = "block int, part int, sums binary"


def _rows(blocks: list, parts: list, sums: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(parts, pa.int32()), pa.array(sums, pa.binary())], ["block", "part", "sums"]
    )


def _each(fold: Callable, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            fold(batch, total)
        if total.any():
            blocks = np.array_split(total.astype(np.float32), BLOCKS)
            yield _rows(list(range(BLOCKS)), [TaskContext.get().partitionId() % FAN_IN] * BLOCKS, [b.tobytes() for b in blocks])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, total = None, None
    for batch in batches:
        for b, p, sums in zip(*(batch[c].to_pylist() for c in ("block", "part", "sums"))):
            x = np.frombuffer(sums, np.float32).astype(np.float64)
            if (b, p) == key:
                total += x
                continue
            if key is not None:
                yield _rows([key[0]], [key[1]], [total.astype(np.float32).tobytes()])
            key, total = (b, p), x
    if key is not None:
        yield _rows([key[0]], [key[1]], [total.astype(np.float32).tobytes()])


def summed(rows: DataFrame, fold: Callable, size: int) -> np.ndarray:
    """``fold(batch, total)`` adds to ``total``, an array of ``size`` numbers, in each task; the sum of all."""
    sums = rows.mapInArrow(_each(fold, size), SUMS)
    for last in (False, True):
        sums = sums.withColumn("part", F.lit(0)) if last else sums
        sums = sums.repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(_added, SUMS)
    out = np.array_split(np.zeros(size, np.float32), BLOCKS)
    for r in sums.select("block", "sums").collect():
        out[r.block] = np.frombuffer(r.sums, np.float32)
    return np.concatenate(out)
