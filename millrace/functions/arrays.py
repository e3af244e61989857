"""Token arrays, vectors and matrices as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD_ID, EOS_ID, UNK_ID, FIRST_WORD_ID = 0, 1, 2, 3
IGNORED_LABEL = -100
REQUEST_LENGTH = 128


def _fill(value: Column, n: Column) -> Column:
    return F.array_repeat(value, F.greatest(n, F.lit(0)))


def pad_to(ids: Column, n: Column, side: str = "right", pad: int = PAD_ID) -> Column:
    """``ids`` lengthened to ``n`` with ``pad``; a longer array is left alone."""
    padding = _fill(F.lit(pad).cast("int"), n - F.size(ids))
    return F.concat(ids, padding) if side == "right" else F.concat(padding, ids)


def mask_to(ids: Column, n: Column, side: str = "right") -> Column:
    """One for each real position, zero for each padded one."""
    ones = _fill(F.lit(1), F.size(ids))
    zeros = _fill(F.lit(0), n - F.size(ids))
    return F.concat(ones, zeros) if side == "right" else F.concat(zeros, ones)


def pad_truncate(ids: Column, n: int = REQUEST_LENGTH, side: str = "right", pad: int = PAD_ID) -> tuple[Column, Column]:
    """Exactly ``n`` 32-bit ids and the matching attention mask."""
    cut = F.slice(ids.cast("array<int>"), 1, n)
    return pad_to(cut, F.lit(n), side, pad), mask_to(cut, F.lit(n), side)


def last_n(items: Column, n: int) -> Column:
    """The last ``n`` items, or all of a shorter array."""
    return F.slice(items, F.greatest(F.lit(1), F.size(items) - n + 1), F.lit(n))


def scale(vector: Column, factor: float) -> Column:
    """Divide each value by ``factor``, as doubles."""
    return F.transform(vector, lambda x: x.cast("double") / F.lit(float(factor)))


def quantise(vector: Column, levels: int = 127) -> Column:
    """Each value of [-1, 1] rounded to the nearest of ``levels`` steps, back as doubles."""
    return F.transform(vector, lambda x: F.round(x.cast("double") * levels) / F.lit(float(levels)))


def argmax(scores: Column) -> Column:
    """Zero-based position of the largest score; the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def joined(items: Column, sep: str = " ") -> Column:
    return F.array_join(items.cast("array<string>"), sep)
