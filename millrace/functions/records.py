"""Typed JSON records with defaults, and small value formats."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _with_defaults(value: Column, kind: T.DataType, default: Any) -> Column:
    if isinstance(kind, T.StructType) and isinstance(default, Mapping):
        filled = F.struct(
            *[_with_defaults(value[f.name], f.dataType, default.get(f.name)).alias(f.name) for f in kind.fields]
        )
        # An absent nested record stays absent; only the fields of a present one are filled.
        return F.when(value.isNotNull(), filled)
    if default is None:
        return value
    return F.coalesce(value, F.lit(default).cast(kind))


def parse_json_record(text: Column, schema: T.StructType, defaults: Mapping[str, Any] | None = None) -> Column:
    """A JSON object as a struct: unknown fields are dropped, missing ones take their default.

    A malformed record (or a null one) parses to an all-default struct.
    """
    record = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    defaults = defaults or {}
    return F.struct(
        *[_with_defaults(record[f.name], f.dataType, defaults.get(f.name)).alias(f.name) for f in schema.fields]
    )


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two timestamps of either kind, to the microsecond."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1000).cast("double")


def elapsed_seconds_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two epoch times held as seconds."""
    return (end.cast("double") - start.cast("double")) * 1000


def render_ms(ms: Column) -> Column:
    return F.format_string("%.3f ms", ms)


def epoch_text(ts: Column) -> Column:
    """Epoch seconds with six decimals, as text."""
    return (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(20,6)").cast("string")
