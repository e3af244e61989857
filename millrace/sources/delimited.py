"""Header CSV in which over-long lines are skipped and short ones padded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words a data-frame CSV reader takes as missing (the empty field included).
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TRUE_WORDS = ["True", "TRUE", "true"]
FALSE_WORDS = ["False", "FALSE", "false"]
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"

_BAD = "_bad_line"


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    on_bad_lines: str = "skip",
    multi_line: bool = True,
    infer: bool = False,
) -> DataFrame:
    """Read a header CSV as strings, dropping only lines with too many fields.

    Short lines keep their fields and get nulls for the rest; a doubled quote is a literal
    quote; missing-value words become null. ``multi_line`` allows line breaks in quoted
    fields but gives each file to one task, so turn it off for large files whose fields hold
    no line breaks: those are then split. ``infer`` adds one pass that picks column types.
    """
    if on_bad_lines not in ("skip", "error"):
        raise ValueError("on_bad_lines is 'skip' or 'error'")
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    names = list(columns or reader.csv(path).columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD]])
    raw = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(path)

    # The reader flags short and long lines alike; commas outside quotes tell them apart.
    # A quote opens a quoted piece at the start of a field only; inside it a doubled quote is literal.
    bare = F.regexp_replace(F.col(_BAD), r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    too_long = F.col(_BAD).isNotNull() & (F.size(F.split(bare, ",")) > len(names))
    if on_bad_lines == "error":
        too_long = F.when(too_long, F.raise_error(F.concat(F.lit("too many fields: "), F.col(_BAD)))).otherwise(False)
    # Always true: it makes every read use all columns, without which the reader cannot tell
    # that a line is long, and refuses a query on the flag alone.
    whole = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    # A line of blanks holds no row.
    blank = F.coalesce(F.trim(F.col(_BAD) if len(names) > 1 else F.col(f"`{names[0]}`")) == "", F.lit(False))
    good = raw.where(~too_long & whole & ~blank)
    rows = good.select(*[F.when(~F.col(f"`{c}`").isin(NA_WORDS), F.col(f"`{c}`")).alias(c) for c in names])
    return cast_columns(rows, infer_types(rows)) if infer else rows


def infer_types(df: DataFrame) -> dict[str, str]:
    """Pick bigint, double, boolean or string for each string column, in one aggregate."""
    checks = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        checks += [
            F.count(v).alias(f"n{i}"),
            F.count(F.when(v.rlike(INTEGER) & v.try_cast("bigint").isNotNull(), 1)).alias(f"i{i}"),
            F.count(F.when(v.rlike(NUMBER), 1)).alias(f"f{i}"),
            F.count(F.when(v.isin(TRUE_WORDS + FALSE_WORDS), 1)).alias(f"b{i}"),
        ]
    stats = df.agg(F.count(F.lit(1)).alias("rows"), *checks).first()
    types = {}
    for i, c in enumerate(df.columns):
        n, whole = stats[f"n{i}"], stats[f"n{i}"] == stats["rows"]
        if n and stats[f"i{i}"] == n and whole:
            types[c] = "bigint"
        elif stats[f"f{i}"] == n:
            # Integers beside missing values are held as doubles, as is an all-missing column.
            types[c] = "double"
        elif stats[f"b{i}"] == n and whole:
            types[c] = "boolean"
        else:
            types[c] = "string"
    return types


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast named columns; text that does not fit its type becomes null."""
    return df.select(
        *[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns]
    )


def csv_line(*columns: str) -> Column:
    """One CSV line of string columns: every field quoted, quotes doubled, null left empty."""
    doubled = [F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')) for c in columns]
    return F.concat_ws(",", *[F.coalesce(F.concat(F.lit('"'), d, F.lit('"')), F.lit("")) for d in doubled])
