"""Run a registered query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb

# Spark and DuckDB names of the same type.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value + 0.0, 9)
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """A short description of the first difference, or None."""
    rel = con.sql(sql)
    types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    mine = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    if types != mine:
        return f"schema: spark {mine}, sql {types}"
    got = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = _bag(rel.columns, rel.fetchall())
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"rows: spark {got.total()}, sql {want.total()}; extra {extra.total()} {str(list(extra)[:1])[:400]}; "
            f"missing {missing.total()} {str(list(missing)[:1])[:400]}"
        )
    return None
