"""Incremental output of growing messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.context import BLOCK, with_previous
from millrace.session import new_path, stage
from millrace.sizing import lookup_join

#: Micro-batches after which the ends are written in full again.
FULL_EVERY = 16


def _held(column: str) -> Column:
    """A key to join by; a null key is a key too."""
    return F.to_json(F.struct(F.col(column).alias("k"))).alias("_held")


def _ends(spark: SparkSession, folder: str, batch: int, schema: T.StructType) -> DataFrame:
    """The last order of each key before ``batch`` and the length there: the last full table and what came after it."""
    full = batch // FULL_EVERY * FULL_EVERY - 1
    parts = [spark.read.schema(schema).parquet(f"{folder}/{n:09d}") for n in range(max(full, 0), batch)]
    if not parts:
        return spark.createDataFrame([], schema)
    return _last(reduce(DataFrame.unionByName, parts))


def _last(rows: DataFrame) -> DataFrame:
    # As in the window, a null order comes first.
    return rows.groupBy("_key").agg(F.max(F.struct("_order", "_length")).alias("_e")).select("_key", "_e._order", "_e._length")


def stream_delta(
    messages: DataFrame, key: str, order: str, text: str = "text", out: str | None = None, block: int = BLOCK
) -> DataFrame:
    """``key, order, delta`` for each message of a stream: what it adds after the length of the one before it.

    All available input is processed and the table of all deltas so far is returned, empty where there was no input;
    run again with the same ``out``, it goes on after the input already done. Bound the micro-batch at the source.
    Messages may come in any order, unique by ``(key, order)``.

    A micro-batch is a batch job without Python: the previous length comes from ``with_previous``, so a key with a
    third of the rows is spread, and for a key's first message from a table with one length a key that earlier
    micro-batches wrote. Each writes its own folders, over what a failed attempt left, so a repeated
    micro-batch changes nothing. A null text counts as empty for the message after it and has a null delta.

    A key with a message that comes in a later micro-batch than one that follows it is marked, and the lengths of marked
    keys are looked up once more over all their messages at the end. So the messages are kept, with the
    length before each, and the deltas cut from them when the table is read.
    """
    spark = messages.sparkSession
    out = out or new_path(spark, "deltas")
    kinds = {f.name: f.dataType for f in messages.schema.fields}
    known = T.StructType([T.StructField("_key", kinds[key]), T.StructField("_order", kinds[order]), T.StructField("_length", T.IntegerType())])
    kept = T.StructType(
        [T.StructField(c, kinds[c]) for c in (key, order, text)] + [T.StructField("_seen", T.IntegerType()), T.StructField("_late", T.BooleanType())]
    )
    size = F.coalesce(F.length(text), F.lit(0))
    delta = F.col(text).substr(F.coalesce(F.col("_seen"), F.lit(0)) + 1, F.length(text)).alias("delta")
    # Without input there is no micro-batch, and still a table.
    spark.createDataFrame([], kept).write.mode("ignore").parquet(f"{out}/deltas/batch=-1")

    def advance(batch: DataFrame, number: int) -> None:
        rows = with_previous(batch.select(key, order, text), key, order, size, "_seen", block)
        late = F.lit(False)
        if number:
            before = _ends(spark, f"{out}/ends", number, known).select(_held("_key"), "_order", "_length")
            asked = rows.withColumn("_held", F.when(F.col("_seen").isNull(), _held(key)))
            rows = lookup_join(asked, before, "_held", "left").withColumn("_seen", F.coalesce("_seen", "_length"))
            after = F.col(order).isNotNull() & (F.col("_order").isNull() | (F.col(order) > F.col("_order")))
            late = F.col("_length").isNotNull() & ~after
        rows.select(key, order, text, "_seen", late.alias("_late")).write.mode("overwrite").parquet(f"{out}/deltas/batch={number}")
        last = _last(batch.select(F.col(key).alias("_key"), F.col(order).alias("_order"), size.alias("_length")))
        if number % FULL_EVERY == FULL_EVERY - 1:
            last = _last(_ends(spark, f"{out}/ends", number, known).unionByName(last))
        last.write.mode("overwrite").parquet(f"{out}/ends/{number:09d}")

    query = messages.writeStream.foreachBatch(advance).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    table = spark.read.schema(kept).option("pathGlobFilter", "*.parquet").parquet(f"{out}/deltas").select(*kept.names)
    late = stage(table.where("_late").select(_held(key)).distinct(), "late-keys")
    if late.isEmpty():
        return table.select(key, order, delta)
    table = table.withColumn("_held", _held(key))
    again = lookup_join(table, late, "_held", "left_semi").select(key, order, text)
    again = with_previous(again, key, order, size, "_seen", block).select(key, order, delta)
    return lookup_join(table, late, "_held", "left_anti").select(key, order, delta).unionByName(again)
