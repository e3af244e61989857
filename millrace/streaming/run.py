"""Running a stream to the end of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import new_path


def read_files(
    spark: SparkSession, folder: str, like: DataFrame, glob: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream with the schema of ``like``.

    ``files_per_trigger`` bounds how much one micro-batch holds.
    """
    reader = spark.readStream.schema(like.schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def read_table(spark: SparkSession, path: str, like: DataFrame, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream with the schema of ``like``: one file, or a folder of part files.

    The stream source takes folders and patterns only, so the name is passed as a pattern that it alone matches.
    """
    folder, name = path.rstrip("/").rsplit("/", 1)
    return read_files(spark, f"{folder}/{{{name}}}", like, files_per_trigger=files_per_trigger)


def drain(stream: DataFrame, label: str, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all available input into a Parquet table, stop the query whatever happens, read the table.

    Run again with the same ``out`` and ``checkpoint``, it goes on after the input already done.
    """
    spark = stream.sparkSession
    out = out or new_path(spark, label)
    checkpoint = checkpoint or new_path(spark, f"{label}-progress")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(out)
