"""Processing-time stamps on a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.records import epoch_text


def stamp_stream(records: DataFrame) -> DataFrame:
    """Set ``timestamp`` of every record to the time of its micro-batch, epoch seconds as text."""
    return records.withColumn("timestamp", epoch_text(F.current_timestamp()))
