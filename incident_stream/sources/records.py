"""Record lines from Kafka or from text files, as a stream or as one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incident_stream.settings import RecordSource


def read_record_stream(
    spark: SparkSession, source: RecordSource, streaming: bool = True
) -> DataFrame:
    """One row per message, its value as text in `csv_line`; other message columns are dropped.

    With `streaming=False` the same source is read once, as a backfill.
    """
    reader = (spark.readStream if streaming else spark.read).format(source.format)
    reader = reader.options(**source.options)
    loaded = reader.load(source.path) if source.path else reader.load()
    return loaded.selectExpr("CAST(value AS STRING) AS csv_line")
