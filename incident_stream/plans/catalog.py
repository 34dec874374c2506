"""The registered queries: each takes a session and a folder of tables and returns a DataFrame.

All of them read whole tables. Timestamps are handed out without a zone, as the comparison
engine has them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_stream import fixtures
from incident_stream.functions import strip_leading_zeros
from incident_stream.operators.aggregate import (
    aggregate_monthly,
    aggregate_windowed,
    anomalies,
)
from incident_stream.operators.enrich import duplicate_codes
from incident_stream.operators.parse import parse_records
from incident_stream.plans.pipelines import enriched
from incident_stream.schema import ANOMALIES, MONTHLY, WINDOWED, Contract
from incident_stream.settings import (
    FileStore,
    Params,
    RecordSource,
    new_work_dir,
    prepare_session,
)
from incident_stream.sources.codes import normalize_codes, read_codes
from incident_stream.sources.publish import (
    Manifest,
    csv_files,
    file_lines,
    publish_lines,
    publish_new_files,
)
from incident_stream.sources.records import read_record_stream
from incident_stream.sources.results import read_results
from incident_stream.streaming.sinks import batch_writer, fold

Query = Callable[[SparkSession, str], DataFrame]


def zoneless(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select([plain(field) for field in df.schema.fields])


def _events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    lines = fixtures.event_lines(spark, sf_dir)
    return enriched(lines, fixtures.codes(spark, sf_dir), **options)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(fixtures.order_lines(spark, sf_dir), fixtures.codes(spark, sf_dir))


def _undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(fixtures.undated_lines(spark, sf_dir), fixtures.codes(spark, sf_dir))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(fixtures.dirty_lines(spark, sf_dir), fixtures.codes(spark, sf_dir))


# --- batch ---------------------------------------------------------------------------------


def _carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records carry each normalised code."""
    parsed = parse_records(fixtures.event_lines(spark, sf_dir))
    return parsed.groupBy("IUCR").agg(F.count("*").alias("records"))


def code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the code file, read it back, normalise, and count the records of each code."""
    path = f"{new_work_dir(spark)}/codes"
    fixtures.code_file(spark, sf_dir).write.csv(path, header=True, quoteAll=True)
    table = normalize_codes(read_codes(spark, path))
    return table.join(_carried(spark, sf_dir), "IUCR", "left")


def normalized_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every code that the records carry, before and after normalising, with its frequency."""
    raw = fixtures.event_fields(spark, sf_dir).groupBy("IUCR").agg(F.count("*").alias("n"))
    return raw.select(
        F.col("IUCR").alias("raw_code"), strip_leading_zeros(F.col("IUCR")).alias("code"), "n"
    )


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(fixtures.event_lines(spark, sf_dir))


def parsed_dirty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(fixtures.dirty_lines(spark, sf_dir))


def duplicated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that stand in the table more than once, and the records that they multiply."""
    found = duplicate_codes(normalize_codes(fixtures.codes_with_duplicates(spark, sf_dir)))
    return found.join(_carried(spark, sf_dir), "IUCR", "left")


def monthly_with_duplicate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.event_lines(spark, sf_dir)
    return aggregate_monthly(enriched(lines, fixtures.codes_with_duplicates(spark, sf_dir)))


def enriched_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join that a code table too large for broadcasting gets."""
    return _events(spark, sf_dir, broadcast_bytes=0)


# --- streaming -----------------------------------------------------------------------------


def _closed_anomalies(spark: SparkSession, store: FileStore) -> DataFrame:
    return read_results(spark, store, ANOMALIES).drop("threshold")


def stream_anomalies_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fixtures.replay(spark, sf_dir, Params("A"), ("anomalies",))
    return _closed_anomalies(spark, store)


def stream_anomalies_all_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every closed window, whatever its share."""
    store = fixtures.replay(spark, sf_dir, Params("A", threshold=0), ("anomalies",))
    return _closed_anomalies(spark, store)


def stream_late_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the lines of the first day coming once more at the end."""
    store = fixtures.replay(spark, sf_dir, Params("A", threshold=0), ("anomalies",), late=True)
    return _closed_anomalies(spark, store)


def stream_window30_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fixtures.replay(spark, sf_dir, Params("C"), ("aggregates",))
    return read_results(spark, store, WINDOWED)


def stream_monthly_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fixtures.replay(spark, sf_dir, Params("A"), ("aggregates",))
    return read_results(spark, store, MONTHLY)


def stream_monthly_late_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fixtures.replay(spark, sf_dir, Params("A"), ("aggregates",), late=True)
    return read_results(spark, store, MONTHLY)


def stream_monthly_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from a query without state: each batch stores its own, reading adds up."""
    store = fixtures.replay(spark, sf_dir, Params("A"), ("aggregates",), sink_mode="add")
    return read_results(spark, store, MONTHLY)


def stream_monthly_late_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With late lines, and the log folded after each start of the job."""
    store = fixtures.replay(
        spark, sf_dir, Params("A"), ("aggregates",), late=True, sink_mode="add",
        after=lambda store: fold(spark, store, MONTHLY),
    )
    return read_results(spark, store, MONTHLY)


def stream_two_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both results of one job, below each other."""
    params = Params("A", window_days=3, threshold=30.0)
    store = fixtures.replay(spark, sf_dir, params, ("aggregates", "anomalies"), slices=2)
    counts = read_results(spark, store, MONTHLY)
    windows = read_results(spark, store, ANOMALIES)
    return counts.select(
        F.lit("aggregates").alias("result"),
        F.col("year_month").alias("period"),
        "category",
        "district",
        "total_crimes",
        "fbi_indexed",
    ).unionByName(
        windows.select(
            F.lit("anomalies").alias("result"),
            F.date_format("window_start", "yyyy-MM-dd").alias("period"),
            F.lit("ALL").alias("category"),
            "district",
            "total_crimes",
            "fbi_indexed",
        )
    )


# --- publishing and reading back -----------------------------------------------------------


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with headers, published as lines, read as a source, parsed."""
    work = new_work_dir(spark)
    empty = [F.lit(None).cast("string").alias(c) for c in ("ComArea", "Latitude", "Longitude")]
    table = fixtures.event_fields(spark, sf_dir).select(*fixtures.FIELDS, *empty)
    table.write.csv(f"{work}/in", header=True)
    published = RecordSource.text(f"{work}/lines")
    publish_lines(spark, f"{work}/in", published)
    return parse_records(read_record_stream(spark, published, streaming=False))


def publish_beside_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a folder that also holds a sub-folder with a CSV file."""
    work = new_work_dir(spark)
    empty = [F.lit(None).cast("string").alias(c) for c in ("ComArea", "Latitude", "Longitude")]
    table = fixtures.event_fields(spark, sf_dir).select(*fixtures.FIELDS, *empty)
    table.write.csv(f"{work}/in", header=True)
    table.write.csv(f"{work}/in/x=1", header=True)
    published = RecordSource.text(f"{work}/lines")
    publish_lines(spark, f"{work}/in", published)
    return parse_records(read_record_stream(spark, published, streaming=False))


def publish_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of four files two are published and in the manifest; the others follow file by file, and
    publishing once more sends nothing."""
    work = new_work_dir(spark)
    empty = [F.lit(None).cast("string").alias(c) for c in ("ComArea", "Latitude", "Longitude")]
    table = fixtures.event_fields(spark, sf_dir).select(*fixtures.FIELDS, *empty)
    table.repartition(4).write.csv(f"{work}/in", header=True)
    published, manifest = RecordSource.text(f"{work}/lines"), f"{work}/manifest"
    first = csv_files(spark, f"{work}/in")[:2]
    lines = file_lines(spark, f"{work}/in", names=[f.name for f in first])
    lines.write.text(f"{work}/lines")
    Manifest(spark, manifest).add(first)
    for _ in range(2):
        publish_new_files(spark, f"{work}/in", published, manifest, step_bytes=1)
    return parse_records(read_record_stream(spark, published, streaming=False))


def _read_back(
    spark: SparkSession, contract: Contract, mode: str, batches: list[DataFrame]
) -> DataFrame:
    store = FileStore(f"{new_work_dir(spark)}/results")
    write = batch_writer(store, contract, mode)
    for number, batch in enumerate(batches):
        write(batch, number)
    return read_results(spark, store, contract)


def results_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mode "replace": the second batch takes the place of the first, in the stored types."""
    batches = [aggregate_monthly(_orders(spark, sf_dir)), aggregate_monthly(_events(spark, sf_dir))]
    return _read_back(spark, MONTHLY, "replace", batches)


def results_readback_recreated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mode "recreate": the table takes the columns and types of the last batch."""
    batches = [aggregate_monthly(_orders(spark, sf_dir)), aggregate_monthly(_events(spark, sf_dir))]
    return _read_back(spark, MONTHLY, "recreate", batches)


def results_readback_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mode "upsert": keys of both batches; where a key is in both, the second counts."""
    first = aggregate_monthly(_orders(spark, sf_dir))
    second = aggregate_monthly(_orders(spark, sf_dir).where(F.col("Arrest") == "True"))
    return _read_back(spark, MONTHLY, "upsert", [first, second])


def results_readback_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the log folded after the first batch and after the second."""
    store = FileStore(f"{new_work_dir(spark)}/results")
    write = batch_writer(store, MONTHLY)
    orders = _orders(spark, sf_dir)
    for number, records in enumerate([orders, orders.where(F.col("Arrest") == "True")]):
        write(aggregate_monthly(records), number)
        fold(spark, store, MONTHLY)
    return read_results(spark, store, MONTHLY)


def results_read_while_folding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame made after the second batch, read after the log has been folded twice."""
    store = FileStore(f"{new_work_dir(spark)}/results")
    write = batch_writer(store, MONTHLY)
    orders = _orders(spark, sf_dir)
    for number, records in enumerate([orders, orders.where(F.col("Arrest") == "True")]):
        write(aggregate_monthly(records), number)
    found = read_results(spark, store, MONTHLY)
    fold(spark, store, MONTHLY)
    write(aggregate_monthly(_events(spark, sf_dir)), 2)
    fold(spark, store, MONTHLY)
    return found


def stream_anomalies_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 30 days, closed by the day of the same length after the last record."""
    params = Params("A", window_days=30, threshold=0)
    return _closed_anomalies(spark, fixtures.replay(spark, sf_dir, params, ("anomalies",)))


def stream_anomalies_two_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lengths and thresholds in one store; the second is read back."""
    store = fixtures.replay(spark, sf_dir, Params("A"), ("anomalies",))
    second = Params("A", window_days=3, threshold=60.0)
    fixtures.replay(spark, sf_dir, second, ("anomalies",), store=store)
    days = F.datediff("window_end", "window_start")
    found = read_results(spark, store, ANOMALIES).where((days == 3) & (F.col("threshold") == 60.0))
    return found.drop("threshold")


def stream_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth record has half a district: its groups stand beside the table."""

    def halved(fields: DataFrame) -> DataFrame:
        number = F.col("event_id") % 25 + F.lit(0.5)
        half = F.when(F.col("event_id") % 50 == 0, number.cast("string"))
        return fields.withColumn("District", F.coalesce(half, F.col("District")))

    store = fixtures.replay(spark, sf_dir, Params("A"), ("aggregates",), slices=2, lines=halved)
    kept = read_results(spark, store, MONTHLY).select(
        F.lit("stored").alias("place"), F.col("district").cast("double").alias("district"), "total_crimes"
    )
    path = f"{store.path(MONTHLY.table)}_rejected"
    newest = F.max("total_crimes").alias("total_crimes")  # counts of a group only grow
    rejected = spark.read.parquet(path).groupBy("year_month", "category", "District").agg(newest)
    both = kept.union(rejected.select(F.lit("rejected"), "District", "total_crimes"))
    return both.groupBy("place", "district").agg(F.sum("total_crimes").alias("records"))


BATCH: dict[str, Query] = {
    "code_table": code_table,
    "normalized_codes": normalized_codes,
    "duplicated_codes": duplicated_codes,
    "parsed_records": parsed_records,
    "parsed_dirty_records": parsed_dirty_records,
    "enriched_records": _events,
    "enriched_records_orders": _orders,
    "enriched_dirty_records": _dirty,
    "enriched_by_shuffle": enriched_by_shuffle,
    "monthly_aggregates_events": lambda s, d: aggregate_monthly(_events(s, d)),
    "monthly_aggregates_orders": lambda s, d: aggregate_monthly(_orders(s, d)),
    "monthly_aggregates_dirty": lambda s, d: aggregate_monthly(_dirty(s, d)),
    "monthly_with_duplicate_codes": monthly_with_duplicate_codes,
    "window30_aggregates_events": lambda s, d: aggregate_windowed(_events(s, d)),
    "window30_aggregates_orders": lambda s, d: aggregate_windowed(_orders(s, d)),
    "anomalies_7d_40_events": lambda s, d: anomalies(_events(s, d)),
    "anomalies_7d_40_orders": lambda s, d: anomalies(_orders(s, d)),
    "anomalies_1d_40": lambda s, d: anomalies(_events(s, d), window_days=1),
    "anomalies_1d_40_orders": lambda s, d: anomalies(_orders(s, d), window_days=1),
    "anomalies_7d_0": lambda s, d: anomalies(_events(s, d), threshold=0),
    "anomalies_7d_0_orders": lambda s, d: anomalies(_orders(s, d), threshold=0),
    "anomalies_30d_33": lambda s, d: anomalies(_orders(s, d), window_days=30, threshold=33.0),
    "anomalies_dirty": lambda s, d: anomalies(_dirty(s, d), window_days=2, threshold=30.0),
    "null_event_time": lambda s, d: anomalies(_undated(s, d), threshold=0),
    "null_event_time_monthly": lambda s, d: aggregate_monthly(_undated(s, d)),
    "null_event_time_window30": lambda s, d: aggregate_windowed(_undated(s, d)),
}

STREAMING: dict[str, Query] = {
    "stream_anomalies_closed": stream_anomalies_closed,
    "stream_anomalies_all_closed": stream_anomalies_all_closed,
    "stream_window30_closed": stream_window30_closed,
    "stream_monthly_upsert": stream_monthly_upsert,
    "stream_monthly_added": stream_monthly_added,
    "stream_monthly_late_added": stream_monthly_late_added,
    "stream_late_dropped": stream_late_dropped,
    "stream_monthly_late_counted": stream_monthly_late_counted,
    "stream_two_queries": stream_two_queries,
    "stream_anomalies_30d": stream_anomalies_30d,
    "stream_anomalies_two_settings": stream_anomalies_two_settings,
    "stream_rejected_rows": stream_rejected_rows,
}

STORAGE: dict[str, Query] = {
    "publish_roundtrip": publish_roundtrip,
    "publish_beside_folders": publish_beside_folders,
    "publish_resumed": publish_resumed,
    "results_readback_folded": results_readback_folded,
    "results_read_while_folding": results_read_while_folding,
    "results_readback": results_readback,
    "results_readback_recreated": results_readback_recreated,
    "results_readback_upserted": results_readback_upserted,
}


def registered() -> dict[str, Query]:
    def comparable(query: Query) -> Query:
        return lambda spark, sf_dir: zoneless(query(prepare_session(spark), sf_dir))

    return {name: comparable(q) for name, q in {**BATCH, **STREAMING, **STORAGE}.items()}
