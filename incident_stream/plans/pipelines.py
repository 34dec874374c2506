"""The pipelines a user runs."""

from __future__ import annotations

import hashlib
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from incident_stream.operators.aggregate import (
    aggregate_monthly,
    aggregate_windowed,
    anomalies,
)
from incident_stream.operators.enrich import (
    BROADCAST_BYTES,
    duplicate_codes,
    enrich,
    fill_unknown,
    table_bytes,
)
from incident_stream.operators.hot_codes import METRIC, CodeListener, RecentCodes, frequent_codes
from incident_stream.operators.parse import parse_records
from incident_stream.schema import ANOMALIES, MONTHLY, WINDOWED, Contract
from incident_stream.settings import (
    FileStore,
    JdbcStore,
    Params,
    RecordSource,
    prepare_session,
    shuffle_partitions,
)
from incident_stream.sources.codes import normalize_codes, pin_codes
from incident_stream.sources.records import read_record_stream
from incident_stream.streaming.queries import start_query
from incident_stream.streaming.sinks import batch_writer, claim_run, lineage_of

# Output mode of each stored result.
OUTPUT_MODES = {MONTHLY.table: "update", WINDOWED.table: "append", ANOMALIES.table: "append"}


def enriched(lines: DataFrame, codes: DataFrame, **options) -> DataFrame:
    """Record lines and the code table, as read, to records ready for counting. `options` go to
    `enrich`."""
    joined = enrich(parse_records(lines), normalize_codes(codes), **options)
    return fill_unknown(joined)


def aggregates_for(records: DataFrame, params: Params) -> tuple[DataFrame, Contract]:
    if params.delay == "A":
        return aggregate_monthly(records), MONTHLY
    return aggregate_windowed(records, keep_window=True), WINDOWED


def checkpoint_names(params: Params) -> dict[str, str]:
    """Checkpoint folder per result. The state of one window length must never be continued with
    another, and two jobs must never write one checkpoint, so the parameters and the job are part
    of the name."""
    days, share = params.window_days, repr(float(params.threshold))
    return {
        MONTHLY.table: "aggregates_A",
        f"{MONTHLY.table} added": "aggregates_A_added",
        WINDOWED.table: "aggregates_C",
        ANOMALIES.table: f"anomalies_{params.delay}_D{days}_P{share}",
    }


def staging_name(checkpoint: str) -> str:
    """A short name for the query with this checkpoint, fit for a table name."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def warn_of_duplicates(codes: DataFrame) -> None:
    """One warning with the number of codes and, as an example, one of them."""
    found = duplicate_codes(normalize_codes(codes)).agg(
        F.count("*").alias("n"), F.min("IUCR").alias("first")
    ).first()
    if found["n"]:
        warnings.warn(
            f"{found['n']} codes stand more than once in the code table, {found['first']!r} for one;"
            " records that carry them count as often",
            stacklevel=3,
        )


def run(
    spark: SparkSession,
    source: RecordSource,
    codes_path: str,
    store: FileStore | JdbcStore,
    checkpoint_root: str,
    params: Params,
    sink_mode: str = "upsert",
    trigger: dict | None = None,
    results: tuple[str, ...] = ("aggregates", "anomalies"),
    state_partitions: int | None = None,
    unique_codes: bool = False,
) -> list[StreamingQuery]:
    """Start the anomaly query and the aggregate query on one source. The two are independent:
    each reads the source itself and has its own watermark, state and checkpoint.

    With `sink_mode="add"` the monthly counts need no state: every batch stores its own counts, and
    reading adds them up. The other results are handed out once and are upserted in that mode.

    `state_partitions` is the number of state stores per query, in place of
    `spark.sql.shuffle.partitions`; a checkpoint keeps the number it was made with. It should
    follow the number of result keys: records are summed up per key before they are shuffled.

    The code table is copied below the checkpoints first and read from there: replacing its file has
    no effect before the next start. It is read once and kept, in memory or on disk.

    Codes that stand more than once in the code table multiply the records that they match; they
    are reported as a warning, or, with `unique_codes`, refused.
    """
    prepare_session(spark)
    # kept in memory as far as it fits, so that the micro-batches do not read it again
    codes = pin_codes(spark, codes_path, f"{checkpoint_root.rstrip('/')}/codes").persist()
    if not unique_codes:
        warn_of_duplicates(codes)
    lines = read_record_stream(spark, source)
    records = _joined(spark, lines, codes, checkpoint_root, unique_codes, state_partitions)
    wanted: list[tuple[DataFrame, Contract, str]] = []
    rest_mode = "upsert" if sink_mode == "add" else sink_mode
    if "anomalies" in results:
        found = anomalies(records, params.window_days, params.threshold)
        share = F.lit(float(params.threshold)).alias("threshold")
        wanted.append((found.select("*", share), ANOMALIES, rest_mode))
    if "aggregates" in results:
        adds = sink_mode == "add" and params.delay == "A"
        if adds:
            wanted.append((records, MONTHLY, "add"))
        else:
            wanted.append((*aggregates_for(records, params), rest_mode))
    names = checkpoint_names(params)
    started: list[StreamingQuery] = []
    try:
        for frame, contract, mode in wanted:
            added = " added" if mode == "add" else ""
            checkpoint = f"{checkpoint_root.rstrip('/')}/{names[contract.table + added]}"
            writer = _writer(spark, store, contract, mode, checkpoint)
            output = "append" if mode == "add" else OUTPUT_MODES[contract.table]
            with shuffle_partitions(spark, state_partitions):
                started.append(start_query(frame, output, writer, checkpoint, trigger))
    except Exception:
        for query in started:
            query.stop()
        raise
    return started


def _writer(
    spark: SparkSession,
    store: FileStore | JdbcStore,
    contract: Contract,
    mode: str,
    checkpoint: str,
) -> Callable[[DataFrame, int], None]:
    name = staging_name(checkpoint)
    if mode not in ("add", "append"):
        return batch_writer(store, contract, mode, claim_run(spark, store, contract), name)
    lineage = lineage_of(spark, store, contract, checkpoint)
    write = batch_writer(store, contract, mode, lineage.number, f"{name}_{lineage.name[:12]}")
    if mode == "append":
        return write
    return lambda batch, batch_id: write(aggregate_monthly(batch), batch_id)


def _joined(
    spark: SparkSession,
    lines: DataFrame,
    codes: DataFrame,
    checkpoint_root: str,
    unique_codes: bool,
    partitions: int | None,
) -> DataFrame:
    """The enriched stream. Where the code table is too large to be broadcast, the batches report
    their frequent codes; those of the last batches, from before this start, are the hot ones."""
    size = table_bytes(normalize_codes(codes))
    if size <= BROADCAST_BYTES:
        return enriched(lines, codes, unique=unique_codes, size=size)
    recent = RecentCodes(spark, f"{checkpoint_root.rstrip('/')}/hot_codes")
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    metric = f"{METRIC} {uuid.uuid4().hex}"
    spark.streams.addListener(CodeListener(recent, metric))
    observed = parse_records(lines).observe(metric, *frequent_codes(F.col("IUCR")))
    joined = enrich(
        observed,
        normalize_codes(codes),
        unique=unique_codes,
        join_partitions=partitions,
        hot=recent.hot(partitions),
        size=size,
    )
    return fill_unknown(joined)
