"""Incident-record analytics on PySpark: counts per month, category and district, and anomaly
windows per district, over batch or streaming input."""

from incident_stream.operators.aggregate import (
    aggregate_monthly,
    aggregate_windowed,
    anomalies,
)
from incident_stream.operators.enrich import duplicate_codes, enrich, fill_unknown
from incident_stream.operators.parse import parse_records
from incident_stream.plans.pipelines import enriched, run
from incident_stream.settings import (
    FileStore,
    JdbcStore,
    Params,
    RecordSource,
    prepare_session,
)
from incident_stream.sources.codes import normalize_codes, read_codes
from incident_stream.sources.publish import publish_lines, publish_new_files
from incident_stream.sources.records import read_record_stream
from incident_stream.sources.results import read_results
from incident_stream.streaming.queries import await_all, start_query
from incident_stream.streaming.sinks import batch_writer, claim_run, conform, fold

__all__ = [
    "FileStore",
    "JdbcStore",
    "Params",
    "RecordSource",
    "aggregate_monthly",
    "aggregate_windowed",
    "anomalies",
    "await_all",
    "batch_writer",
    "claim_run",
    "conform",
    "duplicate_codes",
    "enrich",
    "enriched",
    "fill_unknown",
    "fold",
    "normalize_codes",
    "parse_records",
    "prepare_session",
    "publish_lines",
    "publish_new_files",
    "read_codes",
    "read_record_stream",
    "read_results",
    "run",
    "start_query",
]
