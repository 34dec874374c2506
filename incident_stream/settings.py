"""Parameters, source and store descriptions, and the few session settings the job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from incident_stream.schema import DEFAULT_THRESHOLD, DEFAULT_WINDOW_DAYS

DELAYS = ("A", "C")


@dataclass(frozen=True)
class Params:
    """`delay` A: counts per month, updated every batch. C: counts per 30 days, once closed."""

    delay: str
    window_days: int = DEFAULT_WINDOW_DAYS
    threshold: float = DEFAULT_THRESHOLD

    def __post_init__(self) -> None:
        if self.delay not in DELAYS:
            raise ValueError(f"delay must be one of {DELAYS}, not {self.delay!r}")
        check_window_days(self.window_days)
        check_threshold(self.threshold)


def check_window_days(days: int) -> int:
    if isinstance(days, bool) or not isinstance(days, int) or days < 1:
        raise ValueError(f"window_days must be a whole number of at least 1, not {days!r}")
    return days


def check_threshold(percent: float) -> float:
    if not 0 <= percent <= 100:
        raise ValueError(f"threshold must lie between 0 and 100, not {percent!r}")
    return percent


@dataclass(frozen=True)
class RecordSource:
    """Where record lines come from: a Kafka topic, or a directory of text files.

    `options` go to the reader as they are, e.g. `maxOffsetsPerTrigger` and `minPartitions` for
    Kafka or `maxFilesPerTrigger` for files, which bound the size of a micro-batch.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None

    @classmethod
    def kafka(cls, servers: str, topic: str, **options: str) -> RecordSource:
        wanted = {"kafka.bootstrap.servers": servers, "subscribe": topic}
        return cls("kafka", {"startingOffsets": "earliest", **wanted, **options})

    @classmethod
    def text(cls, path: str, **options: str) -> RecordSource:
        return cls("text", dict(options), path)


@dataclass(frozen=True)
class FileStore:
    """Result tables as Parquet below `root`, a folder that the whole cluster can reach."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


@dataclass(frozen=True)
class JdbcStore:
    """Result tables in a database. Credentials come in through `properties`, never from code."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 8

    @property
    def dialect(self) -> str:
        return self.url.split(":")[1]


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the zone that month labels and zone-less dates are read in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """Another number of shuffle partitions for the queries started inside."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if number is not None:
        spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# For a state too large for the executors' heap: pass these when the session is built.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def new_work_dir(spark: SparkSession) -> str:
    """A new folder name below the shared folder the cluster names, or, where none is named
    (a test on one machine), below a new temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="incident-stream-")
    return f"{base.rstrip('/')}/incident-stream-{uuid.uuid4().hex}"


def database_properties() -> dict[str, str]:
    """JDBC user and password from the environment of the job."""
    found = {
        "user": os.environ.get("INCIDENT_DB_USER"),
        "password": os.environ.get("INCIDENT_DB_PASSWORD"),
        "driver": os.environ.get("INCIDENT_DB_DRIVER"),
    }
    return {name: value for name, value in found.items() if value}
