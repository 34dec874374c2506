"""What happens with a micro-batch of results.

Modes: `upsert` keeps the last row of every key and is what a query should use; `add` adds the
counts of a batch to those of the batches before it, and needs no state in the query; `replace`
empties the table and keeps its definition; `recreate` drops the table and lets Spark define it
anew; `append` adds rows. With `replace` and `recreate` a table holds the last batch only, since a
streaming query hands out closed or changed groups, never all of them.

As files, a table that is upserted or added up is a log in a folder of its own, `<table>_log` (see
`log.py`). In a database, what may not happen twice is written in one transaction with the number
of the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from incident_stream.schema import Contract
from incident_stream.settings import FileStore, JdbcStore
from incident_stream.storage import Folder
from incident_stream.streaming.log import KEEP_SECONDS, Log

MODES = ("upsert", "add", "replace", "recreate", "append")
LOGGED = ("upsert", "add")
REASON = "reason"
LINEAGE = "lineage.json"
LEDGER = "incident_batches"


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Names, types and column order of the stored table; the district becomes an integer. Rows
    with a `reject_reason` must be taken out before."""
    return df.select(
        [F.col(ours).cast(kind).alias(name) for ours, name, kind in contract.columns]
    )


def reject_reason(df: DataFrame, contract: Contract) -> Column:
    """Why a row cannot be stored, null if it can: a number that is no whole one, or too large, in
    a column of integers. Cut off, it would put two groups under one key."""
    kinds = dict(df.dtypes)
    reasons = []
    for ours, _, kind in contract.columns:
        if kind == "int" and kinds[ours] == "double":
            number = F.col(ours)
            fits = (number == F.floor(number)) & number.between(-(2.0**31), 2.0**31 - 1)
            text = F.concat(F.lit(f"{ours} is no whole number: "), number.cast("string"))
            reasons.append(F.when(~fits, text))
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def claim_run(spark: SparkSession, store: FileStore | JdbcStore, contract: Contract) -> int:
    """A number for a run that starts now, above those of all runs before it that wrote the table.

    It is taken from the store, by making a file that must not be there yet: the order of runs does
    not depend on clocks, a run that is resumed counts as the newest, and of two that start at the
    same time each gets its own.
    """
    if not isinstance(store, FileStore):
        return 0
    folder = Folder(spark, f"{store.path(contract.table)}_runs")
    number = max((int(n) for n in folder.names("*") if n.isdigit()), default=0) + 1
    while not folder.claim(str(number)):
        number += 1
    return number


@dataclass(frozen=True)
class Lineage:
    """All runs of a query on one checkpoint, by a number of the store and a name of its own. Of two
    lineages that add to one Parquet table the one with the higher number counts."""

    number: int
    name: str


def lineage_of(
    spark: SparkSession, store: FileStore | JdbcStore, contract: Contract, checkpoint: str
) -> Lineage:
    """The lineage of a checkpoint, which is noted inside it: a checkpoint that is made anew begins a
    new one, whatever it is called."""
    folder = Folder(spark, checkpoint.rstrip("/"))
    if not folder.exists(LINEAGE):
        number = claim_run(spark, store, contract)
        folder.write_json(LINEAGE, {"number": number, "name": uuid.uuid4().hex})
    return Lineage(**folder.read_json(LINEAGE))


def batch_writer(
    store: FileStore | JdbcStore,
    contract: Contract,
    mode: str = "upsert",
    run: int = 0,
    name: str = "",
) -> Callable[[DataFrame, int], None]:
    """The callback for `foreachBatch`. `run` orders the runs that write one Parquet table; `name`
    tells apart the queries that write one database table.

    With `add`, `run` and `name` are those of the lineage: a batch that is repeated after a restart
    has the same number and counts once. With `append`, a repeated batch is skipped in a database if
    there is a name; files get its rows twice.

    Rows that cannot be stored go to `<table>_rejected`, complete and with the reason, before the
    others are written; the batch goes on.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "add" and not contract.adds_up:
        raise ValueError(f"the values of {contract.table} cannot be added up")

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "recreate":
            _write(batch, store, contract, mode, run, batch_id, name)
            return
        marked = batch.withColumn(REASON, reject_reason(batch, contract)).persist()
        try:
            seen = Observation()
            counted = marked.observe(seen, F.count(REASON).alias("bad"), F.count("*").alias("all"))
            counted.write.format("noop").mode("overwrite").save()
            if seen.get["bad"]:
                rejected = marked.where(F.col(REASON).isNotNull())
                _write_rejected(rejected, store, contract, run, batch_id)
            if mode in LOGGED and seen.get["all"] == seen.get["bad"]:
                return  # nothing to add
            good = conform(marked.where(F.col(REASON).isNull()), contract)
            _write(good, store, contract, mode, run, batch_id, name)
        finally:
            marked.unpersist()

    return write


def _write(
    rows: DataFrame,
    store: FileStore | JdbcStore,
    contract: Contract,
    mode: str,
    run: int,
    batch_id: int,
    name: str,
) -> None:
    if isinstance(store, JdbcStore):
        _write_jdbc(rows, store, contract, mode, name, batch_id)
    else:
        _write_files(rows, store, contract, mode, run, batch_id)


def _write_rejected(
    rows: DataFrame, store: FileStore | JdbcStore, contract: Contract, run: int, batch_id: int
) -> None:
    table = f"{contract.table}_rejected"
    if isinstance(store, JdbcStore):
        writer = rows.repartition(store.connections).write.mode("append")
        writer.jdbc(store.url, table, properties=store.properties)
    else:
        place = f"{store.path(table)}/run={run}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(place)


def check_layout(spark: SparkSession, store: FileStore, contract: Contract, mode: str) -> None:
    """Refuse a table that was written in another way."""
    log = Log(spark, store, contract)
    if mode in LOGGED:
        plain = store.path(contract.table)
        if Folder(spark, plain).exists():
            raise ValueError(f"{plain} exists: the table was not written with {mode}")
        if log.exists() and log.is_added() != (mode == "add"):
            raise ValueError(f"{log.path} was not written with {mode}")
    elif log.exists():
        raise ValueError(f"{log.path} exists: the table was not written with {mode}")


def _write_files(
    rows: DataFrame, store: FileStore, contract: Contract, mode: str, run: int, batch_id: int
) -> None:
    check_layout(rows.sparkSession, store, contract, mode)
    if mode in LOGGED:
        Log(rows.sparkSession, store, contract).add(rows, (run, batch_id), mode == "add")
        return
    rows.write.mode("append" if mode == "append" else "overwrite").parquet(
        store.path(contract.table)
    )


def fold(
    spark: SparkSession,
    store: FileStore,
    contract: Contract,
    keep_seconds: float = KEEP_SECONDS,
) -> int:
    """Merge the base and all finished batches of a logged table into a new base, and return how
    many batches it took in. A running job goes on unaffected.

    Rows keep the run and batch that they come from, so later batches of older runs are still
    ordered as they were. What the new base covers is deleted by a fold that finds it there for
    `keep_seconds` or longer: until then, a DataFrame made before still reads in full.
    """
    from incident_stream.sources.results import read_log

    log = Log(spark, store, contract)
    state = log.state()
    if state.fresh:
        log.publish(state, read_log(spark, log, contract, state, keep_order=True))
    if log.exists():
        log.clean(keep_seconds)
    return len(state.fresh)


def _write_jdbc(
    rows: DataFrame, store: JdbcStore, contract: Contract, mode: str, name: str, batch_id: int
) -> None:
    # A shuffle, not coalesce: it bounds the number of connections without narrowing the stage
    # that updates the state.
    spread = rows.repartition(store.connections)
    if mode in ("replace", "recreate"):
        _overwrite(spread, store, contract.table, truncate=mode == "replace")
        return
    if mode == "append" and not name:
        spread.write.mode("append").jdbc(store.url, contract.table, properties=store.properties)
        return
    if mode == "add" and not name:
        raise ValueError("batches that add up in a database need the name of their query")
    # of its own for each query: two jobs may write into one table at the same time
    staging = f"{contract.table}_staging{f'_{name}' if name else ''}"
    _overwrite(spread, store, staging, truncate=True)
    if mode == "upsert":  # a repeated batch has the same rows, so it may be merged again
        execute(rows.sparkSession, store, [merge_statement(contract, staging, store.dialect)])
        return
    if mode == "append":
        statement = append_statement(contract, staging)
    else:
        statement = merge_statement(contract, staging, store.dialect, add=True)
    commit_once(rows.sparkSession, store, name, batch_id, [statement])


def _overwrite(rows: DataFrame, store: JdbcStore, table: str, truncate: bool) -> None:
    writer = rows.write.mode("overwrite").option("truncate", str(truncate).lower())
    writer.jdbc(store.url, table, properties=store.properties)


def append_statement(contract: Contract, staging: str) -> str:
    columns = ", ".join(contract.names)
    return f"INSERT INTO {contract.table} ({columns}) SELECT DISTINCT {columns} FROM {staging}"


def merge_statement(contract: Contract, staging: str, dialect: str, add: bool = False) -> str:
    """One statement that moves the staged rows in: the values of a known key are replaced or, with
    `add`, added to. A task that ran twice can have staged its rows twice, hence DISTINCT."""
    columns = ", ".join(contract.names)
    if dialect == "postgresql":
        old = f"{contract.table}." if add else ""
        updates = ", ".join(
            f"{c} = {f'{old}{c} + ' if add else ''}EXCLUDED.{c}" for c in contract.values
        )
        return (
            f"INSERT INTO {contract.table} ({columns}) SELECT DISTINCT {columns} FROM {staging} "
            f"ON CONFLICT ({', '.join(contract.key)}) DO UPDATE SET {updates}"
        )
    matched = " AND ".join(f"t.{c} = s.{c}" for c in contract.key)
    updates = ", ".join(f"t.{c} = {f't.{c} + ' if add else ''}s.{c}" for c in contract.values)
    fresh = ", ".join(f"s.{c}" for c in contract.names)
    return (
        f"MERGE INTO {contract.table} t USING (SELECT DISTINCT {columns} FROM {staging}) s "
        f"ON {matched} WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({fresh})"
    )


# SQL types of the stored columns. A key column cannot be of unlimited length everywhere.
_SQL_TYPES = {
    "string": "VARCHAR(4000)",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE PRECISION",
    "timestamp": "TIMESTAMP",
}


def table_statement(contract: Contract, dialect: str) -> str:
    """Definition of a result table with its primary key."""
    types = dict(_SQL_TYPES, string="TEXT") if dialect == "postgresql" else _SQL_TYPES
    columns = ", ".join(f"{name} {types[kind]}" for _, name, kind in contract.columns)
    guard = "IF NOT EXISTS " if dialect == "postgresql" else ""
    key = ", ".join(contract.key)
    return f"CREATE TABLE {guard}{contract.table} ({columns}, PRIMARY KEY ({key}))"


def ledger_statement(dialect: str) -> str:
    """Definition of the ledger: the last batch of each query that is in its table."""
    guard = "IF NOT EXISTS " if dialect == "postgresql" else ""
    return (
        f"CREATE TABLE {guard}{LEDGER} "
        "(query_name VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, PRIMARY KEY (query_name))"
    )


def create_tables(spark: SparkSession, store: JdbcStore, *contracts: Contract) -> None:
    tables = [table_statement(c, store.dialect) for c in contracts]
    execute(spark, store, [*tables, ledger_statement(store.dialect)])


@contextmanager
def transaction(spark: SparkSession, store: JdbcStore) -> Iterator:
    """A connection over the JDBC driver on the Spark driver's class path. What is done inside is
    committed as one, or, after an error, not at all."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in store.properties.items():
        settings.setProperty(name, value)
    if "driver" in store.properties:
        jvm.java.lang.Class.forName(store.properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(store.url, settings)
    try:
        connection.setAutoCommit(False)
        try:
            yield connection
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
    finally:
        connection.close()


def execute(spark: SparkSession, store: JdbcStore, statements: list[str]) -> None:
    """Run statements in one transaction."""
    with transaction(spark, store) as connection:
        statement = connection.createStatement()
        for text in statements:
            statement.executeUpdate(text)


def commit_once(
    spark: SparkSession, store: JdbcStore, name: str, batch_id: int, statements: list[str]
) -> bool:
    """Run the statements of a batch and enter it in the ledger, in one transaction. A batch that is
    entered already is left out. A query writes its batches in their order, so the ledger holds the
    last one only."""
    with transaction(spark, store) as connection:
        asked = connection.prepareStatement(f"SELECT batch_id FROM {LEDGER} WHERE query_name = ?")
        asked.setString(1, name)
        found = asked.executeQuery()
        known = found.getLong(1) if found.next() else None
        if known is not None and known >= batch_id:
            return False
        statement = connection.createStatement()
        for text in statements:
            statement.executeUpdate(text)
        if known is None:
            entry = f"INSERT INTO {LEDGER} (batch_id, query_name) VALUES (?, ?)"
        else:
            entry = f"UPDATE {LEDGER} SET batch_id = ? WHERE query_name = ?"
        entered = connection.prepareStatement(entry)
        entered.setLong(1, batch_id)
        entered.setString(2, name)
        entered.executeUpdate()
    return True
