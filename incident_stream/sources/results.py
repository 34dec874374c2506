"""Read a stored result back in full."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.functions import month_label
from incident_stream.schema import Contract
from incident_stream.settings import FileStore, JdbcStore
from incident_stream.storage import Folder
from incident_stream.streaming.log import LOG_ORDER, Log, State, folder_of
from incident_stream.streaming.sinks import check_layout


def read_results(
    spark: SparkSession, store: FileStore | JdbcStore, contract: Contract
) -> DataFrame:
    """Every row of the table: no filter, no order, no limit."""
    if isinstance(store, JdbcStore):
        return _read_jdbc(spark, store, contract)
    log = Log(spark, store, contract)
    if log.exists():
        check_layout(spark, store, contract, "add" if log.is_added() else "upsert")
        return read_log(spark, log, contract, log.state())
    if not Folder(spark, store.path(contract.table)).exists() and _has_runs(spark, store, contract):
        return _empty(spark, contract)
    return spark.read.parquet(store.path(contract.table))


def _has_runs(spark: SparkSession, store: FileStore, contract: Contract) -> bool:
    return Folder(spark, f"{store.path(contract.table)}_runs").exists()


def _empty(spark: SparkSession, contract: Contract) -> DataFrame:
    return spark.createDataFrame([], _ddl(contract))


def _ddl(contract: Contract) -> str:
    return ", ".join(f"{name} {kind}" for _, name, kind in contract.columns)


def _read_jdbc(spark: SparkSession, store: JdbcStore, contract: Contract) -> DataFrame:
    """One query per share of the districts, so that no single task reads the whole table. A table
    that Spark itself has defined has other column names and types, and is one plain query, and so
    is any table with one connection."""
    n, table = store.connections, contract.table
    plain = spark.read.jdbc(store.url, table, properties=store.properties)
    if n == 1 or dict(plain.dtypes).get("district") != "int":
        return plain
    shares = [f"ABS(MOD(district, {n})) = {i}" for i in range(n)]
    shares[0] += " OR district IS NULL"
    return spark.read.jdbc(store.url, table, predicates=shares, properties=store.properties)


def read_log(
    spark: SparkSession, log: Log, contract: Contract, state: State, keep_order: bool = False
) -> DataFrame:
    """The last written row of each key, or, in a table that adds up, the sums of the newest lineage,
    from the base and the finished batches beside it.

    The order is one number, and a value that is text is derived from the key, so that all of it is
    summed up by hash and nothing is sorted.
    """
    order = ", ".join(f"{name} bigint" for name in LOG_ORDER)
    schema = f"{_ddl(contract)}, {order}"
    parts = []
    if state.number:
        parts.append(spark.read.schema(schema).parquet(log.base_path(state.folder)))
    if state.fresh:
        paths = [f"{log.path}/{folder_of(place)}" for place in state.fresh]
        parts.append(spark.read.schema(schema).option("basePath", log.path).parquet(*paths))
    if not parts:
        return spark.createDataFrame([], schema if keep_order else _ddl(contract))
    rows = reduce(DataFrame.unionByName, parts)
    run, batch = LOG_ORDER
    if log.is_added():
        newest = max({*state.marks, *(place[0] for place in state.fresh)})
        groups = rows.where(F.col(run) == newest).groupBy(*contract.key)
        last = [F.lit(newest).cast("bigint").alias(run), F.max(batch).alias(batch)] if keep_order else []
        return groups.agg(*[F.sum(c).alias(c) for c in contract.values], *last).select(
            *contract.names, *(LOG_ORDER if keep_order else ())
        )
    version = F.shiftleft(F.col(run), 32) + F.col(batch)
    kinds = {name: kind for _, name, kind in contract.columns}
    # the month of a window is that of its start, which is part of the key
    derived = {}
    if "window_start" in contract.key and "year_month" in contract.values:
        derived["year_month"] = month_label(F.col("window_start"))
    stored = [c for c in contract.values if c not in derived]
    newest = rows.withColumn("version", version).groupBy(*contract.key).agg(
        *[F.max_by(c, "version").alias(c) for c in stored], F.max("version").alias("version")
    )
    columns = [derived.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in contract.names]
    if keep_order:
        columns += [
            F.shiftright("version", 32).alias(run),
            F.col("version").bitwiseAND(F.lit((1 << 32) - 1)).alias(batch),
        ]
    return newest.select(columns)
