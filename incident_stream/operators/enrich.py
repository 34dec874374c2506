"""Join with the code table, and stand-ins for missing keys."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_stream.schema import MISSING_KEYS

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64
SALTS = 8


def table_bytes(codes: DataFrame) -> int:
    """Size of the code table, its text and a fixed amount per row, in one small job."""
    width = F.lit(ROW_OVERHEAD)
    for name in codes.columns:
        width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return codes.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def duplicate_codes(codes: DataFrame) -> DataFrame:
    """Codes that stand in the table more than once after normalising. Each such row multiplies
    the records it matches."""
    counted = codes.where(F.col("IUCR").isNotNull()).groupBy("IUCR")
    return counted.agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def enrich(
    records: DataFrame,
    codes: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int | None = None,
    unique: bool = False,
    join_partitions: int | None = None,
    hot: Collection[str] | None = None,
    size: int | None = None,
) -> DataFrame:
    """Left join on the normalised code; records without a match keep a null category.

    A table of up to `broadcast_bytes`, which is measured first if its `size` is not known, is
    broadcast, so the records do not move. A larger one is joined by shuffle and merge, which can spill, in `join_partitions`
    tasks (by default the shuffle partitions of the session when the join is made).

    In a batch, adaptive execution splits the tasks of a hot code, and nothing is copied. A stream
    has no adaptive execution, and where a session has none, codes are salted: `hot` names those
    that carry many records. Each of their rows in the table is copied for all tasks, and their
    records are spread over all tasks; all others are joined as they are. Where nothing is known
    (`hot` is None), every code has `salts` copies. A record takes its salt from a hash of itself
    and the number of the partition it was read in, so that the records of a code spread however few
    partitions the source has, and a task that runs again gives the same salts. Records without a
    code need no partner: they take salts of all partitions, of which no copies are made. With
    `unique`, duplicate codes are an error.
    """
    if unique and not duplicate_codes(codes).isEmpty():
        raise ValueError("a code stands more than once in the code table after normalising")
    if (table_bytes(codes) if size is None else size) <= broadcast_bytes:
        return records.join(F.broadcast(codes), "IUCR", "left")
    conf = records.sparkSession.conf
    partitions = join_partitions or int(conf.get("spark.sql.shuffle.partitions"))
    adaptive = conf.get("spark.sql.adaptive.enabled") == "true" and not records.isStreaming
    if adaptive and salts is None and hot is None:
        return records.join(codes.hint("merge"), "IUCR", "left")
    if hot is None:
        copies = F.lit(min(SALTS, partitions) if salts is None else salts)
    else:
        copies = F.when(F.col("IUCR").isin(list(hot)), salts or partitions).otherwise(1)
    number = F.xxhash64(F.spark_partition_id(), *records.columns)
    spread = F.when(F.col("IUCR").isNull(), F.lit(partitions)).otherwise(copies)
    salted = records.withColumn("salt", F.pmod(number, spread).cast("int"))
    repeated = salted_codes(codes, copies)
    return (
        salted.repartition(partitions, "IUCR", "salt")
        .join(repeated.repartition(partitions, "IUCR", "salt").hint("merge"), ["IUCR", "salt"], "left")
        .drop("salt")
    )


def salted_codes(codes: DataFrame, copies: Column) -> DataFrame:
    """The known codes, with so many copies of each."""
    salt = F.explode(F.sequence(F.lit(0), copies - 1))
    return codes.where(F.col("IUCR").isNotNull()).withColumn("salt", salt)


def fill_unknown(records: DataFrame) -> DataFrame:
    """Missing category, month and district get their stand-ins; a NaN district counts as
    missing."""
    return records.fillna(MISSING_KEYS)
