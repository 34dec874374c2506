"""The given tables as record lines and as a code table (rules in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.plans.pipelines import run
from incident_stream.settings import FileStore, Params, RecordSource, new_work_dir
from incident_stream.streaming.queries import await_all

LINE_TIME = "yyyy-MM-dd HH:mm:ss"
STATE_PARTITIONS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(number: Column) -> Column:
    return F.lpad(number.cast("string"), 4, "0")


def _flag(condition: Column) -> Column:
    return F.when(condition, "True").otherwise("False")


def _district(number: Column) -> Column:
    """Empty where the remainder is 0."""
    rest = number % 25
    return F.when(rest != 0, rest.cast("double").cast("string"))


def code_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code table as its file holds it, with a column that nothing reads."""
    nation = _table(spark, sf_dir, "nation")
    return nation.select(
        _code(F.col("n_nationkey")).alias("IUCR"),
        F.col("n_name").alias("PRIMARY DESCRIPTION"),
        F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias(
            "SECONDARY DESCRIPTION"
        ),
        F.when(F.col("n_regionkey").isin(0, 1), "I").otherwise("N").alias("INDEX CODE"),
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code table as `read_codes` returns it."""
    table = code_file(spark, sf_dir)
    return table.select(
        "IUCR",
        F.col("PRIMARY DESCRIPTION").alias("category"),
        F.col("INDEX CODE").alias("index_code"),
    )


def codes_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth code once more, without its leading zeros."""
    table = codes(spark, sf_dir)
    again = table.where(F.col("IUCR").cast("int") % 5 == 0)
    return table.unionByName(again.withColumn("IUCR", F.col("IUCR").cast("int").cast("string")))


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E, one column per field of the line, and `ts` to cut it by time."""
    events = _table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("event_id").cast("string").alias("ID"),
        F.date_format("ts", LINE_TIME).alias("Date"),
        _code(F.col("event_id") % 30).alias("IUCR"),
        _flag(F.col("event_type") == "purchase").alias("Arrest"),
        _flag(F.col("event_type") == "error").alias("Domestic"),
        _district(F.col("user_id")).alias("District"),
    )


def order_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture O."""
    orders = _table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("ID"),
        F.date_format("o_orderdate", LINE_TIME).alias("Date"),
        _code(F.col("o_orderkey") % 30).alias("IUCR"),
        _flag(F.col("o_orderstatus") == "F").alias("Arrest"),
        _flag(F.col("o_orderpriority") == "1-URGENT").alias("Domestic"),
        _district(F.col("o_custkey")).alias("District"),
    )


FIELDS = ("ID", "Date", "IUCR", "Arrest", "Domestic", "District")


def to_line(*extra: Column) -> Column:
    """The fields as one CSV line, the last three of them empty."""
    filled = [F.coalesce(F.col(name), F.lit("")) for name in FIELDS]
    return F.concat_ws(",", *filled, F.lit(""), F.lit(""), F.lit(""), *extra)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_fields(spark, sf_dir).select(to_line().alias("csv_line"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fields(spark, sf_dir).select(to_line().alias("csv_line"))


def undated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E with an unreadable date in every tenth line."""
    bad = F.when(F.col("event_id") % 10 == 0, F.lit("01/05/2024 11:00:00 AM"))
    fields = event_fields(spark, sf_dir)
    return fields.withColumn("Date", F.coalesce(bad, F.col("Date"))).select(
        to_line().alias("csv_line")
    )


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E with one kind of irregularity per line, chosen by the remainder of event_id."""
    kind = F.col("event_id") % 10
    number, district, code = F.col("event_id"), F.col("District"), F.col("IUCR")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    day_only = F.date_format("ts", "yyyy-MM-dd")
    changed = {
        "District": F.when(kind == 1, "abc").when(kind == 2, " 7.0 ").otherwise(district),
        "IUCR": F.when(kind == 3, F.concat(F.lit(" "), code, F.lit(" ")))
        .when(kind == 4, '"0,1"')
        .otherwise(code),
        "Arrest": F.when(kind == 5, F.lower("Arrest")).otherwise(F.col("Arrest")),
        "Date": F.when(kind == 6, iso).when(kind == 7, day_only).otherwise(F.col("Date")),
    }
    fields = event_fields(spark, sf_dir).withColumns(changed)
    short = F.concat_ws(",", "ID", "Date", "IUCR")
    line = (
        F.when(kind == 8, short)
        .when(number % 20 == 9, "")
        .when(number % 1000 == 0, F.concat(to_line(), F.repeat(F.lit(","), F.lit(21_000))))
        .when(kind == 9, to_line(F.lit("EXTRA")))
        .otherwise(to_line())
    )
    return fields.select(line.alias("csv_line"))


def land_in_slices(
    spark: SparkSession,
    sf_dir: str,
    landing: str,
    slices: int,
    advance: Callable[[], None],
    lines: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write fixture E into a folder of text files, one stretch of time after the other, and call
    `advance` after each."""
    fields = event_fields(spark, sf_dir)
    ends = fields.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    step = (ends["last"] - ends["first"]) / slices
    for i in range(slices):
        inside = F.col("ts") >= _moment(ends["first"] + i * step)
        if i + 1 < slices:
            inside = inside & (F.col("ts") < _moment(ends["first"] + (i + 1) * step))
        if i == 0:  # a line without a time belongs to the first stretch
            inside = (F.col("ts") < _moment(ends["first"] + step)) | F.col("ts").isNull()
        part = fields.where(inside)
        _land(lines(part) if lines else part, landing)
        advance()


def land_first_day_again(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """All lines of the first day once more, long after their windows have closed."""
    fields = event_fields(spark, sf_dir)
    first = fields.agg(F.min("ts").alias("first")).first()["first"]
    midnight = first.replace(hour=0, minute=0, second=0, microsecond=0)
    _land(fields.where(F.col("ts") < _moment(midnight + timedelta(days=1))), landing)


def _moment(when: datetime) -> Column:
    """A literal of the type of `ts`, so that the comparison reaches the Parquet scan."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def _land(fields: DataFrame, landing: str) -> None:
    fields.select(to_line().alias("value")).write.mode("append").text(landing)


def replay(
    spark: SparkSession,
    sf_dir: str,
    params: Params,
    results: tuple[str, ...],
    slices: int = 3,
    late: bool = False,
    store: FileStore | None = None,
    lines: Callable[[DataFrame], DataFrame] | None = None,
    sink_mode: str = "upsert",
    after: Callable[[FileStore], None] | None = None,
) -> FileStore:
    """Run the streaming job over fixture E, stopping and restarting it after every slice. `store`
    takes the results of several such jobs; `lines` changes the fields of the fixture; `after` is
    called after each start of the job."""
    work = new_work_dir(spark)
    code_file(spark, sf_dir).write.csv(f"{work}/codes", header=True)
    landing = f"{work}/landing"
    store = store or FileStore(f"{work}/results")

    def advance() -> None:
        source = RecordSource.text(landing)
        await_all(
            run(
                spark,
                source,
                f"{work}/codes",
                store,
                f"{work}/checkpoints",
                params,
                sink_mode,
                trigger={"availableNow": True},
                results=results,
                state_partitions=STATE_PARTITIONS,
            )
        )
        if after:
            after(store)

    land_in_slices(spark, sf_dir, landing, slices, advance, lines)
    if late:
        land_first_day_again(spark, sf_dir, landing)
        advance()
    return store
