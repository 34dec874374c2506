"""The three results. On a stream each sets its own watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from incident_stream.functions import flag_is, month_label, month_start, percent_of
from incident_stream.operators.panes import day_panes
from incident_stream.schema import (
    AGGREGATE_DELAY,
    CLOSED_WINDOW,
    DEFAULT_THRESHOLD,
    DEFAULT_WINDOW_DAYS,
    INDEXED,
    MISSING_KEYS,
    SLIDE,
    YES,
)
from incident_stream.settings import check_threshold, check_window_days

# On a stream, windows of so many days are built from panes: below, copying records costs less than
PANE_DAYS = 7


def _indexed() -> Column:
    return F.count_if(flag_is("index_code", INDEXED)).alias("fbi_indexed")


def _total() -> Column:
    return F.count("*").alias("total_crimes")


def _all_counts() -> list[Column]:
    return [
        _total(),
        F.count_if(flag_is("Arrest", YES)).alias("arrests"),
        F.count_if(flag_is("Domestic", YES)).alias("domestics"),
        _indexed(),
    ]


def aggregate_monthly(enriched: DataFrame) -> DataFrame:
    """Counts per month, category and district, for streams in update mode.

    The window of time is not part of the key, so late records count, records without a date are
    kept under their own label, and the state holds every key ever seen. Months are grouped as
    dates and labelled once per group.
    """
    timed = enriched.withWatermark("event_time", AGGREGATE_DELAY)
    month = month_start(F.col("event_time")).alias("month")
    counted = timed.groupBy(month, "category", "District").agg(*_all_counts())
    label = F.coalesce(month_label(F.col("month")), F.lit(MISSING_KEYS["year_month"]))
    return counted.select(label.alias("year_month"), *counted.columns[1:])


def aggregate_windowed(enriched: DataFrame, keep_window: bool = False) -> DataFrame:
    """Counts per 30-day window, category and district, labelled with the month the window
    starts in, for streams in append mode.

    The windows follow the epoch and not the calendar: two can carry one label. `keep_window`
    adds the window start, which tells them apart.
    """
    timed = enriched.withWatermark("event_time", AGGREGATE_DELAY)
    span = F.window("event_time", CLOSED_WINDOW).alias("span")
    counted = timed.groupBy(span, "category", "District").agg(*_all_counts())
    start = F.col("span.start")
    extra = [start.alias("window_start")] if keep_window else []
    return counted.select(
        month_label(start).alias("year_month"),
        "category",
        "District",
        "total_crimes",
        "arrests",
        "domestics",
        "fbi_indexed",
        *extra,
    )


def anomalies(
    enriched: DataFrame,
    window_days: int = DEFAULT_WINDOW_DAYS,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Districts and sliding windows, one starting each day, in which the share of indexed
    incidents is at least `threshold` percent, for streams in append mode.

    The share is compared unrounded and rounded afterwards.
    """
    length = f"{check_window_days(window_days)} days"
    check_threshold(threshold)
    if not enriched.isStreaming:
        counted = _slide_over_days(enriched, length)
    elif window_days < PANE_DAYS:
        counted = _slide_over_records(enriched, length)
    else:
        counted = _slide_over_panes(enriched, length)
    share = percent_of(F.col("fbi_indexed"), F.col("total_crimes"))
    flagged = counted.withColumn("share", share).where(F.col("share") >= F.lit(float(threshold)))
    return flagged.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "District",
        "fbi_indexed",
        "total_crimes",
        F.round("share", 2).alias("pct_fbi"),
    )


def _slide_over_panes(enriched: DataFrame, length: str) -> DataFrame:
    """Streaming form for long windows. Each task of a micro-batch hands on one row per day and district, its pane,
    and only panes are copied into the windows they belong to.

    A pane carries the latest event time of its records. That time lies in the same day as theirs
    and so in the same windows, and the latest of all panes is the latest of all records: the
    watermark, and what is late for which window, are those of the records.
    """
    dated = enriched.where(F.col("event_time").isNotNull())
    counted = dated.select(
        "event_time", "District", F.coalesce(flag_is("index_code", INDEXED), F.lit(False)).alias("indexed")
    )
    district = counted.schema["District"].dataType.simpleString()
    ddl = f"event_time timestamp, District {district}, fbi_indexed bigint, total_crimes bigint"
    panes = counted.mapInArrow(day_panes(), ddl).withWatermark("event_time", length)
    span = F.window("event_time", length, SLIDE).alias("span")
    return _summed(panes.groupBy(span, "District"))


def _slide_over_records(enriched: DataFrame, length: str) -> DataFrame:
    """Streaming form for short windows: every record is copied into the windows it belongs to.
    Lateness is decided per window."""
    timed = enriched.withWatermark("event_time", length)
    span = F.window("event_time", length, SLIDE).alias("span")
    return timed.groupBy(span, "District").agg(_indexed(), _total())


def _slide_over_days(enriched: DataFrame, length: str) -> DataFrame:
    """Batch form. Every window is a whole number of days, so records are counted per day once
    and only the day counts are copied into the windows they belong to: the first shuffle
    carries one row per day and district from each task, not one per window."""
    day = F.window("event_time", SLIDE).alias("day")
    daily = enriched.groupBy(day, "District").agg(_indexed(), _total())
    span = F.window(F.col("day.start"), length, SLIDE).alias("span")
    return _summed(daily.groupBy(span, "District"))


def _summed(groups: GroupedData) -> DataFrame:
    return groups.agg(
        F.sum("fbi_indexed").alias("fbi_indexed"), F.sum("total_crimes").alias("total_crimes")
    )
