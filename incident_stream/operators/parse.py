"""Record lines to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.functions import (
    month_label,
    parse_event_time,
    parse_line,
    strip_leading_zeros,
)


def parse_records(lines: DataFrame) -> DataFrame:
    """`csv_line` to ID, IUCR, Arrest, Domestic, District, event_time, year_month.

    The record struct and the event time come out of generators (`inline` and `explode` of one
    element) and not out of projections. The optimizer moves the event-time filter of a window
    below a projection and there repeats the expressions it refers to, so that a line would be
    parsed several times; it moves no filter below a generator that makes its column.
    """
    fields = lines.select(F.inline(F.array(parse_line(F.col("csv_line")))))
    event_time = F.explode(F.array(parse_event_time(F.col("Date")))).alias("event_time")
    timed = fields.select("ID", "IUCR", "Arrest", "Domestic", "District", event_time)
    return timed.withColumns(
        {
            "IUCR": strip_leading_zeros(F.col("IUCR")),
            "year_month": month_label(F.col("event_time")),
        }
    )
