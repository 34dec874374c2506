"""Column expressions; all of them built-in functions, evaluated on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_stream.schema import MONTH_FORMAT, RECORD_DDL

MOST_FIELDS = 1_000_000


def parse_line(line: Column) -> Column:
    """CSV text to a record struct: missing fields and unreadable numbers become null, extra
    fields are ignored, strings are kept untrimmed.

    The parser stops the job at a line of more fields than it was told to expect. Lines with as
    many commas as that, which cannot be records, count as empty: a record of nulls.
    """
    commas = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    short = F.when(F.length(line) < MOST_FIELDS, line).when(commas < MOST_FIELDS, line)
    return F.from_csv(short, RECORD_DDL, {"header": "false", "maxColumns": str(MOST_FIELDS)})


def parse_event_time(text: Column) -> Column:
    """ISO-like text to a timestamp; anything else is null, also under ANSI mode.

    A time without a date, `12:30:00`, also gives null: it would become a time of the day on which
    the job happens to run, and move the watermark there.
    """
    dated = F.when(~F.trim(text).rlike(r"^T?\d{1,2}:"), text)
    return F.try_to_timestamp(dated)


def month_label(moment: Column) -> Column:
    return F.date_format(moment, MONTH_FORMAT)


def month_start(moment: Column) -> Column:
    """First day of the month: as a grouping key it says the same as the label and costs a
    fraction."""
    return F.trunc(moment, "month")


def strip_leading_zeros(code: Column) -> Column:
    """`0110` to `110`, `0000` to the empty string. Trimming needs no regular expression."""
    return F.ltrim(code, F.lit("0"))


def flag_is(column: str, literal: str) -> Column:
    """Exact comparison: `true` is not `True`, and null is not counted."""
    return F.col(column) == F.lit(literal)


def percent_of(part: Column, whole: Column) -> Column:
    """Divide first, multiply after: the order decides which shares reach a threshold exactly."""
    return part / whole * F.lit(100.0)
