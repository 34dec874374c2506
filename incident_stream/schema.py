"""Layout of the records, of the code table and of the stored results."""

from __future__ import annotations

from dataclasses import dataclass

# The CSV layout of one record line, in field order.
RECORD_DDL = "ID STRING, Date STRING, IUCR STRING, Arrest STRING, Domestic STRING, District DOUBLE, ComArea DOUBLE, Latitude DOUBLE, Longitude DOUBLE"  # noqa: E501

# Header names in the code table file, and what they are called here.
CODE_COLUMNS = {
    "IUCR": "IUCR",
    "PRIMARY DESCRIPTION": "category",
    "INDEX CODE": "index_code",
}

# What stands for a missing grouping key.
MISSING_KEYS = {"category": "UNKNOWN", "year_month": "UNKNOWN_MONTH", "District": -1.0}

# The literals that mean "yes".
YES = "True"
INDEXED = "I"

# Window lengths, watermark delays and label format.
SLIDE = "1 day"
CLOSED_WINDOW = "30 days"
AGGREGATE_DELAY = "1 day"
MONTH_FORMAT = "yyyy-MM"

# Defaults of the two anomaly parameters.
DEFAULT_WINDOW_DAYS = 7
DEFAULT_THRESHOLD = 40.0


@dataclass(frozen=True)
class Contract:
    """A stored result: table name, (query column, stored column, type) triples, and the key.
    `adds_up`: the values of a key are sums over its records, so those of two batches add up."""

    table: str
    columns: tuple[tuple[str, str, str], ...]
    key: tuple[str, ...]
    adds_up: bool = False

    @property
    def names(self) -> list[str]:
        return [stored for _, stored, _ in self.columns]

    @property
    def values(self) -> list[str]:
        return [name for name in self.names if name not in self.key]


_COUNTS = (
    ("total_crimes", "total_crimes", "bigint"),
    ("arrests", "arrests", "bigint"),
    ("domestics", "domestics", "bigint"),
    ("fbi_indexed", "fbi_indexed", "bigint"),
)

# year_month is a plain string: the label for missing months is longer than seven characters.
MONTHLY = Contract(
    table="crime_aggregates",
    columns=(
        ("year_month", "year_month", "string"),
        ("category", "category", "string"),
        ("District", "district", "int"),
        *_COUNTS,
    ),
    key=("year_month", "category", "district"),
    adds_up=True,
)

# Two 30-day windows can start in one month, so the month label cannot be part of this key:
# the window start is stored with the row and takes its place.
WINDOWED = Contract(
    table="crime_aggregates_closed",
    columns=(
        *MONTHLY.columns,
        ("window_start", "window_start", "timestamp"),
    ),
    key=("window_start", "category", "district"),
)

# Runs with other window lengths or thresholds share the table, so both are part of the key: the
# length by the window's end.
ANOMALIES = Contract(
    table="crime_anomalies",
    columns=(
        ("window_start", "window_start", "timestamp"),
        ("window_end", "window_end", "timestamp"),
        ("District", "district", "int"),
        ("fbi_indexed", "fbi_indexed", "bigint"),
        ("total_crimes", "total_crimes", "bigint"),
        ("pct_fbi", "pct_fbi", "double"),
        ("threshold", "threshold", "double"),
    ),
    key=("window_start", "window_end", "threshold", "district"),
)
