import datetime as dt

import pytest
from pyspark.sql import functions as F

from incident_stream.functions import (
    flag_is,
    month_label,
    parse_event_time,
    parse_line,
    percent_of,
    strip_leading_zeros,
)
from incident_stream.operators.parse import parse_records


def parsed(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "csv_line string")
    return [row.asDict() for row in parse_records(frame).collect()]


@pytest.mark.parametrize(
    "code, expected",
    [
        ("0110", "110"),
        ("031A", "31A"),
        ("0000", ""),
        ("", ""),
        ("1010", "1010"),
        (" 0486 ", " 0486 "),
        ("x\n01", "x\n01"),
        (None, None),
    ],
)
def test_strip_leading_zeros(spark, code, expected):
    frame = spark.createDataFrame([(code,)], "c string")
    assert frame.select(strip_leading_zeros(F.col("c"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2001-01-05 10:00:00", dt.datetime(2001, 1, 5, 10)),
        ("2001-01-05T10:00:00.000Z", dt.datetime(2001, 1, 5, 10)),
        ("2001-01-02", dt.datetime(2001, 1, 2)),
        (" 2001-01-02 ", dt.datetime(2001, 1, 2)),
        ("2001-01-05 10:00:00+02:00", dt.datetime(2001, 1, 5, 8)),
        ("01/05/2001 11:00:00 AM", None),
        ("x", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time_never_fails(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "c string")
    found = frame.select(parse_event_time(F.col("c")).cast("timestamp_ntz")).first()[0]
    assert found == expected


def test_month_label(spark):
    frame = spark.sql("SELECT TIMESTAMP '2001-12-31 23:59:59' AS t, CAST(NULL AS TIMESTAMP) AS n")
    row = frame.select(month_label(F.col("t")), month_label(F.col("n"))).first()
    assert tuple(row) == ("2001-12", None)


def test_flags_are_compared_exactly(spark):
    frame = spark.createDataFrame([("True",), ("true",), ("TRUE",), (None,)], "a string")
    assert frame.agg(F.count_if(flag_is("a", "True"))).first()[0] == 1


def test_percent_divides_first(spark):
    frame = spark.createDataFrame([(7, 25), (29, 100)], "f long, n long")
    found = [row[0] for row in frame.select(percent_of(F.col("f"), F.col("n"))).collect()]
    assert found == [28.000000000000004, 28.999999999999996]


def test_full_line(spark):
    (row,) = parsed(spark, "1001,2024-01-03 11:00:00,0110,True,False,9.0,1.0,41.8,-87.6")
    assert row.pop("event_time") == dt.datetime(2024, 1, 3, 11)
    assert row == {
        "ID": "1001",
        "IUCR": "110",
        "Arrest": "True",
        "Domestic": "False",
        "District": 9.0,
        "year_month": "2024-01",
    }


def test_columns_and_types(spark):
    frame = parse_records(spark.createDataFrame([("1",)], "csv_line string"))
    assert frame.dtypes == [
        ("ID", "string"),
        ("IUCR", "string"),
        ("Arrest", "string"),
        ("Domestic", "string"),
        ("District", "double"),
        ("event_time", "timestamp"),
        ("year_month", "string"),
    ]


def test_short_line_leaves_the_rest_null(spark):
    (row,) = parsed(spark, "2,2001-01-02,0110")
    assert (row["ID"], row["IUCR"], row["year_month"]) == ("2", "110", "2001-01")
    assert row["Arrest"] is None and row["Domestic"] is None and row["District"] is None


def test_extra_fields_are_ignored(spark):
    (row,) = parsed(spark, "4,x,0000,True,True,1,2,3,4,EXTRA")
    assert row["event_time"] is None and row["IUCR"] == "" and row["District"] == 1.0


def test_unreadable_number_spoils_its_field_only(spark):
    (row,) = parsed(spark, "5,2001-01-02,0110,True,False,abc,1,x,2")
    assert row["District"] is None
    assert (row["ID"], row["Arrest"], row["Domestic"]) == ("5", "True", "False")


def test_numbers_are_trimmed_and_strings_are_not(spark):
    (row,) = parsed(spark, "6,2001-01-02, 0486 ,True , True, 7.0 ,,,")
    assert (row["IUCR"], row["Arrest"], row["Domestic"]) == (" 0486 ", "True ", " True")
    assert row["District"] == 7.0


def test_quoted_comma(spark):
    (row,) = parsed(spark, '7,2001-01-02,"0,1",True,False,1,,,')
    assert row["IUCR"] == ",1" and row["Arrest"] == "True"


def test_empty_and_null_lines_are_rows_of_nulls(spark):
    rows = parsed(spark, "", None)
    assert len(rows) == 2
    assert all(value is None for row in rows for value in row.values())


def test_flattening_equals_selecting_the_fields(spark):
    """The generators must not add, drop or change rows."""
    lines = ["1,2001-01-02,0110,True,False,9", "", None, ",,,,,", "a", '"q""q",x', "1,,0,,,NaN"]
    frame = spark.createDataFrame([(line,) for line in lines], "csv_line string")
    plain = frame.select(parse_line(F.col("csv_line")).alias("r")).select("r.*")
    code = strip_leading_zeros(F.col("IUCR")).alias("IUCR")
    wanted = plain.select("ID", code, "Arrest", "Domestic").collect()
    found = parse_records(frame).select("ID", "IUCR", "Arrest", "Domestic").collect()
    assert sorted(map(str, found)) == sorted(map(str, wanted))
