import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from incident_stream.functions import month_label
from incident_stream.operators import aggregate
from incident_stream.operators.aggregate import (
    aggregate_monthly,
    aggregate_windowed,
    anomalies,
)

SCHEMA = (
    "IUCR string, ID string, Arrest string, Domestic string, District double, "
    "event_time timestamp, year_month string, category string, index_code string"
)
START = dt.datetime(2024, 1, 10)


def record(when=START, district=1.0, index="I", arrest="False", domestic="False", category="A"):
    label = when.strftime("%Y-%m") if when else "UNKNOWN_MONTH"
    return ("1", "x", arrest, domestic, district, when, label, category, index)


def frame(spark, records):
    return spark.createDataFrame(records, SCHEMA)


def shares(spark, indexed, total, days=1, threshold=40.0):
    records = [record(index="I" if i < indexed else "N") for i in range(total)]
    return anomalies(frame(spark, records), days, threshold).collect()


def test_threshold_is_inclusive(spark):
    (row,) = shares(spark, 2, 5)
    assert (row["fbi_indexed"], row["total_crimes"], row["pct_fbi"]) == (2, 5, 40.0)


def test_threshold_meets_the_unrounded_share(spark):
    assert shares(spark, 29, 100, threshold=29.0) == []
    assert shares(spark, 9999, 25000, threshold=40.0) == []  # 39.996 would round to 40.0
    (row,) = shares(spark, 9999, 25000, threshold=39.99)
    assert row["pct_fbi"] == 40.0


def test_share_is_rounded_to_two_places(spark):
    (row,) = shares(spark, 2, 3, threshold=0)
    assert row["pct_fbi"] == 66.67


def test_unindexed_and_null_codes_do_not_count(spark):
    records = [record(index=i) for i in ("I", "i", "N", None)]
    (row,) = anomalies(frame(spark, records), 1, 0).collect()
    assert (row["fbi_indexed"], row["total_crimes"], row["pct_fbi"]) == (1, 4, 25.0)


def test_record_lies_in_every_window_of_its_day(spark):
    found = anomalies(frame(spark, [record()]), 7, 0).orderBy("window_start").collect()
    assert [r["window_start"] for r in found] == [
        START - dt.timedelta(days=6 - i) for i in range(7)
    ]
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(days=7) for r in found)


def test_event_on_a_window_end_is_outside(spark):
    found = anomalies(frame(spark, [record(START)]), 1, 0).collect()
    assert [(r["window_start"], r["window_end"]) for r in found] == [
        (START, START + dt.timedelta(days=1))
    ]


def test_columns_and_types_of_anomalies(spark):
    assert anomalies(frame(spark, [])).dtypes == [
        ("window_start", "timestamp"),
        ("window_end", "timestamp"),
        ("District", "double"),
        ("fbi_indexed", "bigint"),
        ("total_crimes", "bigint"),
        ("pct_fbi", "double"),
    ]


@pytest.mark.parametrize("days", [0, -1, 1.5, True, "7"])
def test_window_days_are_checked(spark, days):
    with pytest.raises(ValueError):
        anomalies(frame(spark, []), days)


@pytest.mark.parametrize("threshold", [-0.1, 100.1, float("nan")])
def test_threshold_is_checked(spark, threshold):
    with pytest.raises(ValueError):
        anomalies(frame(spark, []), 7, threshold)


def test_records_without_time_are_absent_from_windows_only(spark):
    records = frame(spark, [record(None), record()])
    assert anomalies(records, 1, 0).agg(F.sum("total_crimes")).first()[0] == 1
    assert aggregate_windowed(records).agg(F.sum("total_crimes")).first()[0] == 1
    months = {r["year_month"]: r["total_crimes"] for r in aggregate_monthly(records).collect()}
    assert months == {"UNKNOWN_MONTH": 1, "2024-01": 1}


def test_monthly_counts(spark):
    records = [
        record(arrest="True", domestic="True"),
        record(arrest="true", domestic=None, index=None),
        record(arrest="True", district=-1.0),
        record(when=dt.datetime(2024, 2, 1), index="N"),
        record(category="UNKNOWN"),
    ]
    found = sorted(map(tuple, aggregate_monthly(frame(spark, records)).collect()))
    assert found == [
        ("2024-01", "A", -1.0, 1, 1, 0, 1),
        ("2024-01", "A", 1.0, 2, 1, 1, 1),
        ("2024-01", "UNKNOWN", 1.0, 1, 0, 0, 1),
        ("2024-02", "A", 1.0, 1, 0, 0, 0),
    ]


def test_months_are_the_labels_of_the_records(spark):
    """Also before year 1 and beyond four digits."""
    texts = [
        "0002-03-01 10:00:00",
        "-0001-03-31 23:59:59",
        "-0001-03-01",
        "0000-01-15",
        "0001-01-15",
        "1582-10-10",
        "1969-12-31 23:59:59",
        "+12345-06-07",
        "2024-02-29",
        None,
    ]
    frame_ = spark.createDataFrame([(t,) for t in texts], "t string")
    moment = F.try_to_timestamp("t")
    records = frame_.select(
        moment.alias("event_time"),
        F.coalesce(month_label(moment), F.lit("UNKNOWN_MONTH")).alias("year_month"),
        F.lit("A").alias("category"),
        F.lit(1.0).alias("District"),
        *[F.lit("True").alias(c) for c in ("Arrest", "Domestic", "index_code")],
    )
    assert records.where("event_time IS NULL").count() == 1
    wanted = records.groupBy("year_month").count().collect()
    found = aggregate_monthly(records).select("year_month", "total_crimes").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted))


def test_identical_records_count_each_time(spark):
    (row,) = aggregate_monthly(frame(spark, [record()] * 3)).collect()
    assert row["total_crimes"] == 3


def test_two_30_day_windows_can_carry_one_label(spark):
    days = [dt.datetime(1998, 10, 1), dt.datetime(1998, 10, 30), dt.datetime(1998, 10, 31)]
    records = frame(spark, [record(d) for d in [*days, dt.datetime(1998, 11, 29)]])
    plain = sorted(map(tuple, aggregate_windowed(records).collect()))
    assert plain == [("1998-10", "A", 1.0, 2, 0, 0, 2)] * 2
    starts = {r["window_start"] for r in aggregate_windowed(records, keep_window=True).collect()}
    assert starts == {dt.datetime(1998, 10, 1), dt.datetime(1998, 10, 31)}


def test_columns_of_the_aggregates(spark):
    wanted = [
        "year_month",
        "category",
        "District",
        "total_crimes",
        "arrests",
        "domestics",
        "fbi_indexed",
    ]
    assert aggregate_monthly(frame(spark, [])).columns == wanted
    assert aggregate_windowed(frame(spark, [])).columns == wanted
    assert aggregate_windowed(frame(spark, []), keep_window=True).columns == [
        *wanted,
        "window_start",
    ]


moments = st.datetimes(dt.datetime(1969, 11, 1), dt.datetime(1970, 3, 1)).map(
    lambda t: t.replace(microsecond=0)
)
record_lists = st.lists(
    st.tuples(
        st.one_of(st.none(), moments),
        st.sampled_from([-1.0, 0.0, 1.0, 2.5]),
        st.sampled_from(["I", "N", None]),
    ),
    max_size=40,
)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(record_lists, st.integers(1, 40))
def test_counting_days_first_equals_counting_records(spark, drawn, days):
    """Also before 1970, where windows start at negative times."""
    records = frame(spark, [record(when, d, index) for when, d, index in drawn])
    length = f"{days} days"
    key = ["span", "District", "fbi_indexed", "total_crimes"]
    by_day = aggregate._slide_over_days(records, length).select(key).collect()
    by_record = aggregate._slide_over_records(records, length).select(key).collect()
    assert sorted(map(str, by_day)) == sorted(map(str, by_record))


def brute_force(records, days, threshold):
    groups = {}
    for when, district, index in records:
        if when is None:
            continue
        day = (when - dt.datetime(1970, 1, 1)).days
        for back in range(days):
            cell = groups.setdefault((day - back, district), [0, 0])
            cell[0] += index == "I"
            cell[1] += 1
    return sorted(
        (dt.datetime(1970, 1, 1) + dt.timedelta(days=start), district, indexed, total)
        for (start, district), (indexed, total) in groups.items()
        if indexed / total * 100.0 >= threshold
    )


@pytest.mark.parametrize("days, threshold", [(1, 40.0), (3, 50.0), (7, 33.0), (45, 0.0)])
def test_anomalies_against_brute_force(spark, days, threshold):
    """A third of all records in one district on one day."""
    rng = random.Random(days)
    drawn = [
        (
            START + dt.timedelta(seconds=rng.randrange(60 * 86400)),
            float(rng.randrange(5)),
            rng.choice("INN"),
        )
        for _ in range(400)
    ] + [(START, 2.0, rng.choice("IN")) for _ in range(200)]
    found = anomalies(frame(spark, [record(w, d, i) for w, d, i in drawn]), days, threshold)
    got = sorted(
        tuple(r)
        for r in found.select("window_start", "District", "fbi_indexed", "total_crimes").collect()
    )
    assert got == brute_force(drawn, days, threshold)


def test_other_session_zone_keeps_the_windows(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        when = "CAST('2024-03-10T12:00:00Z' AS TIMESTAMP)"  # the day that clocks change there
        records = frame(spark, [record()]).withColumn("event_time", F.expr(when))
        seconds = [F.unix_seconds("window_start").alias("s")]
        day = aggregate._slide_over_days(records, "3 days")
        direct = aggregate._slide_over_records(records, "3 days")
        for counted in (day, direct):
            starts = counted.select(F.col("span.start").alias("window_start")).select(*seconds)
            assert {r["s"] % 86400 for r in starts.collect()} == {0}
            assert len({r["s"] for r in starts.collect()}) == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
