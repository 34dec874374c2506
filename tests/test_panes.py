import datetime as dt
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incident_stream.operators import aggregate
from incident_stream.operators.aggregate import anomalies
from incident_stream.operators.panes import day_panes
from tests.test_streaming import Feed, line

UTC = dt.timezone.utc
DAY = dt.timedelta(days=1)


def batch(rows):
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.timestamp("us", "UTC")),
            pa.array([r[1] for r in rows], pa.float64()),
            pa.array([r[2] for r in rows], pa.bool_()),
        ],
        ["event_time", "District", "indexed"],
    )


def panes(rows, size=7, **options):
    batches = [batch(rows[i : i + size]) for i in range(0, len(rows), size)]
    found = pa.Table.from_batches(list(day_panes(**options)(iter(batches)))).to_pylist() if rows else []
    return {(r["event_time"], r["District"]): (r["fbi_indexed"], r["total_crimes"]) for r in found}


def brute(rows):
    epoch = dt.datetime(1970, 1, 1, tzinfo=UTC)
    groups = {}
    for moment, district, indexed in rows:
        groups.setdefault(((moment - epoch) // DAY, district), []).append((moment, indexed))
    return {
        (max(m for m, _ in of), district): (sum(i for _, i in of), len(of))
        for (_, district), of in groups.items()
    }


@pytest.mark.parametrize("held_rows", [1, 5, 1 << 16])
def test_one_pane_per_day_and_district(held_rows):
    rng = random.Random(4)
    start = dt.datetime(1969, 12, 28, tzinfo=UTC)  # days before 1970 are whole days as well
    rows = [
        (start + dt.timedelta(seconds=rng.randrange(8 * 86_400), microseconds=rng.randrange(3)),
         rng.choice([None, -1.0, 1.0, 2.0]), rng.random() < 0.4)
        for _ in range(500)
    ]
    rows += [(start, 1.0, True), (start + DAY - dt.timedelta(microseconds=1), 1.0, True), (start + DAY, 1.0, False)]
    assert panes(rows, held_rows=held_rows) == brute(rows)


def test_no_rows_no_panes():
    assert list(day_panes()(iter([]))) == []
    assert list(day_panes()(iter([batch([])]))) == []


def by_records(records, days):
    """The same with every record copied into its windows: what panes must equal."""
    timed = records.withWatermark("event_time", f"{days} days")
    span = F.window("event_time", f"{days} days", "1 day").alias("span")
    indexed = F.count_if(F.col("index_code") == "I").alias("fbi_indexed")
    counted = timed.groupBy(span, "District").agg(indexed, F.count("*").alias("total_crimes"))
    share = F.col("fbi_indexed") / F.col("total_crimes") * F.lit(100.0)
    return counted.select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
        "District", "fbi_indexed", "total_crimes", F.round(share, 2).alias("pct_fbi"),
    ).where(share >= 0)


@pytest.mark.parametrize("days", [2, 5])
def test_batch_by_batch_the_same_as_from_records(spark, tmp_path, monkeypatch, days):
    """Random lateness over many batches: each step hands out the same windows with the same counts,
    and drops as much as it would if every pane were a record."""
    monkeypatch.setattr(aggregate, "PANE_DAYS", 2)
    rng = random.Random(days)
    for name in ("panes", "records"):
        (tmp_path / name).mkdir()
    ours, theirs = Feed(spark, tmp_path / "panes"), Feed(spark, tmp_path / "records")
    handed_out = Counter()
    for step in range(6):
        # one day and district each time: a pane is a record, so that even the drops are equal
        late = 1 + max(0, 4 * step - rng.randrange(8))
        lines = [line(late, rng.choice([1.0, -0.0, 0.0])), line(4 * step + 2, 1.0, "0486")]
        lines += [line(4 * step + 2, 1.0, "0486", clock=f"{h:02d}:00:00") for h in range(rng.randrange(5))]
        for feed in (ours, theirs):
            feed.add(*lines, "x,not a date,0110,True,False,1.0,,,")
        got = ours.step(lambda r: anomalies(r, days, 0.0), "append")
        want = theirs.step(lambda r: by_records(r, days), "append")
        assert Counter(map(tuple, got)) == Counter(map(tuple, want))
        assert (ours.dropped() > 0) == (theirs.dropped() > 0)
        handed_out.update(map(tuple, got))
    assert handed_out and max(handed_out.values()) == 1
