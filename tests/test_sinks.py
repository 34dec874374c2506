import contextlib
import datetime as dt
import os

import pytest

from incident_stream.schema import ANOMALIES, MONTHLY, WINDOWED
from incident_stream.settings import FileStore, JdbcStore, new_work_dir
from incident_stream.sources.results import read_results
from incident_stream.streaming import sinks
from incident_stream.streaming.sinks import (
    append_statement,
    batch_writer,
    claim_run,
    commit_once,
    conform,
    fold,
    ledger_statement,
    merge_statement,
    reject_reason,
    table_statement,
)

SCHEMA = (
    "year_month string, category string, District double, total_crimes bigint, arrests bigint, "
    "domestics bigint, fbi_indexed bigint"
)


def batch(spark, *counts):
    rows = [(month, "A", 1.0, n, 0, 0, 0) for month, n in counts]
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, store):
    return {
        r["year_month"]: r["total_crimes"] for r in read_results(spark, store, MONTHLY).collect()
    }


@pytest.fixture
def store(tmp_path):
    return FileStore(str(tmp_path / "results"))


def test_conform_names_types_and_order(spark):
    frame = conform(batch(spark, ("UNKNOWN_MONTH", 1)).select(*reversed(MONTHLY_INPUT)), MONTHLY)
    assert frame.dtypes == [
        ("year_month", "string"),
        ("category", "string"),
        ("district", "int"),
        ("total_crimes", "bigint"),
        ("arrests", "bigint"),
        ("domestics", "bigint"),
        ("fbi_indexed", "bigint"),
    ]
    assert frame.first()["year_month"] == "UNKNOWN_MONTH"


MONTHLY_INPUT = [ours for ours, _, _ in MONTHLY.columns]


def test_district_must_be_whole(spark):
    numbers = (-1.0, 0.0, -0.0, 25.0, None, 1.5, 1e10, float("inf"), float("nan"))
    rows = [("2001-01", "A", district, 1, 0, 0, 0) for district in numbers]
    frame = spark.createDataFrame(rows, SCHEMA)
    marked = frame.withColumn("reason", reject_reason(frame, MONTHLY))
    assert [r["reason"] is None for r in marked.collect()] == [True] * 5 + [False] * 4
    found = conform(marked.where("reason is null"), MONTHLY).collect()
    assert [r["district"] for r in found] == [-1, 0, 0, 25, None]


@pytest.mark.parametrize("mode", ["upsert", "append", "replace"])
def test_rows_that_cannot_be_stored_are_kept_beside_the_table(spark, store, mode):
    rows = [("2001-01", "A", d, 1, 2, 3, 4) for d in (7.5, 1.0, 1e10)]
    batch_writer(store, MONTHLY, mode, run=2)(spark.createDataFrame(rows, SCHEMA), 3)
    assert [r["district"] for r in read_results(spark, store, MONTHLY).collect()] == [1]
    kept = spark.read.parquet(f"{store.path(MONTHLY.table)}_rejected").collect()
    assert sorted((r["District"], r["total_crimes"], r["run"], r["batch"]) for r in kept) == [
        (7.5, 1, 2, 3),
        (1e10, 1, 2, 3),
    ]
    assert all("no whole number" in r["reason"] for r in kept)


def test_keys():
    assert MONTHLY.key == ("year_month", "category", "district")
    assert WINDOWED.key == ("window_start", "category", "district")
    assert ANOMALIES.key == ("window_start", "window_end", "threshold", "district")
    assert WINDOWED.names[:7] == MONTHLY.names


def test_replace_keeps_the_last_batch_only(spark, store):
    write = batch_writer(store, MONTHLY, "replace")
    write(batch(spark, ("2001-01", 1), ("2001-02", 2)), 0)
    write(batch(spark, ("2001-02", 3)), 1)
    assert stored(spark, store) == {"2001-02": 3}
    assert dict(read_results(spark, store, MONTHLY).dtypes)["district"] == "int"
    write(batch(spark), 2)
    assert stored(spark, store) == {}


def test_recreate_takes_the_types_of_the_batch(spark, store):
    batch_writer(store, MONTHLY, "replace")(batch(spark, ("2001-01", 1)), 0)
    batch_writer(store, MONTHLY, "recreate")(batch(spark, ("2001-02", 2)), 1)
    found = read_results(spark, store, MONTHLY)
    assert dict(found.dtypes)["District"] == "double"
    assert stored(spark, store) == {"2001-02": 2}


def test_append_adds(spark, store):
    write = batch_writer(store, MONTHLY, "append")
    write(batch(spark, ("2001-01", 1)), 0)
    write(batch(spark, ("2001-01", 1)), 0)
    assert read_results(spark, store, MONTHLY).count() == 2


def test_upsert_keeps_the_latest_row_of_each_key(spark, store):
    write = batch_writer(store, MONTHLY)
    write(batch(spark, ("2001-01", 1), ("2001-02", 9)), 0)
    write(batch(spark, ("2001-02", 3), ("2001-03", 4)), 1)
    write(batch(spark), 2)
    assert stored(spark, store) == {"2001-01": 1, "2001-02": 3, "2001-03": 4}
    assert read_results(spark, store, MONTHLY).columns == MONTHLY.names


def test_upsert_orders_batches_by_number(spark, store):
    write = batch_writer(store, MONTHLY)
    for number in range(11):
        write(batch(spark, ("2001-01", number)), number)
    assert stored(spark, store) == {"2001-01": 10}


def test_upsert_of_a_repeated_batch_changes_nothing(spark, store):
    write = batch_writer(store, MONTHLY, run=5)
    write(batch(spark, ("2001-01", 1), ("2001-02", 9)), 0)
    write(batch(spark, ("2001-01", 2)), 1)
    write(batch(spark, ("2001-01", 2)), 1)
    assert stored(spark, store) == {"2001-01": 2, "2001-02": 9}
    assert spark.read.parquet(f"{store.path(MONTHLY.table)}_log").count() == 3


def test_later_run_wins_over_higher_batches_of_an_earlier_one(spark, store):
    early = batch_writer(store, MONTHLY, run=1000)
    for number in range(3):
        early(batch(spark, ("2001-01", number)), number)
    batch_writer(store, MONTHLY, run=2000)(batch(spark, ("2001-01", 50)), 0)
    assert stored(spark, store) == {"2001-01": 50}


def test_run_numbers_come_from_the_store(spark, store):
    assert [claim_run(spark, store, MONTHLY) for _ in range(11)] == list(range(1, 12))
    assert claim_run(spark, store, ANOMALIES) == 1


def test_a_run_that_is_resumed_is_the_newest(spark, store):
    old, new = (claim_run(spark, store, MONTHLY) for _ in range(2))
    batch_writer(store, MONTHLY, run=old)(batch(spark, ("2001-01", 1)), 5)
    batch_writer(store, MONTHLY, run=new)(batch(spark, ("2001-01", 2)), 0)
    assert stored(spark, store) == {"2001-01": 2}
    again = claim_run(spark, store, MONTHLY)
    batch_writer(store, MONTHLY, run=again)(batch(spark, ("2001-01", 3)), 6)
    assert stored(spark, store) == {"2001-01": 3}


@pytest.mark.parametrize("first", sinks.MODES)
@pytest.mark.parametrize("second", sinks.MODES)
def test_a_table_that_is_written_in_two_modes(spark, store, first, second):
    """Every row that the modes promise, or a clear refusal; nothing gets lost in silence."""
    batch_writer(store, MONTHLY, first)(batch(spark, ("2001-01", 1)), 0)
    write = batch_writer(store, MONTHLY, second)
    if first != second and set(sinks.LOGGED) & {first, second}:
        with pytest.raises(ValueError, match="was not written with"):
            write(batch(spark, ("2001-02", 2)), 1)
        assert stored(spark, store) == {"2001-01": 1}
        return
    if second == "append" and first == "recreate":
        return  # columns of other names and types, which Spark itself tells apart
    write(batch(spark, ("2001-02", 2)), 1)
    kept = {"2001-01": 1} if second in ("append", "upsert", "add") else {}
    assert stored(spark, store) == kept | {"2001-02": 2}


def test_a_batch_that_is_half_written_is_not_seen(spark, store):
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark, ("2001-01", 1)), 0)
    write(batch(spark, ("2001-01", 2), ("2001-02", 2)), 1)
    half = f"{store.path(MONTHLY.table)}_log/run=1/batch=1/_SUCCESS"
    os.remove(half)
    assert stored(spark, store) == {"2001-01": 1}
    write(batch(spark, ("2001-01", 3)), 1)
    assert stored(spark, store) == {"2001-01": 3}


def test_empty_batches_leave_nothing(spark, store):
    claim_run(spark, store, MONTHLY)
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark), 0)
    assert stored(spark, store) == {}
    assert not os.path.exists(f"{store.path(MONTHLY.table)}_log")
    write(batch(spark, ("2001-01", 1)), 1)
    assert stored(spark, store) == {"2001-01": 1}


def test_folding_changes_nothing_that_is_read(spark, store):
    """Also when an older run goes on afterwards: its batches keep their place."""
    older = batch_writer(store, MONTHLY, run=1)
    newer = batch_writer(store, MONTHLY, run=2)
    older(batch(spark, ("2001-01", 1), ("2001-02", 1)), 0)
    newer(batch(spark, ("2001-01", 2)), 0)
    before = stored(spark, store)
    assert fold(spark, store, MONTHLY) == 2
    assert stored(spark, store) == before == {"2001-01": 2, "2001-02": 1}
    assert fold(spark, store, MONTHLY) == 0
    older(batch(spark, ("2001-01", 8), ("2001-02", 9)), 1)  # older than run 2
    assert stored(spark, store) == {"2001-01": 2, "2001-02": 9}
    newer(batch(spark, ("2001-03", 4)), 1)
    assert fold(spark, store, MONTHLY, keep_seconds=0) == 2
    assert stored(spark, store) == {"2001-01": 2, "2001-02": 9, "2001-03": 4}
    names = os.listdir(f"{store.path(MONTHLY.table)}_log")
    assert "base=2" in names and "base=1" not in names


@pytest.mark.parametrize("contract", [MONTHLY, WINDOWED, ANOMALIES])
def test_reading_a_log_sorts_nothing(spark, store, contract):
    columns = ", ".join(f"{ours} {'double' if kind == 'int' else kind}" for ours, _, kind in contract.columns)
    months = dt.datetime(2024, 3, 5)
    values = {"string": "2024-03", "int": 1.0, "bigint": 5, "double": 0.5, "timestamp": months}
    row = tuple(values[kind] for _, _, kind in contract.columns)
    batch_writer(store, contract)(spark.createDataFrame([row], columns), 0)
    found = read_results(spark, store, contract)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert found.columns == contract.names
    assert tuple(found.first()) == tuple(1 if v == 1.0 else v for v in row)


def test_unknown_mode(store):
    with pytest.raises(ValueError):
        batch_writer(store, MONTHLY, "merge")


def test_timestamps_survive_storage(spark, store):
    start = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(start, start + dt.timedelta(days=7), -1.0, 2, 5, 40.0, 33.0)],
        "window_start timestamp, window_end timestamp, District double, fbi_indexed bigint, "
        "total_crimes bigint, pct_fbi double, threshold double",
    )
    batch_writer(store, ANOMALIES)(frame, 0)
    (row,) = read_results(spark, store, ANOMALIES).collect()
    assert tuple(row) == (start, start + dt.timedelta(days=7), -1, 2, 5, 40.0, 33.0)


# --- database: statements and calls only, no database is started here ------------------------


def test_postgres_statement():
    assert merge_statement(ANOMALIES, "staged", "postgresql") == (
        "INSERT INTO crime_anomalies "
        "(window_start, window_end, district, fbi_indexed, total_crimes, pct_fbi, threshold) "
        "SELECT DISTINCT window_start, window_end, district, fbi_indexed, total_crimes, pct_fbi, "
        "threshold FROM staged ON CONFLICT (window_start, window_end, threshold, district) "
        "DO UPDATE SET fbi_indexed = EXCLUDED.fbi_indexed, "
        "total_crimes = EXCLUDED.total_crimes, pct_fbi = EXCLUDED.pct_fbi"
    )


def test_merge_statement_joins_on_the_whole_key():
    text = merge_statement(WINDOWED, "staged", "derby")
    assert "ON t.window_start = s.window_start AND t.category = s.category" in text
    assert "AND t.district = s.district WHEN MATCHED" in text


def test_table_statement():
    text = table_statement(MONTHLY, "postgresql")
    assert text == (
        "CREATE TABLE IF NOT EXISTS crime_aggregates (year_month TEXT, category TEXT, "
        "district INTEGER, total_crimes BIGINT, arrests BIGINT, domestics BIGINT, "
        "fbi_indexed BIGINT, PRIMARY KEY (year_month, category, district))"
    )


class Recorder:
    """Stands in for a DataFrame and its writer, and notes what it is asked to do."""

    def __init__(self):
        self.calls = []
        self.sparkSession = self.write = self

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls.append((name, *args))
            return self

        return note


@pytest.mark.parametrize(
    "mode, expected",
    [
        (
            "replace",
            [("mode", "overwrite"), ("option", "truncate", "true"), "crime_aggregates"],
        ),
        (
            "recreate",
            [("mode", "overwrite"), ("option", "truncate", "false"), "crime_aggregates"],
        ),
        (
            "append",
            [("mode", "overwrite"), ("option", "truncate", "true"), "crime_aggregates_staging_q1"],
        ),
        (
            "add",
            [("mode", "overwrite"), ("option", "truncate", "true"), "crime_aggregates_staging_q1"],
        ),
        (
            "upsert",
            [("mode", "overwrite"), ("option", "truncate", "true"), "crime_aggregates_staging_q1"],
        ),
    ],
)
def test_calls_for_a_database(monkeypatch, mode, expected):
    db = JdbcStore("jdbc:postgresql://host/db", {"user": "u"}, connections=3)
    frame, executed, once = Recorder(), [], []
    monkeypatch.setattr(sinks, "execute", lambda spark, store, texts: executed.extend(texts))
    monkeypatch.setattr(sinks, "commit_once", lambda spark, store, *entry: once.append(entry))
    sinks._write(frame, db, MONTHLY, mode, 0, 7, "q1")
    assert frame.calls[0] == ("repartition", 3)
    *options, table = expected
    assert frame.calls[1:-1] == options
    assert frame.calls[-1] == ("jdbc", db.url, table)
    staging = "crime_aggregates_staging_q1"
    staged = merge_statement(MONTHLY, staging, "postgresql")
    assert executed == ([staged] if mode == "upsert" else [])
    added = merge_statement(MONTHLY, staging, "postgresql", add=True)
    wanted = {"add": [added], "append": [append_statement(MONTHLY, staging)]}
    assert once == ([("q1", 7, wanted[mode])] if mode in wanted else [])


def test_calls_for_a_database_without_a_name(monkeypatch):
    db, frame = JdbcStore("jdbc:postgresql://host/db"), Recorder()
    sinks._write(frame, db, MONTHLY, "append", 0, 7, "")
    assert frame.calls[-1] == ("jdbc", db.url, "crime_aggregates")
    with pytest.raises(ValueError, match="name"):
        sinks._write(frame, db, MONTHLY, "add", 0, 7, "")


def test_statements_that_add():
    assert merge_statement(MONTHLY, "staged", "postgresql", add=True).endswith(
        "DO UPDATE SET total_crimes = crime_aggregates.total_crimes + EXCLUDED.total_crimes, "
        "arrests = crime_aggregates.arrests + EXCLUDED.arrests, "
        "domestics = crime_aggregates.domestics + EXCLUDED.domestics, "
        "fbi_indexed = crime_aggregates.fbi_indexed + EXCLUDED.fbi_indexed"
    )
    assert "UPDATE SET t.total_crimes = t.total_crimes + s.total_crimes" in merge_statement(
        MONTHLY, "staged", "derby", add=True
    )
    assert append_statement(MONTHLY, "staged").startswith(
        "INSERT INTO crime_aggregates (year_month, category, district, total_crimes, arrests, "
    )
    assert ledger_statement("postgresql") == (
        "CREATE TABLE IF NOT EXISTS incident_batches (query_name VARCHAR(200) NOT NULL, "
        "batch_id BIGINT NOT NULL, PRIMARY KEY (query_name))"
    )


class Ledger:
    """Stands in for a connection: notes what is committed, and holds the ledger."""

    def __init__(self, fail=False):
        self.entries, self.log, self.fail = {}, [], fail

    def begin(self, *_):
        return contextlib.contextmanager(self._transaction)()

    def _transaction(self):
        before, self.pending = dict(self.entries), []
        try:
            yield self
            self.log += self.pending
        except BaseException:
            self.entries = before
            raise

    def createStatement(self):
        return self

    def executeUpdate(self, text):
        if self.fail:
            raise RuntimeError("lost")
        self.pending.append(text)

    def prepareStatement(self, text):
        return Prepared(self, text)


class Prepared:
    def __init__(self, ledger, text):
        self.ledger, self.text, self.values = ledger, text, {}

    def setString(self, place, value):
        self.values[place] = value

    setLong = setString

    def executeQuery(self):
        assert self.text == "SELECT batch_id FROM incident_batches WHERE query_name = ?"
        self.rows = [v for k, v in self.ledger.entries.items() if k == self.values[1]]
        return self

    def next(self):
        return bool(self.rows)

    def getLong(self, place):
        return self.rows[place - 1]

    def executeUpdate(self):
        known = self.values[2] in self.ledger.entries
        assert self.text.startswith("UPDATE" if known else "INSERT")
        self.ledger.entries[self.values[2]] = self.values[1]


def test_a_batch_is_committed_once(monkeypatch):
    ledger, db = Ledger(), JdbcStore("jdbc:postgresql://host/db")
    monkeypatch.setattr(sinks, "transaction", ledger.begin)
    assert commit_once(None, db, "q", 0, ["a"]) and commit_once(None, db, "q", 3, ["b"])
    assert not commit_once(None, db, "q", 3, ["b"]) and not commit_once(None, db, "q", 1, ["x"])
    assert commit_once(None, db, "other", 1, ["c"])
    assert ledger.log == ["a", "b", "c"] and ledger.entries == {"q": 3, "other": 1}
    ledger.fail = True  # neither rows nor entry
    with pytest.raises(RuntimeError):
        commit_once(None, db, "q", 4, ["d"])
    ledger.fail = False
    assert commit_once(None, db, "q", 4, ["d"])
    assert ledger.log == ["a", "b", "c", "d"]


def test_reading_a_database_is_split_over_the_districts():
    class Table(tuple):
        dtypes = (("district", "int"),)

    class Own(tuple):  # a table that Spark itself has defined
        dtypes = (("District", "double"),)

    class Session:
        read = Recorder()

    def reads(kind):
        Session.read.jdbc = lambda url, table, predicates=None, properties=None: kind(
            (table, predicates)
        )

    reads(Own)
    recreated = read_results(Session, JdbcStore("jdbc:x:y", connections=2), ANOMALIES)
    assert recreated == ("crime_anomalies", None)
    reads(Table)
    table, shares = read_results(Session, JdbcStore("jdbc:x:y", connections=2), ANOMALIES)
    assert table == "crime_anomalies"
    assert shares == [
        "ABS(MOD(district, 2)) = 0 OR district IS NULL",
        "ABS(MOD(district, 2)) = 1",
    ]
    whole = read_results(Session, JdbcStore("jdbc:x:y", connections=1), ANOMALIES)
    assert whole == ("crime_anomalies", None)


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = new_work_dir(spark), new_work_dir(spark)
    assert first != second
    if base:
        assert first.startswith(base)
