import os

import pytest
from pyspark.sql import functions as F

from incident_stream.schema import ANOMALIES, MONTHLY
from incident_stream.settings import FileStore
from incident_stream.sources.results import read_results
from incident_stream.streaming import log as logs
from incident_stream.streaming.log import Log, Mark, State
from incident_stream.streaming.sinks import batch_writer, claim_run, fold, lineage_of
from tests.test_sinks import batch, stored


@pytest.fixture
def store(tmp_path):
    return FileStore(str(tmp_path / "results"))


@pytest.fixture
def log(spark, store):
    return Log(spark, store, MONTHLY)


def names(log):
    return set(os.listdir(log.path))


# --- marks ---------------------------------------------------------------------------------------


def test_marks_move_over_empty_batches_and_stop_before_unfinished_ones():
    mark = Mark().moved([0, 1, 4], [])
    assert mark == Mark(4) and mark.covers(3) and not mark.covers(5)
    mark = mark.moved([5, 7, 8], [6])
    assert mark == Mark(5, (7, 8)) and mark.covers(8) and not mark.covers(6)
    assert mark.moved([6], []) == Mark(8)
    assert mark.moved([], []) == Mark(8)  # 6 was given up
    assert Mark(3).moved([], [1]) == Mark(3)


def test_state_tells_fresh_batches():
    state = State(1, 1, {1: Mark(4), 2: Mark(0, (2,))}, ((1, 3), (1, 5), (2, 1), (2, 2), (3, 0)), ((3, 1),))
    assert state.fresh == [(1, 5), (2, 1), (3, 0)]
    assert state.moved() == {1: Mark(5), 2: Mark(2), 3: Mark(0)}


def test_the_description_does_not_grow_with_the_batches(spark, store, log):
    sizes = []
    for n, before in ((10, 0), (10_000, 10)):
        for number in range(before, n):
            os.makedirs(f"{log.path}/run=1/batch={number}")
            open(f"{log.path}/run=1/batch={number}/_SUCCESS", "w").close()
        state = log.state()
        assert len(state.fresh) == n - before
        number = log.publish(state, spark.range(1))
        sizes.append(os.path.getsize(f"{log.path}/_base_{number}.json"))
        assert log.state().fresh == []
    assert sizes[1] <= sizes[0] + 4
    assert log.clean(0) == 10_000 and log.clean(0) == 0
    assert log.state().fresh == [] and log.state().marks == {1: Mark(9_999)}


def test_a_base_of_an_earlier_version_is_read(spark, store, log):
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark, ("2001-01", 1)), 0)
    write(batch(spark, ("2001-02", 2)), 1)
    fold(spark, store, MONTHLY)
    log.folder.delete("_base_1.json")
    log.folder.write_json("_base_1.json", ["run=1/batch=0", "run=1/batch=1"])
    assert log.state().marks == {1: Mark(1)}
    write(batch(spark, ("2001-02", 3)), 2)
    assert stored(spark, store) == {"2001-01": 1, "2001-02": 3}


def test_an_unfinished_batch_is_not_taken_for_an_empty_one(spark, store, log):
    write = batch_writer(store, MONTHLY, run=1)
    for number in range(3):
        write(batch(spark, (f"2001-0{number + 1}", number)), number)
    os.remove(f"{log.path}/run=1/batch=1/_SUCCESS")
    assert fold(spark, store, MONTHLY, keep_seconds=0) == 2
    assert log.state().marks == {1: Mark(0, (2,))}
    write(batch(spark, ("2001-02", 7)), 1)  # again, to its end
    assert stored(spark, store) == {"2001-01": 0, "2001-02": 7, "2001-03": 2}
    fold(spark, store, MONTHLY, keep_seconds=0)
    assert log.state().marks == {1: Mark(2)}


# --- reading while folding -----------------------------------------------------------------------


def test_a_frame_made_before_a_fold_reads_in_full_after_it(spark, store, log):
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark, ("2001-01", 1), ("2001-02", 1)), 0)
    early = read_results(spark, store, MONTHLY)
    fold(spark, store, MONTHLY)
    write(batch(spark, ("2001-02", 5)), 1)
    middle = read_results(spark, store, MONTHLY)
    fold(spark, store, MONTHLY)
    assert {r["year_month"]: r["total_crimes"] for r in early.collect()} == {"2001-01": 1, "2001-02": 1}
    assert {r["year_month"]: r["total_crimes"] for r in middle.collect()} == {"2001-01": 1, "2001-02": 5}
    assert {"base=1", "base=2", "run=1"} <= names(log)


def test_what_is_older_than_the_stated_time_goes(spark, store, log, monkeypatch):
    write = batch_writer(store, MONTHLY, run=1)
    times = {}
    real = logs.Folder.modified
    monkeypatch.setattr(logs.Folder, "modified", lambda self, name: times.get(name, real(self, name)))
    for number in range(3):
        write(batch(spark, ("2001-01", number)), number)
        fold(spark, store, MONTHLY, keep_seconds=1000)
    assert {"base=1", "base=2", "base=3"} <= names(log)
    times["_base_2.json"] = real(log.folder, "_base_3.json") - 2000
    assert fold(spark, store, MONTHLY, keep_seconds=1000) == 0  # also without new batches
    assert "base=1" not in names(log) and {"base=2", "base=3"} <= names(log)
    assert os.listdir(f"{log.path}/run=1") == ["batch=2"]  # base 3 is younger than that
    assert stored(spark, store) == {"2001-01": 2}


def test_a_batch_that_is_repeated_after_its_folding_changes_nothing(spark, store, log):
    for mode in ("upsert", "add"):
        own = FileStore(f"{store.root}/{mode}")
        write = batch_writer(own, MONTHLY, mode, run=4)
        write(batch(spark, ("2001-01", 1)), 0)
        write(batch(spark, ("2001-01", 2)), 1)
        fold(spark, own, MONTHLY, keep_seconds=0)
        write(batch(spark, ("2001-01", 2)), 1)
        assert stored(spark, own) == {"2001-01": 2 if mode == "upsert" else 3}
        assert Log(spark, own, MONTHLY).state().finished == ()


def test_of_two_folds_at_the_same_time_one_counts(spark, store, log):
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark, ("2001-01", 1)), 0)
    slow, rows = log.state(), read_results(spark, store, MONTHLY)
    write(batch(spark, ("2001-02", 2)), 1)
    fold(spark, store, MONTHLY)
    with pytest.raises(RuntimeError, match="another job"):
        log.publish(slow, rows.selectExpr("*", "1L AS run", "0L AS batch"))
    assert stored(spark, store) == {"2001-01": 1, "2001-02": 2}
    assert "base=2" not in names(log)


def test_a_fold_that_ended_half_way_is_passed_over(spark, store, log):
    write = batch_writer(store, MONTHLY, run=1)
    write(batch(spark, ("2001-01", 1)), 0)
    log.folder.claim("_fold_1")
    os.makedirs(f"{log.path}/base=1")
    assert fold(spark, store, MONTHLY, keep_seconds=0) == 1
    assert stored(spark, store) == {"2001-01": 1}
    assert {n for n in names(log) if not n.startswith(".")} == {
        "base=2", "_fold_2", "_base_1.json", "_clock", "run=1"
    }


# --- adding up -----------------------------------------------------------------------------------


def test_batches_add_up_before_and_after_folding(spark, store, log):
    write = batch_writer(store, MONTHLY, "add", run=1)
    write(batch(spark, ("2001-01", 1), ("2001-02", 5)), 0)
    write(batch(spark, ("2001-01", 2)), 1)
    write(batch(spark, ("2001-01", 2)), 1)  # repeated
    assert stored(spark, store) == {"2001-01": 3, "2001-02": 5}
    assert fold(spark, store, MONTHLY) == 2
    write(batch(spark, ("2001-01", 4), ("2001-03", 1)), 2)
    wanted = {"2001-01": 7, "2001-02": 5, "2001-03": 1}
    assert stored(spark, store) == wanted
    assert fold(spark, store, MONTHLY, keep_seconds=0) == 1
    assert stored(spark, store) == wanted
    assert read_results(spark, store, MONTHLY).columns == MONTHLY.names


def test_a_new_lineage_takes_the_place_of_the_old_one(spark, store, tmp_path):
    first = lineage_of(spark, store, MONTHLY, str(tmp_path / "c1"))
    assert first == lineage_of(spark, store, MONTHLY, str(tmp_path / "c1"))
    batch_writer(store, MONTHLY, "add", first.number)(batch(spark, ("2001-01", 5)), 0)
    fold(spark, store, MONTHLY)
    claim_run(spark, store, MONTHLY)
    second = lineage_of(spark, store, MONTHLY, str(tmp_path / "c2"))
    assert second.number > first.number and second.name != first.name
    assert stored(spark, store) == {"2001-01": 5}
    batch_writer(store, MONTHLY, "add", second.number)(batch(spark, ("2001-01", 2)), 0)
    assert stored(spark, store) == {"2001-01": 2}
    fold(spark, store, MONTHLY, keep_seconds=0)
    batch_writer(store, MONTHLY, "add", second.number)(batch(spark, ("2001-01", 4)), 1)
    assert stored(spark, store) == {"2001-01": 6}


def test_shares_do_not_add_up(store):
    with pytest.raises(ValueError, match="cannot be added"):
        batch_writer(store, ANOMALIES, "add")


def test_a_log_that_adds_up_is_summed_by_hash(spark, store):
    batch_writer(store, MONTHLY, "add")(batch(spark, ("2001-01", 1)), 0)
    found = read_results(spark, store, MONTHLY)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert found.agg(F.sum("total_crimes")).first()[0] == 1
