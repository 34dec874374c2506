import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from incident_stream.operators import enrich as joins
from incident_stream.operators.enrich import enrich, salted_codes
from incident_stream.operators.hot_codes import (
    CodeListener,
    RecentCodes,
    SpaceSaving,
    frequent_codes,
)
from incident_stream.plans import pipelines
from incident_stream.schema import ANOMALIES, MONTHLY
from incident_stream.settings import FileStore, Params
from incident_stream.sources.results import read_results
from tests.test_enrich import CODE, rows
from tests.test_streaming import Feed, go, line, snapshot


def test_no_frequent_item_is_missed():
    rng = random.Random(2)
    items = [rng.choice("ab") if rng.random() < 0.3 else str(rng.randrange(5000)) for _ in range(20_000)]
    sketch, true = SpaceSaving(50), Counter(items)
    for item in items:
        sketch.add(item, 1)
    sketch.total = len(items)
    assert len(sketch.counts) == 50
    assert all(sketch.counts[i] >= true[i] for i in sketch.counts if i in true)
    assert {"a", "b"} <= set(sketch.frequent(0.1)) and len(sketch.frequent(0.1)) == 2


def test_old_batches_fade():
    sketch = SpaceSaving(10)
    sketch.add_batch([("a", 50)], 100)
    assert sketch.frequent(0.4) == ["a"]
    for _ in range(3):
        sketch.add_batch([("b", 50)], 100)
    assert sketch.frequent(0.4) == ["b"]
    assert SpaceSaving(3).frequent(0.1) == []


def test_what_is_remembered(spark, tmp_path):
    recent = RecentCodes(spark, str(tmp_path / "hot"))
    assert recent.hot(8) is None
    recent.update([("110", 60), ("9", 1)], 100)
    recent.update([("110", 40), ("é", 30)], 100)
    again = RecentCodes(spark, str(tmp_path / "hot"))
    assert again.hot(8) == ["110", "é"] and again.hot(1) == []
    assert len(list((tmp_path / "hot").glob("codes_*.json"))) == 1


def test_a_batch_reports_its_frequent_codes(spark):
    code = F.when(F.col("id") % 3 == 0, "110").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    found = spark.range(9000).select(code.alias("IUCR")).agg(*frequent_codes(F.col("IUCR"))).first()
    assert found["rows"] == 9000
    assert {r["item"]: r["count"] for r in found["top"]}["110"] >= 3000


@pytest.fixture
def codes(spark):
    hundred = [(str(i), f"C{i}", "I") for i in range(100)]
    return spark.createDataFrame([*hundred, (None, "NULL", "N")], CODE)


def test_only_hot_codes_are_copied(codes):
    copies = F.when(F.col("IUCR").isin(["1", "7", "absent"]), 16).otherwise(1)
    salted = salted_codes(codes, copies)
    assert salted.count() == 98 + 2 * 16
    assert salted.where("salt > 0").select("IUCR").distinct().count() == 2


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("hot", [["1"], [], None])
def test_a_hot_code_is_spread_over_all_tasks(spark, codes, parts, hot):
    """A third of the records carry code 1 and a third none; nothing adapts."""
    kind = F.col("id") % 3
    code = F.when(kind == 0, "1").when(kind == 1, (F.col("id") % 150).cast("string"))
    records = spark.range(0, 9000, 1, parts).select(F.col("id").cast("string").alias("ID"), code.alias("IUCR"))
    wanted = rows(enrich(records, codes), "ID", "IUCR", "category")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = enrich(records, codes, broadcast_bytes=0, join_partitions=40, hot=hot)
        assert rows(joined, "ID", "IUCR", "category") == wanted
        group = F.when(F.col("IUCR") == "1", "hot").when(F.col("IUCR").isNull(), "none").otherwise("rest")
        sizes = joined.groupBy(group.alias("group"), F.spark_partition_id().alias("task")).count().collect()
        most = {g: max(r["count"] for r in sizes if r["group"] == g) for g in ("hot", "none")}
        assert most["none"] < 3000 / 6
        # all of them in one task, in about a fortieth each, or in an eighth
        assert (most["hot"] >= 3000) if hot == [] else most["hot"] < 3000 / (6 if hot else 3)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_the_job_learns_its_hot_codes(spark, tmp_path, monkeypatch):
    """The first start knows nothing and salts all codes; the next ones salt what was frequent. The
    results are those of a broadcast table."""
    feed, asked = Feed(spark, tmp_path), []
    plain, salted = FileStore(str(tmp_path / "plain")), FileStore(str(tmp_path / "salted"))
    real = pipelines.enrich

    def noted(records, codes, **options):
        asked.append(options.get("hot"))
        return real(records, codes, **options)

    for step in range(3):
        feed.add(*[line(step + 1)] * 20, *[line(step + 1, 2.0, "0486")] * 3, line(20 * step + 1, 3.0, "77"))
        go(spark, tmp_path, plain, Params("A", 2), "plain_c")
        with monkeypatch.context() as patch:
            patch.setattr(pipelines, "enrich", noted)
            patch.setattr(pipelines, "BROADCAST_BYTES", 0)
            patch.setattr(joins.enrich, "__defaults__", (0, *joins.enrich.__defaults__[1:]))
            go(spark, tmp_path, salted, Params("A", 2), "salted_c")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert asked[0] is None
    assert all(hot is not None and "110" in hot for hot in asked[1:])
    for contract in (MONTHLY, ANOMALIES):
        assert snapshot(spark, salted, contract) == snapshot(spark, plain, contract) != []
    assert read_results(spark, salted, MONTHLY).where("category = 'HOMICIDE'").count() > 0


def test_other_metrics_are_left_alone(spark, tmp_path):
    recent = RecentCodes(spark, str(tmp_path / "hot"))
    listener = CodeListener(recent, "codes 1")

    class Event:
        class progress:
            observedMetrics = {"codes 2": {"rows": 5, "top": []}}

    listener.onQueryProgress(Event)
    Event.progress.observedMetrics = {"codes 1": {"rows": 0, "top": None}}
    listener.onQueryProgress(Event)
    assert recent.hot(4) is None
