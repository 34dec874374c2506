import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_stream.llm import hilbert
from incident_stream.llm.queries import op10_hilbert
from tests.llm.conftest import MIDDLE, documents, prose, rows_of

LARGE = "/root/testdata/sf0.1"


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    place = hilbert.curve_index([cells[:, i] for i in range(n)], bits)
    assert sorted(place) == list(range(1 << (n * bits)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts, shards=40):
    got = {}
    for r in rows:
        got.setdefault(r["shard"], []).append(r)
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    for shard, of in got.items():
        assert sorted(r["slot"] for r in of) == list(range(len(of)))
        assert 0 <= shard < shards
        assert abs(sum(r["size"] for r in of) - total / shards) <= largest
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    return got


def test_query(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = op10_hilbert(spark, MIDDLE).collect()
    got = check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert len(got) == 40


@pytest.fixture(scope="module")
def sharded(spark, tmp_path_factory):
    from incident_stream.llm.common import importable

    importable(spark)
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    shards = hilbert.write_shards(docs, str(tmp_path_factory.mktemp("shards") / "out"))
    return docs, shards, shards.bounds(spark).cache()


def test_every_row_is_written_once_with_its_columns(spark, sharded):
    docs, shards, _ = sharded
    found = shards.read(spark)
    assert found.select(docs.columns).exceptAll(docs).count() == docs.exceptAll(found.select(docs.columns)).count() == 0
    assigned = hilbert.shard_by_curve(docs).drop("curve")
    assert hilbert.digest(shards, spark).exceptAll(assigned).count() == 0


def stretches(weights):
    """Ascending (value, weight) in about ten runs of equal weight."""
    total, at, out = sum(w for _, w in weights), 0, {}
    for value, w in weights:
        out.setdefault((10 * (2 * at + w)) // (2 * total), []).append((value, w))
        at += w
    return [(run[0][0], run[-1][0], sum(w for _, w in run) / total) for run in out.values()]


def weighed(spark, shards, *columns):
    rows = shards.read(spark).groupBy(*columns).agg(F.sum(shards.names["size"])).collect()
    return sorted((tuple(r)[:-1], r[-1]) for r in rows)


def test_a_tenth_of_the_sizes_meets_few_shards(spark, sharded):
    _, shards, bounds = sharded
    for (low,), (high,), share in stretches(weighed(spark, shards, shards.names["size"])):
        met = shards.meeting(bounds, "size", low, high)
        assert share < 0.15 and len(met) <= 15, (low, high)
        there = shards.read(spark).where(F.col(shards.names["size"]).between(low, high))
        assert {r[0] for r in there.select(shards.names["shard"]).distinct().collect()} <= set(met)


def test_a_tenth_of_languages_and_sources_meets_few_shards(spark, sharded):
    _, shards, bounds = sharded
    for low, high, share in stretches(weighed(spark, shards, "lang", "source")):
        met = shards.meeting(bounds, ("lang", "source"), low, high)
        inside = F.struct("lang", "source").between(*(F.struct(F.lit(e[0]).alias("lang"), F.lit(e[1]).alias("source")) for e in (low, high)))
        there = shards.read(spark).where(inside).select(shards.names["shard"]).distinct()
        assert {r[0] for r in there.collect()} <= set(met)
        assert share < 0.15 and len(met) <= 15, (low, high)
    total = sum(w for _, w in weighed(spark, shards, "lang"))
    for (lang,), weight in weighed(spark, shards, "lang"):
        assert len(shards.meeting(bounds, "lang", lang, lang)) <= 15 + 40 * max(0, weight / total - 0.1), lang


def test_other_shards_are_not_opened(spark, sharded):
    _, shards, _ = sharded
    some = shards.read(spark, [3, 7])
    assert {f.split(f"{shards.names['shard']}=")[1].split("/")[0] for f in some.inputFiles()} > {"3"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"{shards.names['shard']}#" in plan
    assert some.select(shards.names["shard"]).distinct().count() == 2


def test_cells_hold_equal_weights():
    cells = hilbert.Cells.of({"a": 6.0, "b": 1.0, "c": 1.0, "d": 4.0, "e": 4.0}, 2)
    assert cells.place(np.array(["a", "b", "c", "d", "e", "cc", "A", "z"])).tolist() == [0, 1, 1, 2, 3, 1, 0, 3]
    assert hilbert.Cells.of({}, 3).place(np.array([1, 2])).tolist() == [0, 0]


def test_edges(spark):
    texts = [(1, None), (2, ""), (2, ""), (3, "é" * 10), (4, prose(1, 20_000)), *[(7, "same")] * 500, *[(i, "same") for i in range(10, 200)]]
    docs = documents(spark, texts).withColumnRenamed("source", "part").withColumnRenamed("lang", "shard")
    check(hilbert.shard_by_curve(docs).collect(), texts)
    assert rows_of(hilbert.shard_by_curve(documents(spark, []))) == []
    alone = hilbert.shard_by_curve(documents(spark, [(None, "x")])).collect()
    assert [(r["doc_id"], r["slot"]) for r in alone] == [(None, 0)]


def test_edges_of_written_shards(spark, tmp_path):
    texts = [(1, None), (2, ""), (3, "é" * 10), (4, prose(1, 20_000)), *[(7, "same")] * 500, (None, "x"), *[(i, "same") for i in range(10, 200)]]
    docs = documents(spark, texts).withColumn("curve_shard", F.lit("mine")).withColumn("slot_", F.lit(1))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, "en")).withColumn("source", F.lit(None).cast("string"))
    shards = hilbert.write_shards(docs, str(tmp_path / "a"))
    assert shards.names["shard"] == "curve_shard_"
    rows = hilbert.digest(shards, spark).collect()
    check(rows, texts)
    assert shards.read(spark).select("curve_shard").distinct().collect()[0][0] == "mine"
    bounds = shards.bounds(spark).agg(F.sum("rows"), F.bool_and("null_source"), F.bool_or("null_lang")).first()
    assert tuple(bounds) == (len(texts), True, True)
    none = hilbert.write_shards(documents(spark, []), str(tmp_path / "b"))
    assert none.path == str(tmp_path / "b")
    wide = [(None, "x"), *[((1 << 60) + i, "x" * 50) for i in range(90)]]
    large = hilbert.write_shards(documents(spark, wide), str(tmp_path / "d"))
    check(hilbert.digest(large, spark).collect(), wide)
    alone = hilbert.write_shards(documents(spark, [(None, None)]), str(tmp_path / "c"))
    assert [(r["doc_id"], r["size"], r["slot"]) for r in hilbert.digest(alone, spark).collect()] == [(None, 16, 0)]
