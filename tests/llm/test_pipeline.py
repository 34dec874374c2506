from pyspark.sql import functions as F

import corpus_pipeline
from incident_stream.llm import packing
from tests.llm.conftest import DOCS, MIDDLE, documents, prose
from tests.llm.test_packing import VOCABULARY, check_pieces
from tests.llm.test_simhash import expected as near_duplicates
from tests.llm.test_substring import expected as without_passages


def test_stages_on_their_own_input(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(corpus_pipeline.written(stage(spark, steps[-1], MIDDLE)))
        assert steps[-1].columns == docs.columns
        assert dict(steps[-1].dtypes) == dict(docs.dtypes)
    tables = [{r["doc_id"]: r["text"] for r in df.collect()} for df in steps]
    good = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(good & set(tables[1])) >= 0.97 * len(good)
    toxic = {i for i in tables[1] if i in labels and labels[i]["toxic"] == 1}
    assert len(toxic & set(tables[2])) <= 0.3 * len(toxic)
    assert len(good & set(tables[2])) >= 0.99 * len(good & set(tables[1]))
    kept = {i for i, _, root in near_duplicates(sorted(tables[2].items())) if i == root}
    assert set(tables[3]) == kept
    at = sorted(tables[3])
    wanted = dict(zip(at, without_passages([tables[3][i] for i in at]), strict=True))
    assert tables[4] == {i: w[2] if tables[3][i] is not None else None for i, w in wanted.items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, steps[-1], MIDDLE).collect()
    coder = packing.Coder(VOCABULARY, corpus_pipeline.public_tokenizers.PATTERN)
    check_pieces(pieces, {i: coder.ids(t or "") for i, t in tables[4].items()})


def test_run_is_all_stages(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "offset"} <= set(found.columns) and found.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), "/root/testdata/sf0.001").count() == 0


def test_stages_take_odd_rows(spark):
    """Nulls in every column, empty, very long and repeated texts, repeated rows, clashing columns."""
    sf = "/root/testdata/sf0.001"
    good = spark.read.parquet(f"{sf}/documents.parquet")
    long = prose(3, 60_000, 20_000)
    odd = spark.createDataFrame(
        [
            (None, None, None, None, None), (900_001, "", "en", "s", 0), (900_002, long, None, None, 1),
            (900_003, prose(4, 80), "en", "s", 1), (900_003, prose(4, 80), "en", "s", 1),
            (None, prose(5, 80), "en", "s", None), (900_004, " \n ", "en", "s", 3),
        ],
        DOCS,
    )
    docs = good.unionByName(odd)
    for name in ("n_words", "kept_text", "root", "_score", "_text", "tier"):
        docs = docs.withColumn(name, F.lit("x"))
    ids, texts = [], []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf))
        assert docs.columns == corpus_pipeline.COLUMNS
        rows = docs.collect()
        ids.append([r["doc_id"] for r in rows])
        texts.append({r["text"] for r in rows})
    assert not {900_001, 900_004} & set(ids[0]) and ids[0].count(900_003) == 2  # too short, or judged alike
    assert ids[2].count(900_003) == 1
    assert long in texts[2] and 900_002 in ids[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == len(set(ids[3]))
