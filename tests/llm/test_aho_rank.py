import math
import re

import pytest
from pyspark.sql import functions as F

from incident_stream.llm import aho_rank, oracle
from incident_stream.llm.queries import op12_aho_rank
from tests.compare import connect, differences
from tests.llm.conftest import MIDDLE, SMALL, documents, prose

FOLD = str.maketrans(aho_rank.UPPER, aho_rank.LOWER)


def terms_of(text):
    return re.findall(aho_rank.TERM, (text or "").translate(FOLD))


def brute(docs, items, k=10):
    read = [(i, terms_of(t)) for i, t in docs]
    n_docs = sum(1 for _, t in read if t)
    total = sum(len(t) for _, t in read)
    df = {}
    for _, t in read:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in read:
            score = 0
            for x in set(terms_of(text)) & set(t):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                tf, m = t.count(x), 10 + 90 * len(t) * n_docs // total
                score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    table = documents(spark, docs).repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in aho_rank.rank(table, asked, **options).collect()), key=str)


@pytest.mark.parametrize("sf", [SMALL, MIDDLE])
def test_query_against_sql(spark, sf):
    sql = oracle.SQL["op12_aho_rank"]
    assert differences(spark, connect(sf), sf, op12_aho_rank, sql) is None


def test_terms_stand_alone(spark):
    docs = [
        (1, "cat"), (2, "concat cats"), (3, "Cat,cat;CAT"), (4, "the-cat's 9cat cat9"), (5, "çat ÇAT cat x"),
        (6, "dog cat dog"), (7, "a"), (8, "\x00cat\x7f[cat]`{"), (9, "日本cat 日本 cat"),
    ]
    items = [(1, "cat"), (2, "CAT dog"), (3, "ÇAT"), (4, "日本"), (5, "s 9cat"), (6, "cat cat")]
    assert found(spark, docs, items) == brute(docs, items)


def test_ties_repeated_rows_and_the_best_of_many_tasks(spark, monkeypatch):
    docs = [(i % 300, prose(i % 90, 30 + i % 7, 60)) for i in range(700)] + [(None, "w1 w2")] * 15
    items = [(i, prose(1000 + i, 6, 80)) for i in range(20)] + [(3, "w1 w2"), (3, "w2 w1"), (None, "w5")]
    monkeypatch.setattr(aho_rank, "PORTION_BYTES", 900)
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=1) == brute(docs, items, k=1)


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (4, "x"), (5, "long " * 200_000 + "needle"), (6, "y" * 300_000)]
    items = [(1, None), (2, ""), (3, "-"), (4, "absent"), (5, "needle"), (6, "y" * 300_000), (7, "long x")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_clashing_columns(spark):
    docs, items = [(i, prose(i, 20, 30)) for i in range(40)], [(1, "w1 w2"), (2, "w3")]
    table, asked = documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")
    for name in ("score", "rank", "key", "terms", "item_id", "number", "n"):
        table = table.withColumn(name, F.lit("x"))
    for name in ("score", "rank", "key", "terms", "doc_id", "number", "n", "best"):
        asked = asked.withColumn(name, F.lit("x"))
    got = sorted((tuple(r) for r in aho_rank.rank(table, asked).collect()), key=str)
    assert got == brute(docs, items)


def test_long_texts_are_counted_in_slices(monkeypatch):
    import pyarrow as pa

    from incident_stream.llm import textkernel

    monkeypatch.setattr(aho_rank, "HIT_NUMBERS", 6)
    found = aho_rank.automaton("here", ["a", "b", "ab"])
    texts = next(textkernel.chunks(pa.array(["a b a ab b", "", "b b b b c"])))
    n, text, term, tf = aho_rank.counted(texts, found, 3)
    assert n.tolist() == [5, 0, 5]
    assert list(zip(text, term, tf)) == [(0, 0, 2), (0, 1, 2), (0, 2, 1), (2, 1, 4)]
