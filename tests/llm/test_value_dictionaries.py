import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_stream.llm import oracle, value_dictionaries
from incident_stream.llm.queries import op13_value_dictionaries
from tests.compare import connect, differences
from tests.llm.conftest import MIDDLE, SMALL
from tests.llm.test_maxscore import clustered, table_of


def brute(rows, entries=256, parts=4, rounds=4, scale=1024):
    """Codes and errors by plain Python."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(np.float32(x)) for x in v):
            kept.append((i, [math.floor(float(np.float32(x)) * scale) for x in v], label))
    if not kept:
        return []
    width = max(len(v) for _, v, _ in kept)
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cuts = [k * width // parts for k in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(cuts, cuts[1:])] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [
                [sum(xs) // len(xs) for xs in zip(*groups[k])] if k in groups else e
                for k, e in enumerate(book)
            ]
    text = ",".join(str(x) for book in books for e in book for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    best = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [min(2**63 - 1, sum(d for d, _ in b)) for b in best]
    sums = {}
    for (_, _, label), e in zip(kept, errors):
        sums[label] = min(2**63 - 1, sums.get(label, 0) + e)
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in b), e, sums[label], digest)
        for (i, _, label), b, e in zip(kept, best, errors)), key=str
    )


def found(df, **options):
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = value_dictionaries.with_label_errors(*value_dictionaries.encode(df, **options))
    assert got.columns == names
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("sf", [SMALL, MIDDLE])
def test_query_against_sql(spark, sf):
    sql = oracle.SQL["op13_value_dictionaries"]
    assert differences(spark, connect(sf), sf, op13_value_dictionaries, sql) is None


def test_small_codebooks_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(value_dictionaries, "BLOCK_ROWS", 17)
    rows = [(i, v, i % 3 or None) for i, v, _ in clustered(300, 12, 4)]
    assert found(table_of(spark, rows, 5), entries=9) == brute(rows, entries=9)


def test_ties_repeated_ids_and_negative_means(spark):
    rows = [(i % 40, [float((i * k) % 3 - 1) / 64 for k in range(1, 9)], i % 2) for i in range(120)]
    rows += [(0, [0.0] * 8, 0)] * 30 + [(None, [-0.001] * 8, None)] * 5
    assert found(table_of(spark, rows), entries=6) == brute(rows, entries=6)
    only_null = [(None, [float(i)] * 4, 1) for i in range(10)]
    assert found(table_of(spark, only_null), entries=4) == brute(only_null, entries=4)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [nan, 0.0], 1), (4, [inf], None), (5, [None, 1.0], 1),
        (6, [1.0, 2.0, 3.0, 4.0, 5.0], None), (7, [0.5], 2), (8, [-1.0, -2.0], 2),
    ]
    assert found(table_of(spark, rows)) == brute(rows)
    assert found(table_of(spark, [])) == []
    assert found(table_of(spark, [(1, None, 1)])) == []
    assert found(table_of(spark, [(1, [], 1), (2, [], None)])) == brute([(1, [], 1), (2, [], None)])
    with pytest.raises(ValueError):
        value_dictionaries.encode(table_of(spark, rows), entries=257)


def test_large_numbers_are_exact(spark):
    rows = [(i, [2.0 ** (i + 8), -(2.0**i), 1.0, float(i)], 1) for i in range(30)]
    rows += [(90, [2.0**50, 0.0, 0.0, 0.0], 1), (91, [2.0**80, 0.0, 0.0, 0.0], 1)]
    assert found(table_of(spark, rows), entries=3) == brute(rows[:-1], entries=3)


def test_clashing_columns(spark):
    rows = clustered(50, 8, 9)
    df = table_of(spark, rows)
    for name in ("id", "code", "error", "group", "n", "numbers", "codes", "ids"):
        df = df.withColumn(name, F.lit("x"))
    assert found(df, entries=5) == brute(rows, entries=5)


def test_tables_give_the_distances():
    rng = np.random.default_rng(1)
    cells = rng.integers(-500, 500, (200, 6))
    entries = rng.integers(-500, 500, (7, 6))
    block = value_dictionaries._Block.__new__(value_dictionaries._Block)
    block.n, block.dictionaries, block.codes = 200, [], []
    for j in range(6):
        d, c = np.unique(cells[:, j], return_inverse=True)
        block.dictionaries.append(d)
        block.codes.append(c.astype(np.uint16))
    index, distance = value_dictionaries.nearest(block, 0, 6, entries)
    true = ((cells[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
