import numpy as np

from incident_stream.llm import nn_descent
from incident_stream.llm.queries import op4_nn_descent
from tests.llm.conftest import MIDDLE, components_of, rows_of

VECTORS = "vec_id bigint, embedding array<float>, label int"


def expected(rows, threshold=0.93):
    """{row: (vec_id, n_links, component_id, kept)} by brute force, row by row."""
    units = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)
        x = np.array(v, np.float32).astype(float) if ok else None
        units.append(x / np.linalg.norm(x) if ok and x.any() else None)
    links, pairs = [0] * len(rows), []
    groups = {}
    for i, u in enumerate(units):
        if u is not None:
            groups.setdefault((rows[i][2], len(u)), []).append(i)
    for at in groups.values():
        x = np.array([units[i] for i in at])
        near = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            pairs.append((at[a], at[b]))
            links[at[a]] += 1
            links[at[b]] += 1
    root = components_of(range(len(rows)), pairs)
    least = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            least[root[i]] = min(least.get(root[i], vec_id), vec_id)
    return sorted(
        ((r[0], links[i], least.get(root[i]), r[0] is not None and r[0] == least[root[i]]) for i, r in enumerate(rows)),
        key=repr,
    )


def near(rng, v, noise):
    return (v + noise * rng.normal(size=len(v))).astype(np.float32).tolist()


def test_planted_pairs_chains_and_a_dense_cluster(spark):
    """The cluster is larger than the largest list, so it takes the exact way."""
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for _ in range(900):
        rows.append((n, rng.normal(size=64).astype(np.float32).tolist(), n % 4))
        n += 1
    for k in range(40):
        v = rng.normal(size=64)
        for _ in range(2 + k % 3):
            rows.append((n, near(rng, v, 0.08), k % 4))
            n += 1
    centre = rng.normal(size=64)
    for _ in range(150):
        rows.append((n, near(rng, centre, 0.08), 1))
        n += 1
    for _ in range(60):
        rows.append((n, rows[3][1], 3))
        n += 1
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert sorted(rows_of(nn_descent.near_duplicates(df)), key=repr) == expected(rows)


def test_links_between_saturated_groups(spark):
    """Two groups fill their lists each from itself; all links across are below those within."""
    rng = np.random.default_rng(6)
    one, other = np.eye(64)[0], np.eye(64)[1]
    rows = [(n, rng.normal(size=64).astype(np.float32).tolist(), n % 2) for n in range(100)]
    for side in (0.0, 0.33):
        centre = np.cos(side) * one + np.sin(side) * other
        rows += [(len(rows) + k, near(rng, centre, 0.01), 1) for k in range(250)]
    x = np.array([r[1] for r in rows[100:]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    cosine = x @ x.T
    across = cosine[:250, 250:]
    assert across.max() < min(cosine[:250, :250].min(), cosine[250:, 250:].min()) and (across >= 0.93).mean() > 0.5
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(rows_of(nn_descent.near_duplicates(df)), key=repr) == expected(rows)


def test_exact_after_failed_audits(spark, monkeypatch):
    """A search that finds nothing, in a table where the first audited nodes have no links."""
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 1)
    monkeypatch.setattr(nn_descent, "AUDIT_NODES", 5)
    empty = spark.createDataFrame([], nn_descent._EDGES)
    monkeypatch.setattr(nn_descent, "neighbour_graph", lambda nodes, plan, seed: empty)
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(size=64).astype(np.float32).tolist(), n % 2) for n in range(900)]
    rows += [(900 + n, near(rng, rows[n][1], 0.08), n % 2) for n in range(9)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(rows_of(nn_descent.near_duplicates(df)), key=repr) == expected(rows)


def test_a_table_without_links_is_audited_in_one_pass(spark, monkeypatch):
    """Orthogonal vectors: only the probes have links. They are found, stand for no row and join
    nothing, and no more than the fixed number of nodes is compared with all."""
    passes, searches = [], []
    audited, searched = nn_descent._audited, nn_descent._searched
    monkeypatch.setattr(nn_descent, "_audited", lambda queries, threshold: passes.append(len(queries)) or audited(queries, threshold))
    monkeypatch.setattr(nn_descent, "_searched", lambda *args: searches.append(searched(*args)) or searches[-1])
    rows = [(n, np.eye(600)[n % 600].tolist(), n // 600) for n in range(1200)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = rows_of(nn_descent.near_duplicates(df))
    assert sorted(found) == [(n, 0, n, True) for n in range(1200)]
    assert passes == [nn_descent.AUDIT_NODES]
    (_, _, (met, there)), = searches
    assert there == nn_descent.PROBES and met >= nn_descent.MIN_RECALL * there


def test_probes_lie_just_above_the_threshold(spark):
    rows = [(n, np.random.default_rng(n).normal(size=8)) for n in range(20)]
    rows = [(n, "8/0", bytearray((v / np.linalg.norm(v)).tobytes())) for n, v in rows] + [(20, "1/0", bytearray(np.ones(1).tobytes()))]
    nodes = spark.createDataFrame(rows, "node bigint, grp string, full binary")
    units = {n: np.frombuffer(bytes(v)) for n, _, v in rows}
    found = nn_descent.probes_of(nodes, 0.93).collect()
    assert sorted(r["node"] for r in found) == [-1 - n for n in range(19, -1, -1)]
    for r in found:
        turned = np.frombuffer(bytes(r["full"]))
        assert 0.93 < turned @ units[-1 - r["node"]] <= 0.95 + 1e-9
        assert abs(np.linalg.norm(turned) - 1) < 1e-9 and len(bytes(r["half"])) == 16


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(rows_of(op4_nn_descent(spark, MIDDLE)), key=repr) == expected(rows)


def test_edges(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [
        (1, a, 0), (2, a, 1), (3, a, None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [0.0] * 3, 0),
        (7, [1.0, None, 0.0], 0), (8, [float("nan"), 1.0, 0.0], 0), (9, [float("inf"), 1.0, 0.0], 0), (10, [], 0),
        (11, [2.0, 0.0, 0.0], 0), (12, [1.0, 0.0], 0), (13, [-1.0, 0.0, 0.0], 0), (14, b, 0), (14, b, 0), (14, a, 0),
        (None, b, 0), (None, [0.0, 0.0, 1.0], 5), (15, [1.0, 0.38, 0.0], 0), (16, [1.0, 0.41, 0.0], 0),
        (17, [1e-30, 0.0, 0.0], 0), (18, [3e38, 3e38, 0.0], 0), (19, [-0.0, 1.0, -0.0], 0),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS + ", n bigint, node string")
    assert sorted(rows_of(nn_descent.near_duplicates(df)), key=repr) == expected(rows)
    assert rows_of(nn_descent.near_duplicates(spark.createDataFrame([], VECTORS))) == []
