"""Embedding near-duplicates by NN-descent.

Equal vectors of a label are one node. A neighbour graph is started from nodes that are next to
each other when sorted by random hyperplane signatures, and refined: every node brings together its
neighbours and those that have it as neighbour, and whoever finds a closer one this way takes it
into its list, until hardly any list changes. A list whose neighbours all reach the threshold is
saturated and grows; nodes that saturate even the largest list lie in a dense cluster and are
compared with all nodes of their label, in blocks, but for blocks that their centre and radius prove
out of reach. Kept links are computed in double precision.
The recall is measured in one pass: a fixed number of nodes is compared with all others, and probes,
copies of some nodes turned away to a cosine just above the threshold, take part in the search, which
must find them. Below the wanted value the search starts again with longer lists, and after the last
attempt all nodes of a label are compared in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.llm.common import components, join_hot, written

THRESHOLD = 0.93
# The search works with half precision; what it keeps has this margin and is then checked.
MARGIN = 0.005
NEIGHBOURS = 12
GROWN = 48
TABLES = 6
NEXT = 4
ROUNDS = 8
SETTLED = 0.002
BLOCK = 512
CLUSTER = 8
PAIRS = 64
CENTRE_BYTES = 32 << 20
# Nodes of each kind that are audited. With as many probes, a recall of 0.97 or more is above 0.94
# with a confidence of 95 percent, however few links the table has.
AUDIT_NODES = 250
PROBES = 250
# Probes are turned to cosines up to so much above the threshold.
PROBE_RANGE = 0.02
MIN_RECALL = 0.97
ATTEMPTS = 3


@dataclass(frozen=True)
class Plan:
    threshold: float = THRESHOLD
    neighbours: int = NEIGHBOURS
    grown: int = GROWN
    tables: int = TABLES


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of a vector's label and value, its unit vector in double and in half precision; null
    for vectors that link with nothing."""
    for batch in batches:
        keys, fulls, halves, groups = [], [], [], []
        labels = batch.column(1).to_pylist()
        vectors = batch.column(2)
        for i, label in enumerate(labels):
            one = vectors[i]
            found = None
            if label is not None and one.is_valid and one.values.null_count == 0 and len(one.values):
                v = np.asarray(one.values, dtype=np.float64) + 0.0
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    group = f"{len(v)}/{label}"
                    scaled = v / top
                    found = (group, v, scaled / np.linalg.norm(scaled))
            if found is None:
                row = (None, None, None, None)
            else:
                group, v, unit = found
                key = hashlib.blake2b(group.encode() + b"\0" + v.tobytes(), digest_size=16)
                row = (key.digest(), unit.tobytes(), unit.astype("<f2").tobytes(), group)
            for out, value in zip((keys, fulls, halves, groups), row, strict=True):
                out.append(value)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(keys, pa.binary()),
                pa.array(groups, pa.string()),
                pa.array(fulls, pa.binary()),
                pa.array(halves, pa.binary()),
            ],
            ["vec_id", "key", "grp", "full", "half"],
        )


def _column(batches: list[pa.RecordBatch], i: int) -> np.ndarray:
    return np.concatenate([np.asarray(b.column(i)) for b in batches])


def _matrix(raw: list[bytes], kind: str, to=np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(to)


def _edge_batch(u, v, sim, new) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float32()), pa.array(new, pa.bool_())],
        ["u", "v", "sim", "new"],
    )


_EDGES = "u bigint, v bigint, sim float, new boolean"
# the columns of a block that are one entry per node
_BLOCK = ["root", "node", "weight", "is_full", "vectors"]


def _signed(tables: int, seed: int):
    """The signature of each node in each table: the signs of 30 random projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            halves = batch.column(2).to_pylist()
            out = np.zeros((batch.num_rows, tables), dtype=np.int64)
            sizes = np.array([len(h) // 2 for h in halves])
            for dim in np.unique(sizes):
                if int(dim) not in planes:
                    rng = np.random.default_rng([seed, int(dim)])
                    planes[int(dim)] = rng.standard_normal((int(dim), tables * 30)).astype(np.float32)
                at = np.flatnonzero(sizes == dim)
                x = _matrix([halves[i] for i in at], "<f2")
                bits = (x @ planes[int(dim)] > 0).reshape(len(at), tables, 30)
                out[at] = bits @ (1 << np.arange(29, -1, -1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(list(out), pa.list_(pa.int64())),
                ],
                ["node", "grp", "half", "signatures"],
            )

    return run


def _started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node with the nodes that follow it in the order of a table, within its group."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    node, table = _column(held, 0), _column(held, 1)
    group = np.concatenate([np.asarray(b.column(2).to_pylist(), dtype=object) for b in held])
    halves = [h for b in held for h in b.column(3).to_pylist()]
    run = np.cumsum(np.concatenate(([0], (table[1:] != table[:-1]) | (group[1:] != group[:-1]))))
    for lo in np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))):
        hi = int(np.searchsorted(run, run[lo], "right"))
        for at in range(lo, hi, 4096):
            end = min(hi, at + 4096 + NEXT)
            x = _matrix(halves[at:end], "<f2")
            for step in range(1, NEXT + 1):
                if end - at <= step:
                    break
                sim = np.einsum("ij,ij->i", x[:-step], x[step:])
                u, v = node[at : end - step], node[at + step : end]
                ok = u != v
                new = np.ones(2 * int(ok.sum()), bool)
                yield _edge_batch(
                    np.concatenate((u[ok], v[ok])), np.concatenate((v[ok], u[ok])),
                    np.concatenate((sim[ok], sim[ok])), new,
                )


def _best(neighbours: int, grown: int, floor: float):
    """The best `neighbours` of each node, and up to `grown` while they reach the floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        u, v, sim = (_column(held, i) for i in range(3))
        new = np.concatenate([b.column(3).to_numpy(zero_copy_only=False) for b in held])
        order = np.lexsort((new, v, u))
        u, v, sim, new = u[order], v[order], sim[order], new[order]
        first = np.concatenate(([True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])))
        u, v, sim, new = u[first], v[first], sim[first], new[first]
        order = np.lexsort((v, -sim, u))
        u, v, sim, new = u[order], v[order], sim[order], new[order]
        start = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
        rank = np.arange(len(u)) - np.repeat(start, np.diff(start, append=len(u)))
        stay = (rank < neighbours) | ((rank < grown) & (sim >= floor))
        yield _edge_batch(u[stay], v[stay], sim[stay], new[stay])

    return run


def _shortened(edges: DataFrame, plan: Plan) -> DataFrame:
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    floor = plan.threshold - MARGIN
    best = _best(plan.neighbours, plan.grown, floor)
    return written(edges.repartition(parts, "u").mapInArrow(best, _EDGES))


def _local_join(reverse: int):
    """Brings together the members of each pivot; hands out who is closer than a member's bound.

    Of those that have the pivot as neighbour a random few take part, as NN-descent has it; the
    pivot's own list takes part whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        pivot, member, mark, bound = (_column(held, i) for i in range(4))
        new = np.concatenate([b.column(4).to_numpy(zero_copy_only=False) for b in held])
        halves = [h for b in held for h in b.column(5).to_pylist()]
        order = np.lexsort((mark, pivot))
        start = np.flatnonzero(np.concatenate(([True], np.diff(pivot[order]) != 0)))
        outs: list[tuple] = []
        size = 0
        for lo, hi in zip(start, np.append(start[1:], len(order)), strict=True):
            at = order[lo:hi]
            own = at[mark[at] < 0]
            at = np.concatenate((own, at[mark[at] >= 0][:reverse]))
            _, once = np.unique(member[at], return_index=True)
            fresh = np.zeros(len(once), bool)
            np.logical_or.at(fresh, np.searchsorted(member[at][once], member[at]), new[at])
            at = at[once]
            if len(at) < 2 or not fresh.any():
                continue
            x = _matrix([halves[i] for i in at], "<f2")
            sim = x @ x.T
            closer = (sim > bound[at][:, None]) & (fresh[:, None] | fresh[None, :])
            np.fill_diagonal(closer, False)
            i, j = np.nonzero(closer)
            if len(i):
                outs.append((member[at][i], member[at][j], sim[i, j]))
                size += len(i)
            if size > 200_000:
                u, v, s = (np.concatenate([o[k] for o in outs]) for k in range(3))
                yield _edge_batch(u, v, s, np.ones(len(u), bool))
                outs, size = [], 0
        if outs:
            u, v, s = (np.concatenate([o[k] for o in outs]) for k in range(3))
            yield _edge_batch(u, v, s, np.ones(len(u), bool))

    return run


def _refined(graph: DataFrame, nodes: DataFrame, plan: Plan, round_number: int) -> DataFrame:
    """One round: neighbours of neighbours."""
    parts = int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = graph.groupBy("u").agg(F.min("sim").alias("worst"), F.count("*").alias("n"))
    floor = plan.threshold - MARGIN
    # a list that is not full takes anything; one that is saturated takes what reaches the floor
    bound = (
        F.when(F.col("n") < plan.neighbours, F.lit(-2.0))
        .when(F.col("n") < plan.grown, F.least("worst", F.lit(floor)))
        .otherwise(F.col("worst"))
    )
    known = nodes.select("node", "half").join(bounds, F.col("node") == F.col("u"), "left").select(
        "node", "half", F.coalesce(bound, F.lit(-2.0)).cast("float").alias("bound")
    )
    own = graph.select(
        F.col("u").alias("pivot"), F.col("v").alias("member"), F.lit(-1).cast("bigint").alias("mark"), "new"
    )
    number = F.xxhash64("u", "v", F.lit(round_number)).bitwiseAND(F.lit((1 << 62) - 1))
    back = graph.select(F.col("v").alias("pivot"), F.col("u").alias("member"), number.alias("mark"), "new")
    members = own.union(back).join(known, F.col("member") == F.col("node"))
    dealt = members.select("pivot", "member", "mark", "bound", "new", "half").repartition(parts, "pivot")
    closer = dealt.mapInArrow(_local_join(plan.neighbours), _EDGES)
    return _shortened(graph.withColumn("new", F.lit(False)).union(closer), plan)


def neighbour_graph(nodes: DataFrame, plan: Plan, seed: int) -> DataFrame:
    """The lists (u, v, sim) of the nodes (node, grp, half) after the last round."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = nodes.select("node", "grp", "half").mapInArrow(
        _signed(plan.tables, seed), "node bigint, grp string, half binary, signatures array<bigint>"
    )
    rows = signed.select("node", "grp", "half", F.posexplode("signatures").alias("t", "signature"))
    order = ["t", "grp", "signature", "node"]
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    start = sorted_rows.select("node", "t", "grp", "half").mapInArrow(_started, _EDGES)
    graph = _shortened(start, plan)
    n_nodes = nodes.count()
    for round_number in range(ROUNDS):
        graph = _refined(graph, nodes, plan, round_number)
        if graph.where("new").count() <= SETTLED * plan.neighbours * n_nodes:
            break
    return graph


def _checked(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = batch.column(2).to_pylist()
            b = batch.column(3).to_pylist()
            near = np.array(
                [
                    float(np.frombuffer(x) @ np.frombuffer(y)) >= threshold
                    for x, y in zip(a, b, strict=True)
                ],
                dtype=bool,
            )
            keep = pa.array(near)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"]
            )

    return run


def _exact(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose cosine reaches the threshold in double precision."""
    one = nodes.select(F.col("node").alias("u"), F.col("full").alias("a"))
    two = nodes.select(F.col("node").alias("v"), F.col("full").alias("b"))
    met = pairs.join(one, "u").join(two, "v").select("u", "v", "a", "b")
    return written(met.mapInArrow(_checked(threshold), "u bigint, v bigint"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes in runs of up to BLOCK rows of one group and cluster, by which rows come sorted, full
    nodes first. A run with full nodes has their centre, and the widest angle from it to one."""

    def block(group: str, rows: list[tuple], number: int) -> tuple:
        root, node, weight = (np.array([r[i] for r in rows], "<i8") for i in range(3))
        is_full = np.array([r[3] for r in rows], bool)
        raw = b"".join(r[4] for r in rows)
        centre = radius = None
        if is_full.any():
            x = np.frombuffer(raw).reshape(len(rows), -1)[is_full]
            mean = x.mean(axis=0)
            size = np.linalg.norm(mean)
            centre = mean / size if size > 1e-6 else x[0]
            radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
            centre = centre.tobytes()
        return group, number, root.tobytes(), node.tobytes(), weight.tobytes(), is_full.tobytes(), raw, centre, radius

    names = ["grp", "number", *_BLOCK, "centre", "radius"]
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 6, pa.float64()]
    now, rows, made = None, [], []

    from pyspark import TaskContext

    task = TaskContext.get().partitionId() << 40
    count = 0

    def out() -> pa.RecordBatch:
        columns = [pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for group, cluster, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows and ((group, cluster) != now or len(rows) == BLOCK):
                made.append(block(now[0], rows, task + count))
                rows, count = [], count + 1
            now = group, cluster
            rows.append(tuple(row))
        if len(made) > 20:
            yield out()
            made = []
    if rows:
        made.append(block(now[0], rows, task + count))
    if made:
        yield out()


def _within_reach(centres: list[tuple[str, int, bytes, float]], threshold: float):
    """The pairs of a block and a block of `centres` that may hold a link with a full node.

    If x links with a node of a block, the angle from x to the block's centre is at most the
    block's radius and the angle of the threshold together; other rows are out of reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = np.arccos(np.clip(threshold, -1, 1)) + 1e-6
        by_group: dict[str, list[int]] = {}
        for i, c in enumerate(centres):
            by_group.setdefault(c[0], []).append(i)
        sides = {}
        for group, at in by_group.items():
            angles = np.array([centres[i][3] for i in at]) + reach
            least = np.where(angles < np.pi, np.cos(np.minimum(angles, np.pi)) - 1e-9, -np.inf)
            number = np.array([centres[i][1] for i in at], np.int64)
            sides[group] = number, _matrix([centres[i][2] for i in at], "<f8", np.float64), least
        for batch in batches:
            for group, number, vectors in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if group not in sides:
                    continue
                others, x, least = sides[group]
                y = np.frombuffer(vectors).reshape(-1, x.shape[1])
                met = np.concatenate(
                    [(x[k : k + 1024] @ y.T >= least[k : k + 1024, None]).any(axis=1) for k in range(0, len(x), 1024)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.minimum(others[met], number), pa.int64()),
                        pa.array(np.maximum(others[met], number), pa.int64()),
                    ],
                    ["number1", "number2"],
                )

    return run


def _block_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """The pairs (number1, number2) of blocks to compare. The centres are sent to the tasks in
    portions of CENTRE_BYTES."""
    full = blocks.where("centre is not null")
    portions = 1 + (full.agg(F.sum(F.length("centre"))).first()[0] or 0) // CENTRE_BYTES
    portion = F.pmod(F.xxhash64("number"), F.lit(portions))
    pairs = None
    for k in range(portions):
        rows = full.where(portion == k).select("grp", "number", "centre", "radius").collect()
        centres = [(r[0], r[1], bytes(r[2]), r[3]) for r in rows]
        found = written(
            blocks.select("grp", "number", "vectors").mapInArrow(
                _within_reach(centres, threshold), "number1 bigint, number2 bigint"
            )
        )
        pairs = found if pairs is None else pairs.union(found)
    return written(pairs.distinct())


def _with_block(pairs: DataFrame, blocks: DataFrame, side: int) -> DataFrame:
    """`pairs` with the columns of the block of one side; a block that stands in many pairs is
    copied for every PAIRS of them."""
    number = f"number{side}"
    salts = F.ceil(F.count("*") / F.lit(PAIRS)).cast("int").alias("salts")
    uses = written(pairs.groupBy(number).agg(salts))
    salted = pairs.join(uses, number).withColumn("salt", F.pmod(F.xxhash64("number1", "number2"), "salts").cast("int"))
    columns = [F.col(c).alias(f"{c}{side}") for c in _BLOCK]
    copies = blocks.select(F.col("number").alias(number), *columns).join(uses, number)
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return salted.drop("salts").join(copies, [number, "salt"]).drop("salt")


def _counted(threshold: float):
    """For two blocks of one group: how many rows each node links with, where one is full; and
    the components (node, other) that such links join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n1, n2, root1, node1, w1, f1, x1, root2, node2, w2, f2, x2 in zip(
                *[c.to_pylist() for c in batch.columns], strict=True
            ):
                a, b = np.frombuffer(node1, "<i8"), np.frombuffer(node2, "<i8")
                wa, wb = np.frombuffer(w1, "<i8"), np.frombuffer(w2, "<i8")
                fa, fb = np.frombuffer(f1, bool), np.frombuffer(f2, bool)
                ra, rb = np.frombuffer(root1, "<i8"), np.frombuffer(root2, "<i8")
                xa = np.frombuffer(x1).reshape(len(a), -1)
                xb = np.frombuffer(x2).reshape(len(b), -1)
                near = (xa @ xb.T >= threshold) & (fa[:, None] | fb[None, :])
                if n1 == n2:
                    near = near & (a[:, None] != b[None, :])
                    node, links = a, near @ wb
                    classes = near.sum(axis=1)
                else:
                    node = np.concatenate((a, b))
                    links = np.concatenate((near @ wb, near.T @ wa))
                    classes = np.concatenate((near.sum(axis=1), near.sum(axis=0)))
                some = classes > 0
                n = int(some.sum())
                i, j = np.nonzero(near & (ra[:, None] != rb[None, :]))
                joined = np.unique(np.stack((ra[i], rb[j]), axis=1), axis=0)
                none = np.zeros(len(joined), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((node[some], joined[:, 0])), pa.int64()),
                        pa.array(np.concatenate((links[some], none)), pa.int64()),
                        pa.array(np.concatenate((classes[some], none)), pa.int64()),
                        pa.array(np.concatenate((node[some], joined[:, 1])), pa.int64(), mask=np.arange(n + len(joined)) < n),
                    ],
                    ["node", "links", "classes", "other"],
                )

    return run


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few rows, for rows that hold whole blocks."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, 32)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def _dense_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, classes) over all pairs in a group of which one node is full, and rows with
    `other` for two components that such a pair joins.

    `members` are all nodes of the groups that hold a full one.
    """
    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["grp", "cluster", "whole", "root", "node"]
    ranged = members.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ddl = f"grp string, number bigint, {', '.join(f'{c} binary' for c in _BLOCK)}, centre binary, radius double"
    blocks = written(
        ranged.select("grp", "cluster", "root", "node", "n", "is_full", "full").mapInArrow(_blocks, ddl)
    )
    with _few_rows(spark):
        pairs = _block_pairs(blocks, threshold)
        met = _with_block(_with_block(pairs, blocks, 1), blocks, 2)
        columns = [f"{c}{i}" for i in (1, 2) for c in _BLOCK]
        return written(
            met.select("number1", "number2", *columns).mapInArrow(
                _counted(threshold), "node bigint, links bigint, classes bigint, other bigint"
            )
        )


def _audited(queries: list[tuple[int, str, bytes]], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array([q[0] for q in queries])
        groups: dict[str, list[int]] = {}
        for i, q in enumerate(queries):
            groups.setdefault(q[1], []).append(i)
        sides = {g: (ids[at], _matrix([queries[i][2] for i in at], "<f8", np.float64)) for g, at in groups.items()}
        found = dict.fromkeys(ids.tolist(), 0)
        for batch in batches:
            node, group, full = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())
            by_group: dict[str, list[int]] = {}
            for i, g in enumerate(group):
                if g in sides:
                    by_group.setdefault(g, []).append(i)
            for g, at in by_group.items():
                y = _matrix([full[i] for i in at], "<f8", np.float64)
                others = np.array([node[i] for i in at])[None, :]
                for k in range(0, len(sides[g][0]), 1024):
                    q, x = (side[k : k + 1024] for side in sides[g])
                    near = x @ y.T >= threshold
                    near &= q[:, None] != others
                    for one, n in zip(q.tolist(), near.sum(axis=1).tolist(), strict=True):
                        found[one] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
            ["node", "truth"],
        )

    return run


def _drawn(column: str, purpose: str):
    return F.xxhash64(column, F.lit(purpose))


def probes_of(nodes: DataFrame, threshold: float) -> DataFrame:
    """Probes beside the nodes: PROBES nodes, drawn by a hash, each turned in a random direction. The
    probe of the node number k has the number -1 - k. It stands for no row."""
    drawn = nodes.where(F.length("full") > 8).orderBy(_drawn("node", "probe")).limit(PROBES)
    rows = []
    for r in drawn.select("node", "grp", "full").collect():
        unit = np.frombuffer(bytes(r["full"]))
        rng = np.random.default_rng([7, r["node"] & 0xFFFFFFFF, r["node"] >> 32])
        side = rng.standard_normal(len(unit))
        side -= (side @ unit) * unit
        cosine = min(1.0, threshold + PROBE_RANGE * (0.05 + 0.95 * rng.random()))
        turned = cosine * unit + np.sqrt(1 - cosine * cosine) * side / np.linalg.norm(side)
        half = turned.astype("<f2").tobytes()
        rows.append((-1 - r["node"], r["grp"], bytearray(turned.tobytes()), bytearray(half)))
    return nodes.sparkSession.createDataFrame(rows, "node bigint, grp string, full binary, half binary")


def _recall(nodes: DataFrame, result: DataFrame, threshold: float, met: tuple[int, int]) -> float:
    """The lesser of two shares of links that were found: those of full nodes, which have many each,
    and those of all others together with the probes, of which `met` has how many were found and
    how many there are. Found links are true ones.

    AUDIT_NODES nodes of each kind are compared with every node, in one pass.
    """
    kinds = [result.where("is_full"), result.where("not is_full")]
    keys = [k.orderBy(_drawn("node", "audit")).limit(AUDIT_NODES).select("node", "classes", "is_full") for k in kinds]
    sample = nodes.join(F.broadcast(keys[0].union(keys[1])), "node").select("node", "grp", "full", "classes", "is_full").collect()
    queries = [(r["node"], r["grp"], bytes(r["full"])) for r in sample]
    truth = nodes.select("node", "grp", "full").mapInArrow(
        _audited(queries, threshold), "node bigint, truth bigint"
    )
    true = dict(truth.groupBy("node").agg(F.sum("truth")).collect()) if queries else {}
    shares = []
    for is_full, (found, there) in ((True, (0, 0)), (False, met)):
        of = [r for r in sample if r["is_full"] == is_full]
        found += sum(r["classes"] for r in of)
        there += sum(true[r["node"]] for r in of)
        shares.append(found / there if there else 1.0)
    return min(shares)


def _searched(
    nodes: DataFrame, probes: DataFrame, plan: Plan, seed: int
) -> tuple[DataFrame, DataFrame, tuple[int, int]]:
    """The links (u, v) that the lists hold, (node, n, root, is_full) of each node: its component
    along these links, and whether its list has no room left above the threshold, and how many
    probes were found, of how many. A probe whose list, or whose node's, is full counts as found: the
    exact way would meet it."""
    columns = ["node", "grp", "full", "half"]
    both = nodes.select(columns).union(probes.select(columns))
    graph = neighbour_graph(both, plan, seed)
    likely = graph.where(F.col("sim") >= plan.threshold - MARGIN)
    pairs = likely.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    found = _exact(pairs, both, plan.threshold)
    links = found.where("u >= 0 and v >= 0")
    full = written(
        likely.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= plan.grown).select(F.col("u").alias("f"))
    )
    asked = probes.select(F.col("node").alias("probe"), (-1 - F.col("node")).alias("base"))
    met = found.where("u < 0 and v = -1 - u").select(F.col("u").alias("probe"))
    sides = asked.selectExpr("probe", "probe as f").union(asked.selectExpr("probe", "base as f"))
    n_met = met.union(full.join(F.broadcast(sides), "f").select("probe")).distinct().count()
    roots = written(components(links))
    lists = nodes.select("node", "n").join(roots, F.col("node") == F.col("id"), "left").join(
        full, F.col("node") == F.col("f"), "left"
    )
    known = lists.select(
        "node", "n", F.coalesce("component", "node").alias("root"), F.col("f").isNotNull().alias("is_full")
    )
    return links, written(known), (n_met, probes.count())


def _node_links(nodes: DataFrame, links: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(node, links, classes, root, is_full): rows and nodes that each node links with, and its
    component. Full nodes are compared with all nodes of their group."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sizes = written(known.groupBy("root").agg(F.count("*").alias("n_root"), F.max("is_full").alias("dense")))
    clusters = sizes.where(F.col("dense") & (F.col("n_root") >= CLUSTER)).select("root", "n_root", F.col("root").alias("cluster"))
    placed = join_hot(known, written(clusters), "root", ["cluster"], "n_root", ["node"])
    at = placed.join(nodes.select("node", "grp", "full"), "node")
    dense = known.where("is_full").join(nodes.select("node", "grp"), "node").select("grp").distinct()
    members = at.join(dense, "grp").withColumn("whole", ~F.col("is_full"))
    found = _dense_links(members, threshold)
    light = known.select("node", "n", "is_full")
    sparse = (
        both.join(light.select(F.col("node").alias("u"), F.col("is_full").alias("fu")), "u")
        .join(light.select(F.col("node").alias("v"), "n", F.col("is_full").alias("fv")), "v")
        .where("not fu and not fv")
        .select(F.col("u").alias("node"), F.col("n").alias("links"), F.lit(1).cast("bigint").alias("classes"))
    )
    in_dense = found.where("other is null").select("node", "links", "classes")
    sums = sparse.union(in_dense).groupBy("node").agg(
        F.sum("links").alias("links"), F.sum("classes").alias("classes")
    )
    joined = written(components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v"))))
    joined = joined.join(sizes, F.col("id") == F.col("root")).select("root", "n_root", "component")
    rooted = join_hot(known, written(joined), "root", ["component"], "n_root", ["node"])
    root = F.coalesce("component", "root").alias("root")
    out = rooted.select("node", root, "is_full").join(sums, "node", "left")
    return written(out.na.fill(0, ["links", "classes"]))


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors are compared if their labels are equal and not null and they have as many components.
    Those that are null, empty, zero, or hold null or non-finite components link with nothing, and
    so do those without a label: n_links 0, component_id their own id. Equal vectors are one node
    that counts as many times as it stands there. Ids may repeat; the component_id is the smallest
    that can be reached. A row without an id is never kept. Other columns are ignored.
    """
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    ddl = "vec_id bigint, key binary, grp string, full binary, half binary"
    prepared = written(rows.mapInArrow(_prepared, ddl))
    counted = prepared.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"),
        F.count("*").alias("n"),
        F.first("grp").alias("grp"),
        F.first("full").alias("full"),
        F.first("half").alias("half"),
    )
    nodes = written(counted.withColumn("node", F.monotonically_increasing_id()))
    probes = probes_of(nodes, threshold)
    plan = Plan(threshold)
    for attempt in range(ATTEMPTS):
        links, known, met = _searched(nodes, probes, plan, attempt)
        found = _node_links(nodes, links, known, threshold)
        if _recall(nodes, found, threshold, met) >= MIN_RECALL:
            break
        plan = Plan(threshold, 2 * plan.neighbours, 2 * plan.grown, 2 * plan.tables)
    else:
        # no search was good enough: compare all nodes of each group, in blocks
        found = _node_links(nodes, links, known.withColumn("is_full", F.lit(True)), threshold)
    roots = found.join(nodes.select("node", "least"), "node").groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("n_root")
    )
    rooted = join_hot(found, written(roots), "root", ["component_id"], "n_root", ["node"])
    classes = written(
        nodes.select("node", "key", "n").join(rooted.select("node", "links", "component_id"), "node")
    )
    out = join_hot(prepared.select("vec_id", "key"), classes.withColumn("own", F.col("n")), "key", ["links", "own", "component_id"], "n", ["vec_id"])
    is_node = F.col("key").isNotNull()
    component = F.when(is_node, F.col("component_id")).otherwise(F.col("vec_id"))
    links = F.when(is_node, F.col("links") + F.col("own") - 1).otherwise(F.lit(0))
    return out.select(
        "vec_id",
        links.cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
