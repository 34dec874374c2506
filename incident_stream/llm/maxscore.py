"""Exact top-k search by inner product with MaxScore.

The terms of a query are its dimensions; the postings of a term are the column of that dimension in
a shard of the index, with its least and greatest weight. Embeddings are dense, so a column holds
every row of the shard; a row in which it is zero adds nothing, as if it were not listed.

For each query and shard, terms are sorted by how much they can add at most. The largest number of
weak terms that together stay below the query's threshold, its k-th best score so far, is
non-essential: no row can get into the result by these alone. The other, essential, columns are
multiplied and added for all rows; of the rows that can still reach the threshold the non-essential
terms are probed, strongest first, as long as the row stays competitive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_stream.llm.common import written
from incident_stream.llm.ranking import Best, sortable
from incident_stream.llm.vectors import EXACT, doubles, integers, listed, packed, unpacked, usable

SHARD_ROWS = 2048
BLOCK_ROWS = 256
GROUP_ROWS = 1 << 18
CELL_QUERIES = 1 << 14
SEED_SHARDS = 4
PROBES = 8

_BLOCKS = (
    "kind int, number bigint, place bigint, ids array<bigint>, rows array<bigint>, cells binary"
)


def _blocks(scale: int, shard_rows: int, block_rows: int):
    """Shards of the index (kind 1) and, of the rows that are queries, blocks (kind 0)."""

    def block(kind: int, number: int, part: int, parts: list) -> pa.RecordBatch:
        ids = pa.concat_arrays([p[0] for p in parts])
        rows = np.concatenate([p[1] for p in parts])
        width = max(p[2].shape[1] for p in parts)
        cells = [np.pad(p[2], ((0, 0), (0, width - p[2].shape[1]))) for p in parts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([kind], pa.int32()),
                pa.array([(part << 32) + number], pa.int64()),
                # the first shards of all partitions are dealt to the groups in turn
                pa.array([part + number], pa.int64()),
                listed(ids),
                listed(pa.array(rows)),
                pa.array([packed(np.concatenate(cells))], pa.binary()),
            ],
            ["kind", "number", "place", "ids", "rows", "cells"],
        )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting: dict[int, list] = {0: [], 1: []}
        limits, numbers, seen = {0: block_rows, 1: shard_rows}, {0: 0, 1: 0}, 0
        for batch in batches:
            ids, n = batch.column(0), batch.num_rows
            cells = integers(batch.column(1), scale)
            rows = np.arange(seen, seen + n, dtype=np.int64) + (part << 40)
            seen += n
            asked = np.flatnonzero(np.asarray(batch.column(2)))
            for kind, chosen in ((1, np.arange(n)), (0, asked)):
                while len(chosen):
                    free = limits[kind] - sum(len(p[1]) for p in waiting[kind])
                    now, chosen = chosen[:free], chosen[free:]
                    waiting[kind].append((ids.take(pa.array(now)), rows[now], cells[now]))
                    if len(now) == free:
                        yield block(kind, numbers[kind], part, waiting[kind])
                        numbers[kind] += 1
                        waiting[kind] = []
        for kind, parts in waiting.items():
            if parts:
                yield block(kind, numbers[kind], part, parts)

    return make


class _Queries:
    """A block of queries with the best rows of each so far."""

    def __init__(self, row: dict, k: int) -> None:
        self.k, self.number = k, row["number"]
        self.ids = pa.array(row["ids"], pa.int64())
        self.rows = np.asarray(row["rows"], dtype=np.int64)
        self.weights = unpacked(row["cells"], len(self.rows))
        known = row.get("floors")
        # the k-th best score seen elsewhere: at least k other rows reach it
        floor = np.full(len(self.rows), -np.inf) if known is None else np.array(known, np.float64)
        self.best = Best(k, floor)

    @property
    def floor(self) -> np.ndarray:
        return self.best.floor


def _candidates(
    queries: _Queries, columns: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of every pair that can still get into a result, by MaxScore."""
    width = min(queries.weights.shape[1], columns.shape[0])
    weights, columns = queries.weights[:, :width], columns[:width]
    n_queries, n = len(weights), columns.shape[1]
    most = int(np.abs(weights).max(initial=0)) * int(np.abs(columns).max(initial=0)) * max(1, width)
    if most >= EXACT:
        return _exactly(queries, weights, columns, rows)
    weights, columns = weights.astype(np.float64), columns.astype(np.float64)
    least, greatest = columns.min(axis=1), columns.max(axis=1)
    bound = np.maximum(np.maximum(weights * greatest, weights * least), 0)
    order = np.argsort(bound, axis=1, kind="stable")
    rising = np.take_along_axis(bound, order, axis=1)
    total = np.cumsum(rising, axis=1)
    n_weak = (total < queries.floor[:, None]).sum(axis=1)
    padded = np.concatenate([np.zeros((n_queries, 1)), total], axis=1)
    rest = padded[np.arange(n_queries), n_weak]
    weak = np.zeros_like(bound, dtype=bool)
    np.put_along_axis(weak, order, np.arange(width) < n_weak[:, None], axis=1)

    score = np.where(weak, 0, weights) @ columns
    own = queries.rows[:, None] == rows[None, :]
    score[own] = -np.inf
    floor = queries.floor
    full = np.flatnonzero(n_weak == 0)
    if len(full) and n > queries.k:
        # all terms were essential, so these are whole scores, and k rows reach the k-th of them
        kth = np.partition(score[full], n - queries.k, axis=1)[:, n - queries.k]
        floor = floor.copy()
        floor[full] = np.maximum(floor[full], kth)
    of, at = np.nonzero(score + rest[:, None] >= floor[:, None])
    found = score[of, at]
    alive = np.isfinite(found)
    of, at, found = of[alive], at[alive], found[alive]

    left = n_weak
    while len(of) and (left > 0).any():
        places = left[:, None] - 1 - np.arange(min(PROBES, width))
        real = places >= 0
        terms = np.take_along_axis(order, np.maximum(places, 0), axis=1)
        probed = np.where(real, np.take_along_axis(weights, terms, axis=1), 0)
        left_rest = padded[np.arange(n_queries), np.maximum(left - PROBES, 0)]
        left = np.maximum(left - PROBES, 0)
        for lo in range(0, len(of), 1 << 16):
            here = slice(lo, lo + (1 << 16))
            found[here] += (probed[of[here]] * columns[terms[of[here]], at[here, None]]).sum(axis=1)
        alive = found + left_rest[of] >= floor[of]
        of, at, found = of[alive], at[alive], found[alive]
    return of, at, found.astype(np.int64)


def _exactly(queries: _Queries, weights, columns, rows):
    """The same for numbers beyond what doubles hold: all terms essential, in Python's integers. A
    score beyond 64 bits counts as the nearest number that has 64."""
    score = weights.astype(object) @ columns.astype(object)
    limits = np.iinfo(np.int64)
    score = np.clip(score, limits.min, limits.max).astype(np.int64)
    of, at = np.nonzero(queries.rows[:, None] != rows[None, :])
    return of, at, score[of, at]


def _searched(k: int, seed: bool):
    """Searches the shards of each cell for the queries of the cell, which come before them.

    Gives the best k rows of each query in the cell, or, for a seed, each block's thresholds."""

    def results(blocks: list[_Queries]) -> Iterator[pa.RecordBatch]:
        for q in blocks:
            if seed:
                floors = pa.array(q.floor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q.number], pa.int64()), listed(floors)], ["number", "floors"]
                )
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q.rows[q.best.of]),
                    q.ids.take(pa.array(q.best.of)),
                    q.best.ids(),
                    pa.array(q.best.score),
                ],
                ["query_row", "query_id", "vec_id", "score"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    yield from results(blocks)
                    cell, blocks = row["cell"], []
                if row["kind"] == 0:
                    blocks.append(_Queries(row, k))
                    continue
                id, null = sortable(pa.array(row["ids"], pa.int64()))
                rows = np.asarray(row["rows"], dtype=np.int64)
                columns = np.ascontiguousarray(unpacked(row["cells"], len(rows)).T)
                for q in blocks:
                    of, at, score = _candidates(q, columns, rows)
                    if len(of):
                        q.best.add(of, score, id[at], null[at])
        yield from results(blocks)

    return search


def _cells(queries: DataFrame, shards: DataFrame, parts: int, groups: int) -> DataFrame:
    """Every part of the queries meets every group of shards in one cell, its queries first."""
    part = F.pmod("place", F.lit(parts))
    group = F.pmod("place", F.lit(groups))
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    asked = queries.withColumn("group", each_group).withColumn("cell", part * groups + F.col("group"))
    met = shards.withColumn("part", each_part).withColumn("cell", F.col("part") * groups + group)
    none = F.lit(None).cast("array<double>").alias("floors")
    names = ["cell", "kind", "number", "ids", "rows", "cells"]
    floors = "floors" if "floors" in queries.columns else none
    both = asked.select(*names, floors).union(met.select(*names, none))
    spread = both.repartitionById(parts * groups, F.col("cell").cast("int"))
    return spread.sortWithinPartitions("cell", "kind", "number")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """For each row that is a query: its k best other rows by inner product of the integer vectors
    floor(scale * x), as (query_id, rank, vec_id, score), equal scores by ascending vec_id.

    The index is cut into shards and the shards into groups; the queries are cut into parts. Each
    part meets each group in one task, which reads the shards one after the other, so a task holds
    at most CELL_QUERIES queries and a shard. A first pass over a few shards gives each query a
    threshold to start from, and the results of the groups are merged by a window per query, which
    receives k rows from each group at most. Nothing is collected or broadcast.

    A vector that is null or holds a null, a component that is not finite, or one whose integer
    has more than 61 bits takes no part; missing components of a shorter vector count as zero.
    Repeated rows are rows of their own: each is a candidate, and each that is a query has its own
    ranks. A null id is no query unless `is_query` says so; as a candidate it comes after all others
    of its score. Fewer candidates than k give fewer rows; an empty table gives none. Scores beyond
    64 bits count as the nearest number of 64 bits. Other columns are not read.
    """
    chosen = vectors.where(usable(F.col(vector_column), scale)).select(
        F.col(id_column).cast("bigint").alias("id"),
        doubles(F.col(vector_column)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    blocks = written(chosen.mapInArrow(_blocks(scale, SHARD_ROWS, BLOCK_ROWS), _BLOCKS))
    queries, shards = blocks.where("kind = 0"), blocks.where("kind = 1")
    held = {r[0]: (r[1], r[2]) for r in blocks.groupBy("kind").agg(F.count("*"), F.sum(F.size("rows"))).collect()}
    n_shards, n_rows = held.get(1, (0, 0))
    n_queries = held.get(0, (0, 0))[1]
    wanted = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-n_queries // CELL_QUERIES))
    groups = max(1, -(-n_rows // GROUP_ROWS), min(wanted, n_shards))

    first = shards.orderBy("place", "number").limit(SEED_SHARDS)
    seed = _cells(queries, first, max(1, min(wanted, held.get(0, (0, 0))[0])), 1)
    floors = seed.drop("floors").mapInArrow(_searched(k, True), "number bigint, floors array<double>")
    started = written(queries.join(floors, "number"))

    met = _cells(started, shards, parts, groups)
    ddl = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
    found = met.mapInArrow(_searched(k, False), ddl)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
