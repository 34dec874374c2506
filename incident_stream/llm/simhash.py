"""SimHash near-duplicates over a Gray-order hierarchical index.

Two fingerprints within 3 of 64 bits agree in at least one of four 16-bit segments. The distinct
fingerprints are therefore put in four times, each time rotated so that another segment leads,
and each copy is sorted by Gray rank. Rows that share the leading segment form an upper node: a
masked bit pattern. Below it a node splits into halves in Gray order, in which neighbours share
most bits; a node keeps the mask of the bits that all its rows share. The search walks down pairs
of nodes and adds up the differences in the bits that both sides have fixed: over 3, the pair of
groups is pruned whole; if no pair of rows can differ in more than 3, the groups are linked whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm.common import Forest, components, free_name, join_hot, written
from incident_stream.llm.textkernel import bytes_of

SHINGLE = 3
DISTANCE = 3
SEED = 42
SEGMENTS = 4
LEAF = 128
BLOCK = 4096
_SIGN = -(1 << 63)


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the hashes of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)))
    n = len(shingles)
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n
    )
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 1 << 15):
        raw = hashes[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = bytes_of(batch.column(2))
        found = np.fromiter(
            (
                fingerprint_of(raw[offsets[i] : offsets[i + 1]].tobytes())
                for i in range(batch.num_rows)
            ),
            dtype=np.uint64,
            count=batch.num_rows,
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
            ["doc_id", "text_hash", "fp"],
        )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint of every whole text, as a signed 64-bit number, and
    a hash of the text, which tells rows with equal ids apart."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column),
    )
    return rows.mapInArrow(_fingerprinted, "doc_id bigint, text_hash bigint, fp bigint")


class _Node:
    """A run of rows in Gray order: the bits that all of them share, and what they are."""

    __slots__ = ("hi", "lo", "mask", "pattern")

    def __init__(self, rows: np.ndarray, lo: int, hi: int) -> None:
        part = rows[lo:hi]
        ones, any_one = np.bitwise_and.reduce(part), np.bitwise_or.reduce(part)
        self.lo, self.hi = lo, hi
        self.mask = ~(ones ^ any_one)
        self.pattern = ones & self.mask


class _Index:
    """The nodes over one sorted block, made when the search first comes to them."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.nodes: dict[tuple[int, int], _Node] = {}

    def node(self, lo: int, hi: int) -> _Node:
        found = self.nodes.get((lo, hi))
        if found is None:
            found = self.nodes[lo, hi] = _Node(self.rows, lo, hi)
        return found

    def halves(self, node: _Node) -> list[_Node]:
        if node.hi - node.lo <= LEAF:
            return [node]
        middle = (node.lo + node.hi) // 2
        return [self.node(node.lo, middle), self.node(middle, node.hi)]


def _bits(x: np.uint64) -> int:
    return int(x).bit_count()


def search(a: _Index, b: _Index, distance: int, forest: Forest) -> None:
    """Join in `forest` whatever rows of `a` and `b` (the same object: within it) are linked."""
    same = a is b
    todo = [(a.node(0, len(a.rows)), b.node(0, len(b.rows)))]
    while todo:
        x, y = todo.pop()
        fixed = x.mask & y.mask
        apart = _bits((x.pattern ^ y.pattern) & fixed)
        if apart > distance:
            continue
        if apart + _bits(~fixed) <= distance:
            first = int(a.rows[x.lo])
            for row in (*a.rows[x.lo : x.hi].tolist(), *b.rows[y.lo : y.hi].tolist()):
                forest.join(first, row)
            continue
        left, right = a.halves(x), b.halves(y)
        if len(left) == 1 and len(right) == 1:
            p, q = a.rows[x.lo : x.hi], b.rows[y.lo : y.hi]
            i, j = np.nonzero(np.bitwise_count(p[:, None] ^ q[None, :]) <= distance)
            if same and x.lo == y.lo:
                i, j = i[i < j], j[i < j]
            for u, v in zip(p[i].tolist(), q[j].tolist(), strict=True):
                forest.join(u, v)
            continue
        for s in left:
            for t in right:
                if not same or s.lo <= t.lo:
                    todo.append((s, t))


def _turned(word: np.ndarray, by: np.ndarray | int) -> np.ndarray:
    """Rotated left by `by` bits."""
    by = np.asarray(by, dtype=np.uint64) & np.uint64(63)
    return (word << by) | (word >> ((np.uint64(64) - by) & np.uint64(63)))


_LINKS = "u bigint, v bigint, seg int, lead int, block bigint, mask bigint, pattern bigint, rows binary"


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def _link_batch(pairs: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    n = len(pairs[0])
    nothing = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.binary())]
    names = ["u", "v", "seg", "lead", "block", "mask", "pattern", "rows"]
    return pa.RecordBatch.from_arrays([_signed(pairs[0]), _signed(pairs[1]), *nothing], names)


def _forest_pairs(forest: Forest, seg: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of a forest, turned back to the fingerprints themselves."""
    child = np.array(list(forest.parent), dtype=np.uint64)
    up = np.array([forest.find(x) for x in forest.parent], dtype=np.uint64)
    back = 64 - 16 * seg
    return _turned(child[child != up], back), _turned(up[child != up], back)


def _search_partition(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64)) for b in batches
        ]
        seg = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int32)
        if len(seg) == 0:
            return
        word = np.concatenate([f[1] for f in found])
        lead = (word >> np.uint64(48)).astype(np.int64) + seg.astype(np.int64) * (1 << 16)
        starts = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])))
        ends = np.concatenate((starts[1:], [len(lead)]))
        sizes = ends - starts
        large = sizes > LEAF
        # small nodes: each row against the rows after it, all nodes of the partition at once
        limit = np.repeat(np.where(large, 0, ends), sizes)
        at = np.arange(len(word))
        step = 1
        while True:
            left = at[at + step < limit]
            if len(left) == 0:
                break
            near = np.bitwise_count(word[left] ^ word[left + step]) <= distance
            one, other = left[near], left[near] + step
            if len(one):
                back = 64 - 16 * seg[one].astype(np.int64)
                yield _link_batch((_turned(word[one], back), _turned(word[other], back)))
            step += 1
        task = TaskContext.get().partitionId() << 32
        for k in np.flatnonzero(large | (starts == 0) | (ends == len(lead))):
            rows, of = word[starts[k] : ends[k]], int(seg[starts[k]])
            blocks = [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
            if large[k]:
                for block in blocks:
                    forest = Forest()
                    index = _Index(block)
                    search(index, index, distance, forest)
                    if forest.parent:
                        yield _link_batch(_forest_pairs(forest, of))
            if len(blocks) > 1 or starts[k] == 0 or ends[k] == len(lead):
                nodes = [_Node(b, 0, len(b)) for b in blocks]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, pa.int64()),
                        pa.nulls(n, pa.int64()),
                        pa.array([of] * n, pa.int32()),
                        pa.array([int(lead[starts[k]]) & 0xFFFF] * n, pa.int32()),
                        pa.array([task + int(starts[k]) + i * BLOCK for i in range(n)], pa.int64()),
                        _signed([x.mask for x in nodes]),
                        _signed([x.pattern for x in nodes]),
                        pa.array([b.tobytes() for b in blocks], pa.binary()),
                    ],
                    ["u", "v", "seg", "lead", "block", "mask", "pattern", "rows"],
                )

    return run


def _search_pairs(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg, one, other in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                forest = Forest()
                a = _Index(np.frombuffer(one, dtype=np.uint64))
                search(a, _Index(np.frombuffer(other, dtype=np.uint64)), distance, forest)
                u, v = _forest_pairs(forest, seg)
                yield pa.RecordBatch.from_arrays([_signed(u), _signed(v)], ["u", "v"])

    return run


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (u, v) that join exactly the fingerprints (column `fp`, each once) which lie within
    `distance` bits of each other, directly or through others; not every near pair is listed."""
    if distance >= SEGMENTS:
        raise ValueError(f"{SEGMENTS} segments find distances below {SEGMENTS} only")
    spark = distinct.sparkSession
    turned = [
        F.col("fp")
        if s == 0
        else F.shiftleft("fp", 16 * s).bitwiseOR(F.shiftrightunsigned("fp", 64 - 16 * s))
        for s in range(SEGMENTS)
    ]
    copies = distinct.select(
        F.posexplode(F.array(*turned)).alias("seg", "word")
    )
    rank = F.col("word")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    ranked = copies.withColumn("rank", rank.bitwiseXOR(F.lit(_SIGN)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ranked.repartitionByRange(parts, "seg", "rank").sortWithinPartitions("seg", "rank")
    found = written(ordered.select("seg", "word").mapInArrow(_search_partition(distance), _LINKS))
    blocks = found.where("rows is not null")
    one = blocks.select("seg", "lead", *[F.col(c).alias(f"{c}1") for c in ("block", "mask", "pattern", "rows")])
    two = blocks.select("seg", "lead", *[F.col(c).alias(f"{c}2") for c in ("block", "mask", "pattern", "rows")])
    differing = F.col("pattern1").bitwiseXOR(F.col("pattern2"))
    apart = F.bit_count(differing.bitwiseAND(F.col("mask1")).bitwiseAND(F.col("mask2")))
    pairs = one.join(two, ["seg", "lead"]).where(
        (F.col("block1") < F.col("block2")) & (apart <= distance)
    )
    across = pairs.select("seg", "rows1", "rows2").mapInArrow(
        _search_pairs(distance), "u bigint, v bigint"
    )
    return found.where("u is not null").select("u", "v").union(across)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    distance: int = DISTANCE,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row, and for `keep_one` a hash
    of its text and the number of its component.

    Words are split at ASCII white space after A-Z is lowered; a text with fewer words than a
    shingle has its whole word sequence as the only shingle, and one without words (null, empty)
    has fingerprint zero, linked like any other. Documents with equal fingerprints are one class,
    so copies never meet in a join; the index works on distinct fingerprints. component_id is the
    smallest id that can be reached; rows without an id count for no minimum, and a component of
    such rows only has none. Repeated rows stay repeated. Other columns are ignored.
    """
    marked = written(fingerprints(docs, id_column, text_column))
    distinct = written(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    )
    found = components(fingerprint_links(distinct, distance))
    rooted = written(
        distinct.join(found, distinct["fp"] == found["id"], "left").select(
            "fp", "least", "n", F.coalesce("component", "fp").alias("root")
        )
    )
    roots = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("n_root")
    )
    classes = written(
        join_hot(rooted, written(roots), "root", ["component_id"], "n_root", ["fp"]).select(
            "fp", "n", "component_id", "root"
        )
    )
    out = join_hot(marked, classes, "fp", ["component_id", "root"], "n", ["doc_id"])
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select("doc_id", hexed, "component_id", "text_hash", "root")


def keep_one(
    docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of `docs` without the near-duplicates that `found`, the result for them, names: of
    each component one row stays, whose id is its component_id. Among rows that share that id, or
    in a component without any id, it is one with the least hash of its text."""
    own, mark, times = (free_name(docs, c) for c in ("_keep", "_mark", "_times"))
    least = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(
        "root", F.col("doc_id").alias(own), "text_hash"
    ).agg(F.count("*").alias("n"))
    keepers = written(
        least.groupBy("root", own)
        .agg(F.min_by("n", "text_hash").alias(times), F.min("text_hash").alias(mark))
        .drop("root")
    )
    kept = docs.join(
        keepers,
        F.col(id_column).cast("bigint").eqNullSafe(F.col(own))
        & (F.xxhash64(text_column) == F.col(mark)),
    )
    single = kept.where(F.col(times) == 1).drop(own, mark, times)
    if keepers.where(F.col(times) > 1).isEmpty():
        return single
    again = kept.where(F.col(times) > 1).dropDuplicates([own, mark])
    return single.union(again.drop(own, mark, times))
