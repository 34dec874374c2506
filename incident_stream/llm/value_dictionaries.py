"""Vector code compression with a dictionary of values for each dimension.

Vectors of integers are cut into parts, and every part is replaced by the index of the nearest entry
of a codebook, which a fixed number of rounds of k-means fits.

The distinct integers of a dimension are few. Each block of rows is kept as a dictionary of them per
dimension and the code of every value. To compare a block with the entries of a codebook, the
squared differences of each distinct integer to all entries are tabulated once; the distances of all
rows are then rows of these tables, gathered by code and added up over the dimensions of the part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incident_stream.llm.common import join_hot, written
from incident_stream.llm.vectors import doubles, integers, listed, packed, unpacked, usable

BLOCK_ROWS = 4096
STEP_ROWS = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

_LONG = (1 << 63) - 1


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    """First and last dimension of each part; equal parts where the width allows it."""
    cuts = [i * width // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _encoded(scale: int, width: int, block_rows: int):
    """Blocks of rows: ids, labels, per dimension the distinct integers and the codes of the rows."""

    def block(parts: list) -> pa.RecordBatch:
        ids, labels = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
        cells = np.concatenate([p[2] for p in parts])
        values, codes = [], []
        for j in range(width):
            distinct, code = np.unique(cells[:, j], return_inverse=True)
            values.append(packed(distinct))
            codes.append(code.astype("<u2").tobytes())
        return pa.RecordBatch.from_arrays(
            [
                listed(ids),
                listed(labels),
                listed(pa.array(values, pa.binary())),
                listed(pa.array(codes, pa.binary())),
            ],
            ["ids", "labels", "dictionaries", "codes"],
        )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            cells = integers(batch.column(2), scale, width)
            lo = 0
            while lo < batch.num_rows:
                n = min(batch.num_rows - lo, block_rows - held)
                waiting.append((batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), cells[lo : lo + n]))
                lo, held = lo + n, held + n
                if held == block_rows:
                    yield block(waiting)
                    waiting, held = [], 0
        if waiting:
            yield block(waiting)

    return encode


class _Block:
    """A block as read back."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        self.ids, self.labels = (pa.concat_arrays([batch.column(c)[i].values]) for c in (0, 1))
        self.n = len(self.ids)
        self.dictionaries = [
            unpacked(d, 1)[0] for d in batch.column("dictionaries")[i].as_py()
        ]
        self.codes = [np.frombuffer(c, dtype="<u2") for c in batch.column("codes")[i].as_py()]

    def values(self, j: int) -> np.ndarray:
        return self.dictionaries[j][self.codes[j]]


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block(batch, i)


def _kind(dictionaries: list[np.ndarray], entries: np.ndarray):
    """The narrowest type that holds every distance of a part: 32 or 64 bits, or Python's integers."""
    far = max((int(np.abs(d).max(initial=0)) for d in dictionaries), default=0)
    far += int(np.abs(entries).max(initial=0))
    most = far * far * max(1, len(dictionaries))
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object


def nearest(block: _Block, lo: int, hi: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the dimensions lo to hi of every row: the number of the nearest entry, the lower one of
    equally near ones, and the squared distance to it."""
    dictionaries = block.dictionaries[lo:hi]
    kind = _kind(dictionaries, entries)
    tables = [
        (d.astype(kind)[:, None] - entries[None, :, j].astype(kind)) ** 2
        for j, d in enumerate(dictionaries)
    ]
    index = np.empty(block.n, dtype=np.int64)
    distance = np.empty(block.n, dtype=object if kind is object else np.int64)
    for at in range(0, block.n, STEP_ROWS):
        rows = slice(at, min(at + STEP_ROWS, block.n))
        total = np.zeros((rows.stop - at, len(entries)), dtype=kind)
        for table, codes in zip(tables, block.codes[lo:hi], strict=True):
            total += table[codes[rows]]
        index[rows] = total.argmin(axis=1)
        distance[rows] = np.take_along_axis(total, index[rows, None], axis=1)[:, 0]
    return index, distance


def _smallest(entries: int):
    """The rows of a task with the smallest ids, nulls last, equal ids by their integers."""

    def key(row):
        return (row[0] is None, row[0] or 0, row[1])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = []
        for block in _blocks_of(batches):
            ids = np.asarray(block.ids.fill_null(_LONG))
            null = np.asarray(block.ids.is_null())
            order = np.lexsort((ids, null))
            # all rows that share the last id: only their integers can tell them apart
            last = order[min(entries, block.n) - 1]
            chosen = (null < null[last]) | ((null == null[last]) & (ids <= ids[last]))
            numbers = np.empty((int(chosen.sum()), len(block.codes)), dtype=np.int64)
            for j in range(len(block.codes)):
                numbers[:, j] = block.values(j)[chosen]
            best += list(zip(block.ids.filter(pa.array(chosen)).to_pylist(), numbers.tolist(), strict=True))
            best = sorted(best, key=key)[:entries]
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[0] for b in best], pa.int64()), pa.array([b[1] for b in best], pa.list_(pa.int64()))],
                ["id", "numbers"],
            )

    return pick


def _sums(codebooks):
    """Number of rows and sum of their integers for each entry, over all blocks of a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.value
        width = sum(b.shape[1] for b in books)
        bounds = part_bounds(width, len(books))
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        high, low = ([np.zeros(b.shape, dtype=np.int64) for b in books] for _ in range(2))
        for block in _blocks_of(batches):
            for p, (lo, hi) in enumerate(bounds):
                index, _ = nearest(block, lo, hi, books[p])
                counts[p] += np.bincount(index, minlength=len(books[p]))
                for j in range(lo, hi):
                    # two halves, so that sums of any number of rows stay exact
                    value = block.values(j)
                    np.add.at(high[p][:, j - lo], index, value >> 32)
                    np.add.at(low[p][:, j - lo], index, value & 0xFFFFFFFF)
        for p, count in enumerate(counts):
            used = np.flatnonzero(count)
            if not len(used):
                continue
            total = [
                [Decimal((h << 32) + s) for h, s in zip(hs, ls, strict=True)]
                for hs, ls in zip(high[p][used].tolist(), low[p][used].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), p, dtype=np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(count[used]),
                    pa.array(total, pa.list_(pa.decimal128(38, 0))),
                ],
                ["part", "entry", "n", "sums"],
            )

    return add


def _first_books(blocks: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids; `entries` vectors at most reach the driver."""
    near = written(blocks.mapInArrow(_smallest(entries), "id bigint, numbers array<bigint>"))
    first = near.orderBy(F.asc_nulls_last("id"), "numbers").limit(entries).collect()
    whole = np.array([r["numbers"] for r in first], dtype=np.int64)
    return [whole[:, lo:hi] for lo, hi in part_bounds(whole.shape[1], parts)]


def _next_books(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: each entry becomes the rounded down mean of the parts nearest to it."""
    known = blocks.sparkSession.sparkContext.broadcast(books)
    ddl = "part int, entry int, n bigint, sums array<decimal(38,0)>"
    partial = blocks.mapInArrow(_sums(known), ddl)
    placed = partial.select("part", "entry", "n", F.posexplode_outer("sums").alias("place", "total"))
    found = placed.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    moved = [b.copy() for b in books]
    for row in found.collect():  # a number for each entry and dimension, whatever the rows
        if row["place"] is not None:
            moved[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    known.destroy()
    return moved


def _assigned(codebooks):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = codebooks.value
        bounds = part_bounds(sum(b.shape[1] for b in books), len(books))
        for block in _blocks_of(batches):
            indexes, error = [], np.zeros(block.n, dtype=object)
            for book, (lo, hi) in zip(books, bounds, strict=True):
                index, distance = nearest(block, lo, hi, book)
                indexes.append(index)
                error = error + distance.astype(object)
            codes = ["".join(f"{x:02x}" for x in row) for row in zip(*(i.tolist() for i in indexes), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    block.ids,
                    block.labels,
                    pa.array(codes, pa.string()),
                    pa.array([min(e, _LONG) for e in error], pa.int64()),
                ],
                ["vec_id", "label", "code", "error"],
            )

    return assign


def digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every vector, and the fitted codebooks, one array per part.

    Components are floor(scale * x). Each codebook starts as that part of the vectors with the
    smallest ids (fewer vectors: fewer entries; equal ids by their integers; null ids last). A round
    assigns every part to its nearest entry, the lower index of equally near ones, and moves each
    used entry to the mean of its parts, rounded down. `code` holds two hexadecimal digits a part
    (`entries` is at most 256), `error` the squared distances added up.

    A vector that is null or holds a null, a component that is not finite, or one whose integer has
    more than 61 bits is dropped; shorter vectors are filled up with zeros to the longest kept one;
    a width that is no multiple of `parts` is cut as evenly as it can be. Repeated rows are rows of
    their own. An empty table gives no rows and no codebooks. Sums and distances are exact; an
    `error` beyond 64 bits counts as the largest such number. Other columns are not read.

    A task holds one block of BLOCK_ROWS rows, the tables of one part and the sums of its entries;
    the driver holds the codebooks, whose size does not depend on the number of rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"entries must lie between 1 and 256, not {entries!r}")
    spark = vectors.sparkSession
    vector = F.col(vector_column)
    kept = vectors.where(usable(vector, scale))
    width = kept.agg(F.max(F.size(vector))).first()[0]
    chosen = kept.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(label_column).alias("label"), doubles(vector).alias("vector")
    )
    label = chosen.schema["label"].dataType
    out = T.StructType.fromDDL("vec_id bigint, code string, error bigint")
    out = T.StructType([out["vec_id"], T.StructField("label", label), out["code"], out["error"]])
    if width is None:
        return spark.createDataFrame([], out), []
    ddl = (
        f"ids array<bigint>, labels array<{label.simpleString()}>, dictionaries array<binary>, "
        "codes array<binary>"
    )
    blocks = written(chosen.mapInArrow(_encoded(scale, width, BLOCK_ROWS), ddl))
    books = _first_books(blocks, parts, entries)
    for _ in range(rounds):
        books = _next_books(blocks, books)
    return blocks.mapInArrow(_assigned(spark.sparkContext.broadcast(books)), out), books


def with_label_errors(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The codes with the errors added up over equal labels (nulls together), and the checksum of
    the codebooks. A sum beyond 64 bits counts as the largest such number."""
    rows = written(coded.withColumn("group", F.to_json(F.struct("label"))))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.least(total, F.lit(Decimal(_LONG))).cast("bigint").alias("label_error")
    totals = written(rows.groupBy("group").agg(whole, F.count("*").alias("n")))
    joined = join_hot(rows, totals, "group", ["label_error"])
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
