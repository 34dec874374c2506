"""Sharding along a Hilbert curve.

Several metadata columns are quantised to cells of a grid, in the order of their values and so that
the cells of a column hold equal shares of the bytes. The rows are sorted by the place of their cell
on a Hilbert curve, and the sorted rows are cut into shards of near equal bytes. Rows that are near
each other in all dimensions so land in few shards, whose least and greatest values then prune
files for a filter on any of the dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.llm.common import free_name, offsets_of, written

BITS = 6
ROW_BYTES = 16
# Sizes are weighed in so many classes for each doubling; of a category, so many values are weighed,
# those with the most bytes, and any other value goes where the next smaller one goes.
SIZE_CLASSES = 32
WEIGHED_VALUES = 4096
# Columns of one group are one dimension, ordered by the first, then by the next. With 40 shards a
# third dimension would leave each only three or four stretches.
DIMENSIONS = (("lang", "source"),)


def curve_index(axes: list[np.ndarray], bits: int) -> np.ndarray:
    """The place of each cell on the Hilbert curve of `len(axes)` dimensions (Skilling 2004).

    `axes` holds one array of cell numbers below 2 ** bits per dimension.
    """
    x = [np.array(a, dtype=np.uint64) for a in axes]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        here, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(n):
            is_set = (x[i] & here) != 0
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] = x[0] ^ np.where(is_set, below, swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        is_set = (x[n - 1] & np.uint64(1 << level)) != 0
        turn ^= np.where(is_set, np.uint64((1 << level) - 1), np.uint64(0))
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            bit = ((x[i] ^ turn) >> np.uint64(level)) & np.uint64(1)
            place = (place << np.uint64(1)) | bit
    return place.astype(np.int64)


@dataclass(frozen=True)
class Cells:
    """The cells of one dimension: ascending values, and the cell that begins with each."""

    values: np.ndarray
    cells: np.ndarray

    @classmethod
    def of(cls, weights: dict, bits: int) -> Cells:
        """Each value goes to the cell in which the middle of its weight lies."""
        values = np.array(sorted(weights))
        weight = np.array([weights[v] for v in values.tolist()], dtype=np.float64)
        middle = (np.cumsum(weight) - weight / 2) / max(1.0, weight.sum())
        return cls(values, np.minimum(middle * (1 << bits), (1 << bits) - 1).astype(np.int64))

    def place(self, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.values, values, "right") - 1
        return self.cells[np.maximum(at, 0)] if len(self.cells) else np.zeros(len(values), np.int64)


def _category(names: tuple[str, ...]) -> Column:
    """The values of the columns as one text; null comes before all others."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("")) for n in names]
    return F.concat_ws("\1", *values)


def _held(docs: DataFrame, dimensions: tuple[tuple[str, ...], ...]) -> list[tuple[str, ...]]:
    """The groups without the columns that the table does not have."""
    groups = [tuple(name for name in group if name in docs.columns) for group in dimensions]
    return [group for group in groups if group]


def _size_class(size: Column) -> Column:
    return F.floor(F.log2(size.cast("double")) * SIZE_CLASSES).cast("int")


def _size(text_column: str) -> Column:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return (F.octet_length(text) + ROW_BYTES).cast("bigint")


def _axes(
    docs: DataFrame, groups: list[tuple[str, ...]], text_column: str, bits: int
) -> tuple[dict[str, Column], list[Cells]]:
    """What the dimensions rest on, the last of them the size, and the cells of each."""
    size = _size(text_column)
    inputs = [*[_category(group) for group in groups], _size_class(size)]
    axes = []
    for value in inputs:
        weights = docs.groupBy(value.alias("value")).agg(F.sum(size).alias("weight"))
        top = weights.orderBy(F.desc("weight"), "value").limit(WEIGHED_VALUES)
        axes.append(Cells.of({r["value"]: float(r["weight"]) for r in top.collect()}, bits))
    return {f"v{i}": value for i, value in enumerate(inputs)}, axes


def _struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def _places(axes: list[Cells], values: pd.DataFrame, bits: int) -> np.ndarray:
    return curve_index([axis.place(values[f"v{i}"].to_numpy()) for i, axis in enumerate(axes)], bits)


def _curve(inputs: dict[str, Column], axes: list[Cells], bits: int) -> Column:
    """The place of a row on the curve."""

    def placed(values: pd.DataFrame) -> pd.Series:
        return pd.Series(_places(axes, values, bits))

    return F.pandas_udf(placed, "bigint")(_struct(inputs))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of a sorted partition: the rows and the bytes before it in the partition."""
    part = TaskContext.get().partitionId()
    rows = bytes_before = 0
    for batch in batches:
        size = np.asarray(batch.column(1))
        ends = np.cumsum(size)
        n = len(size)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(n, part, dtype=np.int32)),
                pa.array(np.arange(rows, rows + n, dtype=np.int64)),
                pa.array(bytes_before + ends - size),
            ],
            [*batch.schema.names, "part", "rows_before", "bytes_before"],
        )
        rows += n
        bytes_before += int(ends[-1]) if n else 0


ORDER = ["curve", "text_crc32", "doc_id", "tie"]
META = "doc_id bigint, size bigint, text_crc32 bigint, curve bigint, tie bigint"


def _meta(curve: Column, id_column: str, text_column: str) -> dict[str, Column]:
    """What the order rests on: curve, checksum, id. A hash of the row's number comes last, so that
    even repeated rows spread; as these are equal, it does not matter which is which."""
    return {
        "doc_id": F.col(id_column).cast("bigint"),
        "size": _size(text_column),
        "text_crc32": F.crc32(F.coalesce(F.col(text_column), F.lit(""))),
        "curve": curve,
        "tie": F.xxhash64(F.monotonically_increasing_id()),
    }


def _cut(docs: DataFrame, meta: dict[str, Column], shards: int) -> DataFrame:
    """The columns of META for every row, its shard, and its number in the order of the rows."""
    spark = docs.sparkSession
    placed = written(docs.select([column.alias(name) for name, column in meta.items()]))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER)
    ddl = f"{META}, part int, rows_before bigint, bytes_before bigint"
    counted = written(ranged.mapInArrow(_counted, ddl))
    # one row per partition, a few thousand numbers however large the table
    sums = counted.groupBy("part").agg(F.count("*"), F.sum("size")).collect()
    before = offsets_of({r[0]: (r[1], r[2]) for r in sums})
    total = max(1, sum(r[2] for r in sums))
    known = spark.createDataFrame(
        [(p, *b) for p, b in before.items()], "part int, rows_at bigint, bytes_at bigint"
    )
    laid = counted.join(F.broadcast(known), "part")
    byte = (F.col("bytes_before") + F.col("bytes_at")).cast("decimal(38,0)")
    shard = F.floor((byte * 2 + F.col("size")) * shards / F.lit(2 * total)).cast("int")
    return laid.select(
        *meta,
        F.least(shard, F.lit(shards - 1)).alias("shard"),
        (F.col("rows_before") + F.col("rows_at")).alias("row"),
    )


def shard_by_curve(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: tuple[tuple[str, ...], ...] = DIMENSIONS,
) -> DataFrame:
    """Shard, slot and size of every row, in the order of the curve, by the law `bytes`.

    The dimensions are the groups of columns that the table has, and the size. A row's size is the
    UTF-8 bytes of its text (null: none) plus 16. The sorted rows are laid end to end; the row whose
    middle byte lies in the k-th of `shards` equal stretches goes to shard k. Ties on the curve are
    ordered by checksum and id, so equal texts of one cell stand together; a hash of the number of
    the row comes last, so that even repeated rows spread over the tasks. A row larger than a
    stretch can leave a shard empty. An empty table gives no rows; nulls are values like any
    other. Only ids, sizes, checksums and places are shuffled, never texts.
    """
    curve = _curve(*_axes(docs, _held(docs, dimensions), text_column, BITS), BITS)
    cut = _cut(docs, _meta(curve, id_column, text_column), shards)
    firsts = cut.groupBy("shard").agg(F.min("row").alias("first_row"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


@dataclass(frozen=True)
class Shards:
    """Written shards: one folder each below `path`, `<shard>=<number>`, with the rows in the order
    of the curve, and least and greatest values of every shard.

    `names` has what the added columns are called: shard, size, crc, and place, which orders them.
    """

    path: str
    names: dict[str, str]
    groups: tuple[tuple[str, ...], ...]

    def read(self, spark: SparkSession, shards: list[int] | None = None) -> DataFrame:
        """All rows, or those of some shards; of the others no file is opened."""
        rows = spark.read.parquet(self.path)
        return rows if shards is None else rows.where(F.col(self.names["shard"]).isin(shards))

    def bounds(self, spark: SparkSession) -> DataFrame:
        """For each shard that has rows: their number and bytes, and of each column of a dimension, of
        each group of columns as a whole, and of the size the least and greatest value, and whether
        there are nulls. Only these columns are read."""
        own = self.names
        columns = [F.count("*").alias("rows"), F.sum(own["size"]).alias("bytes")]
        singles = [(name, F.col(name)) for group in self.groups for name in group]
        for name, column in [*singles, ("size", F.col(own["size"]))]:
            columns += [F.min(column).alias(f"least_{name}"), F.max(column).alias(f"greatest_{name}")]
            columns.append(F.bool_or(column.isNull()).alias(f"null_{name}"))
        for group in self.groups:
            whole = F.struct(*group)
            columns += [F.min(whole).alias(f"least {group}"), F.max(whole).alias(f"greatest {group}")]
        return self.read(spark).groupBy(F.col(own["shard"]).alias("shard")).agg(*columns)

    def meeting(self, bounds: DataFrame, name: str | tuple[str, ...], low, high) -> list[int]:
        """The shards that can hold a row whose `name` lies between `low` and `high`, both included;
        for a group, which is ordered by its columns in turn, all three are tuples. `bounds` has a
        row for each shard."""
        least, greatest = (f"`{kind}{'_' if isinstance(name, str) else ' '}{name}`" for kind in ("least", "greatest"))
        if not isinstance(name, str):
            low, high = (F.struct(*[F.lit(v).alias(n) for n, v in zip(name, end, strict=True)]) for end in (low, high))
        met = bounds.where((F.col(least) <= F.lit(high)) & (F.col(greatest) >= F.lit(low)))
        return sorted(r["shard"] for r in met.select("shard").collect())

    def slots(self, spark: SparkSession) -> DataFrame:
        """All rows with `slot`, their number within the shard, without gaps from 0."""
        rows = self.read(spark)
        shard, place = self.names["shard"], self.names["place"]
        part = F.shiftright(place, 33).cast("int")
        # a row for each shard and task: the tasks follow the order, so few tasks share a shard
        found = rows.groupBy(F.col(shard).alias("shard"), part.alias("part")).agg(
            F.min(place).alias("first"), F.count("*").alias("n")
        )
        starts, held = [], {}
        for r in sorted(found.collect(), key=lambda r: (r["shard"], r["part"])):
            at = held.get(r["shard"], 0)
            starts.append((r["shard"], r["part"], r["first"] - at))
            held[r["shard"]] = at + r["n"]
        known = spark.createDataFrame(starts, "_shard int, _part int, _first bigint")
        on = (F.col(shard) == F.col("_shard")) & (part == F.col("_part"))
        slot = (F.col(place) - F.col("_first")).alias("slot")
        return rows.join(F.broadcast(known), on).select(*rows.columns, slot)


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: tuple[tuple[str, ...], ...] = DIMENSIONS,
) -> Shards:
    """Write the rows, with all their columns, into a folder for each shard of `shard_by_curve`.

    Every shard is cut on into stretches of equal bytes, so many that there is one for each shuffle
    partition, and a task writes one stretch in the order of the curve. The stretches are told by
    their first keys; a row finds its stretch by searching its own key among them, so no row is
    joined. The added columns get underscores where a name is taken.
    """
    spark = docs.sparkSession
    groups = _held(docs, dimensions)
    inputs, axes = _axes(docs, groups, text_column, BITS)
    meta = _meta(_curve(inputs, axes, BITS), id_column, text_column)
    each = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    cut = _cut(docs, meta, shards * each).withColumnRenamed("shard", "stretch")
    key = F.struct(*[F.col(name) for name in ORDER])
    begins = sorted((r[0], *r[1]) for r in cut.groupBy("stretch").agg(F.min(key)).collect())
    names = {own: free_name(docs, f"curve_{own}") for own in ("shard", "size", "crc", "place")}
    own = {name: F.col(f"_{name}_") for name in meta if name != "curve"}
    rows = docs.select("*", *[column.alias(f"_{name}_") for name, column in meta.items() if name in own])
    searched = {
        **inputs,
        "crc": own["text_crc32"],
        "known": own["doc_id"].isNotNull().cast("bigint"),
        "id": F.coalesce(own["doc_id"], F.lit(0)),
        "tie": own["tie"],
    }
    found = rows.withColumn("_found_", _stretch(axes, BITS, begins)(_struct(searched)))
    dealt = found.repartitionById(shards * each, F.col("_found_.stretch"))
    order = [F.col("_found_.stretch"), F.col("_found_.curve"), *[F.col(f"_{name}_") for name in ORDER[1:]]]
    out = dealt.sortWithinPartitions(*order).select(
        *docs.columns,
        F.col("_size_").alias(names["size"]),
        F.col("_text_crc32_").alias(names["crc"]),
        F.monotonically_increasing_id().alias(names["place"]),
        F.floor(F.col("_found_.stretch") / each).cast("int").alias(names["shard"]),
    )
    out.write.partitionBy(names["shard"]).parquet(path)
    return Shards(path, names, tuple(groups))


def _stretch(axes: list[Cells], bits: int, begins: list[tuple]):
    """The place of a row on the curve, and its stretch: that with the last first key that is not
    above its own. A null id is below all others."""
    kind = np.dtype([("curve", "<i8"), ("crc", "<i8"), ("known", "<i8"), ("id", "<i8"), ("tie", "<i8")])
    numbers = np.array([b[0] for b in begins], dtype=np.int32)
    firsts = np.array(
        [(curve, crc, doc is not None, doc or 0, tie) for _, curve, crc, doc, tie in begins], dtype=kind
    )

    def stretch(values: pd.DataFrame) -> pd.DataFrame:
        keys = np.empty(len(values), dtype=kind)
        keys["curve"] = _places(axes, values, bits)
        for name in kind.names[1:]:
            keys[name] = values[name]
        at = np.maximum(np.searchsorted(firsts, keys, "right") - 1, 0)
        return pd.DataFrame({"curve": keys["curve"], "stretch": numbers[at]})

    return F.pandas_udf(stretch, "curve bigint, stretch int")


def digest(shards: Shards, spark: SparkSession, id_column: str = "doc_id") -> DataFrame:
    """Id, size, checksum, shard and slot of every written row."""
    names = shards.names
    return shards.slots(spark).select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(names["size"]).alias("size"),
        F.col(names["crc"]).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col(names["shard"]).alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
