"""What several operators share: intermediate tables, joins with hot keys, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.settings import new_work_dir

# A key with more than one HOT-th of all rows is hot, so there are fewer than HOT hot keys.
HOT = 1000
SALTS = 1024
FIND_ROUNDS = 60
BATCH_ROWS = 1000


def written(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read back: cuts the lineage, and a
    lost executor costs a reread only."""
    path = new_work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_hot(
    rows: DataFrame,
    totals: DataFrame,
    key: str,
    values: list[str],
    count: str = "n",
    spread: list[str] | None = None,
) -> DataFrame:
    """Left join of `rows` with `totals`, which has one row for each `key`, its `values`, and in
    `count` how many rows carry it; the rows of a hot key stay where they are.

    Fewer than HOT keys carry more than one HOT-th of all rows. Those are broadcast; all others
    are joined by shuffle, in which the rows of hot keys and rows without a key take part with a
    null key and a salt from `spread` (default: the number of the row), and so are spread evenly.
    """
    n_rows = totals.agg(F.sum(count)).first()[0] or 0
    if n_rows == 0:
        return rows.select("*", *[F.lit(None).cast(totals.schema[v].dataType).alias(v) for v in values])
    cold_values = [F.col(v).alias(f"_cold_{v}") for v in values]
    hot = totals.where(F.col(count) > n_rows // HOT).select(
        F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot")
    )
    cold = totals.where(F.col(count) <= n_rows // HOT).select(
        F.col(key).alias("_cold_key"), F.lit(0).alias("_cold_salt"), *cold_values
    )
    # (the keys of both sides are renamed, so equal names cannot clash)
    number = F.xxhash64(*spread) if spread else F.xxhash64(F.monotonically_increasing_id())
    met = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    is_free = F.col("_hot").isNotNull() | F.col(key).isNull()
    met = met.withColumn("_join_key", F.when(~is_free, F.col(key))).withColumn(
        "_salt", F.when(is_free, F.pmod(number, F.lit(SALTS)).cast("int") + 1).otherwise(F.lit(0))
    )
    on = (F.col("_join_key") == F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt"))
    out = met.join(cold, on, "left")
    found = [F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold_{v}")).alias(v) for v in values]
    return out.select(*rows.columns, *found)


class Forest:
    """Union-find over a few thousand to a few million numbers; the root is the smallest."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x] = root
            x = up
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one batch, with every node linked to the smallest one it can reach in it."""
    for batch in batches:
        forest = Forest()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        pairs = [(x, r) for x in forest.parent if (r := forest.find(x)) != x]
        u = np.array([p[0] for p in pairs], dtype=np.int64)
        v = np.array([p[1] for p in pairs], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of the links (u, v): the smallest node it can reach.

    Large-star and small-star steps in turn: each node hands its smallest neighbour on to its
    larger neighbours, then to its smaller ones, until nothing changes. The smallest neighbour is
    a partial minimum and it reaches the links of a hub through `join_hot`, so a node with very
    many links is never gathered in one task. Each step is written to the shared folder.
    """
    star = links.where("u <> v").mapInArrow(_local_stars, "u bigint, v bigint").distinct()
    star = written(star)
    before = None
    for _ in range(FIND_ROUNDS):
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        large = join_hot(both, least, "u", ["m"], spread=["v"])
        large = large.where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        ).where("u <> v").distinct()
        large = written(large)
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = join_hot(large, least, "u", ["m"], spread=["v"])
        pairs = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        star = written(pairs.where("u <> v").distinct())
        now = star.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = star.select(F.col("v").alias("id")).distinct()
    return star.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )


def offsets_of(sums: dict[int, tuple[int, ...]]) -> dict[int, tuple[int, ...]]:
    """For numbered parts with some totals each: the totals of all parts before."""
    before: dict[int, tuple[int, ...]] = {}
    width = len(next(iter(sums.values()))) if sums else 0
    run = (0,) * width
    for part in sorted(sums):
        before[part] = run
        run = tuple(a + b for a, b in zip(run, sums[part], strict=True))
    return before


def hash_sample(df: DataFrame, key: str, limit: int, salt: str = "") -> DataFrame:
    """The first `limit` rows, or nearly so many, in the order of a hash of `key`.

    A threshold on the hash first leaves about one and a half times as many rows over all tasks, so
    that what is sorted and sent does not grow with the number of tasks.
    """
    number = F.xxhash64(key, F.lit(salt))
    rows = df.count()
    if rows > 2 * limit:
        most = int(1.5 * limit / rows * (1 << 63))
        df = df.where(F.shiftrightunsigned(number, 1) < F.lit(most))
    return df.orderBy(number, *df.columns).limit(limit)


def importable(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it. On a cluster whose
    executors do not see that folder, pass the package with `--py-files` instead."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def bounded_batches(spark: SparkSession) -> None:
    """Fewer rows for each Arrow batch, unless the session has a number of its own: rows hold whole
    texts, and ten thousand long ones would not fit into a worker. The workers' Arrow gives freed
    memory back."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, BATCH_ROWS)
    spark.sparkContext.environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def job(function: Callable) -> Callable:
    """Marks a function of (spark, ...) that runs operators of this subpackage."""

    @wraps(function)
    def run(spark: SparkSession, *args, **options):
        importable(spark)
        bounded_batches(spark)
        return function(spark, *args, **options)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
