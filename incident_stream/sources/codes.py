"""The static code table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.functions import strip_leading_zeros
from incident_stream.schema import CODE_COLUMNS
from incident_stream.storage import Folder


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Three columns of a CSV file with a header, picked by name, all strings."""
    table = spark.read.csv(path, header=True)
    return table.select([F.col(f"`{name}`").alias(ours) for name, ours in CODE_COLUMNS.items()])


def normalize_codes(codes: DataFrame) -> DataFrame:
    """Codes without leading zeros, as the records carry them."""
    return codes.withColumn("IUCR", strip_leading_zeros(F.col("IUCR")))


def digest(table: DataFrame) -> str:
    """A number of all rows, in whatever order they stand, and how many there are."""
    number = F.xxhash64(*table.columns)
    row = table.agg(
        F.count("*"), F.bit_xor(number), F.sum(F.hash(*table.columns).cast("bigint"))
    ).first()
    return "-".join(str(value) for value in row)


def pin_codes(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The code table as it is now, from a copy of its own in `folder`.

    A job that reads the copy is not touched by what happens to the file. The copy is noted with the
    lengths and times of the files it was made from and a digest of its rows: as long as one of the
    two is the same, later starts use the same copy. Copies of earlier tables stay, since another
    job may still read them.
    """
    place = Folder(spark, folder.rstrip("/"))
    files = Folder(spark, path.rstrip("/")).signature()
    known = _newest(place)[1]
    if files and known.get("files") == files:
        return _pinned(spark, place, known["copy"])
    copy = f"copy={uuid.uuid4().hex}"
    read_codes(spark, path).write.parquet(f"{place.path}/{copy}")
    made = _pinned(spark, place, copy)
    found = digest(made)
    while True:
        newest, known = _newest(place)
        same = known.get("digest") == found
        entry = {"digest": found, "copy": known["copy"] if same else copy, "files": files}
        try:
            place.write_json(f"pinned_{newest + 1}.json", entry)
        except FileExistsError:
            continue  # another job has pinned one just now
        if same:
            place.delete(copy)
        return _pinned(spark, place, entry["copy"])


def _newest(place: Folder) -> tuple[int, dict]:
    numbers = [int(n[len("pinned_") : -len(".json")]) for n in place.names("pinned_*.json")]
    newest = max(numbers, default=0)
    return newest, place.read_json(f"pinned_{newest}.json") if newest else {}


def _pinned(spark: SparkSession, place: Folder, copy: str) -> DataFrame:
    schema = ", ".join(f"{name} string" for name in CODE_COLUMNS.values())
    return spark.read.schema(schema).parquet(f"{place.path}/{copy}")
