"""Publish a directory of CSV files as one message per line, without the header lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.settings import RecordSource
from incident_stream.storage import Folder

STEP_BYTES = 16 << 30
# What has a meaning of its own in a path pattern.
SPECIAL = r"[\\{}\[\]*?]"


def _header_filter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that drops the first row of each file's first block.

    The rows of a task come block by block, in file order. `first_block_of` names the file for
    rows of a first block and is null for all others, so a header is a row whose name is set and
    differs from that of the row before it. The function is made here, and not at module level,
    so that Spark sends its code along: the Python workers need not have this package.
    """

    def without_header_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.column("first_block_of")
            previous = pa.concat_arrays([pa.array([before], names.type), names[:-1]])
            same = pc.fill_null(pc.equal(names, previous), False)
            keep = pc.or_(pc.is_null(names), same)
            before = names[-1].as_py()
            yield pa.RecordBatch.from_arrays([batch.column("value").filter(keep)], ["value"])

    return without_header_lines


@dataclass(frozen=True)
class CsvFile:
    """What tells a file from a later one of the same name."""

    name: str
    length: int
    modified: int


def csv_files(spark: SparkSession, in_dir: str) -> list[CsvFile]:
    """The `*.csv` files of a directory in the order of their names, without hidden ones."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{in_dir.rstrip('/')}/*.csv")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    entries = [s for s in found or [] if not s.getPath().getName().startswith(".")]
    names = [(s.getPath().getName(), s.isDirectory()) for s in entries]
    wrong = sorted(name for name, is_folder in names if is_folder or name.startswith("_"))
    if wrong:
        raise ValueError(f"cannot be published from {in_dir}: {', '.join(wrong)}")
    files = [CsvFile(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in entries]
    return sorted(files, key=lambda f: f.name)


class Manifest:
    """Which files have been published, in a folder with one entry per step."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, path.rstrip("/"))

    def _numbers(self) -> list[int]:
        names = self.folder.names("published_*.json")
        return sorted(int(n[len("published_") : -len(".json")]) for n in names)

    def known(self) -> set[CsvFile]:
        entries = [self.folder.read_json(f"published_{n}.json") for n in self._numbers()]
        return {CsvFile(*row) for entry in entries for row in entry}

    def add(self, files: list[CsvFile]) -> None:
        number = max(self._numbers(), default=0) + 1
        entry = [[f.name, f.length, f.modified] for f in files]
        while True:
            try:
                return self.folder.write_json(f"published_{number}.json", entry)
            except FileExistsError:  # another publishing job has made it just now
                number += 1


def file_lines(
    spark: SparkSession, in_dir: str, on_error: str = "fail", names: list[str] | None = None
) -> DataFrame:
    """All lines of the `*.csv` files in a directory, or of those with the given names, but the first
    of each file, in `value`.

    Files in sub-folders are not read. A name that Spark would pass over (with a leading
    underscore), and a folder whose name ends in `.csv`, is an error; names with a leading dot are
    hidden and left out.
    Blank lines are kept, and lines are not CSV records: a quoted line break splits one. Only the
    position decides what a header is, so a later line that looks like one is kept. With
    `on_error="skip"` the unreadable rest of a file is left out and Spark logs a warning; the
    default stops, because a passing fault of the storage would look the same.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    folder = in_dir.rstrip("/")
    if names is None:
        names = [f.name for f in csv_files(spark, in_dir)]
        paths = [f"{folder}/*.csv"]
    else:
        paths = [f"{folder}/{re.sub(SPECIAL, _escaped, name)}" for name in names]
    if not names:
        return spark.read.text(in_dir).where("false").select("value")
    reader = spark.read
    for fault in ("ignoreCorruptFiles", "ignoreMissingFiles"):
        reader = reader.option(fault, str(on_error == "skip").lower())
    first = F.col("_metadata.file_block_start") == 0
    placed = reader.text(paths).select(
        "value", F.when(first, F.col("_metadata.file_path")).alias("first_block_of")
    )
    return placed.mapInArrow(_header_filter(), "value string")


def _escaped(special: re.Match) -> str:
    return f"\\{special.group()}"


def publish_lines(
    spark: SparkSession, in_dir: str, sink: RecordSource, on_error: str = "fail"
) -> None:
    """Append the lines to a topic, as values without a key, or to a directory of text files.
    Publishing twice sends them twice."""
    _send(file_lines(spark, in_dir, on_error), sink)


def publish_new_files(
    spark: SparkSession,
    in_dir: str,
    sink: RecordSource,
    manifest: str,
    on_error: str = "fail",
    step_bytes: int = STEP_BYTES,
) -> int:
    """The same for the files that the manifest folder does not hold yet; returns their number.

    Files go in steps of about `step_bytes` (a file is never divided), in the order of their names,
    and each step is entered in the manifest once it has been sent: a publishing that was stopped
    goes on where it was, and another one sends only files that are new or have another length or
    time. What is sent again is at most the step that was stopped; text files take a step as a whole
    or not at all, a topic may hold a part of it.
    """
    entries = Manifest(spark, manifest)
    known = entries.known()
    waiting = [f for f in csv_files(spark, in_dir) if f not in known]
    step: list[CsvFile] = []
    for i, file in enumerate(waiting):
        step.append(file)
        if i + 1 == len(waiting) or sum(f.length for f in step) >= step_bytes:
            _send(file_lines(spark, in_dir, on_error, [f.name for f in step]), sink)
            entries.add(step)
            step = []
    return len(waiting)


def _send(lines: DataFrame, sink: RecordSource) -> None:
    if sink.format == "kafka":
        # "topic" and "subscribe" name the same thing on the writing and on the reading side
        reading_only = ("subscribe", "startingOffsets")
        options = {k: v for k, v in sink.options.items() if k not in reading_only}
        topic = sink.options["subscribe"]
        lines.write.format("kafka").options(**options).option("topic", topic).save()
    else:
        lines.write.format(sink.format).mode("append").save(sink.path)
