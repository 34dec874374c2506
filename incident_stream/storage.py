"""Files of a store, through Hadoop's file systems: any place that Spark can write to."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder and the few operations on it that Spark's readers and writers do not have."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._bytes = spark.sparkContext._jvm.java.lang.String
        self.path = path

    def _at(self, name: str):
        place = self._hadoop.Path(f"{self.path}/{name}" if name else self.path)
        return place.getFileSystem(self._conf), place

    def exists(self, name: str = "") -> bool:
        files, place = self._at(name)
        return files.exists(place)

    def names(self, pattern: str) -> list[str]:
        """What matches the pattern, relative to the folder."""
        files, place = self._at(pattern)
        depth = pattern.count("/") + 1
        found = [s.getPath().toString() for s in files.globStatus(place) or []]
        return sorted("/".join(f.split("/")[-depth:]) for f in found)

    def signature(self) -> list[list]:
        """Name, length and time of the files directly in the folder, or of the file itself."""
        files, place = self._at("")
        found = files.listStatus(place) if files.exists(place) else []
        return sorted([s.getPath().getName(), s.getLen(), s.getModificationTime()] for s in found)

    def modified(self, name: str) -> float:
        """When the file was last written, in seconds of the clock of the store."""
        files, place = self._at(name)
        return files.getFileStatus(place).getModificationTime() / 1000

    def claim(self, name: str) -> bool:
        """Make a file; false if it is there already."""
        files, place = self._at(name)
        try:
            files.create(place, False).close()
        except Exception:
            if files.exists(place):
                return False
            raise
        return True

    def write_json(self, name: str, value) -> None:
        """Make a file that must not be there yet. A reader sees all of it or none, and of two writers
        one fails: it is written aside and renamed."""
        files, place = self._at(name)
        _, aside = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        out = files.create(aside, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        if not files.rename(aside, place):
            files.delete(aside, False)
            raise FileExistsError(f"{place} could not be made")

    def read_json(self, name: str):
        files, place = self._at(name)
        stream = files.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        files, place = self._at(name)
        files.delete(place, True)
