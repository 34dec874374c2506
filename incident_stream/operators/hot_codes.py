"""Which codes carry a large share of the latest records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from incident_stream.storage import Folder

# Codes that a batch reports, and codes that are remembered.
REPORTED, TRACKED, REMEMBERED = 256, 4096, 1024
METRIC = "codes"


class SpaceSaving:
    """Counts of the most frequent items in bounded memory: when it is full, a new item takes the
    place of the least counted one and inherits its count, so no count is ever too low."""

    def __init__(self, size: int, counts: dict[str, float] | None = None, total: float = 0) -> None:
        self.size, self.total = size, total
        self.counts = dict(counts or {})

    def add(self, item: str, count: float) -> None:
        if item not in self.counts and len(self.counts) >= self.size:
            least = min(self.counts, key=self.counts.get)
            count += self.counts.pop(least)
        self.counts[item] = self.counts.get(item, 0) + count

    def add_batch(self, found: Iterable[tuple[str, float]], rows: int) -> None:
        """The counts of a batch. What came before weighs half as much as it did."""
        self.total = self.total / 2 + rows
        self.counts = {item: count / 2 for item, count in self.counts.items()}
        for item, count in found:
            self.add(item, count)

    def frequent(self, share: float) -> list[str]:
        return sorted(i for i, count in self.counts.items() if count >= share * self.total > 0)


def frequent_codes(code: Column) -> list[Column]:
    """What a batch is asked for: its most frequent codes with their counts, and its rows. Both are
    merged from small sketches of the tasks."""
    known = F.when(code.isNotNull(), code)
    top = F.call_function("approx_top_k", known, F.lit(REPORTED), F.lit(TRACKED))
    return [top.alias("top"), F.count("*").alias("rows")]


class RecentCodes:
    """The frequent codes of the last batches, remembered in a folder from one start to the next."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.folder = Folder(spark, path)
        self.number = max(self._numbers(), default=0)
        known = self.folder.read_json(f"codes_{self.number}.json") if self.number else {}
        self.sketch = SpaceSaving(REMEMBERED, **known)

    def _numbers(self) -> list[int]:
        names = self.folder.names("codes_*.json")
        return [int(n[len("codes_") : -len(".json")]) for n in names]

    def hot(self, partitions: int) -> list[str] | None:
        """Codes with at least half as many records as a task has on average; None if no batch has
        been seen."""
        return self.sketch.frequent(0.5 / partitions) if self.sketch.total else None

    def update(self, found: Iterable[tuple[str, float]], rows: int) -> None:
        self.sketch.add_batch(found, rows)
        self.number = max([self.number, *self._numbers()]) + 1
        state = {"counts": self.sketch.counts, "total": self.sketch.total}
        self.folder.write_json(f"codes_{self.number}.json", state)
        for number in self._numbers():
            if number < self.number:
                self.folder.delete(f"codes_{number}.json")


class CodeListener(StreamingQueryListener):
    """Hands what the batches of one job report, under the name `metric`, to `recent`."""

    def __init__(self, recent: RecentCodes, metric: str) -> None:
        self.recent, self.metric = recent, metric

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.metric)
        if seen is not None and seen["rows"]:
            found = [(r["item"], r["count"]) for r in seen["top"] or [] if r["item"] is not None]
            self.recent.update(found, seen["rows"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
