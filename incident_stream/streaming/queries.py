"""Start and await streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_query(
    df: DataFrame,
    mode: str,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query, named after its checkpoint, that hands its batches to `writer`. `trigger`
    holds the arguments of `DataStreamWriter.trigger`; without it the next batch starts when the
    last one ends."""
    stream = df.writeStream.queryName(checkpoint).outputMode(mode).foreachBatch(writer)
    if trigger:
        stream = stream.trigger(**trigger)
    return stream.option("checkpointLocation", checkpoint).start()


def await_all(queries: Iterable[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until every query has ended. If one fails, stop the others and raise its error, so
    that no failure goes unnoticed behind a query that still runs."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds)]
    except Exception:
        for query in waiting:
            query.stop()
        raise
