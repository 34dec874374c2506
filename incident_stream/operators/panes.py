"""Sums per day and district within a task of a micro-batch, without any state.

Structured Streaming turns every grouping into a stateful one; what must be summed up statelessly,
before the watermark, takes a function over the batches of a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

# A task groups so many rows at a time, and adds up the panes it holds when they are as many.
HELD_ROWS = 1 << 18


def day_panes(held_rows: int = HELD_ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from rows (event_time, District, indexed) to one row per day and district of the
    task: latest event time, District, indexed rows, all rows.

    Days are those of UTC, with which the windows of Spark begin. Equal districts that differ in
    their sign of zero may stay apart; the grouping that follows takes them for one. The function is
    made here, and not at module level, so that Spark sends its code along: the Python workers need
    not have this package.
    """

    def summed(table: pa.Table) -> pa.Table:
        groups = table.group_by(["day", "District"], use_threads=False)
        added = groups.aggregate([("event_time", "max"), ("indexed", "sum"), ("total", "sum")])
        added = added.select(["day", "District", "event_time_max", "indexed_sum", "total_sum"])
        return added.rename_columns(["day", "District", "event_time", "indexed", "total"])

    def grouped(batches: list[pa.RecordBatch]) -> pa.Table:
        import pyarrow.compute as pc

        # Fixed value: microseconds of a day.
        day_length = 86_400_000_000
        rows = pa.Table.from_batches(batches)
        micros = rows.column(0).cast(pa.timestamp("us", "UTC")).cast(pa.int64())
        # division cuts towards zero; times before 1970 are moved to the start of their day first
        rest = pc.subtract(micros, pc.multiply(pc.divide(micros, day_length), day_length))
        rest = pc.if_else(pc.less(rest, 0), pc.add(rest, day_length), rest)
        columns = {
            "day": pc.subtract(micros, rest),
            "District": rows.column(1),
            "event_time": rows.column(0),
            "indexed": rows.column(2).cast(pa.int64()),
            "total": pa.repeat(pa.scalar(1, pa.int64()), rows.num_rows),
        }
        return summed(pa.table(columns))

    def panes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held: list[pa.Table] = []
        n_waiting, n_held, limit = 0, 0, held_rows
        for batch in batches:
            waiting.append(batch)
            n_waiting += batch.num_rows
            if n_waiting >= held_rows:
                held.append(grouped(waiting))
                n_held += held[-1].num_rows
                waiting, n_waiting = [], 0
            if n_held > limit:
                held = [summed(pa.concat_tables(held))]
                n_held = held[0].num_rows
                limit = max(held_rows, 2 * n_held)
        if n_waiting:
            held.append(grouped(waiting))
        if held:
            out = summed(pa.concat_tables(held)).select(["event_time", "District", "indexed", "total"])
            names = ["event_time", "District", "fbi_indexed", "total_crimes"]
            yield from out.rename_columns(names).to_batches()

    return panes
