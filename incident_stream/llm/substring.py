"""Removal of passages that occur more than once, behind a count-min prefilter.

First pass: every task adds to a count-min sketch with counters that stop at two; the sketches of
all tasks are merged. A window is counted by its anchor, the least hash among the shingles in it:
equal windows have equal anchors at equal places, so the count of an anchor is never below that of
a window, while neighbouring windows share anchors and the sketch has a tenth of the entries. A
window whose estimate is one occurs once. The
second pass takes only windows whose estimate is two or more and groups them exactly, by 128 bits
of hashes of their word sequence: two polynomials over the two halves of XXH3-128 of the words. What it has to hand back are only the windows
which the sketch overestimated: they occur once, so each belongs to one document, and no answer has
to reach the many occurrences of a frequent passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm import textkernel as tk
from incident_stream.llm.common import free_name

WIDTH = 35
# The sketch has two rows of at most 2 ** ROW_BITS counters: 64 MB as bits when it is broadcast.
# Beyond some billion windows it overestimates more of them; the exact pass then gets more to
# group, and the result stays the same.
ROW_BITS = 28
BLOCK_BITS = 17
FLUSH = 800_000


class Windows:
    """The words of a chunk of texts, the windows in them, and their anchors."""

    def __init__(self, texts: tk.Texts, width: int) -> None:
        self.width = width
        self.spans = tk.words(texts)
        self.starts = tk.window_starts(self.spans.doc, width)
        self.word_hashes = tk.span_hash_pairs(texts, self.spans)
        self.shingle = max(1, width // 3)
        every = np.arange(max(0, len(self.spans) - self.shingle + 1))
        self.shingles = tk.window_hashes(self.word_hashes[0], every, self.shingle, 0)
        self.reach = width - self.shingle + 1
        self.anchors = _sliding(np.minimum, self.shingles, self.reach)[self.starts]

    def hashes(self, starts: np.ndarray) -> list[np.ndarray]:
        """Two hashes of the word sequence of each window."""
        return [tk.window_hashes(h, starts, self.width, r) for r, h in enumerate(self.word_hashes)]

    def anchored(self) -> np.ndarray:
        """The shingles that are the anchor of a window, once for each place where they stand."""
        least = np.zeros(len(self.shingles) + self.reach - 1, dtype=np.uint64)
        least[self.starts + self.reach - 1] = self.anchors
        here = _sliding(np.maximum, least, self.reach)
        return self.shingles[here == self.shingles]


def _sliding(best, values: np.ndarray, reach: int) -> np.ndarray:
    """The least or largest of every `reach` neighbours."""
    size, held = 1, values
    while 2 * size <= reach:
        held = best(held[:-size], held[size:])
        size *= 2
    rest = reach - size
    return best(held[: len(held) - rest], held[rest:]) if rest else held


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    return tk.mix(anchors ^ tk.BASES[row]) >> np.uint64(64 - bits)


def _packed(sorted_codes: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte plane by byte plane: the upper planes are zeros,
    which the compression of the shuffle removes."""
    steps = np.diff(sorted_codes, prepend=np.uint32(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _sketched(width: int, bits: int):
    """Parts of sketches: for each block of counters the counters touched, and whether twice."""

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        blocks: list[int] = []
        parts: list[bytes] = []
        for row, lists in enumerate(held):
            cells = np.sort(np.concatenate(lists))
            new = np.concatenate(([True], cells[1:] != cells[:-1]))
            first = np.flatnonzero(new)
            twice = np.diff(first, append=len(cells)) > 1
            cells = cells[first]
            block = (cells >> np.uint64(BLOCK_BITS)).astype(np.int64)
            inside = cells & np.uint64((1 << BLOCK_BITS) - 1)
            code = (inside * np.uint64(2) + twice).astype(np.uint32)
            edge = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
            for lo, hi in zip(edge, np.append(edge[1:], len(block)), strict=True):
                blocks.append((row << (bits - BLOCK_BITS)) + int(block[lo]))
                parts.append(_packed(code[lo:hi]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array(parts, pa.binary())], ["block", "part"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]
        n = 0
        for batch in batches:
            for texts in tk.chunks(batch.column(0)):
                anchors = Windows(texts, width).anchored()
                for row in (0, 1):
                    held[row].append(_cells(anchors, row, bits))
                n += len(anchors)
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [[], []], 0
        if n:
            yield from flush(held)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block after the other: the sum of its parts, as a bit per counter that reached two."""
    now, seen, twice = None, np.zeros(1, bool), np.zeros(1, bool)

    def done() -> pa.RecordBatch:
        bits = np.packbits(twice, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"]
        )

    for batch in batches:
        for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                now = block
                seen, twice = np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
            code = _unpacked(part)
            cell = code >> 1
            twice[cell] |= seen[cell] | ((code & 1) == 1)
            seen[cell] = True
    if now is not None:
        yield done()


class Sketch:
    """The merged sketch: which counters reached two."""

    def __init__(self, bits: int, table: np.ndarray) -> None:
        self.bits, self.table = bits, table

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        """Whether the estimated count of a window is two or more."""
        out = None
        for row in (0, 1):
            cell = _cells(anchors, row, self.bits) + np.uint64(row << self.bits)
            byte = self.table[(cell >> np.uint64(3)).astype(np.int64)]
            bit = (byte >> (cell & np.uint64(7)).astype(np.uint8)) & 1
            out = bit if out is None else out & bit
        return out.astype(bool)


def build_sketch(docs: DataFrame, text_column: str, width: int) -> Sketch:
    """A counter for every ten bytes of text or fewer in each row, up to the bound: some six for
    every anchor."""
    total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    bits = min(ROW_BITS, max(BLOCK_BITS, int(total // 10).bit_length()))
    parts = docs.select(text_column).mapInArrow(_sketched(width, bits), "block int, part binary")
    dealt = parts.repartition("block").sortWithinPartitions("block")
    merged = dealt.mapInArrow(_merged, "block int, bits binary")
    table = np.zeros(2 << (bits - 3), dtype=np.uint8)
    size = 1 << (BLOCK_BITS - 3)
    for block, raw in merged.toLocalIterator():  # at most 64 MB, a task's blocks at a time
        table[block * size : (block + 1) * size] = np.frombuffer(raw, dtype=np.uint8)
    return Sketch(bits, table)


def _candidates(width: int, shared):
    """Windows with an estimate of two or more, once per flush, with their number and the place
    of the first."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        one, two, key, more, place = (np.concatenate([h[i] for h in held]) for i in range(5))
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        first = np.flatnonzero(new)
        counts = np.diff(first, append=len(one)).astype(np.int64)
        at = order[first]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(one[first].view(np.int64)),
                pa.array(two[first].view(np.int64)),
                pa.array(counts),
                pa.array(key[at]),
                pa.array(more[at]),
                pa.array(place[at]),
            ],
            ["h1", "h2", "n", "k1", "k2", "place"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        held: list[tuple] = []
        n = 0
        for batch in batches:
            key, more = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for texts in tk.chunks(batch.column(2)):
                found = Windows(texts, width)
                starts = found.starts[sketch.repeated(found.anchors)]
                hashes = found.hashes(starts)
                row = found.spans.doc[starts]
                first_word = np.searchsorted(found.spans.doc, np.arange(len(texts)))
                place = (starts - first_word[row]).astype(np.int32)
                row = row + texts.first
                held.append((*hashes, key[row], more[row], place))
                n += len(starts)
                if n >= FLUSH // 2:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return run


def _cleaned(width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            column = batch.column(0)
            once = batch.column(1)
            n = batch.num_rows
            n_words, n_removed = np.zeros(n, np.int64), np.zeros(n, np.int64)
            kept: list[str] = [""] * n
            for texts in tk.chunks(column):
                found = Windows(texts, width)
                spans = found.spans
                first_word = np.searchsorted(spans.doc, np.arange(len(texts) + 1))
                repeated = np.zeros(len(spans), dtype=bool)
                repeated[found.starts[sketch.repeated(found.anchors)]] = True
                for i in range(len(texts)):
                    single = once[texts.first + i]
                    if single.is_valid:
                        repeated[first_word[i] + np.asarray(single.values)] = False
                out = tk.covered(len(spans), np.flatnonzero(repeated), width)
                lo = texts.first
                n_words[lo : lo + len(texts)] = tk.per_text(texts, spans.doc)
                n_removed[lo : lo + len(texts)] = tk.per_text(texts, spans.doc[out])
                # each kept word and a space, for all texts of the chunk at once
                stay = ~out
                start, length = spans.start[stay], (spans.end - spans.start)[stay]
                data = texts.data[tk.expand(start, length)]
                padded = np.insert(data, np.cumsum(length), 0x20) if len(length) else data
                sizes = np.bincount(spans.doc[stay], weights=length + 1, minlength=len(texts))
                ends = np.cumsum(sizes).astype(np.int64)
                for i, (hi, size) in enumerate(zip(ends, sizes, strict=True)):
                    if size:
                        kept[lo + i] = padded[hi - int(size) : hi - 1].tobytes().decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[2:],
                    pa.array(kept, pa.string(), mask=np.asarray(column.is_null())),
                    pa.array(n_words),
                    pa.array(n_removed),
                ],
                [*batch.schema.names[2:], "_kept", "_words", "_removed"],
            )

    return run


def remove_repeated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    carry: list[str] | None = None,
) -> DataFrame:
    """All rows, with `kept_text`, `n_words` and `n_removed` (names that are taken get an
    underscore) beside the columns of `carry` (default: all but the text).

    A window is `width` consecutive words of one text. Every word that lies in a window which also
    starts anywhere else, in the same text too, is removed; windows are judged on the input. The
    words left are joined by single spaces. A null text has no words and stays null; a text of
    fewer words than a window is kept whole; repeated rows are copies of each other and lose all
    their windows. Rows are told apart by 96 bits of hash of id and text,
    and need no unique id.
    """
    spark = docs.sparkSession
    carry = [c for c in docs.columns if c != text_column] if carry is None else carry
    sketch = build_sketch(docs, text_column, width)
    shared = spark.sparkContext.broadcast(sketch)
    # 96 bits of two hash functions of id and text: rows of the same id, or of none, are told apart
    row_keys = [F.xxhash64(id_column, text_column), F.hash(id_column, text_column)]
    keys = [key.alias(f"k{i}") for i, key in enumerate(row_keys, 1)]
    likely = docs.select(*keys, F.col(text_column).alias("t")).mapInArrow(
        _candidates(width, shared), "h1 bigint, h2 bigint, n bigint, k1 bigint, k2 int, place int"
    )
    exact = likely.groupBy("h1", "h2").agg(
        F.sum("n").alias("n"),
        F.min("k1").alias("k1"),
        F.min("k2").alias("k2"),
        F.min("place").alias("place"),
    )
    once = exact.where("n = 1").groupBy("k1", "k2").agg(F.collect_list("place").alias("_once"))
    once = once.withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    rows = docs.select(
        F.col(text_column).alias("_text"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        *[key.alias(f"_i{i}") for i, key in enumerate(row_keys, 1)],
    )
    met = rows.join(
        once.hint("shuffle_hash"),
        (F.col("_i1") == F.col("_k1")) & (F.col("_i2") == F.col("_k2")),
        "left",
    )
    carried = met.select("_text", "_once", *[f"_c{i}" for i in range(len(carry))])
    kinds = carried.schema.fields[2:]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    tail = "_kept string, _words bigint, _removed bigint"
    out = carried.mapInArrow(_cleaned(width, shared), f"{ddl}, {tail}" if ddl else tail)
    shape = docs.select(*carry)
    names = {"_kept": "kept_text", "_words": "n_words", "_removed": "n_removed"}
    return out.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        *[F.col(k).alias(free_name(shape, v)) for k, v in names.items()],
    )


