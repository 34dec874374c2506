"""Hierarchical packing into windows of several lengths.

A document's ids are cut into full windows of the longest tier; what is left is routed to the
shortest tier that holds it. Tiers are packed from the longest down: a window opens with a document
of its own tier, its gap is filled with whole documents of shorter tiers, largest first, and what
then remains is filled exactly by a cut of one more. Every window so ends at its tier's length, a
power of two, and only the last window of a task can need padding. Windows of a tier are dealt to
step groups of equal numbers of tokens.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm import textkernel as tk
from incident_stream.llm.common import offsets_of, written

TIERS = (256, 512, 1024, 2048)
END_ID = 1
# Documents are packed together in groups of about so many ids, which bounds a task's memory.
GROUP_IDS = 1 << 20
STEP_IDS = 1 << 16
CHUNK_BYTES = 1 << 20


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary: printable bytes
    stand for themselves, the others are numbered from 256 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {chr(b): b for b in plain}
    others = [b for b in range(256) if chr(b) not in symbols]
    return symbols | {chr(256 + i): b for i, b in enumerate(others)}


class Coder:
    """Ids of whole texts, by coding each different piece between blanks of a chunk once.

    The vocabulary file's pattern never lets a match reach across a blank that is followed by a
    word, except that one space belongs to the word behind it. So different words can be coded in
    one go, with line feeds between them, which come out as ids of their own. Texts with white space
    outside ASCII are coded whole.
    """

    def __init__(self, vocabulary: str, pattern: str) -> None:
        with open(vocabulary, encoding="utf-8") as f:
            file = json.load(f)
        entries = file["model"]["vocab"]
        # tokens that are matched in the text itself, before it is split
        self.added = {token["content"]: token["id"] for token in file.get("added_tokens") or []}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file.get("added_tokens") or []):
            raise ValueError("added tokens that take blanks along or match whole words only are not supported")
        symbols = byte_symbols()
        ranks = {
            bytes(symbols[c] for c in piece): number
            for piece, number in entries.items()
            if all(c in symbols for c in piece)
        }
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.added
        )
        self.line_feed = ranks[b"\n"]

    def ids(self, text: str) -> list[int]:
        if any(token in text for token in self.added):
            return self.encoding.encode(text, allowed_special="all")
        return self.encoding.encode_ordinary(text)

    def _with_added(self, texts: tk.Texts) -> np.ndarray:
        """Which texts hold an added token."""
        out = np.zeros(len(texts), dtype=bool)
        raw = texts.data.tobytes()
        for token in map(str.encode, self.added):
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(texts.offsets, at, "right")) - 1
                if at + len(token) <= texts.offsets[text + 1]:
                    out[text] = True
                    at = raw.find(token, int(texts.offsets[text + 1]))
                else:  # across the border of two texts
                    at = raw.find(token, at + 1)
        return out

    def _words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words without line feeds, one after the other, and how many each has."""
        length = end - start
        joined = data[tk.expand(start, length)]
        text = np.insert(joined, np.cumsum(length), 0x0A).tobytes().decode("utf-8")
        ids = np.array(self.ids(text), dtype="<u4")
        stops = np.flatnonzero(ids == self.line_feed)
        return ids[ids != self.line_feed], np.diff(stops, prepend=-1) - 1

    def chunk(self, texts: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a chunk, one after the other, and where each text's ids end."""
        starts, doc, is_word = pieces(texts, _wide_blanks(texts) | self._with_added(texts))
        if len(starts) == 0:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        ends = np.append(starts[1:], len(texts.data))
        number, values = tk.span_classes(texts, tk.Spans(starts, ends, doc))
        first = np.zeros(len(values), dtype=np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        length = np.zeros(len(first), dtype=np.int64)
        at = np.zeros(len(first), dtype=np.int64)
        plain = np.flatnonzero(is_word[first])
        flat, length[plain] = self._words(texts.data, starts[first[plain]], ends[first[plain]])
        at[plain] = np.cumsum(length[plain]) - length[plain]
        parts, size = [flat], len(flat)
        for k in np.flatnonzero(~is_word[first]):
            raw = texts.data[starts[first[k]] : ends[first[k]]].tobytes().decode("utf-8")
            coded = np.array(self.ids(raw), dtype="<u4")
            parts.append(coded)
            at[k], length[k] = size, len(coded)
            size += len(coded)
        flat = np.concatenate(parts)
        ids = flat[tk.expand(at[number], length[number])]
        per_doc = np.bincount(doc, weights=length[number], minlength=len(texts))
        return ids, np.cumsum(per_doc).astype(np.int64)


def _wide_blanks(texts: tk.Texts) -> np.ndarray:
    """Which texts hold white space outside ASCII (U+0085, U+00A0, U+1680, U+2000 and others)."""
    d = texts.data
    out = np.zeros(len(texts), dtype=bool)
    if len(d) < 2:
        return out
    hit = (d[:-1] == 0xC2) & ((d[1:] == 0x85) | (d[1:] == 0xA0))
    where = np.flatnonzero(hit)
    if len(d) > 2:
        a, b, c = d[:-2], d[1:-1], d[2:]
        wide = (a == 0xE1) & (b == 0x9A) & (c == 0x80)
        wide |= (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        wide |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        wide |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
        where = np.concatenate((where, np.flatnonzero(wide)))
    out[np.searchsorted(texts.offsets, where, "right") - 1] = True
    return out


def pieces(texts: tk.Texts, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces start that can be coded one by one, the texts that they lie in, and which
    are words; they leave no gap. The texts marked `whole` are one piece each.

    A word takes one space before it along. Of the blanks left before a word, the last one is a
    piece of its own, and so are all before it; if a space went with the word, all are one piece.
    Blanks at the end of a text are one piece.
    """
    spans = tk.words(texts)
    begin, stop = texts.offsets[:-1], texts.offsets[1:]
    prev_end = begin[spans.doc].copy()
    if len(spans):
        same = np.flatnonzero(spans.doc[1:] == spans.doc[:-1]) + 1
        prev_end[same] = spans.end[same - 1]
    gap = spans.start > prev_end
    spaced = gap.copy()
    spaced[gap] = texts.data[spans.start[gap] - 1] == 0x20
    unit = spans.start - spaced
    apart = gap & ~spaced
    last = np.full(len(texts), -1, dtype=np.int64)
    last[spans.doc] = spans.end  # spans are in order, so the last one stays
    tail = np.where(last >= 0, last, begin)
    tail = tail[tail < stop]
    # marks on the bytes are in order and hold no start twice
    mark = np.zeros(len(texts.data), dtype=np.uint8)
    mark[prev_end[unit > prev_end]] = 1
    mark[spans.start[apart] - 1] = 1
    mark[tail] = 1
    mark[unit] = 2
    starts = np.flatnonzero(mark)
    is_word = mark[starts] == 2
    doc = np.searchsorted(texts.offsets, starts, "right") - 1
    if whole.any():
        stay = ~whole[doc] | (starts == begin[doc])
        starts, doc = starts[stay], doc[stay]
        is_word = is_word[stay] & ~whole[doc]
    return starts, doc, is_word


class Packer:
    """Packs the documents that it is given, group by group, and hands out rows of pieces."""

    def __init__(self, tiers: tuple[int, ...], first_id: int) -> None:
        self.tiers = tiers
        self.next_id = first_id
        self.counts = dict.fromkeys(tiers, 0)
        self.rows: list[tuple] = []
        # what is left to pack: lengths in order, with the rests of that number of ids
        self.pools: dict[int, list[tuple[int, int]]] = {t: [] for t in tiers}
        self.rests: dict[int, tuple] = {}
        self.n_rests = 0
        self.held = 0

    def add(self, doc, ids: np.ndarray) -> None:
        """`ids` of one document, the end id included."""
        longest = self.tiers[-1]
        n = len(ids)
        full = n - n % longest
        for lo in range(0, full, longest):
            self._emit([(doc, lo, ids[lo : lo + longest], n)], longest)
        if full < n:
            self._route((doc, full, ids[full:], n))
        if self.held >= GROUP_IDS:
            self.pack()

    def _route(self, rest: tuple) -> None:
        size = len(rest[2])
        tier = next(t for t in self.tiers if size <= t)
        self.n_rests += 1
        self.rests[self.n_rests] = rest
        insort(self.pools[tier], (size, self.n_rests))
        self.held += size

    def _take(self, tier: int, at: int) -> tuple:
        size, key = self.pools[tier].pop(at)
        self.held -= size
        return self.rests.pop(key)

    def _fitting(self, gap: int, tiers: list[int]) -> tuple | None:
        """The longest rest of these tiers that fits in the gap."""
        for tier in reversed(tiers):
            at = bisect_right(self.pools[tier], (gap, self.n_rests + 1)) - 1
            if at >= 0:
                return self._take(tier, at)
        return None

    def _cut(self, gap: int, tiers: list[int]) -> tuple | None:
        """The first `gap` ids of the shortest rest that is longer; its other ids stay."""
        for tier in tiers:
            at = bisect_right(self.pools[tier], (gap, self.n_rests + 1))
            if at < len(self.pools[tier]):
                doc, start, ids, n = self._take(tier, at)
                self._route((doc, start + gap, ids[gap:], n))
                return doc, start, ids[:gap], n
        return None

    def pack(self, last: bool = False) -> None:
        """Pack what is held. Between groups a window that cannot be filled waits for the next."""
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, shorter = self.tiers[k], list(self.tiers[:k])
            while self.pools[tier]:
                window = [self._take(tier, len(self.pools[tier]) - 1)]
                gap = tier - len(window[0][2])
                while gap:
                    more = self._fitting(gap, shorter or [tier]) or self._cut(gap, list(self.tiers[: k + 1]))
                    if more is None:
                        break
                    window.append(more)
                    gap -= len(more[2])
                if gap and not last:
                    for rest in window:
                        self._route(rest)
                    break
                self._emit(window, tier)

    def _emit(self, window: list[tuple], tier: int) -> None:
        offset = 0
        for doc, start, ids, n in window:
            crc = zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
            self.rows.append(
                (doc, start, len(ids), crc, n, self.next_id, offset, tier, self.counts[tier], ids)
            )
            offset += len(ids)
        self.next_id += 1
        self.counts[tier] += 1

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


_NAMES = [
    "doc_id",
    "start",
    "length",
    "ids_crc32",
    "doc_tokens",
    "sequence_id",
    "offset",
    "tier",
    "tier_index",
    "ids",
]
_DDL = ", ".join(f"{name} bigint" for name in _NAMES[:-1]) + ", ids array<int>, part int"

_coders: dict[tuple[str, str], Coder] = {}


def _packed(vocabulary: str, pattern: str, tiers: tuple[int, ...]):
    def batch_of(rows: list[tuple], part: int) -> pa.RecordBatch:
        *numbers, ids = zip(*rows, strict=True)
        columns = [pa.array(c, pa.int64()) for c in numbers]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
        return pa.RecordBatch.from_arrays(
            [*columns, lists, pa.array([part] * len(rows), pa.int32())], [*_NAMES, "part"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coders.get((vocabulary, pattern))
        if coder is None:  # a worker keeps it for its next tasks
            coder = _coders[vocabulary, pattern] = Coder(vocabulary, pattern)
        part = TaskContext.get().partitionId()
        packer = Packer(tiers, part << 40)
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for texts in tk.chunks(batch.column(1), CHUNK_BYTES):
                ids, ends = coder.chunk(texts)
                lo = 0
                for i, hi in enumerate(ends.tolist()):
                    packer.add(docs[texts.first + i], np.concatenate((ids[lo:hi], end)))
                    lo = hi
                if rows := packer.taken():
                    yield batch_of(rows, part)
        packer.pack()
        packer.pack(last=True)
        if rows := packer.taken():
            yield batch_of(rows, part)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, the
    tier and step group of its sequence, and the ids. A sequence is the ids of its pieces in the
    order of `offset`; what they lack of the tier's length is padding.

    `vocabulary` is the file of a byte-level vocabulary and `pattern` the pattern that goes with
    it. A null text counts as empty, and every document, also an empty one, ends with id 1.
    Special tokens written out in a text are ordinary text. Repeated rows are packed once each.
    Tasks pack what they read, so nothing but the finished rows is ever moved; sequence ids are
    unique but not dense, and are the same when a task runs again. The step group of a window is
    its number in its tier, over all tasks, divided by how many windows make STEP_IDS ids.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column))
    found = written(rows.mapInArrow(_packed(vocabulary, pattern, tuple(tiers)), _DDL))
    # one row per task and tier
    sums = found.groupBy("part", "tier").agg((F.max("tier_index") + 1).alias("n")).collect()
    parts: dict[int, dict[int, int]] = {}
    for r in sums:
        parts.setdefault(r["part"], {})[r["tier"]] = r["n"]
    before = offsets_of({p: tuple(n.get(t, 0) for t in tiers) for p, n in parts.items()})
    known = spark.createDataFrame(
        [(p, t, b) for p, all_before in before.items() for t, b in zip(tiers, all_before, strict=True)],
        "part int, tier bigint, windows_before bigint",
    )
    number = F.col("windows_before") + F.col("tier_index")
    step = F.floor(number * F.col("tier") / F.lit(STEP_IDS)).cast("bigint")
    return found.join(F.broadcast(known), ["part", "tier"]).select(
        *_NAMES[:8], step.alias("step_group"), "ids"
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        crcs = [zlib.crc32(one.values.to_numpy().astype("<u4").tobytes()) for one in lists]
        columns = [*batch.columns[:-1], pa.array(crcs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "ids_crc32"])


def digested(pieces: DataFrame) -> DataFrame:
    """`pieces` with the checksum of the ids in place of the ids."""
    names = [c for c in pieces.columns if c not in ("ids", "ids_crc32")]
    rows = pieces.select(*names, "ids")
    ddl = ", ".join(f"{c} bigint" for c in names) + ", ids_crc32 bigint"
    return rows.mapInArrow(_checksums, ddl).select([c for c in pieces.columns if c != "ids"])
