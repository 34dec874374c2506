"""Vectorised words, spans and hashes over the UTF-8 bytes of a batch of texts.

Words are `[^\\x20\\x09-\\x0D]+`. All six separators are single bytes that occur in no longer
UTF-8 sequence, so words can be found on bytes. Every function works on whole texts; texts are
only grouped into chunks so that the arrays stay small, and a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_128_digest

CHUNK_BYTES = 1 << 19
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@dataclass
class Texts:
    """A run of texts: `data` holds their bytes, text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Spans:
    """Byte spans in `Texts.data`, with the number of the text each lies in."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(where, dtype=np.int64, count=column.offset + n + 1)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The rows in order, in runs of about `limit` bytes; a longer text is a run of its own."""
    if len(column) == 0:
        return
    raw, offsets = bytes_of(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(offsets) - 1)
        data = raw[offsets[lo] : offsets[hi]]
        yield Texts(lo, data, offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def spans_of(texts: Texts, apart: np.ndarray) -> Spans:
    """Maximal runs of bytes that are not `apart`, within one text each."""
    n = len(texts.data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Spans(none, none, none)
    offsets = texts.offsets
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, apart[:-1]
    before[offsets[offsets < n]] = True
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, apart[1:]
    after[offsets[offsets > 0] - 1] = True
    inside = ~apart
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return Spans(start, end, np.searchsorted(offsets, start, "right") - 1)


def words(texts: Texts) -> Spans:
    return spans_of(texts, SPACE[texts.data])


def lines(texts: Texts) -> Spans:
    """The parts between line feeds; empty ones are left out, as they hold no word."""
    return spans_of(texts, texts.data == 0x0A)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers.get(which)
    if known is not None and len(known[0]) >= n:
        return known
    made = []
    for base in (int(BASES[which]), pow(int(BASES[which]), -1, 1 << 64)):
        table = np.full(n, base, dtype=np.uint64)
        table[:1] = 1
        made.append(np.cumprod(table, dtype=np.uint64))
    if n <= 2 * CHUNK_BYTES:
        _powers[which] = (made[0], made[1])
    return made[0], made[1]


def _prefix_sums(values: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    powers, inverse = _power_tables(len(values) + 1, which)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return sums, inverse


def span_values(texts: Texts, spans: Spans) -> pa.Array:
    """The bytes of every span. Spans must ascend and not overlap."""
    change = np.zeros(len(texts.data) + 1, dtype=np.int8)
    change[spans.start] += 1
    change[spans.end] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    ends = np.concatenate(([0], np.cumsum(spans.end - spans.start)))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(spans), [None, pa.py_buffer(ends), pa.py_buffer(texts.data[inside])]
    )


def span_classes(texts: Texts, spans: Spans) -> tuple[np.ndarray, pa.Array]:
    """A number for every span, the same for equal bytes and for no others, and the different
    values in the order of their numbers, which is that of their first spans."""
    coded = span_values(texts, spans).dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), coded.dictionary


def value_hashes(values: list[bytes]) -> np.ndarray:
    """The two halves of XXH3-128 of each value, as two rows."""
    digests = b"".join([xxh3_128_digest(value) for value in values])
    return np.frombuffer(digests, dtype=">u8").reshape(-1, 2).T.astype(np.uint64)


def span_hash_pairs(texts: Texts, spans: Spans) -> np.ndarray:
    """128 bits of hash of every span, as two rows. Each different value is hashed once."""
    number, values = span_classes(texts, spans)
    return value_hashes(values.to_pylist())[:, number]


def sequence_classes(number: np.ndarray, width: int) -> np.ndarray:
    """For every place with `width` numbers from there on, a number of the sequence: equal ones for
    equal sequences and for no others. Sequences of twice the length are pairs of shorter ones."""

    def pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        least = min(len(first), len(second))
        key = first[:least] * (int(second.max(initial=0)) + 1) + second[:least]
        return np.unique(key, return_inverse=True)[1]

    size, held = 1, number
    while 2 * size <= width:
        size, held = 2 * size, pairs(held, held[size:])
    return pairs(held, held[width - size :]) if size < width else held


def window_starts(doc: np.ndarray, width: int) -> np.ndarray:
    """The numbers of the words at which a window of `width` words of one text starts."""
    if len(doc) < width:
        return np.empty(0, np.int64)
    return np.flatnonzero(doc[width - 1 :] == doc[: len(doc) - width + 1])


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, which: int) -> np.ndarray:
    """A 64-bit hash of the `width` word hashes from each start, in their order.

    A polynomial modulo 2 ** 64. It is fit for short windows of random word hashes only: sequences
    of two values that mirror each other agree in the more low bits the longer they are.
    """
    sums, inverse = _prefix_sums(hashes, which)
    return mix((sums[starts + width] - sums[starts]) * inverse[starts])


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of `starts`."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def per_text(texts: Texts, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Number of spans, or sum of their weights, of each text."""
    found = np.bincount(doc, weights=weights, minlength=len(texts))
    return found.astype(np.int64)


def per_text_bytes(texts: Texts, marked: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    sums = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
    return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]


def expand(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... of all runs i, one run after the other."""
    total = int(length.sum())
    if total == 0:
        return np.empty(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(first - (ends - length), length)
