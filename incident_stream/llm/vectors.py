"""Vectors of floats as integers, in blocks of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Integers of up to this size keep sums and differences within 64 bits.
MOST = 1 << 61
# Integers below this are exact as doubles.
EXACT = 1 << 53


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector takes part: it is not null, holds no null and no component that is not
    finite, and none that, times `scale`, goes beyond MOST. An empty vector takes part."""
    held = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(MOST / scale)))
    return F.coalesce(held, F.lit(False))


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def integers(column: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """floor(scale * x) of every component, a row for each vector; shorter vectors are filled up
    with zeros to `width`, or to the longest of the column."""
    lengths = np.asarray(pc.list_value_length(column)).astype(np.int64)
    values = np.floor(np.asarray(column.flatten(), dtype=np.float64) * scale).astype(np.int64)
    most = int(lengths.max(initial=0))
    width = most if width is None else width
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    return out


def packed(numbers: np.ndarray) -> bytes:
    """Integers as bytes, in the smallest of three widths, which the first byte names."""
    most = int(np.abs(numbers).max(initial=0))
    kind = "i2" if most < 1 << 15 else "i4" if most < 1 << 31 else "i8"
    return kind[1].encode() + numbers.astype(f"<{kind}").tobytes()


def unpacked(data: bytes, rows: int) -> np.ndarray:
    """The matrix with so many rows that was packed."""
    flat = np.frombuffer(data, dtype=f"<i{chr(data[0])}", offset=1)
    return flat.reshape(rows, len(flat) // rows if rows else 0).astype(np.int64)


def listed(column: pa.Array) -> pa.Array:
    """All values of the column as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
