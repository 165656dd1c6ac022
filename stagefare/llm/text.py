"""Word arrays of Arrow string columns.

Words are the runs of bytes other than space and tab to carriage return. They are found
on the column's own UTF-8 buffer, so no text is decoded or split in Python; Arrow's
dictionary encoding then names each distinct word once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# A block holds at most this much text, or one document: it bounds the memory of a task.
BLOCK_BYTES = 2 << 20

# Workers live on between tasks: memory that Arrow frees should go back to the system.
pa.set_memory_pool(pa.system_memory_pool())

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

MASK64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one (shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def blocks(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each, or one row."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    first, total = 0, 0
    for row, n in enumerate(size.tolist()):
        if total and total + n > most:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += n
    if first < batch.num_rows:
        yield batch.slice(first)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row bounds in them; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """All words of a block: word ``i`` is ``vocabulary[codes[i]]``."""

    codes: np.ndarray
    vocabulary: list[bytes]
    bounds: np.ndarray  # row r has the words bounds[r] to bounds[r + 1]

    def names(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        digest = xxhash.xxh3_64_intdigest
        of_word = np.fromiter(map(digest, self.vocabulary), np.uint64, len(self.vocabulary))
        return of_word[self.codes] if len(self.codes) else np.zeros(0, np.uint64)


def words(column: pa.Array, lower: bool = False) -> Words:
    """Split a string column; ``lower`` maps A-Z to a-z first."""
    data, rows = utf8(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    starts = np.empty(len(data), dtype=bool)
    starts[:1] = inside[:1]
    starts[1:] = inside[1:] & ~inside[:-1]
    at_row = rows[:-1][rows[:-1] < len(data)]
    starts[at_row] = inside[at_row]
    first = np.flatnonzero(starts)
    letters = np.cumsum(inside, dtype=np.int64)
    offsets = np.empty(len(first) + 1, dtype=np.int32)
    offsets[:-1] = letters[first] - 1
    offsets[-1] = letters[-1] if len(data) else 0
    packed = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    )
    encoded = packed.dictionary_encode()
    return Words(
        np.asarray(encoded.indices),
        encoded.dictionary.to_pylist(),
        np.searchsorted(first, rows),
    )
