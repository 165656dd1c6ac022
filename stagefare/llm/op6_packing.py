"""Hierarchical packing into context windows of several lengths.

Tiers have windows of 256, 512, 1024 and 2048 ids. A document first fills as many whole
windows of 2048 as it can; what is left is routed to the smallest tier that holds it. Tiers
are packed from the longest down: a remainder opens a window of its tier, and the gap is filled
from shorter remainders, the largest that fits first; if none fits, the smallest one, or else
one of the window's own tier, is cut, and its rest is routed again. A window is only closed when it is full, so windows need
no padding; what cannot be filled waits for the next block of documents. At the end of a task's
documents, what is left is poured into windows of 2048, of which the last is padded: less than
one window of padding for each task.

Tasks pack the documents that they read, in blocks of bounded text: no shuffle, no state
between blocks but less than one window of remainders, and a lost task packs the same again.
``step`` numbers the groups of windows of one tier that a training step takes: all full groups
hold the same number of ids, STEP_IDS.

Defined results: a null text counts as empty, and an empty one is one piece, its end id alone; rows repeating
a ``doc_id``, or with a null one, are packed like any others; no rows give no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tables import texts
from .tokens import encoded_blocks

TIERS = (256, 512, 1024, 2048)
LONGEST = TIERS[-1]
STEP_IDS = 16 * LONGEST
END_ID = 1

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, tier int, step long, ids array<int>"
)

# A piece: the number of its document in the block, where it starts there, and its length.
Piece = tuple[int, int, int]


class _Pool:
    """Remainders shorter than a window, by length."""

    def __init__(self) -> None:
        self.by_length: list[list[Piece]] = [[] for _ in range(LONGEST)]
        self.present = 0  # bit n is set if there are pieces of length n

    def add(self, piece: Piece) -> None:
        self.by_length[piece[2]].append(piece)
        self.present |= 1 << piece[2]

    def _take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.present &= ~(1 << length)
        return piece

    def largest(self, most: int) -> Piece | None:
        found = (self.present & ((2 << most) - 1)).bit_length() - 1
        return self._take(found) if found > 0 else None

    def smallest(self, most: int) -> Piece | None:
        found = self.present & ((2 << most) - 1)
        return self._take((found & -found).bit_length() - 1) if found else None


def fill(pool: _Pool, window: list[Piece], gap: int, most: int) -> int:
    """Fill a window's gap from pieces up to ``most`` long, cutting one if need be; what stays open."""
    while gap:
        piece = pool.largest(min(gap, most))
        if piece is None:
            # Cut a shorter one if there is any, else one of the window's own tier.
            piece = pool.smallest(most) or pool.smallest(LONGEST - 1)
            if piece is None:
                return gap
            if piece[2] <= gap:
                window.append(piece)
                gap -= piece[2]
                continue
            key, start, length = piece
            pool.add((key, start + gap, length - gap))
            piece = (key, start, gap)
        window.append(piece)
        gap -= piece[2]
    return 0


def pack_block(pieces: list[Piece]) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of all tiers, and the pieces that wait."""
    windows, pool, waiting = [], _Pool(), []
    for key, start, length in pieces:
        whole = length // LONGEST
        windows.extend([(key, start + k * LONGEST, LONGEST)] for k in range(whole))
        if length % LONGEST:
            pool.add((key, start + whole * LONGEST, length % LONGEST))
    for tier in reversed(TIERS):
        shorter = tier // 2 if tier > TIERS[0] else 0
        while pool.present >> (shorter + 1):
            first = pool.largest(tier)
            window = [first]
            if fill(pool, window, tier - first[2], shorter or tier):
                waiting = window  # nothing is left to fill it with
            else:
                windows.append(window)
    return windows, waiting


def pour(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows of the longest tier holding all pieces; only the last may be short."""
    windows, gap = [], 0
    for key, start, length in pieces:
        while length:
            if not gap:
                windows.append([])
                gap = LONGEST
            part = min(gap, length)
            windows[-1].append((key, start, part))
            start, length, gap = start + part, length - part, gap - part
    return windows


class _Packer:
    """Packs the blocks of one task and makes the rows of finished windows."""

    def __init__(self, task: int, with_ids: bool) -> None:
        self.base, self.with_ids = task << 36, with_ids
        self.sequences, self.of_tier = 0, dict.fromkeys(TIERS, 0)
        self.waiting: list[tuple] = []  # (doc_id, doc_tokens, start, ids)

    def _rows(self, windows: list[list[Piece]], docs: list[tuple]) -> pa.RecordBatch:
        """``docs``: by key, the id, the number of ids, the start of the ids held, and these."""
        columns: list[list] = [[] for _ in range(9)]
        kept: list[np.ndarray] = []
        for window in windows:
            used = sum(p[2] for p in window)
            tier = used if used in TIERS else LONGEST
            count = self.of_tier[tier]
            self.of_tier[tier] += 1
            step = self.base + (TIERS.index(tier) << 32) + count // (STEP_IDS // tier)
            offset = 0
            for key, start, length in window:
                doc_id, total, held, ids = docs[key]
                part = ids[start : start + length]
                row = (doc_id, held + start, length, zlib.crc32(part), total, self.base + self.sequences, offset, tier, step)
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                if self.with_ids:
                    kept.append(part)
                offset += length
            self.sequences += 1
        kinds = [*[pa.int64()] * 7, pa.int32(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        if self.with_ids:
            ends = np.cumsum([0, *map(len, kept)], dtype=np.int32)
            flat = np.concatenate([*kept, np.zeros(0, np.uint32)]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
        else:
            arrays.append(pa.nulls(len(columns[0]), pa.list_(pa.int32())))
        names = [part.split()[0] for part in SCHEMA.split(",")]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def add(self, doc_ids: list, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        docs = list(self.waiting)
        for doc_id, a, b in zip(doc_ids, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            docs.append((doc_id, b - a, 0, ids[a:b]))
        windows, waiting = pack_block([(k, 0, len(d[3])) for k, d in enumerate(docs)])
        rows = self._rows(windows, docs)
        self.waiting = [
            (docs[k][0], docs[k][1], docs[k][2] + start, docs[k][3][start : start + length].copy())
            for k, start, length in waiting
        ]
        return rows

    def finish(self) -> pa.RecordBatch:
        return self._rows(pour([(k, 0, len(d[3])) for k, d in enumerate(self.waiting)]), self.waiting)


def pack(docs: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per piece of ``documents(doc_id, text)``, see SCHEMA; ``ids`` only if asked for.

    ``tier`` is the length that the piece's sequence is padded to.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), with_ids)
        for block, ids, bounds in encoded_blocks(batches, END_ID):
            yield packer.add(block.column("doc_id").to_pylist(), ids, bounds)
        yield packer.finish()

    return texts(docs).mapInArrow(packed, SCHEMA)
