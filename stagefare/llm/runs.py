"""Runs: bounded stretches of a task's documents, whose sorted keys go to key partitions and come back answered.

A run is a row per key partition with its distinct keys, packed; a row stays small whatever the corpus holds,
so a hot key or document is one entry of each run. Rows of one key partition are merged by groups of FAN rows,
again and again until one row is left, so a task holds FAN rows at most however many runs there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key partition that a task merges at a time.
FAN = 256


def pack(values: np.ndarray) -> bytes:
    """An array as zstd of its byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64), dtype=np.uint64)


def first_run() -> int:
    """The number of a task's first run; a task has fewer than 2**24 runs."""
    return TaskContext.get().partitionId() << 24


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = distinct(keys)
    return keys[starts], np.add.reduceat(counts, starts)


def distinct(ordered: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array first stands."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Summed counts of several lists of sorted distinct keys."""
    keys = np.sort(np.concatenate([k for k, _ in pieces]))
    keys = keys[distinct(keys)]
    counts = np.zeros(len(keys), pieces[0][1].dtype)
    for own, held in pieces:
        counts[np.searchsorted(keys, own)] += held
    return keys, counts


def grouped(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[list[dict]]:
    """The rows of each group, of rows sorted by ``by``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[c] != held[0][c] for c in by):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def merge_rows(rows: DataFrame, part: str, run: str, merge: Callable, schema: str, runs: int) -> DataFrame:
    """One row per ``part``: ``merge`` turns batches sorted by ``(part, slot)`` into a row per group.

    ``merge`` and ``rows`` share the columns of ``schema``, which include ``part`` and ``run``.
    """
    def level(df: DataFrame, slots: int) -> DataFrame:
        slot = F.pmod(F.xxhash64(run), F.lit(slots)).alias("slot")
        dealt = df.select("*", slot).repartition(part, "slot").sortWithinPartitions(part, "slot", run)
        return dealt.mapInArrow(merge, schema)

    while runs > FAN:
        runs = -(-runs // FAN)
        rows = level(rows, runs)
    return level(rows, 1)
