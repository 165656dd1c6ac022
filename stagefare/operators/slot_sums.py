"""What a tree on sparse one-hot vectors is made from: sums by node, slot and bin, in tasks that need no more than NumPy and Arrow."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Sums that a task holds at once, by node and slot; where there are more it gives those of each block of rows.
MOST_SUMS = 1 << 20
# Rows of such a block.
BLOCK = 1 << 18

_LONGS, _DOUBLES = ("at", "slot", "place", "bin", "n"), ("s", "q")
SUMS_SCHEMA = "at long, slot long, place long, bin long, n long, s double, q double"


def split_slots(numbers: list[int], bad_rows: str):
    """Rows ``y, v0, v1, ..., hot`` of rows ``y, size, indices, values``: label, numbers, and other slots that are not 0."""
    known = np.array(numbers, np.int64)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, y = batch.num_rows, batch.column("y").to_numpy(zero_copy_only=False)
            indices, values = batch.column("indices"), batch.column("values")
            if values.null_count or not np.isfinite(y).all():
                raise ValueError(bad_rows)
            lengths = np.diff(values.offsets.to_numpy()).astype(np.int64)
            of = np.repeat(np.arange(rows), lengths)
            value = values.flatten().to_numpy(zero_copy_only=False)
            # A dense vector has no indices, its values stand at theirs.
            slot = np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            sparse = np.asarray(indices.is_valid())[of] if rows else np.zeros(0, bool)
            slot[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
            columns = {"y": pa.array(y)}
            for k, i in enumerate(numbers):
                number, here = np.zeros(rows), slot == i
                number[of[here]] = value[here]
                columns[f"v{k}"] = pa.array(number)
            hot = (value != 0) & ~np.isin(slot, known)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of[hot], minlength=rows))]).astype(np.int32)
            columns["hot"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(slot[hot].astype(np.int32)))
            yield pa.record_batch(columns)

    return split


@dataclass
class Walk:
    """The nodes of a tree so far as arrays, and the place among a level's nodes of each that is in the level, else -1."""

    left: np.ndarray
    right: np.ndarray
    slot: np.ndarray
    place: np.ndarray
    edge: np.ndarray
    level: np.ndarray
    depth: int

    def nodes_of(self, bins: np.ndarray, hot: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The node that each row comes to, from its bins and its slots ``hot``, of the rows ``of``."""
        rows = np.arange(len(bins))
        at = np.zeros(len(bins), np.int64)
        for _ in range(self.depth):
            set_here = np.bincount(of[hot == self.slot[at][of]], minlength=len(at)) > 0
            place = self.place[at]
            below = bins[rows, place] <= self.edge[at] if bins.shape[1] else set_here
            goes_left = np.where(place >= 0, below, set_here == (self.edge[at] == 1))
            at = np.where(self.left[at] < 0, at, np.where(goes_left, self.left[at], self.right[at]))
        return at


def slot_sums(walk: Walk, numbers: list[int], cuts: list[list[float]], size: int, most: int = MOST_SUMS, block: int = BLOCK):
    """``at, slot, place, bin, n, s, q``: rows, labels and squared labels of each node of a level by slot and bin."""
    nodes, bins = int(walk.level.max()) + 1, max([1, *[len(c) + 1 for c in cuts]])

    def made(at, slot, place, bin_, sums) -> pa.RecordBatch:
        held = sums[0] > 0
        columns = [at, slot, place, bin_, sums[0]]
        longs = {c: pa.array(np.broadcast_to(x, held.shape)[held].astype(np.int64)) for c, x in zip(_LONGS, columns, strict=True)}
        return pa.record_batch(longs | {c: pa.array(x[held]) for c, x in zip(_DOUBLES, sums[1:], strict=True)})

    def of_slots(keys: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
        return made(keys // size, keys % size, np.int64(-1), np.int64(1), sums)

    def added(key: np.ndarray, y: np.ndarray, length: int) -> list[np.ndarray]:
        return [np.bincount(key, minlength=length).astype(float), np.bincount(key, y, length), np.bincount(key, y * y, length)]

    def read(batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        y = table.column("y").to_numpy()
        value = [table.column(f"v{k}").to_numpy() for k in range(len(numbers))]
        lists = table.column("hot").combine_chunks()
        of = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
        hot = lists.flatten().to_numpy().astype(np.int64)
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, value, strict=True)], axis=1) if cuts else np.zeros((len(y), 0), np.int64)
        at = walk.level[walk.nodes_of(binned, hot, of)]
        return y, binned, hot, of, at

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = nodes * size <= most
        by_bin = [[np.zeros(nodes * bins) for _ in range(3)] for _ in numbers]
        by_slot = [np.zeros(nodes * size) for _ in range(3)] if dense else []
        held: list[pa.RecordBatch] = []

        def add() -> pa.RecordBatch | None:
            y, binned, hot, of, at = read(held)
            held.clear()
            here = at >= 0
            for k in range(len(numbers)):
                for total, more in zip(by_bin[k], added((at * bins + binned[:, k])[here], y[here], nodes * bins), strict=True):
                    total += more
            of, hot = of[here[of]], hot[here[of]]
            keys = at[of] * size + hot
            if dense:
                for total, more in zip(by_slot, added(keys, y[of], nodes * size), strict=True):
                    total += more
                return None
            found, place = np.unique(keys, return_inverse=True)
            return of_slots(found, added(place, y[of], len(found)))

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block and (found := add()):
                yield found
        if any(b.num_rows for b in held) and (found := add()):
            yield found
        for k, slot in enumerate(numbers):
            places = np.arange(nodes * bins)
            yield made(places // bins, np.int64(slot), np.int64(k), places % bins, by_bin[k])
        if dense:
            yield of_slots(np.arange(nodes * size), by_slot)

    return summed
