"""What boosted trees of depth 1 or 2 are made from: sums over pairs of bins, in tasks that need no more than NumPy and Arrow."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

# Binned rows that are added up at a time.
BLOCK = 10_000


@dataclass
class Node:
    """Rows, sum and sum of squares of what a tree is fitted to; ``feature`` is -1 at a leaf, else bins up to ``edge`` go left."""

    n: float
    total: float
    squares: float = 0.0
    feature: int = -1
    edge: int = -1
    gain: float = -1.0
    children: list[Node] = field(default_factory=list)

    @property
    def mean(self) -> float:
        return self.total / self.n

    @property
    def impurity(self) -> float:
        return max(0.0, (self.squares - self.total * self.total / self.n) / self.n)

    def leaves(self) -> list[Node]:
        return [leaf for c in self.children for leaf in c.leaves()] if self.children else [self]

    def hold(self, squares: list[float]) -> None:
        """Take the sums of squares that the leaves hold."""
        for leaf, q in zip(self.leaves(), squares, strict=True):
            leaf.squares = q
        for node in (*self.children, self):
            if node.children:
                node.squares = sum(leaf.squares for leaf in node.leaves())


@dataclass
class Plan:
    """Features and bins of each, and the pairs of features whose sums are kept."""

    features: int
    bins: int

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return list(itertools.combinations(range(self.features), 2))


class Tables:
    """What the trees so far predict, as a table of bins for each feature and each pair that a tree splits by."""

    def __init__(self, plan: Plan):
        self.plan = plan
        self.one = np.zeros((plan.features, plan.bins))
        self.two: dict[tuple[int, int], np.ndarray] = {}

    def add(self, root: Node, weight: float) -> None:
        bins = np.arange(self.plan.bins)
        if not root.children:
            self.one[0] += weight * root.mean
            return
        for child, here in zip(root.children, (bins <= root.edge, bins > root.edge), strict=True):
            if not child.children:
                self.one[root.feature] += weight * child.mean * here
                continue
            values = weight * np.where(bins <= child.edge, child.children[0].mean, child.children[1].mean)
            if child.feature == root.feature:
                self.one[root.feature] += values * here
                continue
            pair = tuple(sorted((root.feature, child.feature)))
            made = np.outer(here, values) if root.feature < child.feature else np.outer(values, here)
            self.two[pair] = self.two.get(pair, 0.0) + made

    def of(self, at: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(at[0]))
        for f, table in enumerate(self.one):
            if table.any():
                out += table[at[f]]
        for (f, g), table in self.two.items():
            out += table.ravel()[at[f] * self.plan.bins + at[g]]
        return out


def leaf_of(root: Node, at: list[np.ndarray]) -> np.ndarray:
    """The place among the tree's leaves of each row."""
    if not root.children:
        return np.zeros(len(at[0]), np.intp)
    left, right = (leaf_of(c, at) for c in root.children)
    return np.where(at[root.feature] <= root.edge, left, right + len(root.children[0].leaves()))


def binned_rows(cuts: list[list[float]], bad_rows: str):
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Labels and the bins of each row, a byte for each feature, eight to a word."""
        words = -(-len(cuts) // 8)
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            vectors = batch.column("v")
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            if vectors.null_count or len(values) != len(cuts) * len(y) or not np.isfinite(y).all() or np.isnan(values).any():
                raise ValueError(bad_rows)
            values = values.reshape(len(y), len(cuts))
            places = np.zeros((len(y), 8 * words), np.uint8)
            for i, cut in enumerate(cuts):
                places[:, i] = np.searchsorted(cut, values[:, i], side="left")
            columns = {f"w{k}": pa.array(places[:, 8 * k : 8 * k + 8].copy().view(np.int64).ravel()) for k in range(words)}
            yield pa.record_batch({"y": pa.array(y), **columns})

    return binned


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches as one row each, a column's numbers as they stand in memory: rows one by one take longer to read than to add up."""
    for batch in batches:
        if batch.num_rows:
            yield pa.record_batch({c: pa.array([batch.column(c).to_numpy().tobytes()], pa.binary()) for c in batch.schema.names})


def no_sums(plan: Plan, last: Node | None, labels: bool) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.zeros((2 if labels else 1, max(1, len(plan.pairs)), plan.bins**2))
    return pairs, np.zeros(len(last.leaves()) if last else 0)


def pair_sums(plan: Plan, tables: Tables | None, last: Node | None, weight: float, whole: bool):
    """Over packed rows, by pair of bins, sums of the errors that ``tables`` and ``weight`` times the tree ``last`` leave; squared errors
    before ``last`` in its leaves.

    Without ``tables`` the sums are of labels, and of numbers of rows. Those of pairs only if ``whole``.
    """
    means = weight * np.array([leaf.mean for leaf in last.leaves()]) if last else None

    def add(pairs: np.ndarray, squares: np.ndarray, codes: np.ndarray, n: np.ndarray, s: np.ndarray, q: np.ndarray) -> None:
        places = codes.view(np.uint8)
        at = [places[:, i].astype(np.intp) for i in range(plan.features)]
        errors = s
        if last is not None:
            value, leaf = (tables.of(at) if tables else 0.0), leaf_of(last, at)
            # The first tree is fitted to the labels, the others to twice the errors.
            held = 4.0 * (q - 2.0 * value * s + n * value * value) if tables else q
            squares += np.bincount(leaf, np.maximum(held, 0.0), len(squares))
            errors = 2.0 * (s - n * (value + means[leaf]))
        if not whole:
            return
        for k, (i, j) in enumerate(plan.pairs):
            place = at[i] * plan.bins + at[j]
            pairs[0, k] += np.bincount(place, errors, plan.bins**2)
            if last is None:
                pairs[1, k] += np.bincount(place, n, plan.bins**2)
        if not plan.pairs:
            pairs[0, 0, : plan.bins] += np.bincount(at[0], errors, plan.bins)
            if last is None:
                pairs[1, 0, : plan.bins] += np.bincount(at[0], n, plan.bins)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, squares = no_sums(plan, last, last is None)
        for batch in batches:
            words = sorted(c for c in batch.schema.names if c[0] == "w")
            for row in range(batch.num_rows):
                read = {c: batch.column(c)[row].as_buffer() for c in batch.schema.names}
                codes = np.stack([np.frombuffer(read[c], np.int64) for c in words], axis=1)
                n = np.frombuffer(read["n"], np.int64).astype(np.float64)
                s, q = np.frombuffer(read["s"]), np.frombuffer(read["q"])
                for k in range(0, len(n), BLOCK):
                    part = slice(k, k + BLOCK)
                    add(pairs, squares, codes[part], n[part], s[part], q[part])
        yield pa.record_batch({"pairs": pa.array([pairs.tobytes()], pa.binary()), "squares": pa.array([squares.tobytes()], pa.binary())})

    return summed
