"""Whitening of embeddings by a bidiagonal qd solver.

Every entry ``c`` becomes the whole number ``floor(64 * c) + 1000000``; the fit takes each distinct vector of these once.

1. Counts and sums of the distinct vectors are whole numbers, added exactly.
2. Blockwise QR: a task reduces its blocks of centred rows to one triangle R, and triangles are reduced again, FAN at a time,
   until one is left for each vector length. Its size is the vector's length squared, whatever the rows.
3. Householder reflections make R bidiagonal; its singular values come from the shifted quotient-difference
   iteration (dqds), which keeps their relative accuracy, and give the covariance's eigenvalues.
4. For each eigenvalue a twisted factorisation (a stationary and a progressive qd transform that meet
   where the remainder is least) gives the eigenvector of the bidiagonal's Gram matrix; equal or nearly equal
   eigenvalues are made orthogonal by inverse iteration. The reflections carry it back to a direction.
5. Rows are centred, projected and divided by the square root of the eigenvalue in one narrow pass.

What reaches the driver and is broadcast: for each vector length its means and directions, 17 numbers for each dimension.

Defined results: rows with a null or empty vector, or null or non-finite entries, are dropped; vectors of different lengths
are fitted apart; entries whose whole number would pass 2**62 count as 2**62 in size; a component whose singular value is
below 1e-12 of the largest is left out, so equal vectors alone give no rows; a deviation beyond a long is null; a null ``vec_id`` and
repeated rows keep their rows; no rows give no rows; other columns are ignored. The sign of a
direction is that which makes its largest entry positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runs import FAN, grouped
from .tables import materialize, ship_package

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Rows of a block that QR reduces, and of a block that is projected.
BLOCK = 2048
_LARGEST = 2.0**62
_FLAT = 1e-12
_EPS = np.finfo(float).eps


# -- the solver ---------------------------------------------------------------------


def bidiagonal(square: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``(diagonal, above, reflections)`` of a square matrix by Householder's method; reflections are the right-hand ones."""
    a = square.copy()
    n = len(a)
    reflections = []

    def reflector(x: np.ndarray) -> np.ndarray:
        """Unit ``v`` with which ``x - 2 v (v x)`` has nothing but a first entry; zero if it has so already."""
        v = x.copy()
        v[0] += math.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(v)
        return v / size if size > 0 and np.any(x[1:]) else np.zeros_like(v)

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 1:
            w = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            reflections.append(w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), reflections


def _sweep(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd transform with a shift: new ``q`` and ``e``, and the remainders ``d`` on the way."""
    d = q[0] - tau
    new_q, new_e, seen = [], [], [d]
    for i in range(len(e)):
        here = d + e[i]
        new_q.append(here)
        if e[i] == 0:
            new_e.append(0.0)
            d = q[i + 1] - tau
        else:
            ratio = q[i + 1] / here if here else math.inf
            new_e.append(e[i] * ratio)
            d = d * ratio - tau
        seen.append(d)
    new_q.append(d)
    return new_q, new_e, seen


def _of_two(q0: float, e0: float, q1: float) -> tuple[float, float]:
    """Both eigenvalues of a block of two, the smaller by their product, which loses no digits."""
    apart = q0 - q1 + e0
    large = (q0 + q1 + e0 + math.sqrt(apart * apart + 4 * q1 * e0)) / 2
    return large, q0 * (q1 / large) if large else 0.0


def _least_known(seen: list[float]) -> float:
    """A shift that stays below the least eigenvalue: ``1 / d`` are the diagonal of the inverse, whose trace bounds it."""
    if min(seen) <= 0:
        return 0.0
    return 1 / sum(1 / d for d in seen) * (1 - 4 * _EPS * len(seen))


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal's singular values by shifted dqds, largest first."""
    found: list[float] = []
    size = max([0.0, *np.abs(diagonal), *np.abs(above)])
    if not size:
        return np.zeros(len(diagonal))
    blocks = [([float(x) for x in (diagonal / size) ** 2], [float(x) for x in (above / size) ** 2], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            cut = next((i for i in range(len(e)) if e[i] <= _EPS**2 * (moved + min(q[i], q[i + 1]))), None)
            if cut is not None:
                blocks.append((q[cut + 1 :], e[cut + 1 :], moved))
                q, e = q[: cut + 1], e[:cut]
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if len(q) == 2:
                found += [x + moved for x in _of_two(q[0], e[0], q[1])]
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            plain = _sweep(q, e, 0.0)
            tau = _least_known(plain[2])
            shifted = _sweep(q, e, tau) if tau > _EPS * moved else plain
            if min(shifted[2]) < 0:  # rounding took the shift beyond the least eigenvalue
                tau, shifted = 0.0, plain
            q, e = shifted[:2]
            moved += tau if shifted is not plain else 0.0
    return np.sort(np.array(found))[::-1] * size * size


@dataclass
class Twisted:
    """A twisted factorisation of ``L D L' - value``: its multipliers, pivots, and where it is twisted."""

    upper: np.ndarray
    lower: np.ndarray
    pivots: np.ndarray
    at: int

    def vector(self) -> np.ndarray:
        n = len(self.pivots)
        z = np.zeros(n)
        z[self.at] = 1.0
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.upper[i] * z[i + 1]
        for i in range(self.at, n - 1):
            z[i + 1] = -self.lower[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, right: np.ndarray) -> np.ndarray:
        """The solution, scaled to length 1, of the factored matrix times ``z`` = ``right``."""
        n, y = len(right), right.copy()
        for i in range(self.at):
            y[i + 1] -= self.upper[i] * y[i]
        for i in range(n - 2, self.at - 1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        z = y / self.pivots
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.upper[i] * z[i + 1]
        for i in range(self.at, n - 1):
            z[i + 1] -= self.lower[i] * z[i]
        return z / np.linalg.norm(z)


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> Twisted:
    """Of the Gram matrix ``B' B = L D L'`` of a bidiagonal ``B`` less ``value``, twisted where its remainder is least."""
    n = len(diagonal)
    d, multiplier = diagonal**2, above / diagonal[:-1]
    tiny = _EPS * max(float(d.max()), value) * _EPS

    def sound(x: float) -> float:
        return x if abs(x) > tiny else math.copysign(tiny, x)

    s, p = np.zeros(n), np.zeros(n)
    upper, lower = np.zeros(n - 1), np.zeros(n - 1)
    down, up = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = sound(s[i] + d[i])
        upper[i] = d[i] * multiplier[i] / down[i]
        s[i + 1] = upper[i] * multiplier[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = sound(d[i] * multiplier[i] ** 2 + p[i + 1])
        ratio = d[i] / up[i + 1]
        lower[i] = multiplier[i] * ratio
        p[i] = p[i + 1] * ratio - value
    left = s + p + value
    at = int(np.argmin(np.abs(left)))
    pivots = np.concatenate([down[:at], [sound(left[at])], up[at + 1 :]])
    return Twisted(upper, lower, pivots, at)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors, as columns, of a block without zeros above its diagonal, for falling ``values``."""
    n = len(diagonal)
    if n == 1:
        return np.ones((1, len(values)))
    least = _EPS * max(np.abs(diagonal).max(), np.abs(above).max())
    diagonal = np.where(np.abs(diagonal) > least, diagonal, least)
    out = np.zeros((n, len(values)))
    first = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-6 * values[0]:
            first = k
        made = twisted(diagonal, above, value)
        z, known = made.vector(), out[:, first:k]
        rest = z - known @ (known.T @ z)
        if np.linalg.norm(rest) < 0.999:
            # A close neighbour has taken part of this vector: iterate on what is left.
            rest = np.random.default_rng(k).standard_normal(n)
            for _ in range(4):
                rest = rest - known @ (known.T @ rest)
                rest = made.solve(rest / np.linalg.norm(rest))
        for _ in range(2):
            rest = rest - known @ (known.T @ rest)
            rest = rest / np.linalg.norm(rest)
        out[:, k] = rest
    return out


def leading(diagonal: np.ndarray, above: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``(values, vectors, total)`` of a bidiagonal: leading squared singular values, right vectors, sum of all values.

    Zeros above the diagonal part it into blocks, each solved by itself, so equal values of two blocks do not meet.
    """
    n = len(diagonal)
    size = max([0.0, *np.abs(diagonal), *np.abs(above)])
    cuts = [0, *(np.flatnonzero(np.abs(above) <= _EPS * size) + 1).tolist(), n]
    found, total = [], 0.0
    for first, last in zip(cuts[:-1], cuts[1:], strict=True):
        part = diagonal[first:last], above[first : last - 1]
        values = squared_singular_values(*part)
        total += float(values.sum())
        found.append((first, last, part, values))
    every = np.sort(np.concatenate([v for *_, v in found]))[::-1]
    least = every[min(most, n) - 1]
    kept = [(first, last, part, v[(v >= least) & (v > _FLAT**2 * every[0])]) for first, last, part, v in found]
    values = np.concatenate([v for *_, v in kept])
    vectors = np.zeros((n, len(values)))
    at = 0
    for first, last, part, v in kept:
        vectors[first:last, at : at + len(v)] = _block_vectors(*part, v)
        at += len(v)
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[:, order], total


def principal(triangle: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``(values, directions, total)``: leading squared singular values of a triangle, right vectors, sum of all values."""
    n = triangle.shape[1]
    square = np.zeros((n, n))
    square[: len(triangle)] = triangle
    diagonal, above, reflections = bidiagonal(square)
    values, vectors, total = leading(diagonal, above, most)
    for k in range(len(reflections) - 1, -1, -1):
        w = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(w, w @ vectors[k + 1 :])
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(values))])
    return values, vectors * signs, total


# -- Spark steps --------------------------------------------------------------------


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as whole numbers."""
    for batch in batches:
        column = batch.column("embedding")
        rows = [r for r in range(batch.num_rows) if column[r].is_valid and len(v := column[r].values) and not v.null_count]
        if not rows:
            continue
        part = batch.take(pa.array(rows))
        lists = part.column("embedding")
        ends = np.cumsum([0, *(len(v.values) for v in lists)])
        with np.errstate(over="ignore", invalid="ignore"):
            flat = np.asarray(lists.flatten(), np.float64)
            x = np.clip(np.floor(SCALE * flat), -_LARGEST, _LARGEST)
        fine = np.add.reduceat(~np.isfinite(flat), ends[:-1]) == 0
        kept = np.repeat(fine, np.diff(ends))
        lengths = np.diff(ends)[fine]
        offsets = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
        whole = pa.ListArray.from_arrays(offsets, pa.array(x[kept].astype(np.int64) + SHIFT))
        yield pa.RecordBatch.from_arrays(
            [part.column("vec_id").filter(pa.array(fine)), pa.array(lengths.astype(np.int32)), whole], names=["vec_id", "length", "x"]
        )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Blocks of rows of one length, with their vectors as a matrix."""
    for batch in batches:
        lengths = np.asarray(batch.column("length"))
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            for k in range(0, len(own), BLOCK):
                part = batch.take(pa.array(own[k : k + BLOCK]))
                yield length, part, np.asarray(part.column("x").flatten(), np.int64).reshape(-1, length)


_HALF = np.int64(1 << 32)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and sums by length and dimension; sums in two halves, so that none overflows."""
    sums: dict[int, np.ndarray] = {}
    for length, _, x in _matrices(batches):
        high = x // _HALF
        found = np.stack([high.sum(axis=0), (x - high * _HALF).sum(axis=0), np.full(length, len(x))])
        sums[length] = sums.get(length, 0) + found
    for length, (high, low, n) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(length, length, np.int32)), pa.array(np.arange(length, dtype=np.int32)), *map(pa.array, (high, low, n))],
            names=["length", "dim", "high", "low", "n"],
        )


@dataclass(frozen=True)
class Centre:
    """Of one length: the number of fitted vectors, and whole and fractional parts of their means."""

    n: int
    whole: np.ndarray
    rest: np.ndarray  # the sums less n times ``whole``

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y = x - self.whole
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 1 << 62:
            return ((y * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = [sum((a * self.n - b) ** 2 for a, b in zip(row, self.rest.tolist(), strict=True)) for row in y.tolist()]
        return [total if total < 1 << 63 else None for total in exact]


def _centres(fit: DataFrame) -> dict[int, Centre]:
    """One entry for each vector length, of one number for each dimension."""
    rows = fit.mapInArrow(_added, "length int, dim int, high long, low long, n long")
    rows = rows.groupBy("length", "dim").agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")]).collect()
    held: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["length"], r["dim"])):
        held.setdefault(r["length"], []).append((r["high"] * int(_HALF) + r["low"], r["n"]))
    return {
        length: Centre(of[0][1], np.array([s // n for s, n in of], np.int64), np.array([s % n for s, n in of], np.int64))
        for length, of in held.items()
    }


def _stacked(above: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")


_TRIANGLE = "length int, task long, triangle array<double>"


def _triangle_rows(held: dict[int, np.ndarray], task: int) -> Iterator[pa.RecordBatch]:
    for length, r in held.items():
        yield pa.record_batch({
            "length": pa.array([length], pa.int32()), "task": pa.array([task], pa.int64()),
            "triangle": pa.array([r.ravel()], pa.list_(pa.float64())),
        })


def _reduced(centres):
    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One triangle of each length for a task's rows."""
        held: dict[int, np.ndarray] = {}
        for length, _, x in _matrices(batches):
            held[length] = _stacked(held.get(length), centres.value[length].centred(x))
        yield from _triangle_rows(held, TaskContext.get().partitionId())

    return reduced


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One triangle of each group's."""
    for rows in grouped(batches, "length", "slot"):
        held = None
        for row in sorted(rows, key=lambda r: r["task"]):
            held = _stacked(held, np.array(row["triangle"]).reshape(-1, row["length"]))
        yield from _triangle_rows({rows[0]["length"]: held}, rows[0]["task"])


_DIRECTIONS = "length int, vals array<double>, directions array<double>, total double"


def _solved(most: int):
    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, directions, total = principal(np.array(row["triangle"]).reshape(-1, row["length"]), most)
                kind = pa.list_(pa.float64())
                yield pa.record_batch({
                    "length": pa.array([row["length"]], pa.int32()), "vals": pa.array([values], kind),
                    "directions": pa.array([directions.ravel()], kind), "total": pa.array([total]),
                })

    return solved


@dataclass(frozen=True)
class Frame:
    """What whitens the vectors of one length."""

    centre: Centre
    values: np.ndarray
    directions: np.ndarray
    total: float

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ (self.directions * np.sqrt(self.centre.n / self.values))


def _moments(frames):
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of whitened entries and of their products over a task's fitted vectors, by length and pair of components."""
        held: dict[int, np.ndarray] = {}
        for length, _, x in _matrices(batches):
            white = frames.value[length].white(x)
            both = np.hstack([white, np.ones((len(x), 1))])
            held[length] = held.get(length, 0) + both.T @ both
        for length, sums in held.items():
            i, j = np.indices(sums.shape)
            yield pa.record_batch({
                "length": pa.array(np.full(sums.size, length, np.int32)), "i": pa.array(i.ravel()), "j": pa.array(j.ravel()), "s": pa.array(sums.ravel()),
            })

    return moments


_OUT = "vec_id long, length int, component int, n long, deviation long, whitened double, explained double"


def _projected(frames):
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, part, x in _matrices(batches):
            frame = frames.value[length]
            m = len(frame.values)
            white = frame.white(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), m))),
                    pa.array(np.full(len(x) * m, length, np.int32)),
                    pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * m, frame.centre.n, np.int64)),
                    pa.array([d for d in frame.centre.deviations(x) for _ in range(m)], pa.int64()),
                    pa.array(white.ravel()),
                    pa.array(np.tile(frame.values / frame.total if m else frame.values, len(x))),
                ],
                names=["vec_id", "length", "component", "n", "deviation", "whitened", "explained"],
            )

    return projected


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened entries of every usable row of ``embeddings(vec_id, embedding)``, a row for each component."""
    spark = embeddings.sparkSession
    ship_package(spark)
    given = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = given.mapInArrow(_whole, "vec_id long, length int, x array<long>")
    fit = materialize(rows.select("length", "x").distinct(), "whitening-fit")
    centres = _centres(fit)
    known = spark.sparkContext.broadcast(centres)
    triangles = materialize(fit.mapInArrow(_reduced(known), _TRIANGLE), "whitening-triangles")
    left = triangles.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    while left > 1:
        left = -(-left // FAN)
        dealt = triangles.withColumn("slot", F.pmod(F.xxhash64("task"), F.lit(left)))
        dealt = dealt.repartition("length", "slot").sortWithinPartitions("length", "slot")
        triangles = dealt.mapInArrow(_again, _TRIANGLE)
    solved = triangles.mapInArrow(_solved(components), _DIRECTIONS)
    # One row for each length of a vector, of COMPONENTS numbers for each dimension.
    frames = {
        r["length"]: Frame(centres[r["length"]], np.array(r["vals"]), np.array(r["directions"]).reshape(r["length"], -1), r["total"])
        for r in solved.toLocalIterator()
    }
    shared = spark.sparkContext.broadcast(frames)
    sums = fit.mapInArrow(_moments(shared), "length int, i long, j long, s double").groupBy("length", "i", "j").agg(F.sum("s").alias("s"))
    errors, moments = [], sums.collect()
    for length, frame in frames.items():
        m = len(frame.values)
        held = np.zeros((m + 1, m + 1))
        for r in moments:
            if r["length"] == length:
                held[r["i"], r["j"]] = r["s"]
        n = frame.centre.n
        spread = held[:m, :m] / n - np.outer(held[m, :m], held[m, :m]) / n**2
        errors.append((length, float(np.abs(spread - np.eye(m)).max(initial=0.0))))
    white = rows.mapInArrow(_projected(shared), _OUT)
    apart = spark.createDataFrame(errors, "length int, identity_error double")
    return white.join(F.broadcast(apart), "length").select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
