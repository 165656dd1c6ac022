import math

import numpy as np
import pytest
from stagefare.llm import op13_whitening as op
from stagefare.llm.queries import op13_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def brute(rows, components=16):
    """By the covariance's own eigenvectors, whole numbers in Python."""
    usable = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n = len(fit)
    sums = [sum(col) for col in zip(*fit, strict=True)]
    centred = np.array([[float(a * n - s) / n for a, s in zip(x, sums, strict=True)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in usable:
        y = np.array([float(a * n - s) / n for a, s in zip(x, sums, strict=True)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(min(components, len(values))):
            if values[k] > 1e-20 * values[0]:
                out[i, k + 1] = (n, deviation, float(y @ vectors[:, k]) / math.sqrt(values[k]), values[k] / values.sum())
    return out


def compare(got, want):
    assert len(got) == len(want)
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, whitened, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        sign = signs.setdefault(r.component, math.copysign(1, whitened * r.whitened))
        assert r.whitened == pytest.approx(sign * whitened, abs=1e-7)
        assert r.identity_error < 1e-9


def random_bidiagonals():
    r = np.random.default_rng(7)
    yield r.standard_normal(12), r.standard_normal(11)
    yield np.ones(9), np.zeros(8)
    yield np.array([1, 1, 1, 1, 1.0]), np.array([1, 1e-3, 1, 1.0])
    yield 10.0 ** -np.arange(12), 10.0 ** -np.arange(11)
    yield 10.0 ** np.arange(-8, 4), r.standard_normal(11)
    yield np.array([3.0, 0, 2, 1]), np.array([1.0, 2, 0])
    yield np.array([2.0, 1, 0]), np.array([1.0, 1])
    yield np.zeros(4), np.zeros(3)
    yield np.array([5.0]), np.zeros(0)
    yield r.standard_normal(120), r.standard_normal(119) * 1e-4
    yield np.ones(60), 0.5 * np.ones(59)


@pytest.mark.parametrize("diagonal,above", list(random_bidiagonals()))
def test_singular_values_and_vectors(diagonal, above):
    b = np.diag(diagonal) + np.diag(above, 1)
    want = np.linalg.svd(b, compute_uv=False)
    values = op.squared_singular_values(diagonal, above)
    assert np.sqrt(values) == pytest.approx(want, rel=1e-12, abs=1e-14 * max(want[0], 1e-300))
    kept, v, total = op.leading(diagonal, above, 16)
    assert kept == pytest.approx(values[: len(kept)], rel=1e-13) and total == pytest.approx(values.sum())
    assert np.abs(v.T @ v - np.eye(len(kept))).max(initial=0) < 1e-12
    assert np.abs(b.T @ (b @ v) - v * kept).max(initial=0) <= 1e-11 * values[0]


def test_small_singular_values_keep_their_digits():
    """Graded down to 1e-24 of the largest, each to full relative accuracy: the product of all is the determinant."""
    diagonal, above = 10.0 ** -np.arange(0, 25, 2.0), 0.5 * 10.0 ** -np.arange(0, 24, 2.0)
    values = op.squared_singular_values(diagonal, above)
    assert np.log(values).sum() == pytest.approx(2 * np.log(diagonal).sum(), rel=1e-14)


@pytest.mark.parametrize("rows,columns", [(50, 8), (5, 9), (1, 4), (30, 1)])
def test_triangle_to_directions(rows, columns):
    x = np.random.default_rng(rows).standard_normal((rows, columns))
    values, directions, total = op.principal(np.linalg.qr(x, mode="r"), 16)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert values == pytest.approx(s[: len(values)] ** 2, rel=1e-10) and total == pytest.approx((s**2).sum())
    assert np.abs(np.abs((vt[: len(values)] * directions.T).sum(axis=1)) - 1).max() < 1e-10


def odd_rows():
    r = np.random.default_rng(3)
    rows = [(k, r.standard_normal(6).tolist()) for k in range(60)]
    rows += [(60 + k, rows[5][1]) for k in range(40)]  # a third of all are copies
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [0.0] * 6)]
    return rows


def test_odd_vectors_match_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(i, v, 1, "clash", "clash") for i, v in rows], SCHEMA).repartition(5)
    want = brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    compare(op.whiten(df).collect(), want)


def test_merged_by_groups(spark, monkeypatch):
    monkeypatch.setattr(op, "FAN", 2)
    monkeypatch.setattr(op, "BLOCK", 7)
    rows = [(k, v) for k, v in odd_rows() if v and len(v) == 6 and k < 100]
    df = spark.createDataFrame([(i, v, 1, None, None) for i, v in rows], SCHEMA).repartition(9)
    compare(op.whiten(df).collect(), brute([(i, [float(np.float32(c)) for c in v]) for i, v in rows]))


def test_lengths_are_fitted_apart_and_equal_vectors_have_no_component(spark):
    r = np.random.default_rng(5)
    some = [(k, r.standard_normal(3).tolist()) for k in range(20)]
    other = [(100 + k, r.standard_normal(5).tolist()) for k in range(20)]
    same = [(200 + k, [1.0, 2.0]) for k in range(5)]
    df = spark.createDataFrame([(i, v) for i, v in some + other + same], "vec_id long, embedding array<double>")
    got = op.whiten(df).collect()
    want = brute(some) | brute(other)
    assert {(g.vec_id, g.component) for g in got} == set(want)
    for part in (some, other):
        compare([g for g in got if g.vec_id in dict(part)], brute(part))


def test_huge_entries_repeats_null_ids_and_no_rows(spark):
    rows = [(None, [1e300, 0.0]), (1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [-1e300, 3.0])]
    got = op.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 4  # beside the huge entries, the other dimension is below 1e-12
    assert all(g.n == 3 for g in got) and all(math.isfinite(g.whitened) for g in got)
    assert op.whiten(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []


def test_given_embeddings_match_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(op13_embedding_whitening(spark, sf_dir).collect(), brute([tuple(r) for r in rows]))
