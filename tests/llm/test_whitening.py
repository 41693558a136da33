import math

import numpy as np
import pytest

from tidewatch.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n int, _x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x") for i, v in rows], SCHEMA)


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def test_counts_equal_eigenvalues():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        np.fill_diagonal(a, rng.choice([0.0, 1.0], d))  # zero diagonals ask for two by two pivots
        e = np.linalg.eigvalsh(a)
        for shift in np.r_[rng.uniform(e[0] - 1, e[-1] + 1, 20), (e[1:] + e[:-1]) / 2]:
            if np.abs(e - shift).min() > 1e-9:
                assert whitening.count_below(a, shift) == (e < shift).sum()


@pytest.mark.parametrize("spectrum", [
    np.arange(40, 0, -1.0), np.r_[np.full(5, 3.0), np.full(20, 1.0)], np.r_[9.0, 9.0 - 1e-9, 4, 4, 4, np.zeros(6)],
    10.0 ** -np.arange(12), np.ones(3)])
def test_leading_equals_dense_solver(spectrum):
    d = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((d, d)))[0]
    v = (q * spectrum) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.leading(v, 16)
    want = np.sort(spectrum[spectrum > 0])[::-1][:16]
    assert len(e) == min(16, (spectrum > 1e-13).sum()) and np.allclose(e, want[:len(e)], rtol=1e-9, atol=1e-13)
    assert (np.diff(e) <= 1e-12).all()
    assert np.allclose(v @ x, x * e, atol=1e-12 * spectrum.max())
    assert np.allclose(x.T @ x, np.eye(len(e)), atol=1e-5)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 20)) * np.linspace(3, 0.2, 20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(7, rows[9][1]), (None, rows[2][1])]
    bad = [(200, None), (201, [None] * 20), (202, [float("nan")] * 20), (203, [float("inf")] + [0.0] * 19), (204, []),
           (205, [1.0] * 5)]
    got = whitening.whiten(frame(spark, rows + bad)).collect()
    x = np.array(sorted({tuple(integers(v)) for _, v in rows}))
    n, s = len(x), x.sum(axis=0)
    v = np.cov(x.T.astype(float), bias=True)
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1][:16], vec[:, ::-1][:, :16]
    assert len(got) == 16 * len(rows)
    own = {}
    for r in got:
        assert r.n == n and 0 <= r.identity_error <= 1e-4
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) <= 1e-9
        own.setdefault(r.vec_id, []).append(r)
    sign = {}
    for i, vector in rows:
        xi = np.array(integers(vector))
        want = (xi - s / n) @ vec / np.sqrt(e)
        exact = sum((n * int(a) - int(b)) ** 2 for a, b in zip(xi, s))
        match = [r for r in own[i] if r.deviation == exact]
        assert len(match) >= 16
        for r in match[:16]:
            w = want[r.component - 1]
            turn = sign.setdefault(r.component, np.sign(w * r.whitened))
            assert abs(turn * r.whitened - w) < 1e-8


def test_no_component_without_spread(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in two) == [(1, 1, 2, 4096), (2, 1, 2, 4096)]
    assert sorted(round(r.whitened, 9) for r in two) == [-1, 1]


def test_huge_entries_and_long_sums(spark):
    rows = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(6)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.n for r in got} == {6} and {r.deviation for r in got} == {None}
    assert max(r.identity_error for r in got) <= 1e-4
