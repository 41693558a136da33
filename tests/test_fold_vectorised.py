"""The block-vectorised steps equal the one-reading-at-a-time references,
including across state hand-overs (split runs)."""

import numpy as np
import pytest

from tidewatch.functions.folds import SpikeFilter, StuckDetector, TimestampRepair

SENSOR = ("x",)


def _values(rng, n, kind):
    if kind == "noise":
        return rng.normal(10, 3, n)
    if kind == "spiky":
        v = rng.normal(10, 1, n)
        v[rng.random(n) < 0.1] *= 3
        return v
    if kind == "steps":
        return np.repeat(rng.integers(-3, 4, n // 5 + 1).astype(float), 5)[:n]
    if kind in ("zeros", "negative", "mixed"):
        v = np.zeros(n) if kind == "zeros" else -np.abs(rng.normal(5, 1, n))
        if kind == "mixed":  # zero, negative and normal stretches, single values, NaN, infinities
            part = np.repeat(rng.integers(0, 3, n // 40 + 1), 40)[:n]
            v = np.where(part == 0, 0.0, np.where(part == 1, v, rng.normal(10, 1, n)))
            v[rng.random(n) < 0.01] = np.nan
            v[rng.random(n) < 0.005] = np.inf
        v[rng.random(n) < 0.02] = 7.0
        return v
    if kind == "nan":
        v = rng.normal(5, 2, n)
        v[rng.random(n) < 0.05] = np.nan
        return v
    return np.round(rng.normal(0, 1, n), 1)


def _stamps(rng, n, kind):
    base = np.arange(n, dtype=np.int64) * 1000 + rng.integers(0, 50, n)
    if kind == "jumps":
        base[rng.random(n) < 0.03] += 3_600_000
        base[rng.random(n) < 0.02] -= 3_600_000
    if kind == "stay":
        base[n // 3:] += 10_000_000
    if kind == "leaps":  # lasting jumps both ways, met again by the frozen clock
        base += np.repeat(rng.integers(-2, 3, n // 300 + 1), 300)[:n] * 40_000
    if kind == "regular":
        base = np.arange(n, dtype=np.int64) * 1000
        base[n // 4:] += 50_000
        base[n // 2:] -= 50_000
    if kind == "bursty":
        base = np.cumsum(rng.exponential(1000, n)).astype(np.int64)
    return base


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("kind", ["noise", "spiky", "steps", "nan", "round", "zeros", "negative", "mixed"])
def test_spikes_vectorised(seed, kind):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    v = _values(rng, n, kind)
    elig = rng.random(n) > 0.1
    fold = SpikeFilter(sensors=SENSOR)
    cut = int(rng.integers(0, n + 1))
    a1, s1 = fold.run({"x": v[:cut]}, elig[:cut], fold.init_state())
    a2, s2 = fold.run({"x": v[cut:]}, elig[cut:], s1)
    b, sb = fold.run_scalar({"x": v}, elig, fold.init_state())
    assert np.array_equal(np.concatenate((a1, a2)), b)
    assert np.array_equal(np.asarray(s2[0]), np.asarray(sb[0]), equal_nan=True)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("kind", ["plain", "jumps", "stay", "leaps", "regular", "bursty"])
def test_timestamps_vectorised(seed, kind):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    ts = _stamps(rng, n, kind)
    elig = rng.random(n) > 0.05
    fold = TimestampRepair()
    cut = int(rng.integers(0, n + 1))
    a1, s1 = fold.run(ts[:cut], elig[:cut], fold.init_state())
    a2, s2 = fold.run(ts[cut:], elig[cut:], s1)
    b, sb = fold.run_scalar(ts, elig, fold.init_state())
    assert np.array_equal(np.concatenate((a1, a2)), b)
    assert s2 == sb


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("kind", ["steps", "nan", "round"])
def test_stuck_vectorised(seed, kind):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    v = _values(rng, n, kind)
    ts = _stamps(rng, n, "jumps")
    elig = rng.random(n) > 0.1
    for d in (0, 3000, 120000):
        fold = StuckDetector(d, sensors=SENSOR)
        cut = int(rng.integers(0, n + 1))
        a1, s1 = fold.run(ts[:cut], {"x": v[:cut]}, elig[:cut], fold.init_state())
        a2, s2 = fold.run(ts[cut:], {"x": v[cut:]}, elig[cut:], s1)
        b, sb = fold.run_scalar(ts, {"x": v}, elig, fold.init_state())
        assert np.array_equal(np.concatenate((a1, a2)), b)
        assert (s2[0] is None) == (sb[0] is None)
        if sb[0] is not None:
            assert s2[0][1] == sb[0][1]
            assert s2[0][0] == sb[0][0] or (np.isnan(s2[0][0]) and np.isnan(sb[0][0]))
