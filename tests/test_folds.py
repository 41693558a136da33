"""Hand-traced cases of the step functions (no Spark)."""

import math

import numpy as np
import pytest

from tidewatch.functions.folds import SpikeFilter, StuckDetector, TimestampRepair, java_mean

NAN = float("nan")


def repair(stamps, rejected=None):
    fold = TimestampRepair()
    ts = np.array(stamps, dtype=np.int64)
    elig = ~np.array(rejected if rejected else [False] * len(stamps))
    out, _ = fold.run(ts, elig, fold.init_state())
    return out.tolist()


BASE = [i * 1000 for i in range(10)]


@pytest.mark.parametrize("tail,expected", [
    ([11000], [11000]),                      # gap exactly 2x is kept
    ([11001], [10000]),                      # gap above 2x
    ([7000], [7000]),                        # backward by exactly 2x
    ([6999], [10000]),                       # backward above 2x
    ([30000, 11000], [10000, 11000]),        # one jump, then back
    ([30000, 31000, 32000, 33000], [10000, 11000, 12000, 13000]),  # jump that stays
])
def test_repair_timestamps_cases(tail, expected):
    assert repair(BASE + tail)[10:] == expected


def test_repair_average_zero_freezes():
    assert repair([5000] * 10 + [5001, 6000, 5000])[10:] == [5000, 5000, 5000]


def test_repair_integer_average():
    first = list(range(9)) + [10]            # gaps sum 10 -> 10 // 9 = 1
    assert repair(first + [12])[10:] == [12]
    assert repair(first + [13])[10:] == [11]


def test_repair_fewer_than_window_unchanged():
    stamps = [0, 100000, 5, 999999, 3]
    assert repair(stamps) == stamps


def test_repair_rejected_rows_pass_and_keep_state():
    stamps = BASE + [99999999, 11000]
    out = repair(stamps, rejected=[False] * 10 + [True, False])
    assert out[10:] == [99999999, 11000]


def test_repair_state_carries_across_runs():
    fold = TimestampRepair()
    ts = np.array(BASE + [30000, 31000], dtype=np.int64)
    whole, _ = fold.run(ts, np.ones(len(ts), bool), [])
    a, st = fold.run(ts[:7], np.ones(7, bool), [])
    b, _ = fold.run(ts[7:], np.ones(len(ts) - 7, bool), st)
    assert whole.tolist() == a.tolist() + b.tolist()


def spikes(values, eligible=None):
    fold = SpikeFilter(sensors=("co",))
    v = np.array(values, dtype=float)
    elig = np.array(eligible if eligible else [True] * len(values))
    out, state = fold.run({"co": v}, elig, fold.init_state())
    return out.tolist(), state


@pytest.mark.parametrize("values,expected", [
    ([5], [False]),
    ([0, 0, 0], [True, True, True]),
    ([-5, -5], [True, True]),
    ([1, 3], [False, True]),
    ([1, 2.9], [False, False]),
    ([3, 1], [False, True]),
    ([10, NAN, 100], [False, False, False]),
])
def test_spike_cases(values, expected):
    assert spikes(values)[0] == expected


def test_spike_window_shrinks_after_spike():
    flags, state = spikes([10.0] * 10 + [100, 100, 10, 10])
    assert flags[10:] == [True, True, False, False]
    assert len(state[0]) == 10
    _, state9 = spikes([10.0] * 10 + [100])
    assert len(state9[0]) == 9


def test_spike_skips_ineligible():
    flags, state = spikes([1, 100, 1], eligible=[True, False, True])
    assert flags == [False, False, False]
    assert state[0] == [1.0, 1.0]


def test_java_mean_is_compensated():
    vals = [0.1] * 10
    assert java_mean(vals) == math.fsum(vals) / 10


def stuck(rows, eligible=None, d=120000):
    fold = StuckDetector(d, sensors=("temp",))
    ts = np.array([r[0] for r in rows], dtype=np.int64)
    v = np.array([r[1] for r in rows], dtype=float)
    elig = np.array(eligible if eligible else [True] * len(rows))
    out, _ = fold.run(ts, {"temp": v}, elig, fold.init_state())
    return out.tolist()


def test_stuck_cases():
    rows = [(0, 21.5), (60000, 21.5), (119999, 21.5), (120000, 21.5), (180000, 22), (300000, 22)]
    assert stuck(rows) == [False, False, False, True, False, True]
    assert stuck([(0, 1), (60000, 2), (120000, 1)], [True, False, True]) == [False, False, True]
    assert stuck([(0, 1), (60000, 2), (120000, 1)]) == [False, False, False]
    assert stuck([(0, NAN), (200000, NAN)]) == [False, False]
    assert stuck([(100000, 1), (0, 1), (220000, 1)]) == [False, False, True]
