"""Per-device step functions of the order-dependent cleaning rules.

Each rule is a small class with ``init_state()`` and ``run(arrays, state)``:
``run`` consumes the readings of ONE device in arrival order (numpy arrays) and
returns the per-row result together with the new state. Batch passes
(``mapInPandas`` over device-sorted partitions) and the streaming state
processor call the very same code, so batch and stream agree by construction.

States are plain Python lists so they can be stored as Spark state rows.
"""

from __future__ import annotations

import math
from collections import deque

import numpy as np

from ..schema import (SENSORS, SPIKE_THRESHOLD, SPIKE_WINDOW, STUCK_DURATION_MS,
                      TS_RATIO, TS_WINDOW)

# rows looked ahead in a stretch where every row is repaired or a spike: few at
# first, more while the stretch lasts
_MIN_BLOCK = 32
_MAX_BLOCK = 4096
_STRETCH = 4  # spikes in a row before looking ahead


def _evenly_spaced(stamps, gap: int) -> bool:
    last = stamps[-1]
    return all(x == last - gap * i for i, x in enumerate(reversed(stamps)))


class TimestampRepair:
    """W1: a stamp whose distance to the last kept stamp exceeds
    ``ratio`` x the mean gap of the last ``window`` kept stamps is replaced by
    last + mean gap. The replaced stamp is what enters the window (so a jump
    that never comes back keeps being replaced). The mean gap is the integer
    quotient sum(|gaps|) // (window - 1); fewer than ``window`` stamps -> the
    stamp is kept."""

    def __init__(self, window: int = TS_WINDOW, ratio: float = TS_RATIO):
        self.window, self.ratio = int(window), float(ratio)

    def init_state(self) -> list[int]:
        return []

    def run(self, ts: np.ndarray, eligible: np.ndarray, state: list[int]):
        """Vectorised. A stamp's verdict depends on the last ``window`` kept
        stamps only, so verdicts computed for all rows at once on the raw
        stamps (running sums of the gaps) are exact up to the first bad stamp
        and again from ``window`` rows after the last repaired one; only the
        rows in between are walked one by one. Same integer arithmetic."""
        window, ratio = self.window, self.ratio
        out = ts.astype(np.int64, copy=True)
        idx = np.flatnonzero(eligible)
        n = len(idx)
        win = [int(x) for x in state][-window:]
        if n == 0:
            return out, win
        t = out[idx]
        size = len(win)
        a = np.concatenate((np.asarray(win, dtype=np.int64), t))
        cs = np.concatenate(([0], np.cumsum(np.abs(np.diff(a)))))
        pos = size + np.arange(n)
        full = pos >= window
        hi = np.maximum(pos - 1, 0)
        lo = np.maximum(pos - window, 0)
        avg = np.where(full, cs[hi] - cs[lo], 0) // (window - 1)
        bad = full & (np.abs(t - a[hi]) > ratio * avg)
        cand = np.flatnonzero(bad).tolist()
        res = t.copy()
        clean_from = 0
        for p in cand:
            if p < clean_from:
                continue
            # rows before p agree with the raw-stamp assumption; p is bad
            recent = deque(a[size + p - window:size + p].tolist(), maxlen=window)
            gap_sum = sum(abs(y - x) for x, y in zip(list(recent)[:-1], list(recent)[1:]))
            last_fix, k, fixed, block = p, p, 0, _MIN_BLOCK
            while k < n and k <= last_fix + window:
                avg_k = gap_sum // (window - 1)
                if fixed >= window and _evenly_spaced(recent, avg_k):
                    # a frozen clock: the kept stamps go on in equal steps, so
                    # all rows up to the first one in range are known at once
                    before = recent[-1] + avg_k * np.arange(min(block, n - k), dtype=np.int64)
                    far = np.abs(t[k:k + len(before)] - before) > ratio * avg_k
                    stop = len(far) if far.all() else int(far.argmin())
                    if stop:
                        res[k:k + stop] = before[:stop] + avg_k
                        recent = deque((x + avg_k * stop for x in recent), maxlen=window)
                        k += stop
                        last_fix = k - 1
                    if stop == len(far):
                        block = min(2 * block, _MAX_BLOCK)
                        continue
                    block = _MIN_BLOCK
                x = int(t[k])
                fixed += 1
                if abs(x - recent[-1]) > ratio * avg_k:
                    x = recent[-1] + avg_k
                    last_fix = k
                else:
                    fixed = 0
                res[k] = x
                gap_sum += abs(x - recent[-1]) - abs(recent[1] - recent[0])
                recent.append(x)
                k += 1
            clean_from = k
        out[idx] = res
        return out, (win + res.tolist())[-window:]

    def run_scalar(self, ts: np.ndarray, eligible: np.ndarray, state: list[int]):
        """Reference: one reading at a time."""
        window, ratio = self.window, self.ratio
        win = deque(state, maxlen=window)
        gaps = deque((abs(b - a) for a, b in zip(list(win)[:-1], list(win)[1:])), maxlen=window)
        gap_sum = sum(gaps)
        out = ts.astype(np.int64, copy=True)
        ts_list = ts.tolist()
        elig = eligible.tolist()
        for i, t in enumerate(ts_list):
            if not elig[i]:
                continue
            if len(win) >= window:
                last = win[-1]
                avg = gap_sum // (window - 1)
                if abs(t - last) > ratio * avg:
                    t = last + avg
                    out[i] = t
                # the oldest stamp leaves: its gap leaves the sum
                gap_sum -= gaps.popleft()
            if win:
                g = abs(t - win[-1])
                gaps.append(g)
                gap_sum += g
            win.append(t)
        return out, list(win)


def java_mean(values) -> float:
    """Mean as a sequential Java double stream computes it: Kahan-compensated
    sum (compensation subtracted at the end) divided by the count."""
    s = 0.0
    c = 0.0
    simple = 0.0
    for x in values:
        y = x - c
        t = s + y
        c = (t - s) - y
        s = t
        simple += x
    total = s - c
    if math.isnan(total) and math.isinf(simple):
        total = simple
    return total / len(values)


def spikes_against(accepted, vals: np.ndarray, thr: float) -> np.ndarray:
    """W2's verdict on each of ``vals``, every one of them met by the same
    ``accepted`` values (the compensated sum of ``java_mean``, its last step
    taken for all values at once)."""
    s = c = simple = 0.0
    for x in accepted:
        y = x - c
        t = s + y
        c = (t - s) - y
        s = t
        simple += x
    with np.errstate(invalid="ignore", over="ignore"):
        y = vals - c
        t = s + y
        total = t - ((t - s) - y)
        simple = simple + vals
        total = np.where(np.isnan(total) & np.isinf(simple), simple, total)
        mean = total / (len(accepted) + 1)
        return (vals >= mean + mean * thr) | (vals <= mean - mean * thr)


class SpikeFilter:
    """W2: per sensor a window of up to ``window`` accepted values. For an
    eligible reading: drop the oldest if full, append the value, take the mean
    m (including the value); the value is a spike iff v >= m + m*t or
    v <= m - m*t, and then it leaves the window again. Any spiking sensor
    marks the reading suspicious. All five sensors are updated every time."""

    def __init__(self, window: int = SPIKE_WINDOW, threshold: float = SPIKE_THRESHOLD,
                 sensors=SENSORS):
        self.window, self.threshold, self.sensors = int(window), float(threshold), tuple(sensors)

    def init_state(self) -> list[list[float]]:
        return [[] for _ in self.sensors]

    def run(self, values: dict[str, np.ndarray], eligible: np.ndarray, state):
        """Block-vectorised per sensor: assume no spike in a block, compute all
        window means of the block at once (the same compensated sum, element by
        element from the oldest, as a (rows x window) matrix; shorter windows
        are left-padded with zeros, which leave the sum and its compensation
        exactly at zero), accept the rows before the first spike, apply that
        spike, and go on from the row after it."""
        n = len(eligible)
        spike = np.zeros(n, dtype=bool)
        idx = np.flatnonzero(eligible)
        new_state = []
        for k, sensor in enumerate(self.sensors):
            flags, win = self._run_sensor(values[sensor][idx].astype(np.float64), list(state[k]))
            spike[idx[flags]] = True
            new_state.append(win)
        return spike, new_state

    def _run_sensor(self, vals: np.ndarray, win: list[float]):
        window, thr = self.window, self.threshold
        n = len(vals)
        flags = np.zeros(n, dtype=bool)
        if n == 0:
            return flags, win
        size = len(win)
        a = np.concatenate((np.asarray(win, dtype=np.float64), vals))
        pos = size + np.arange(n)
        # row r's window (oldest first, left-padded with zeros): a zero-copy view
        padded = np.concatenate((np.zeros(window - 1), a))
        mat = np.lib.stride_tricks.sliding_window_view(padded, window)[size:]
        s = np.zeros(n)
        c = np.zeros(n)
        simple = np.zeros(n)
        with np.errstate(invalid="ignore", over="ignore"):
            for j in range(window):
                x = mat[:, j]
                y = x - c
                t = s + y
                c = (t - s) - y
                s = t
                simple = simple + x
            total = s - c
            total = np.where(np.isnan(total) & np.isinf(simple), simple, total)
            mean = total / np.minimum(pos + 1, window)
            hit = (vals >= mean + mean * thr) | (vals <= mean - mean * thr)
        accepted = np.ones(n, dtype=bool)
        clean_from = 0
        for p in np.flatnonzero(hit).tolist():
            if p < clean_from:
                continue
            # the window of p holds accepted values only: p is a spike
            flags[p] = True
            accepted[p] = False
            recent = deque(a[max(0, size + p - (window - 1)):size + p].tolist(), maxlen=window - 1)
            last_spike, k, spikes, block = p, p + 1, 1, _MIN_BLOCK
            while k < n and k < last_spike + window:
                if spikes >= _STRETCH:
                    # spikes leave the window as it is: all values up to the
                    # first accepted one meet the same window
                    hits = spikes_against(recent, vals[k:k + block], thr)
                    stop = len(hits) if hits.all() else int(hits.argmin())
                    if stop:
                        flags[k:k + stop] = True
                        accepted[k:k + stop] = False
                        k += stop
                        last_spike = k - 1
                    if stop == len(hits):
                        block = min(2 * block, _MAX_BLOCK)
                        continue
                    block = _MIN_BLOCK
                x = float(vals[k])
                m = java_mean([*recent, x])
                if x >= m + m * thr or x <= m - m * thr:
                    flags[k] = True
                    accepted[k] = False
                    last_spike = k
                    spikes += 1
                else:
                    recent.append(x)
                    spikes = 0
                k += 1
            clean_from = k
        keep = window if accepted[-1] else window - 1
        return flags, (win + vals[accepted].tolist())[-keep:]

    def run_scalar(self, values: dict[str, np.ndarray], eligible: np.ndarray, state):
        """Reference: one reading at a time."""
        n = len(eligible)
        spike = np.zeros(n, dtype=bool)
        window, thr = self.window, self.threshold
        new_state = []
        elig_idx = np.flatnonzero(eligible).tolist()
        for k, sensor in enumerate(self.sensors):
            win = deque(state[k])
            vals = values[sensor].tolist()
            for i in elig_idx:
                v = vals[i]
                if len(win) >= window:
                    win.popleft()
                win.append(v)
                m = java_mean(win)
                if v >= m + m * thr or v <= m - m * thr:
                    win.pop()
                    spike[i] = True
            new_state.append(list(win))
        return spike, new_state


class StuckDetector:
    """W3 as a step function (the batch operator uses window aggregates; the
    stream uses this). State per sensor: (value, start) or None."""

    def __init__(self, duration_ms: int = STUCK_DURATION_MS, sensors=SENSORS):
        self.duration, self.sensors = int(duration_ms), tuple(sensors)

    def init_state(self):
        return [None for _ in self.sensors]

    def run(self, ts: np.ndarray, values: dict[str, np.ndarray], eligible: np.ndarray, state,
            per_sensor: bool = False):
        """Vectorised: the state never depends on the verdict, so runs of
        equal values are found with a running maximum of run-start positions.
        With ``per_sensor`` also returns, per sensor, the stuck rows and the
        rows where a run restarts (both as full-length masks)."""
        n = len(eligible)
        stuck = np.zeros(n, dtype=bool)
        stuck_by, restart_by = {}, {}
        d = self.duration
        idx = np.flatnonzero(eligible)
        t = ts[idx].astype(np.int64)
        m = len(idx)
        new_state = []
        for k, sensor in enumerate(self.sensors):
            cur = state[k]
            if m == 0:
                new_state.append(cur)
                continue
            v = values[sensor][idx].astype(np.float64)
            prev = np.concatenate(([np.nan if cur is None else cur[0]], v[:-1]))
            same = v == prev                      # NaN equals nothing
            if cur is None:
                # the first reading creates the state and is compared to itself
                same[0] = v[0] == v[0]
            start_pos = np.maximum.accumulate(np.where(same, -1, np.arange(m)))
            if cur is None:
                start = np.where(start_pos >= 0, t[np.maximum(start_pos, 0)], t[0])
            else:
                start = np.where(start_pos >= 0, t[np.maximum(start_pos, 0)], cur[1])
            flag = same & (t - start >= d)
            stuck[idx[flag]] = True
            new_state.append((float(v[-1]), int(start[-1])))
            if per_sensor:
                stuck_by[sensor] = np.zeros(n, dtype=bool)
                stuck_by[sensor][idx[flag]] = True
                restart_by[sensor] = np.zeros(n, dtype=bool)
                restart_by[sensor][idx[~same]] = True
        if per_sensor:
            for sensor in self.sensors:
                stuck_by.setdefault(sensor, np.zeros(n, dtype=bool))
                restart_by.setdefault(sensor, np.zeros(n, dtype=bool))
            return stuck, new_state, stuck_by, restart_by
        return stuck, new_state

    def run_scalar(self, ts: np.ndarray, values: dict[str, np.ndarray], eligible: np.ndarray,
                   state):
        """Reference: one reading at a time."""
        n = len(eligible)
        stuck = np.zeros(n, dtype=bool)
        d = self.duration
        ts_list = ts.tolist()
        elig_idx = np.flatnonzero(eligible).tolist()
        new_state = []
        for k, sensor in enumerate(self.sensors):
            cur = state[k]
            vals = values[sensor].tolist()
            for i in elig_idx:
                v, t = vals[i], ts_list[i]
                if cur is None:
                    cur = (v, t)
                if cur[0] == v:           # NaN equals nothing, as in Java
                    if t - cur[1] >= d:
                        stuck[i] = True
                else:
                    cur = (v, t)
            new_state.append(cur)
        return stuck, new_state


class EdgeDetector:
    """W4 as a step function: per sensor the verdict ``value < low or
    value > high`` of the previous non-rejected reading (false at first).
    Returns per row and sensor 1 (anomaly_start), 2 (anomaly_end) or 0."""

    def __init__(self, limits: dict, sensors=SENSORS):
        self.limits, self.sensors = limits, tuple(sensors)

    def init_state(self) -> list[bool]:
        return [False for _ in self.sensors]

    def run(self, values: dict[str, np.ndarray], kept: np.ndarray, state):
        idx = np.flatnonzero(kept)
        out, new_state = {}, []
        for k, sensor in enumerate(self.sensors):
            lo, hi = self.limits[sensor]
            v = values[sensor][idx]
            with np.errstate(invalid="ignore"):
                exc = (v < lo) | (v > hi)          # NaN compares false, as in Java
            prev = np.concatenate(([state[k]], exc[:-1])) if len(exc) else exc
            edge = np.zeros(len(kept), dtype=np.int8)
            edge[idx] = np.where(exc != prev, np.where(exc, 1, 2), 0)
            out[sensor] = edge
            new_state.append(bool(exc[-1]) if len(exc) else state[k])
        return out, new_state
