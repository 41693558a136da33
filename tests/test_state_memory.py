"""The keyed state's Python side without Spark: what one device's part of a micro-batch takes."""

import tracemalloc
from unittest.mock import MagicMock

import numpy as np
import pandas as pd

from tidewatch.plans.pipeline import CleaningFold
from tidewatch.schema import READING_COLUMNS, SENSORS
from tidewatch.streaming import processor


class State:
    """One key's state as Spark hands it over."""
    exists, value = False, None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.exists, self.value = True, value


def step_of(monkeypatch, columns):
    """The function that ``clean_stream`` gives to ``applyInPandasWithState``."""
    for name, stub in (("ship_package", lambda s: None), ("with_outlier_verdict", lambda df, bounds: df),
                       ("_restore_nans", lambda df, *more: df), ("F", MagicMock())):
        monkeypatch.setattr(processor, name, stub, raising=False)
    frame = MagicMock(columns=columns)
    frame.select.return_value = frame.withColumn.return_value = frame.selectExpr.return_value = frame
    frame.groupBy.return_value.applyInPandasWithState = lambda process, *rest: process
    return processor.clean_stream(frame)


def batches(n, size, text=False, seed=3):
    """A device's readings in no order of ``seq``, as nullable frames of ``size`` rows."""
    rng = np.random.default_rng(seed)
    seqs = rng.permutation(n)
    for at in range(0, n, size):
        seq = seqs[at:at + size]
        m = len(seq)
        cols = {"seq": seq, "ts": 1000 * seq + np.where(seq % 97 == 0, 10 ** 7, 0), "device": "d", "light": False, "motion": True,
                "rejected": False, "suspicious": False, "_outlier": seq % 50 == 0}
        cols |= {s: 20.0 + (seq % 13) * 0.1 + np.where(seq % 61 == 0, 30.0, 0.0) for s in SENSORS}
        cols[SENSORS[0]] = np.where(seq % 31 == 0, np.nan, cols[SENSORS[0]])
        tail = {"value": [f"{i:0200d}" for i in seq] if text else [None] * m, "reason": [None] * m}
        yield pd.DataFrame({**{c: cols[c] for c in READING_COLUMNS}, "_outlier": cols["_outlier"], **tail, "_key": "d"})


def test_pieces_equal_the_whole_device(monkeypatch):
    process = step_of(monkeypatch, [*READING_COLUMNS, "value", "reason"])
    n = 40_000 + 700
    state, held = State(), State()
    outs = list(process(("d",), batches(n, 1000), held))
    got = pd.concat(outs, ignore_index=True)
    whole = pd.concat(list(batches(n, 1000))).sort_values("seq").reset_index(drop=True)
    fold = CleaningFold()
    changed, end = fold.step({c: whole[c].to_numpy() for c in whole.columns}, fold.init_state())
    want = whole.assign(**changed)
    assert len(outs) > 1 and got["seq"].tolist() == list(range(n))
    assert processor.encode_state(end) == held.value
    for c in READING_COLUMNS:
        assert got[c].equals(want[c]) or (got[c].to_numpy() == want[c].to_numpy()).all(), c
    assert (got["_nan_bits"] == (got["seq"] % 31 == 0)).all()
    assert list(process(("d",), iter([]), state)) == [] and not state.exists


def test_memory_of_a_device_is_that_of_its_numbers(monkeypatch):
    process = step_of(monkeypatch, [*READING_COLUMNS, "value", "reason"])
    n = 150_000
    tracemalloc.start()
    try:
        for out in process(("d",), batches(n, 5000, text=True), State()):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 300 * n, peak / n  # with raw texts and whole frames: over 600


def test_bad_messages_pass_as_they_arrive(monkeypatch):
    process = step_of(monkeypatch, [*READING_COLUMNS, "value", "reason"])
    asked = []

    def arriving():
        for i in range(3):
            asked.append(i)
            yield pd.DataFrame({**{c: [None] for c in READING_COLUMNS}, "_outlier": None, "seq": [i], "value": ["x"], "reason": ["malformed"]})

    out = process(("\0" + "5",), arriving(), State())
    assert next(out)["seq"].tolist() == [0] and asked == [0]
    assert [o["seq"].tolist() for o in out] == [[1], [2]]
