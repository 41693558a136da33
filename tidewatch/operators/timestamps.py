"""W1 repair_timestamps (with A1, the mean absolute gap)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.folds import TimestampRepair
from ..plans.chunked_fold import chunked_device_fold
from ..plans.device_pass import device_fold
from ..plans.skew import resolve
from ..schema import TS_RATIO, TS_WINDOW


class _RepairFold:
    def __init__(self, window, ratio):
        self.rule = TimestampRepair(window, ratio)

    def init_state(self):
        return self.rule.init_state()

    def step(self, a, state):
        ts, state = self.rule.run(a["ts"], ~a["rejected"].astype(bool), state)
        return {"ts": ts}, state


def repair_timestamps(readings: DataFrame, window: int = TS_WINDOW,
                      ratio: float = TS_RATIO, skew=None) -> DataFrame:
    """Replace implausible ``ts`` values from the recent cadence of the device.

    Rejected readings pass through untouched and do not enter the window.
    Columns and their order are kept. Hot devices run as verified chunks
    (``plans.chunked_fold``).
    """
    fold = _RepairFold(window, ratio)
    hot = resolve(readings, skew)
    if hot.any:
        return chunked_device_fold(readings, fold, hot, schema=readings.schema)
    return device_fold(readings, fold.init_state, fold.step)
