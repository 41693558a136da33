"""W2 flag_spikes (with A2, the windowed mean including the current value)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.folds import SpikeFilter
from ..plans.chunked_fold import chunked_device_fold
from ..plans.device_pass import device_fold
from ..plans.skew import resolve
from ..schema import SENSORS, SPIKE_THRESHOLD, SPIKE_WINDOW


class _SpikeFold:
    def __init__(self, window, threshold):
        self.rule = SpikeFilter(window, threshold)

    def init_state(self):
        return self.rule.init_state()

    def step(self, a, state):
        rejected = a["rejected"].astype(bool)
        suspicious = a["suspicious"].astype(bool)
        spike, state = self.rule.run({s: a[s] for s in SENSORS}, ~rejected & ~suspicious, state)
        return {"suspicious": suspicious | spike}, state


def flag_spikes(readings: DataFrame, window: int = SPIKE_WINDOW,
                threshold: float = SPIKE_THRESHOLD, skew=None) -> DataFrame:
    """Mark readings with a sudden spike on any sensor as suspicious.

    Rejected or already suspicious readings pass through and leave every
    window untouched. Columns and their order are kept. Hot devices run as
    verified chunks (``plans.chunked_fold``).
    """
    fold = _SpikeFold(window, threshold)
    hot = resolve(readings, skew)
    if hot.any:
        return chunked_device_fold(readings, fold, hot, schema=readings.schema)
    return device_fold(readings, fold.init_state, fold.step)
