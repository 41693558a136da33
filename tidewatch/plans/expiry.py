"""Expiry of a device's state (T4, off by default).

The clock is the input's own: the place ``seq`` of a reading, which every reading has, which
only rises within a partition and which a device with a broken clock cannot move (its stamps
are what W1 repairs, so they cannot say how long it was silent). A device whose reading stands
more than ``after`` places behind its previous one, rejected or not, starts anew: with empty
windows, no stuck run and no open anomaly. The gap of exactly ``after`` keeps the state.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import types as T


class ExpiringFold:
    """``fold`` (see ``CleaningFold``) with its state lost over silences. State: (the fold's
    state, the last reading's seq)."""

    def __init__(self, fold, after: int):
        if int(after) < 1:
            raise ValueError("expire_after must be at least 1")
        self.fold, self.after = fold, int(after)

    def init_state(self):
        return self.fold.init_state(), None

    def step(self, a, state):
        inner, last = state
        seq = a["seq"]
        n = len(seq)
        gaps = np.diff(seq, prepend=seq[0] if last is None else last)
        cuts = [0, *np.flatnonzero(gaps > self.after).tolist(), n]
        parts = []
        for i, (s, e) in enumerate(zip(cuts, cuts[1:])):
            if i:
                inner = self.fold.anew(inner)
            if e > s:
                out, inner = self.fold.step({c: v[s:e] for c, v in a.items()}, inner)
                parts.append(out)
        merged = parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        return merged, (inner, int(seq[-1]))

    # -- hooks of the chunked pass: the fold's, with the last place beside --
    @property
    def carries_starts(self) -> bool:
        return self.fold.carries_starts

    @property
    def carry_fields(self):
        return self.fold.carry_fields

    @property
    def summary_fields(self):
        return (*self.fold.summary_fields, T.StructField("_last_seq", T.LongType()))

    def open_chunk(self, state):
        return self.fold.open_chunk(state[0]), state[1]

    def verify_view(self, state):
        return [self.fold.verify_view(state[0]), state[1]]

    def summary_extra(self, state) -> dict:
        return {**self.fold.summary_extra(state[0]), "_last_seq": state[1]}

    def restore_state(self, state):
        return self.fold.restore_state(state[0]), state[1]

    def resume_state(self, state, starts):
        return self.fold.resume_state(state[0], starts), state[1]

    def carry_table(self, summary):
        return self.fold.carry_table(summary)

    def carry_fix(self, rows, carry):
        return self.fold.carry_fix(rows, carry)

    def end_states(self, summary):
        return self.fold.end_states(summary, "_last_seq")
