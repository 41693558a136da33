"""Keyed state for the cleaning chain in a stream (T1, T3, T4).

``groupBy("device").applyInPandasWithState`` holds, per device, the W1 stamp
window, the five W2 value windows and the five W3 (value, start) pairs; Spark
checkpoints them in its state store, so a restarted query continues where it
stopped. Within a micro-batch the rows of a device arrive in no particular
order and are sorted by ``seq`` first; the step itself is the batch pass's.

A worker holds one device's part of a micro-batch, as plain arrays of the
columns that the rules use, and hands it back in pieces; raw texts come along
with bad messages only, which are passed on as they arrive.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..plans.pipeline import CleaningFold, with_outlier_verdict
from ..schema import MESSAGE_PLACE, PHYSICAL_BOUNDS, READING, READING_COLUMNS, SENSORS
from ..session import ship_package

STATE = T.StructType([
    T.StructField("ts_window", T.ArrayType(T.LongType(), False), False),
    T.StructField("spike_windows", T.ArrayType(T.ArrayType(T.DoubleType(), False), False), False),
    T.StructField("stuck_values", T.ArrayType(T.DoubleType(), True), False),
    T.StructField("stuck_starts", T.ArrayType(T.LongType(), True), False),
])


def encode_state(state) -> tuple:
    ts_win, spikes, stuck = state[0], state[1], state[2]
    return (
        [int(t) for t in ts_win],
        [[float(v) for v in w] for w in spikes],
        [None if s is None else float(s[0]) for s in stuck],
        [None if s is None else int(s[1]) for s in stuck],
    )


def decode_state(row) -> tuple:
    ts_win, spikes, values, starts = row
    stuck = [None if st is None else (float(v), int(st)) for v, st in zip(values, starts)]
    return (list(ts_win), [list(w) for w in spikes], stuck, None, None)


# The state API hands pandas frames back, and pandas turns NaN into NULL on
# the way to Arrow; NaN is data here, so the sensor columns travel as nullable
# with a bitmask of the NaN ones, and NaN is put back JVM-side.
_OUT = T.StructType([T.StructField(f.name, f.dataType, True) for f in READING.fields]
                    + [T.StructField("_nan_bits", T.IntegerType(), False)])


# Parsed messages (good and bad ones under a tag) keep two columns more.
_TAGGED = T.StructType(_OUT.fields + [T.StructField("value", T.StringType()), T.StructField("reason", T.StringType())])

# Bad messages only pass through the state operator: they are dealt over keys
# of their own, which no device can have, and leave no state there.
BAD_KEYS = 64
_KEY = f"CASE WHEN reason IS NULL THEN device ELSE concat('\\u0000', seq % {BAD_KEYS}) END AS _key"


PIECE = 1 << 15  # readings of a device cleaned and handed back at once


def _gathered(batches, columns) -> dict[str, np.ndarray]:
    """The rows of all batches as one array a column, free of the batches' own
    memory; equal texts are one object."""
    parts, texts = {c: [] for c in columns}, {}
    for pdf in batches:
        for c in columns:
            a = np.array(pdf[c])
            if a.dtype == object:
                a[:] = [texts.setdefault(x, x) for x in a]
            parts[c].append(a)
    return {c: np.concatenate(parts.pop(c)) for c in columns if parts[c]}


def _restore_nans(df: DataFrame, *more: str) -> DataFrame:
    return df.selectExpr(*[
        f"CASE WHEN shiftright(_nan_bits, {SENSORS.index(c)}) & 1 = 1 "
        f"THEN CAST('NaN' AS DOUBLE) ELSE {c} END AS {c}" if c in SENSORS else c
        for c in READING_COLUMNS], *more)


def clean_stream(readings: DataFrame, bounds=PHYSICAL_BOUNDS, **params) -> DataFrame:
    """Streaming counterpart of ``clean_readings`` (same output columns).

    Of parsed messages (with ``value`` and ``reason``, see ``parse_messages``) the
    good ones are cleaned in the order of (topic, partition, seq), as far as the source names them, and the bad ones passed on under their tag, so that one
    query, one parse and one checkpoint serve every sink. Only bad ones keep their ``value``."""
    ship_package(readings.sparkSession)
    fold = CleaningFold(**params)
    tagged = "reason" in readings.columns
    more = ("value", "reason") if tagged else ()
    columns = [*READING_COLUMNS, *more]
    place = [c for c in MESSAGE_PLACE if c in readings.columns]

    used = ("_outlier", *[c for c in columns if c not in ("device", *more)])

    def process(key, batches, state):
        if tagged and key[0] is not None and key[0].startswith("\0"):
            kept = ("seq", *more)
            for pdf in batches:
                if len(pdf):
                    yield pd.DataFrame({c: pdf[c] if c in kept else None for c in columns}).assign(_nan_bits=0)
            return
        rows = _gathered(batches, [*used, *place])
        if not rows or not len(rows["seq"]):
            return
        by = [*place, "seq"]
        order = pd.DataFrame({c: rows[c] for c in by}).sort_values(by, kind="stable").index.to_numpy()
        rows = {c: rows.pop(c)[order] for c in used}
        current = decode_state(state.get) if state.exists else fold.init_state()
        for at in range(0, len(order), PIECE):
            arrays = {c: a[at:at + PIECE] for c, a in rows.items()}
            changed, current = fold.step(arrays, current)
            values = {**arrays, **changed, "device": key[0], **dict.fromkeys(more)}
            bits = np.zeros(len(arrays["seq"]), dtype=np.int32)
            for k, sensor in enumerate(SENSORS):
                bits |= np.isnan(arrays[sensor].astype(np.float64)).astype(np.int32) << k
            yield pd.DataFrame({c: values[c] for c in columns}).assign(_nan_bits=bits)
        state.update(encode_state(current))

    rows = with_outlier_verdict(readings.select(*columns, *place), bounds)
    if tagged:
        rows = rows.withColumn("value", F.expr("CASE WHEN reason IS NOT NULL THEN value END"))
    keyed = rows.selectExpr("*", _KEY).groupBy("_key") if tagged else rows.groupBy("device")
    return _restore_nans(keyed.applyInPandasWithState(
        process, _TAGGED if tagged else _OUT, STATE, "append", GroupStateTimeout.NoTimeout), *more)
