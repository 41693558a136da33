"""The cleaning chain W1 -> F1 -> W2 -> W3 and the full batch pipeline.

``clean_readings`` runs the chain in ONE exchange: F1 is computed JVM-side
before the shuffle (it depends on the sensor values only), then a single
Python pass over device-ordered partitions folds W1, W2 and W3 together.
Running W3 as window aggregates instead (``stuck="window"``) costs a second
full exchange, because Catalyst cannot see through the Python node's output
partitioning; the composed form stays available and is tested equal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.folds import EdgeDetector, SpikeFilter, StuckDetector, TimestampRepair
from ..operators.outliers import flag_outliers, outlier_condition
from ..operators.spikes import flag_spikes
from ..operators.stuck import flag_stuck_values
from ..operators.thresholds import alerts_from_edges
from ..operators.timestamps import repair_timestamps
from ..schema import (PHYSICAL_BOUNDS, SENSORS, SPIKE_THRESHOLD, SPIKE_WINDOW,
                      STUCK_DURATION_MS, TS_RATIO, TS_WINDOW)
from ..sources.config import resolve_limits
from .chunked_fold import chunked_device_fold
from .device_pass import device_fold
from .expiry import ExpiringFold
from .skew import SkewPlan, resolve


def clean_readings_composed(readings: DataFrame, *, ts_window: int = TS_WINDOW,
                            ts_ratio: float = TS_RATIO, bounds=PHYSICAL_BOUNDS,
                            spike_window: int = SPIKE_WINDOW,
                            spike_threshold: float = SPIKE_THRESHOLD,
                            stuck_ms: int = STUCK_DURATION_MS, skew=SkewPlan()) -> DataFrame:
    """The public operators chained one after the other (reference order),
    hot devices detected once on the input."""
    hot = resolve(readings, skew)
    out = repair_timestamps(readings, ts_window, ts_ratio, skew=hot)
    out = flag_outliers(out, bounds)
    out = flag_spikes(out, spike_window, spike_threshold, skew=hot)
    return flag_stuck_values(out, stuck_ms, skew=hot)


class CleaningFold:
    """W1 -> F1 -> W2 (-> W3) (-> W4) as one step over one device's readings.

    Expects the input columns of a reading plus ``_outlier`` (F1's verdict,
    computed JVM-side before the Python pass). Shared by the batch pass, the
    chunked pass for hot devices and the streaming state processor.

    State: (W1 stamps, W2 windows, W3 (value, start) pairs, W4 verdicts,
    first-run flags). The last element is only used by the chunked pass
    (``open_chunk``): there a W3 run that is open when a chunk starts may have
    begun before the chunk's warm-up, so its start is not known inside the
    chunk. Readings of such a first run report their verdict separately
    (``_run0`` / ``_stuck0`` bit masks) and ``carry_fix`` decides them with
    the start carried exactly over the chunk summaries.
    """

    def __init__(self, *, ts_window: int = TS_WINDOW, ts_ratio: float = TS_RATIO,
                 spike_window: int = SPIKE_WINDOW, spike_threshold: float = SPIKE_THRESHOLD,
                 stuck_ms: int | None = STUCK_DURATION_MS, limits=None):
        self.w1 = TimestampRepair(ts_window, ts_ratio)
        self.w2 = SpikeFilter(spike_window, spike_threshold)
        self.w3 = StuckDetector(stuck_ms) if stuck_ms is not None else None
        self.w4 = EdgeDetector(limits) if limits is not None else None
        self.stuck_ms = stuck_ms

    def init_state(self):
        return (self.w1.init_state(), self.w2.init_state(),
                self.w3.init_state() if self.w3 else None,
                self.w4.init_state() if self.w4 else None, None)

    def step(self, a, state):
        s1, s2, s3, s4, s5 = state
        rejected = a["rejected"].astype(bool)
        suspicious = a["suspicious"].astype(bool)
        ts, s1 = self.w1.run(a["ts"], ~rejected, s1)
        rejected = rejected | a["_outlier"].astype(bool)
        values = {s: a[s] for s in SENSORS}
        spike, s2 = self.w2.run(values, ~rejected & ~suspicious, s2)
        suspicious = suspicious | spike
        out = {}
        if self.w3 is not None and s5 is not None:
            stuck_rows, s3, stuck_by, restart_by = self.w3.run(
                ts, values, ~rejected & ~suspicious, s3, per_sensor=True)
            eligible = ~rejected & ~suspicious
            run0 = np.zeros(len(ts), dtype=np.int8)
            stuck0 = np.zeros(len(ts), dtype=np.int8)
            later = np.zeros(len(ts), dtype=bool)
            s5 = list(s5)
            for k, sensor in enumerate(SENSORS):
                first = np.zeros(len(ts), dtype=bool)
                if s5[k]:
                    first = eligible & (np.cumsum(restart_by[sensor]) == 0)
                    if restart_by[sensor].any():
                        s5[k] = False
                run0 |= first.astype(np.int8) << k
                stuck0 |= (first & stuck_by[sensor]).astype(np.int8) << k
                later |= stuck_by[sensor] & ~first
            suspicious = suspicious | later
            out.update(_run0=run0, _stuck0=stuck0)
        elif self.w3 is not None:
            stuck_rows, s3 = self.w3.run(ts, values, ~rejected & ~suspicious, s3)
            suspicious = suspicious | stuck_rows
        out.update(ts=ts, rejected=rejected, suspicious=suspicious)
        if self.w4 is not None:
            edges, s4 = self.w4.run(values, ~rejected, s4)
            out.update({f"_edge_{s}": e for s, e in edges.items()})
        return out, (s1, s2, s3, s4, s5)

    # -- hooks of the chunked pass (plans.chunked_fold) ----------------------
    carry_fields = (T.StructField("_run0", T.ByteType()), T.StructField("_stuck0", T.ByteType()))
    summary_fields = (T.StructField("_w3_open", T.IntegerType()),
                      T.StructField("_w3_start", T.ArrayType(T.LongType())))

    @property
    def carries_starts(self) -> bool:
        return self.w3 is not None

    def open_chunk(self, state):
        if self.w3 is None:
            return state
        # only a run that was under way can have begun before the chunk
        return (*state[:4], [x is not None for x in state[2]])

    def verify_view(self, state):
        """What must agree at a chunk border: everything but W3 run starts
        (those are carried exactly instead) and the first-run flags."""
        s1, s2, s3, s4, _ = state
        values = None if s3 is None else [None if x is None else x[0] for x in s3]
        return [s1, s2, values, s4]

    def summary_extra(self, state) -> dict:
        if self.w3 is None:
            return {}
        s3, s5 = state[2], state[4] or [False] * len(SENSORS)
        return {"_w3_open": sum(1 << k for k, o in enumerate(s5) if o),
                "_w3_start": [None if x is None else int(x[1]) for x in s3]}

    def restore_state(self, state):
        """The reported exit state of a chunk as the state to go on from."""
        s1, s2, s3, s4, _ = state
        if s3 is not None:
            s3 = [None if x is None else (x[0], int(x[1])) for x in s3]
        return (s1, s2, s3, s4, None)

    def resume_state(self, state, starts):
        """The state a device was left in by an earlier slice (``end_states``)."""
        s1, s2, s3, s4, s5 = self.restore_state(state)
        if s3 is not None and starts is not None:
            s3 = [x if x is None or t is None else (x[0], int(t)) for x, t in zip(s3, starts)]
        return (s1, s2, s3, s4, s5)

    def anew(self, state):
        """The empty state where ``state`` was; what follows began inside its chunk."""
        return (*self.init_state()[:4], None if state[4] is None else [False] * len(SENSORS))

    @staticmethod
    def _true_ends(summary: DataFrame, *more: str) -> DataFrame:
        """Per chunk the true W3 starts ``_out_<k>`` it ends with. A chunk's exit
        start is exact when a run restarted inside it (or it is the device's
        first chunk); otherwise it continues the one entering it."""
        over = "OVER (PARTITION BY device ORDER BY _chunk)"
        upto = ("OVER (PARTITION BY device ORDER BY _chunk "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
        return summary.selectExpr(
            "device", "_chunk", f"row_number() {over} = 1 AS _first",
            "_w3_open", "_w3_start", *more).selectExpr(
            "device", "_chunk", *more,
            *[f"last(CASE WHEN _first OR shiftright(_w3_open, {k}) & 1 = 0 "
              f"THEN _w3_start[{k}] END, true) {upto} AS _out_{k}" for k in range(len(SENSORS))])

    def carry_table(self, summary: DataFrame) -> DataFrame:
        """(device, _chunk, _cin_<k>): the true W3 start entering each chunk."""
        over = "OVER (PARTITION BY device ORDER BY _chunk)"
        return self._true_ends(summary).selectExpr(
            "device", "_chunk", *[f"lag(_out_{k}) {over} AS _cin_{k}" for k in range(len(SENSORS))])

    def end_states(self, summary: DataFrame, last: str | None = None) -> DataFrame:
        """(device, state, starts, last): what each device's last chunk ended
        in, with the true W3 starts; ``last`` is a summary field or null."""
        kept = "_exit_full AS state", f"{last or 'CAST(NULL AS BIGINT)'} AS last"
        if self.carries_starts:
            ends = self._true_ends(summary, "_exit_full", *([last] if last else []))
            starts = "array(" + ", ".join(f"_out_{k}" for k in range(len(SENSORS))) + ")"
        else:
            ends, starts = summary, "CAST(NULL AS ARRAY<BIGINT>)"
        return (ends.selectExpr("device", "_chunk", *kept, f"{starts} AS starts")
                .groupBy("device").agg(F.expr("max_by(struct(state, starts, last), _chunk)").alias("s"))
                .select("device", "s.*"))

    def carry_fix(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        """Decide the first-run readings with the carried start (the local
        verdict stands where nothing was carried: the device's first chunk)."""
        joined = rows.join(carry, ["device", "_chunk"], "left")
        fixes = " OR ".join(
            f"(shiftright(_run0, {k}) & 1 = 1 AND CASE WHEN _cin_{k} IS NULL "
            f"THEN shiftright(_stuck0, {k}) & 1 = 1 "
            f"ELSE ts - _cin_{k} >= {int(self.stuck_ms)} END)" for k in range(len(SENSORS)))
        return joined.withColumn("suspicious", F.expr(f"suspicious OR ({fixes})"))


def cleaning_fold(expire_after: int | None = None, **params):
    """The fold of the chain, with expiring state if asked for."""
    fold = CleaningFold(**params)
    return fold if expire_after is None else ExpiringFold(fold, expire_after)


def with_outlier_verdict(readings: DataFrame, bounds=PHYSICAL_BOUNDS) -> DataFrame:
    return readings.withColumn("_outlier", outlier_condition(bounds))


def clean_readings(readings: DataFrame, *, ts_window: int = TS_WINDOW,
                   ts_ratio: float = TS_RATIO, bounds=PHYSICAL_BOUNDS,
                   spike_window: int = SPIKE_WINDOW,
                   spike_threshold: float = SPIKE_THRESHOLD,
                   stuck_ms: int = STUCK_DURATION_MS, stuck: str = "pass",
                   skew=SkewPlan(), expire_after: int | None = None) -> DataFrame:
    """Cleaned readings: timestamps repaired, ``rejected`` and ``suspicious``
    set. Same columns as the input.

    ``stuck="pass"`` folds W3 into the Python pass (one exchange in total);
    ``stuck="window"`` runs it as window aggregates after the pass.

    Hot devices (``skew``: a SkewPlan to detect them, a HotSet, or None) are
    split into seq-range chunks: W1 and W2 run as a verified speculative
    chunked fold (``plans.chunked_fold``) and W3 as chunked windows with an
    exact carry; no task then holds a whole hot device.

    ``expire_after``: a device that is silent for more than so many places of
    ``seq`` starts anew (``plans.expiry``; not with ``stuck="window"``).
    """
    if expire_after is not None and stuck != "pass":
        raise ValueError("expire_after needs stuck='pass'")
    hot = resolve(readings, skew)
    if hot.any:
        fold = cleaning_fold(expire_after, ts_window=ts_window, ts_ratio=ts_ratio, spike_window=spike_window,
                             spike_threshold=spike_threshold, stuck_ms=stuck_ms)
        return chunked_device_fold(with_outlier_verdict(readings, bounds), fold, hot,
                                   schema=readings.schema)
    fold = cleaning_fold(expire_after, ts_window=ts_window, ts_ratio=ts_ratio, spike_window=spike_window,
                         spike_threshold=spike_threshold,
                         stuck_ms=stuck_ms if stuck == "pass" else None)
    out = device_fold(with_outlier_verdict(readings, bounds), fold.init_state, fold.step,
                      schema=readings.schema)
    if stuck != "pass":
        out = flag_stuck_values(out, stuck_ms)
    return out


ALERT_INPUT = ("seq", "ts", "device", *SENSORS, "rejected", "suspicious")
EDGE_COLUMNS = tuple(f"_edge_{s}" for s in SENSORS)


def _has_edge(cols) -> np.ndarray:
    mask = cols[EDGE_COLUMNS[0]] != 0
    for c in EDGE_COLUMNS[1:]:
        mask = mask | (cols[c] != 0)
    return mask


def clean_and_detect(readings: DataFrame, limits=None, *, bounds=PHYSICAL_BOUNDS,
                     stuck_ms: int = STUCK_DURATION_MS, skew=SkewPlan(),
                     edges_only: bool = False, **params) -> DataFrame:
    """Cleaned readings plus ``_edge_<sensor>`` (0 none, 1 start, 2 end):
    W1-W4 in ONE exchange and one Python pass. W4's limits are constants for a
    batch, so its edge state (five booleans per device) rides along in the
    same fold instead of needing a second shuffle for a window.

    With hot devices the fold is split (``plans.chunked_fold``); the W3 run
    starts are carried over the chunk summaries.

    ``edges_only`` keeps only readings with an edge, inside the Python pass,
    so the other readings never travel back to the JVM, and only the columns
    that W1-W4 and the alerts use: the others are never read or shuffled.
    ``expire_after`` as in ``clean_readings``; an expired device has no open
    anomaly either."""
    lim = resolve_limits(limits)
    hot = resolve(readings, skew)
    if edges_only:
        readings = readings.select(*ALERT_INPUT)
    edge_fields = [T.StructField(c, T.ByteType(), False) for c in EDGE_COLUMNS]
    schema = T.StructType(list(readings.schema.fields) + edge_fields)
    pre = with_outlier_verdict(readings, bounds)
    keep = _has_edge if edges_only else None
    fold = cleaning_fold(stuck_ms=stuck_ms, limits=lim, **params)
    if hot.any:
        return chunked_device_fold(pre, fold, hot, schema=schema, keep=keep)
    return device_fold(pre, fold.init_state, fold.step, schema=schema, keep=keep)


def pipeline_alerts(readings: DataFrame, limits=None, **kwargs) -> DataFrame:
    """Alerts of the whole chain (equal to
    ``detect_anomalies(clean_readings(readings), limits)``) with one exchange."""
    return alerts_from_edges(clean_and_detect(readings, limits, edges_only=True, **kwargs))


def run_batch(readings: DataFrame, limits=None, **params) -> tuple[DataFrame, DataFrame]:
    """Cleaned readings and their alerts from ONE fused pass. The pass output
    is shared by both frames; persist it (``write_batch`` does) when both are
    consumed so the pass runs once."""
    both = clean_and_detect(readings, limits, **params)
    cleaned = both.select(*readings.columns)
    return cleaned, alerts_from_edges(both)


def write_batch(readings: DataFrame, out_dir: str, limits=None, recipients=None,
                zone: str = "UTC", fmt: str = "parquet", sinks: dict[str, dict] | None = None,
                batch_id: int | None = None, **params) -> None:
    """The batch job: sensor_data (K1), event_alerts (K2) and notifications
    (K3) from one pass. The pass output is persisted (memory, spilling to
    disk) while the three tables are written; a lost executor's partitions
    are recomputed from lineage. ``sinks`` gives an output a format and writer
    options of its own ({"sensor_data": {"fmt": "jdbc", "url": .., "dbtable": ..}});
    with ``batch_id`` a second run replaces the rows of the first."""
    from pyspark import StorageLevel

    from ..operators.notify import build_notifications
    from ..sinks.tables import sink_options, write_event_alerts, write_notifications, write_sensor_data

    to = sink_options(sinks, fmt)
    both = clean_and_detect(readings, limits, **params).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = out_dir.rstrip("/")
        write_sensor_data(both.select(*readings.columns), f"{out}/sensor_data", batch_id, **to["sensor_data"])
        alerts = alerts_from_edges(both)
        write_event_alerts(alerts, f"{out}/event_alerts", batch_id, **to["event_alerts"])
        write_notifications(build_notifications(alerts, recipients, zone),
                            f"{out}/notifications", batch_id, **to["notifications"])
    finally:
        both.unpersist()
