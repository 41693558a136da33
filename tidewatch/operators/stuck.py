"""W3 flag_stuck_values: a sensor that keeps one value for too long.

Per device and sensor the state is (value, start): a reading whose value
equals the previous eligible value keeps the start, any other value (or NaN,
or the first reading) restarts it at the reading's ``ts``. A reading is stuck
when ``ts - start >= duration`` for any sensor. Only eligible readings (not
rejected, not already suspicious) read or change the state; the others pass
through with their flags.

The state never depends on the verdict, so the fold is a pair of running
window aggregates (no Python): the previous eligible value, then the ts of the
last restart at or before the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import any_sql, equal_sql
from ..plans.skew import assign_chunks, resolve
from ..schema import SENSORS, STUCK_DURATION_MS


def flag_stuck_values(readings: DataFrame, duration_ms: int = STUCK_DURATION_MS,
                      skew=None) -> DataFrame:
    """Set ``suspicious`` on stuck readings; columns and order are kept.

    Plan: one exchange on ``device``, one sort on (device, seq), two Window
    operators sharing them; everything else is codegen'd projection. Hot
    devices are split into seq-range chunks (``plans.skew``) and the state at
    a chunk border is carried exactly through a one-row-per-chunk summary.
    """
    hot = resolve(readings, skew)
    if hot.any:
        return _flag_stuck_chunked(readings, duration_ms, hot)
    cols = readings.columns
    local = _local_runs(readings, "device", duration_ms, with_counts=False)
    stuck = any_sql(f"(NOT isnan({s}) AND ts - _start_{s} >= {int(duration_ms)})" for s in SENSORS)
    return local.selectExpr(*[f"suspicious OR (_elig AND {stuck}) AS suspicious"
                              if c == "suspicious" else c for c in cols])


_ELIG = "NOT rejected AND NOT suspicious"


def _local_runs(df: DataFrame, partition: str, duration_ms: int, with_counts: bool) -> DataFrame:
    """Per ``partition``, in seq order: the previous eligible value, whether
    a run restarts here, the ts of the last restart (``_start_<s>``) and,
    optionally, how many restarts so far (``_nrun_<s>``). Two Window operators
    over one exchange and one sort."""
    before = (f"OVER (PARTITION BY {partition} ORDER BY seq "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    upto = (f"OVER (PARTITION BY {partition} ORDER BY seq "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    step1 = df.selectExpr(
        "*", f"{_ELIG} AS _elig",
        *[f"last(CASE WHEN {_ELIG} THEN {s} END, true) {before} AS _prev_{s}" for s in SENSORS])
    restart = {s: f"(_elig AND NOT (_prev_{s} IS NOT NULL AND {equal_sql(s, f'_prev_{s}')}))"
               for s in SENSORS}
    exprs = [f"last(CASE WHEN {restart[s]} THEN ts END, true) {upto} AS _start_{s}"
             for s in SENSORS]
    if with_counts:
        exprs += [f"sum(CAST({restart[s]} AS INT)) {upto} AS _nrun_{s}" for s in SENSORS]
    return step1.selectExpr("*", *exprs)


def _flag_stuck_chunked(readings: DataFrame, duration_ms: int, hot) -> DataFrame:
    """W3 per (device, chunk). Inside a chunk the runs are found locally (the
    first eligible reading of a chunk always opens a local run). Per chunk a
    summary keeps, per sensor, the first and last eligible value, whether a
    run opens after the first reading, and the local start of the last run.
    Over the chunks of a device (a window on the summary) this gives the true
    (value, start) state entering every chunk; the readings of a chunk's first
    run take that start when their first value continues the previous run."""
    cols = readings.columns
    step2 = _local_runs(assign_chunks(readings, hot), "device, _chunk", duration_ms,
                        with_counts=True)
    summary = (step2.where("_elig").groupBy("device", "_chunk").agg(
        *[F.expr(f"min_by({s}, seq)").alias(f"first_{s}") for s in SENSORS],
        *[F.expr(f"max_by({s}, seq)").alias(f"last_{s}") for s in SENSORS],
        *[F.expr(f"max(_nrun_{s}) > 1").alias(f"inner_{s}") for s in SENSORS],
        *[F.expr(f"max_by(_start_{s}, seq)").alias(f"lstart_{s}") for s in SENSORS]))
    over = "OVER (PARTITION BY device ORDER BY _chunk)"
    upto = ("OVER (PARTITION BY device ORDER BY _chunk "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    carried = summary.selectExpr("*", *[f"lag(last_{s}) {over} AS cv_{s}" for s in SENSORS])
    same = {s: f"(cv_{s} IS NOT NULL AND {equal_sql(f'first_{s}', f'cv_{s}')})" for s in SENSORS}
    # start of the run open at the end of each chunk
    carried = carried.selectExpr(
        "*", *[f"{same[s]} AS same_{s}" for s in SENSORS],
        *[f"last(CASE WHEN inner_{s} OR NOT {same[s]} THEN lstart_{s} END, true) {upto}"
          f" AS end_start_{s}" for s in SENSORS])
    carry = carried.selectExpr(
        "device", "_chunk", *[f"same_{s}" for s in SENSORS],
        *[f"lag(end_start_{s}) {over} AS cs_{s}" for s in SENSORS])
    joined = step2.join(carry, ["device", "_chunk"], "left")
    start = {s: f"CASE WHEN _nrun_{s} <= 1 AND coalesce(same_{s}, false) THEN cs_{s}"
                f" ELSE _start_{s} END" for s in SENSORS}
    stuck = any_sql(f"(NOT isnan({s}) AND ts - ({start[s]}) >= {int(duration_ms)})"
                    for s in SENSORS)
    return joined.selectExpr(*[f"suspicious OR (_elig AND {stuck}) AS suspicious"
                               if c == "suspicious" else c for c in cols])
