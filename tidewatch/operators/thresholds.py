"""W4 detect_anomalies: limit-crossing edges per device and sensor.

For every reading that is not rejected (F5) and every sensor, ``exceeded`` is
``value < low or value > high`` (J1: the limits are one record, inlined as
literals). An alert is emitted where ``exceeded`` differs from the previous
non-rejected reading of the same device (``false`` before the first one):
``anomaly_start`` when it turns true, ``anomaly_end`` when it turns false.
One reading yields 0..5 alerts, in the order co, humidity, lpg, smoke, temp
(R3). Suspicious readings are checked and carry their flag into the alert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import dlit, outside_sql
from ..schema import DEFAULT_LIMITS, EVENT_END, EVENT_START, LIMIT_FIELDS, LIMITS, SENSORS
from ..plans.skew import assign_chunks, resolve
from ..sources.config import resolve_limits
from .as_of import SPAN, as_of


def exceeded_sql(limits) -> dict[str, str]:
    lim = resolve_limits(limits)
    return {s: outside_sql(s, *lim[s]) for s in SENSORS}


_KEPT = ("seq", "device", "ts", "suspicious", *SENSORS)


def _kept(readings: DataFrame, limits) -> DataFrame:
    exc = exceeded_sql(limits)
    return (readings.where("NOT rejected")
            .selectExpr(*_KEPT, *[f"{exc[s]} AS exc_{s}" for s in SENSORS]))


def _lags(partition: str, default: str | None) -> list[str]:
    dflt = f", 1, {default}" if default else ""
    return [f"lag(exc_{s}{dflt}) OVER (PARTITION BY {partition} ORDER BY seq) AS prev_{s}"
            for s in SENSORS]


def _edges_to_alerts(df: DataFrame, prev_of) -> DataFrame:
    """``df`` holds ``exc_<sensor>``; ``prev_of(sensor)`` is the SQL text of
    the previous state. Explode only the changed sensors, keeping sensor
    order."""
    entries = ", ".join(
        f"named_struct('sensorType', '{s}', 'value', {s}, 'exceeded', exc_{s}, "
        f"'changed', exc_{s} <> {prev_of(s)})" for s in SENSORS)
    return (df.selectExpr("seq", "device", "ts", "suspicious",
                          f"explode(filter(array({entries}), e -> e.changed)) AS e")
            .selectExpr("seq", "device AS deviceId",
                        f"CASE WHEN e.exceeded THEN '{EVENT_START}' ELSE '{EVENT_END}' END"
                        " AS eventType",
                        "e.sensorType AS sensorType", "ts AS timestamp", "suspicious",
                        "e.value AS value"))


def alerts_from_edges(df: DataFrame) -> DataFrame:
    """Alerts from readings that carry ``_edge_<sensor>`` (0 none, 1 start,
    2 end), as produced by a fused pass; a narrow explode, no shuffle."""
    entries = ", ".join(
        f"named_struct('sensorType', '{s}', 'value', {s}, 'edge', _edge_{s})" for s in SENSORS)
    any_edge = " OR ".join(f"_edge_{s} <> 0" for s in SENSORS)
    return (df.where(any_edge)
            .selectExpr("seq", "device", "ts", "suspicious",
                        f"explode(filter(array({entries}), e -> e.edge <> 0)) AS e")
            .selectExpr("seq", "device AS deviceId",
                        f"CASE WHEN e.edge = 1 THEN '{EVENT_START}' ELSE '{EVENT_END}' END"
                        " AS eventType",
                        "e.sensorType AS sensorType", "ts AS timestamp", "suspicious",
                        "e.value AS value"))


def detect_anomalies(readings: DataFrame, limits=None, skew=None) -> DataFrame:
    """Alerts (seq, deviceId, eventType, sensorType, timestamp, suspicious,
    value) from cleaned readings.

    Plan: one exchange on ``device`` and a sort on (device, seq) feeding five
    ``lag``s in a single Window operator; the explode is a narrow step after.
    Only the columns used are read from the input.

    Hot devices (see ``plans.skew``) are split into seq-range chunks: the
    window runs per (device, chunk), and the first reading of a chunk takes
    its previous verdict from the last non-rejected reading of the nearest
    earlier chunk, found on a one-row-per-chunk summary (partial aggregate,
    then a window over chunks). Exact, and no task holds a whole device.
    """
    kept = _kept(readings, limits)
    return _detect(kept, resolve(kept, skew))


def _detect(kept: DataFrame, hot) -> DataFrame:
    """Alerts from readings that carry their verdicts ``exc_<sensor>``."""
    if not hot.any:
        with_prev = kept.selectExpr("*", *_lags("device", "false"))
        return _edges_to_alerts(with_prev, lambda s: f"prev_{s}")

    chunked = assign_chunks(kept, hot)
    with_prev = chunked.selectExpr("*", *_lags("device, _chunk", None))
    last = (chunked.groupBy("device", "_chunk")
            .agg(F.expr("max_by(struct(" + ", ".join(f"exc_{s}" for s in SENSORS) + "), seq)")
                 .alias("l")))
    carry = last.selectExpr(
        "device", "_chunk",
        *[f"lag(l.exc_{s}) OVER (PARTITION BY device ORDER BY _chunk) AS carry_{s}"
          for s in SENSORS])
    joined = with_prev.join(carry, ["device", "_chunk"], "left")
    return _edges_to_alerts(joined, lambda s: f"coalesce(prev_{s}, carry_{s}, false)")


def limits_log(changes: DataFrame) -> DataFrame:
    """(from_seq, rec) from a change log of limits records (``seq`` and the
    fields of a record); a field that is missing or null reads as 0.0."""
    fields = ", ".join(f"'{f}', coalesce(CAST({f} AS DOUBLE), 0.0D)" if f in changes.columns else f"'{f}', 0.0D"
                       for f in LIMITS.fieldNames())
    return changes.selectExpr("CAST(seq AS BIGINT) AS from_seq", f"named_struct({fields}) AS rec")


def detect_anomalies_as_of(readings: DataFrame, changes: DataFrame, skew=None, span: int = SPAN) -> DataFrame:
    """W4 under limits that change over time: each reading is held against the
    limits in force at its ``seq`` (T7; the default limits before the first
    change), and the verdict of a device's previous reading is the one taken
    then, under the limits of that time. Plan: the as-of join's one exchange,
    then that of ``detect_anomalies``; hot devices are split as there."""
    rows = as_of(readings.where("NOT rejected").select(*_KEPT), limits_log(changes), span=span)
    exc = []
    for s in SENSORS:
        low, high = (f"coalesce(rec.{f}, {dlit(d)})" for f, d in zip(LIMIT_FIELDS[s], DEFAULT_LIMITS[s]))
        exc.append(f"NOT isnan({s}) AND ((NOT isnan({low}) AND {s} < {low}) OR "
                   f"(NOT isnan({high}) AND {s} > {high})) AS exc_{s}")
    kept = rows.selectExpr(*_KEPT, *exc)
    return _detect(kept, resolve(kept, skew))


def empty_edge_state(spark) -> DataFrame:
    return spark.createDataFrame(
        [], "device string, " + ", ".join(f"exc_{s} boolean" for s in SENSORS))


def detect_anomalies_incremental(readings: DataFrame, prior_state: DataFrame,
                                 limits=None) -> tuple[DataFrame, DataFrame]:
    """W4 for one slice of an unbounded input (a micro-batch).

    ``prior_state`` (device, exc_<sensor>...) holds the verdicts as they were
    taken when each device's last reading was checked, under the limits of
    that time; the first reading of a device in this slice compares against
    it (``false`` when the device is new). Returns the alerts and the changes of
    state: the last verdicts of the devices with a checked reading in this slice.
    """
    kept = _kept(readings, limits)
    with_prev = kept.selectExpr("*", *_lags("device", None))
    prior = prior_state.selectExpr("device", *[f"exc_{s} AS st_{s}" for s in SENSORS])
    joined = with_prev.join(prior, "device", "left")
    alerts = _edges_to_alerts(joined, lambda s: f"coalesce(prev_{s}, st_{s}, false)")
    changes = (kept.groupBy("device")
               .agg(F.expr("max_by(struct(" + ", ".join(f"exc_{s}" for s in SENSORS) + "), seq)")
                    .alias("l"))
               .selectExpr("device", *[f"l.exc_{s} AS exc_{s}" for s in SENSORS]))
    return alerts, changes
