"""P4 / P5: readings and alerts in the layout of the output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.expr import MS_TO_TIMESTAMP_SQL


def to_sensor_data(readings: DataFrame) -> DataFrame:
    """sensor_data(seq, time, device, temperature, humidity, co, light, lpg,
    motion, smoke, rejected, suspicious): ms -> timestamp, temp renamed,
    light/motion as 0/1. ``seq`` is kept as the idempotency key."""
    return readings.selectExpr(
        "seq",
        f"{MS_TO_TIMESTAMP_SQL.format(ms='ts')} AS time",
        "device",
        "temp AS temperature",
        "humidity", "co",
        "CAST(light AS INT) AS light",
        "lpg",
        "CAST(motion AS INT) AS motion",
        "smoke", "rejected", "suspicious",
    )


def to_event_alerts(alerts: DataFrame) -> DataFrame:
    """event_alerts(seq, time, device, event_type, sensor_type, value,
    suspicious)."""
    return alerts.selectExpr(
        "seq",
        f"{MS_TO_TIMESTAMP_SQL.format(ms='timestamp')} AS time",
        "deviceId AS device",
        "eventType AS event_type",
        "sensorType AS sensor_type",
        "value", "suspicious",
    )
