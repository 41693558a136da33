"""Batch sources: the driver's parquet tables and the ``events`` adapter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import READING_COLUMNS

BASE_TS_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
DEVICES = 20


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame, devices: int = DEVICES,
                         hot_every: int | None = None) -> DataFrame:
    """Map the ``events`` table onto sensor readings.

    ``seq`` is the event id (arrival order); ``ts`` is a near-regular cadence of
    3 s per event with a little jitter and rare one-hour jumps forward and back,
    so that timestamp repair has real work; ``device`` spreads events over
    ``devices`` devices. With ``hot_every`` = k, every k-th event goes to one
    device ``dev-hot`` instead (a device holding 1/k of all readings). Only
    the columns read here are scanned.
    """
    device = f"concat('dev-', CAST(event_id % {int(devices)} AS STRING))"
    if hot_every:
        device = f"CASE WHEN event_id % {int(hot_every)} = 0 THEN 'dev-hot' ELSE {device} END"
    return events.selectExpr(
        "event_id AS seq",
        f"CAST({BASE_TS_MS} + event_id * 3000 + CAST(floor(value * 10.0D) AS BIGINT)"
        " + CASE WHEN event_id % 211 = 0 THEN 3600000L"
        " WHEN event_id % 307 = 0 THEN -3600000L ELSE 0L END AS BIGINT) AS ts",
        f"{device} AS device",
        "4.0D + value / 100.0D AS co",
        "40.0D + value / 4.0D AS humidity",
        "event_id % 2 = 0 AS light",
        "CAST(100 + event_id % 103 AS DOUBLE) AS lpg",
        "event_type = 'click' AS motion",
        "3.0D + value / 50.0D AS smoke",
        "CASE WHEN (event_id div 200) % 4 = 0 THEN 21.5D"
        " ELSE 20.0D + CAST(event_id % 101 AS DOUBLE) / 10.0D END AS temp",
        "false AS rejected",
        "false AS suspicious",
    ).select(*READING_COLUMNS)


def readings(spark: SparkSession, sf_dir: str, devices: int = DEVICES,
             hot_every: int | None = None) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), devices, hot_every)



# Change logs derived from the events: a limits record with every 250th event
# (some fields null), an entry of the recipients' list with every 125th.
LIMITS_EVERY, RECIPIENTS_EVERY = 250, 125


def limit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = f"(event_id div {LIMITS_EVERY})"
    return load_table(spark, sf_dir, "events").where(f"event_id % {LIMITS_EVERY} = 0").selectExpr(
        "event_id AS seq", "0.0D AS coLower", f"4.5D + ({k} % 3) * 0.25D AS coUpper",
        "0.0D AS humidityLower", f"50.0D + ({k} % 4) * 10.0D AS humidityUpper",
        f"CASE WHEN {k} % 5 <> 0 THEN 150.0D + ({k} % 3) * 20.0D END AS lpgUpper",
        f"4.0D + ({k} % 6) * 0.5D AS smokeUpper", f"26.0D + ({k} % 5) * 1.0D AS temperatureUpper")


def recipient_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = f"(event_id div {RECIPIENTS_EVERY})"
    return load_table(spark, sf_dir, "events").where(f"event_id % {RECIPIENTS_EVERY} = 0").selectExpr(
        "event_id AS seq", f"concat('user', CAST({k} % 7 AS STRING), '@example.com') AS email",
        f"CASE WHEN {k} % 3 = 2 THEN 'remove' ELSE 'add' END AS op")
