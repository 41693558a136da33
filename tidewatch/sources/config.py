"""Configuration sources: alert limits (S2) and notification recipients (S3).

Both are small configuration records kept in any Spark-readable store
(parquet, JSON, a JDBC table). The limits record is one row by definition; it
is resolved to literals so that Catalyst folds the comparisons into the scan's
projection.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schema import DEFAULT_LIMITS, LIMIT_FIELDS, LIMITS, RECIPIENTS, SENSORS

Limits = dict[str, tuple[float, float]]


def read_config(spark: SparkSession, path: str, fmt: str = "parquet",
                schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def read_limits(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    return read_config(spark, path, fmt, schema=LIMITS if fmt == "json" else None, **options)


def read_recipients(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    return read_config(spark, path, fmt, schema=RECIPIENTS if fmt == "json" else None, **options)


def limits_from_record(record: Mapping | None) -> Limits:
    """Resolve one limits record.

    No record -> the default limits. A record that exists but lacks a field
    (or holds null for it) -> 0.0 for that field, the way a lenient record
    mapper fills a missing primitive. Unknown fields are ignored.
    """
    if record is None:
        return dict(DEFAULT_LIMITS)
    out = {}
    for sensor in SENSORS:
        lo_name, hi_name = LIMIT_FIELDS[sensor]
        lo, hi = record.get(lo_name), record.get(hi_name)
        out[sensor] = (0.0 if lo is None else float(lo), 0.0 if hi is None else float(hi))
    return out


def resolve_limits(limits: DataFrame | Mapping | None) -> Limits:
    """Limits from a one-record DataFrame, a mapping, or ``None`` (defaults).

    The DataFrame is a configuration record: at most one row is allowed, which
    bounds what reaches the driver.
    """
    if limits is None:
        return dict(DEFAULT_LIMITS)
    if isinstance(limits, Mapping):
        if all(s in limits for s in SENSORS):
            return {s: (float(limits[s][0]), float(limits[s][1])) for s in SENSORS}
        return limits_from_record(limits)
    wanted = [c for c in limits.columns if c in LIMITS.fieldNames()]
    rows = limits.select(*wanted).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("the limits table must hold at most one record")
    return limits_from_record(rows[0].asDict() if rows else None)


def limits_frame(spark: SparkSession, limits: Limits | None = None) -> DataFrame:
    """The limits as a one-row DataFrame in the record layout."""
    lim = limits or DEFAULT_LIMITS
    row = {}
    for sensor in SENSORS:
        lo_name, hi_name = LIMIT_FIELDS[sensor]
        row[lo_name], row[hi_name] = lim[sensor]
    return spark.createDataFrame([tuple(row[f] for f in LIMITS.fieldNames())], LIMITS)
