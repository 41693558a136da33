"""F1 flag_outliers: physically impossible values mark a reading rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import any_sql, outside_sql
from ..schema import PHYSICAL_BOUNDS, SENSORS


def outlier_sql(bounds=PHYSICAL_BOUNDS) -> str:
    """True when any sensor lies strictly outside its bounds (NaN is inside)."""
    return any_sql(outside_sql(s, *bounds[s]) for s in SENSORS)


def outlier_condition(bounds=PHYSICAL_BOUNDS) -> Column:
    return F.expr(outlier_sql(bounds))


def flag_outliers(readings: DataFrame, bounds=PHYSICAL_BOUNDS) -> DataFrame:
    """Flag, never drop: ``rejected`` becomes true for out-of-bounds readings;
    a reading already rejected stays rejected. A narrow projection, fused into
    the scan's whole-stage codegen."""
    return readings.withColumn("rejected", F.expr(f"rejected OR {outlier_sql(bounds)}"))
