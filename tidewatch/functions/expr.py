"""Column expressions shared by the operators (all JVM-side built-ins).

Comparisons follow Java double semantics: any comparison with NaN is false.
Spark orders NaN above every number and treats NaN = NaN as true, so every
comparison on a sensor value is guarded with ``isnan``.

Expressions are written as SQL text and turned into a Column with ONE call
(``F.expr``): composing them from many small Column operations costs a
driver round-trip per operation, which dominates planning time for the wide
five-sensor expressions used here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def dlit(x: float) -> str:
    """A double literal as SQL text (NaN and infinities included)."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def less_sql(a: str, b: float) -> str:
    """``a < b`` with Java semantics (false when either is NaN)."""
    if math.isnan(float(b)):
        return "false"
    return f"(NOT isnan({a}) AND {a} < {dlit(b)})"


def greater_sql(a: str, b: float) -> str:
    """``a > b`` with Java semantics (false when either is NaN)."""
    if math.isnan(float(b)):
        return "false"
    return f"(NOT isnan({a}) AND {a} > {dlit(b)})"


def outside_sql(value: str, low: float, high: float) -> str:
    """``value < low || value > high`` with Java NaN semantics."""
    return f"({less_sql(value, low)} OR {greater_sql(value, high)})"


def equal_sql(a: str, b: str) -> str:
    """``a == b`` on doubles with Java semantics (NaN is equal to nothing)."""
    return f"(NOT isnan({a}) AND NOT isnan({b}) AND {a} = {b})"


def any_sql(parts) -> str:
    return "(" + " OR ".join(parts) + ")"


# Years 1 to 9999; a stamp outside them has no timestamp (NULL), never an error.
MS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)
MS_TO_TIMESTAMP_SQL = (
    "timestampadd(MILLISECOND, CASE WHEN {ms} BETWEEN %d AND %d THEN {ms} END, "
    "TIMESTAMP_NTZ'1970-01-01 00:00:00')" % MS_RANGE)


def ms_to_timestamp(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ holding the UTC wall clock of the
    instant. Independent of the session time zone (no zone conversion)."""
    if isinstance(ms, str):
        return F.expr(MS_TO_TIMESTAMP_SQL.format(ms=ms))
    ms = F.when(ms.between(*MS_RANGE), ms)
    return F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
