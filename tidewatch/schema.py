"""Shared schemas, column names and the fixed values of the cleaning rules.

Every operator in the package addresses columns by name; the schemas here are
the single source of truth for them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Sensor order, also the order in which alerts of one reading are emitted.
SENSORS = ("co", "humidity", "lpg", "smoke", "temp")

# Physical plausibility bounds (inclusive ends) used by flag_outliers.
PHYSICAL_BOUNDS = {
    "co": (0.0, 50.0),
    "humidity": (0.0, 100.0),
    "lpg": (0.0, 1000.0),
    "smoke": (0.0, 1000.0),
    "temp": (-90.0, 85.0),
}

# Alert limits used when no limits record exists (lower, upper).
DEFAULT_LIMITS = {
    "humidity": (0.0, 100.0),
    "temp": (-40.0, 50.0),
    "co": (0.0, 10.0),
    "lpg": (0.0, 1000.0),
    "smoke": (0.0, 5.0),
}

# Field names of the limits record, per sensor (lower, upper).
LIMIT_FIELDS = {
    "humidity": ("humidityLower", "humidityUpper"),
    "temp": ("temperatureLower", "temperatureUpper"),
    "co": ("coLower", "coUpper"),
    "lpg": ("lpgLower", "lpgUpper"),
    "smoke": ("smokeLower", "smokeUpper"),
}

TS_WINDOW = 10            # stamps kept by repair_timestamps
TS_RATIO = 2.0            # a gap above ratio x mean gap is bad
SPIKE_WINDOW = 10         # values kept per sensor by flag_spikes
SPIKE_THRESHOLD = 0.5     # spike iff v >= m + m*t or v <= m - m*t
STUCK_DURATION_MS = 120_000  # same value for this long -> stuck

EVENT_START = "anomaly_start"
EVENT_END = "anomaly_end"
EVENT_LABELS = {EVENT_START: "Anomaly start", EVENT_END: "Anomaly end"}
# ---------------------------------------------------------------------------

READING_FIELDS = ("ts", "device", "co", "humidity", "light", "lpg", "motion",
                  "smoke", "temp", "rejected", "suspicious")

# A reading as the operators see it: the 11 fields plus ``seq``, the arrival
# order inside a device (a DataFrame has no order, so it must be a column).
READING = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts", T.LongType(), False),
    T.StructField("device", T.StringType(), False),
    T.StructField("co", T.DoubleType(), False),
    T.StructField("humidity", T.DoubleType(), False),
    T.StructField("light", T.BooleanType(), False),
    T.StructField("lpg", T.DoubleType(), False),
    T.StructField("motion", T.BooleanType(), False),
    T.StructField("smoke", T.DoubleType(), False),
    T.StructField("temp", T.DoubleType(), False),
    T.StructField("rejected", T.BooleanType(), False),
    T.StructField("suspicious", T.BooleanType(), False),
])
READING_COLUMNS = tuple(f.name for f in READING.fields)

ALERT = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("deviceId", T.StringType(), False),
    T.StructField("eventType", T.StringType(), False),
    T.StructField("sensorType", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("suspicious", T.BooleanType(), False),
    T.StructField("value", T.DoubleType(), False),
])
ALERT_COLUMNS = tuple(f.name for f in ALERT.fields)

LIMITS = T.StructType([
    T.StructField(name, T.DoubleType(), True)
    for name in ("humidityUpper", "humidityLower", "temperatureUpper",
                 "temperatureLower", "coUpper", "coLower", "lpgUpper",
                 "lpgLower", "smokeUpper", "smokeLower")
])

RECIPIENTS = T.StructType([T.StructField("email", T.StringType(), False)])

RAW_MESSAGE = T.StructType([
    T.StructField("seq", T.LongType(), True),
    T.StructField("value", T.StringType(), True),
])

# Where a message came from; offsets (``seq``) are an order within one such place only.
MESSAGE_PLACE = ("topic", "partition")
