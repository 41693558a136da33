"""The registered queries: each reads the driver's tables at ``sf_dir`` and
runs one operator (or the whole chain) over them, with the matching oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import oracle as O
from ..operators.notify import build_notifications, notifications_as_of
from ..operators.outliers import flag_outliers
from ..operators.parse import parse_readings, quarantine, readings_as_messages
from ..operators.project import to_event_alerts, to_sensor_data
from ..operators.spikes import flag_spikes
from ..operators.stuck import flag_stuck_values
from ..operators.thresholds import detect_anomalies, detect_anomalies_as_of
from ..operators.timestamps import repair_timestamps
from ..sources.config import limits_frame, limits_from_record
from ..sources.tables import LIMITS_EVERY, RECIPIENTS_EVERY, limit_changes, readings, recipient_changes
from .pipeline import clean_readings, pipeline_alerts
from .skew import SkewPlan, find_hot

# A limits record with some fields absent (they read as 0.0) and others
# tightened, so that every sensor produces alerts on the adapter's data.
CUSTOM_LIMITS_RECORD = {
    "coLower": 0.0, "coUpper": 4.8,
    "humidityLower": 0.0, "humidityUpper": 70.0,
    "lpgLower": 0.0, "lpgUpper": 180.0,
    "temperatureUpper": 27.0,
}
CUSTOM_LIMITS = limits_from_record(CUSTOM_LIMITS_RECORD)

# Recipients configuration used by the notifications query.
RECIPIENTS = ["ops@example.com", "oncall@example.com", "ops@example.com"]

# Every 50th message is damaged by the JSON rendering of the parse queries.
DAMAGE_EVERY = 50

# The hot-device variants: every 3rd event belongs to one device. A device
# with at least 1000 readings and a fifth of all readings is split into
# chunks of 2048 seq values.
HOT_EVERY = 3
HOT_PLAN = SkewPlan(min_rows=1000, span=2048, min_share=0.2)


def _source(spark, sf, hot_every=None, plan=SkewPlan()):
    """Source readings and their hot set, detected once per query on the
    source (a one-column aggregate) and handed to every operator."""
    r = readings(spark, sf, hot_every=hot_every)
    return r, find_hot(r, plan)


def _q_readings(spark, sf):
    return readings(spark, sf)


def _q_outliers(spark, sf):
    return flag_outliers(readings(spark, sf))


def _q_repair(spark, sf):
    r, hot = _source(spark, sf)
    return repair_timestamps(r, skew=hot)


def _q_spikes(spark, sf):
    r, hot = _source(spark, sf)
    return flag_spikes(flag_outliers(r), skew=hot)


def _q_stuck(spark, sf):
    r, hot = _source(spark, sf)
    return flag_stuck_values(flag_outliers(r), skew=hot)


def _q_clean(spark, sf):
    r, hot = _source(spark, sf)
    return clean_readings(r, skew=hot)


def _alerts(spark, sf, limits=None, hot_every=None, plan=SkewPlan()):
    """The whole chain W1-W4 fused in one pass (one exchange)."""
    r, hot = _source(spark, sf, hot_every, plan)
    return pipeline_alerts(r, limits, skew=hot)


def _q_alerts(spark, sf):
    return _alerts(spark, sf)


def _q_alerts_custom(spark, sf):
    """The composed form: the public cleaning and limit operators chained,
    with a partial limits record."""
    limits = limits_frame(spark, CUSTOM_LIMITS).select(*CUSTOM_LIMITS_RECORD)
    r, hot = _source(spark, sf)
    return detect_anomalies(clean_readings(r, skew=hot), limits, skew=hot)


def _q_sensor_data(spark, sf):
    r, hot = _source(spark, sf)
    return to_sensor_data(clean_readings(r, skew=hot))


def _q_event_alerts(spark, sf):
    return to_event_alerts(_alerts(spark, sf))


def _q_notifications(spark, sf):
    return build_notifications(_alerts(spark, sf), RECIPIENTS)


# Places of the order per chunk of the as-of joins (small, as the tables are).
AS_OF_SPAN = 4096


def _q_alerts_limit_changes(spark, sf):
    """Limits that change over time: the cleaned readings as-of joined with
    the change log."""
    r, hot = _source(spark, sf)
    return detect_anomalies_as_of(clean_readings(r, skew=hot), limit_changes(spark, sf), skew=hot, span=AS_OF_SPAN)


def _q_notifications_at_time(spark, sf):
    """Each alert to the recipients of its time."""
    return notifications_as_of(_alerts(spark, sf), recipient_changes(spark, sf), span=AS_OF_SPAN)


def _q_clean_hot(spark, sf):
    r, hot = _source(spark, sf, HOT_EVERY, HOT_PLAN)
    return clean_readings(r, skew=hot)


def _q_alerts_hot(spark, sf):
    return _alerts(spark, sf, hot_every=HOT_EVERY, plan=HOT_PLAN)


def _q_parse(spark, sf):
    return parse_readings(readings_as_messages(readings(spark, sf), DAMAGE_EVERY))


def _q_quarantine(spark, sf):
    return quarantine(readings_as_messages(readings(spark, sf), DAMAGE_EVERY)).select("seq", "reason")


# Devices of the parsed feed speak every 20 places; where one of their messages
# was set aside they were silent for 40, and their state is gone.
EXPIRE_AFTER = 30


def _q_clean_expiry(spark, sf):
    r = parse_readings(readings_as_messages(readings(spark, sf), DAMAGE_EVERY))
    return clean_readings(r, expire_after=EXPIRE_AFTER)


def _q_alerts_expiry(spark, sf):
    r = parse_readings(readings_as_messages(readings(spark, sf), DAMAGE_EVERY))
    return pipeline_alerts(r, expire_after=EXPIRE_AFTER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "readings_from_events": _q_readings,
    "parse_readings": _q_parse,
    "parse_quarantine": _q_quarantine,
    "repair_timestamps": _q_repair,
    "flag_outliers": _q_outliers,
    "flag_spikes": _q_spikes,
    "flag_stuck_values": _q_stuck,
    "clean_readings": _q_clean,
    "detect_anomalies": _q_alerts,
    "detect_anomalies_custom_limits": _q_alerts_custom,
    "sensor_data_rows": _q_sensor_data,
    "event_alert_rows": _q_event_alerts,
    "notifications": _q_notifications,
    "detect_anomalies_limit_changes": _q_alerts_limit_changes,
    "notifications_at_time": _q_notifications_at_time,
    "clean_readings_expiry": _q_clean_expiry,
    "detect_anomalies_expiry": _q_alerts_expiry,
    "clean_readings_hot_device": _q_clean_hot,
    "detect_anomalies_hot_device": _q_alerts_hot,
}


# Of a micro-batch of the hot feed, a device with a fifth of the readings (and
# at least 100) is split into chunks of 256 seq values.
HOT_SLICE_PLAN = SkewPlan(min_rows=100, span=256, min_share=0.2, warm_rows=32)


def _streamed(table: str, *columns: str, hot_every=None, **slices):
    """A sink of the streaming job after a bounded run with restarts; with
    ``slices`` in the form that splits devices and expires states."""
    def query(spark, sf):
        from ..streaming.replay import replayed_table
        from .slices import SliceCleaning

        out = replayed_table(spark, sf, table, DAMAGE_EVERY, hot_every=hot_every,
                             recipients_loader=lambda s: RECIPIENTS,
                             slices=SliceCleaning(**slices) if slices else None)
        return out.select(*columns) if columns else out

    return query


# Whole streaming runs; ``bench.py`` times the stream on its own.
STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_sensor_data": _streamed("sensor_data"),
    "stream_event_alerts": _streamed("event_alerts"),
    "stream_notifications": _streamed("notifications"),
    "stream_quarantine": _streamed("quarantine", "seq", "reason"),
    "stream_sensor_data_hot_device": _streamed("sensor_data", hot_every=HOT_EVERY, plan=HOT_SLICE_PLAN),
    "stream_event_alerts_hot_device": _streamed("event_alerts", hot_every=HOT_EVERY, plan=HOT_SLICE_PLAN),
    "stream_event_alerts_expiry": _streamed("event_alerts", expire_after=EXPIRE_AFTER),
}


def _sql(build) -> str:
    q = O.Sql()
    out = build(q)
    return q.render(f"SELECT * FROM {out}")


def oracle_queries() -> dict[str, str]:
    r = O.readings

    def hot_stream(q):
        return O.clean_readings(q, O.parsed(q, r(q, hot_every=HOT_EVERY), DAMAGE_EVERY))

    def lives(q):  # every life of a device a device of its own
        return O.clean_readings(q, O.lives(q, O.parsed(q, r(q), DAMAGE_EVERY), EXPIRE_AFTER))

    def expiry_alerts(q):
        return O.of_devices(q, O.detect_anomalies(q, lives(q)), "deviceId")

    def streamed_alerts(q):
        return O.detect_anomalies(q, O.clean_readings(q, O.parsed(q, r(q), DAMAGE_EVERY)))

    return {
        "stream_sensor_data": _sql(
            lambda q: O.sensor_data_rows(q, O.clean_readings(q, O.parsed(q, r(q), DAMAGE_EVERY)))),
        "stream_event_alerts": _sql(lambda q: O.event_alert_rows(q, streamed_alerts(q))),
        "stream_notifications": _sql(lambda q: O.notifications(q, streamed_alerts(q), RECIPIENTS)),
        "stream_quarantine": _sql(lambda q: O.quarantined(q, r(q), DAMAGE_EVERY)),
        "stream_sensor_data_hot_device": _sql(lambda q: O.sensor_data_rows(q, hot_stream(q))),
        "stream_event_alerts_hot_device": _sql(lambda q: O.event_alert_rows(q, O.detect_anomalies(q, hot_stream(q)))),
        "stream_event_alerts_expiry": _sql(lambda q: O.event_alert_rows(q, expiry_alerts(q))),
        "clean_readings_expiry": _sql(lambda q: O.of_devices(q, lives(q), "device")),
        "detect_anomalies_expiry": _sql(expiry_alerts),
        "readings_from_events": _sql(lambda q: r(q)),
        "parse_readings": _sql(lambda q: O.parsed(q, r(q), DAMAGE_EVERY)),
        "parse_quarantine": _sql(lambda q: O.quarantined(q, r(q), DAMAGE_EVERY)),
        "repair_timestamps": _sql(lambda q: O.repair_timestamps(q, r(q))),
        "flag_outliers": _sql(lambda q: O.flag_outliers(q, r(q))),
        "flag_spikes": _sql(lambda q: O.flag_spikes(q, O.flag_outliers(q, r(q)))),
        "flag_stuck_values": _sql(lambda q: O.flag_stuck_values(q, O.flag_outliers(q, r(q)))),
        "clean_readings": _sql(lambda q: O.clean_readings(q, r(q))),
        "detect_anomalies": _sql(lambda q: O.detect_anomalies(q, O.clean_readings(q, r(q)))),
        "detect_anomalies_custom_limits": _sql(
            lambda q: O.detect_anomalies(q, O.clean_readings(q, r(q)), CUSTOM_LIMITS)),
        "sensor_data_rows": _sql(lambda q: O.sensor_data_rows(q, O.clean_readings(q, r(q)))),
        "event_alert_rows": _sql(lambda q: O.event_alert_rows(
            q, O.detect_anomalies(q, O.clean_readings(q, r(q))))),
        "notifications": _sql(lambda q: O.notifications(
            q, O.detect_anomalies(q, O.clean_readings(q, r(q))), RECIPIENTS)),
        "detect_anomalies_limit_changes": _sql(
            lambda q: O.detect_anomalies_as_of(q, O.clean_readings(q, r(q)), LIMITS_EVERY)),
        "notifications_at_time": _sql(lambda q: O.notifications_as_of(
            q, O.detect_anomalies(q, O.clean_readings(q, r(q))), RECIPIENTS_EVERY)),
        "clean_readings_hot_device": _sql(
            lambda q: O.clean_readings(q, r(q, hot_every=HOT_EVERY))),
        "detect_anomalies_hot_device": _sql(
            lambda q: O.detect_anomalies(q, O.clean_readings(q, r(q, hot_every=HOT_EVERY)))),
    }
