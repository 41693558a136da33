"""K3 notification outbox (J2 recipients, X5-X8 text functions).

One message per alert, addressed to every recipient. Delivery itself (SMTP)
is not part of the engine; the outbox table is what a mailer would read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MS_TO_TIMESTAMP_SQL
from ..schema import EVENT_END, EVENT_LABELS, EVENT_START
from .as_of import SPAN, as_of

# The message layout (must equal the reference's text).
BODY_FORMAT = (
    "This is an automated message informing you that there has been an `%s` event "
    "for sensor `%s` on device `%s`.\n"
    "Timestamp of the event:            %s\n"
    "Value that triggered the event:    %.2f\n"
    "Can be false flag:                 %b\n"
    "\n"
    "Please take action!\n"
)
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def recipients_header(recipients: DataFrame | list[str] | None) -> str | DataFrame:
    """Distinct recipients, sorted, comma-separated (set semantics): a text for
    a list, a one-row frame (column ``recipients``) for a frame."""
    if isinstance(recipients, DataFrame):
        return recipients.select("email").distinct().agg(
            F.array_join(F.array_sort(F.collect_list("email")), ",").alias("recipients"))
    return ",".join(sorted({e for e in recipients or [] if e is not None}))


def _sql_str(text: str) -> str:
    """A SQL string literal (backslash escapes, as Spark's parser reads them)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def event_label_sql(col: str = "eventType") -> str:
    """anomaly_start -> 'Anomaly start', anomaly_end -> 'Anomaly end', other
    values unchanged."""
    return (f"CASE WHEN {col} = '{EVENT_START}' THEN '{EVENT_LABELS[EVENT_START]}' "
            f"WHEN {col} = '{EVENT_END}' THEN '{EVENT_LABELS[EVENT_END]}' ELSE {col} END")


def format_event_time_sql(ms_col: str, zone: str = "UTC") -> str:
    local = f"convert_timezone('UTC', {_sql_str(zone)}, {MS_TO_TIMESTAMP_SQL.format(ms=ms_col)})"
    return f"date_format({local}, '{TIMESTAMP_PATTERN}')"


def build_notifications(alerts: DataFrame, recipients=None, zone: str = "UTC") -> DataFrame:
    """(seq, deviceId, sensorType, eventType, subject, body, recipients) per
    alert: a narrow projection. Recipients in a frame of any size are gathered
    by Spark and attached as one row on a constant key."""
    to = recipients_header(recipients)
    if isinstance(to, DataFrame):
        # one row by construction: a global aggregate
        alerts = alerts.withColumn("_one", F.lit(1)).join(
            F.broadcast(to.withColumn("_one", F.lit(1))), "_one")
    return _messages(alerts, "recipients" if isinstance(to, DataFrame) else _sql_str(to), zone)


def _messages(alerts: DataFrame, recipients_sql: str, zone: str) -> DataFrame:
    label = event_label_sql()
    body = (f"format_string({_sql_str(BODY_FORMAT)}, {label}, sensorType, deviceId, "
            f"{format_event_time_sql('timestamp', zone)}, value, suspicious)")
    return alerts.selectExpr(
        "seq", "deviceId", "sensorType", "eventType",
        f"concat(sensorType, ' ', {label}, ' Alert') AS subject",
        f"{body} AS body",
        f"{recipients_sql} AS recipients",
    )


def recipients_over_time(log: DataFrame) -> DataFrame:
    """(from_seq, rec) with ``rec.recipients``, the sorted set after every step
    of a log (seq, email, op = add | remove). Steps are numbered; an email holds
    from its ``add`` to the step before its next entry, and each step's set is
    gathered from the intervals that cover it. Adding twice or removing an
    absent email changes nothing; of two entries of one email at one place
    ``remove`` counts. Null emails and other ops are left out."""
    log = (log.where("seq IS NOT NULL AND email IS NOT NULL AND op IN ('add', 'remove')")
           .groupBy(F.expr("CAST(seq AS BIGINT)").alias("seq"), "email").agg(F.max("op").alias("op")))
    steps = log.select("seq").distinct().selectExpr(
        "seq", "row_number() OVER (ORDER BY seq) AS _n", "count(*) OVER () AS _all")
    held = (log.join(steps, "seq")
            .selectExpr("email", "op", "_n", "coalesce(lead(_n) OVER (PARTITION BY email ORDER BY _n) - 1, _all) AS _to")
            .where("op = 'add'").selectExpr("email", "explode(sequence(_n, _to)) AS _n"))
    sets = held.groupBy("_n").agg(F.array_join(F.array_sort(F.collect_set("email")), ",").alias("r"))
    return steps.join(sets, "_n", "left").selectExpr(
        "seq AS from_seq", "named_struct('recipients', coalesce(r, '')) AS rec")


def notifications_as_of(alerts: DataFrame, log: DataFrame, zone: str = "UTC", span: int = SPAN) -> DataFrame:
    """``build_notifications`` to the recipients on the list when each alert was
    raised (its ``seq``), nobody before the first entry."""
    return _messages(as_of(alerts, recipients_over_time(log), span=span), "coalesce(rec.recipients, '')", zone)
