"""Sinks K1-K5: sensor_data, event_alerts, notifications, console, dead letter.

Every sink is an append of one DataFrame. In a stream each write happens
inside ``foreachBatch`` under the micro-batch id: parquet output goes to a
``batch_id=<id>`` folder written with mode overwrite, so a replayed batch
replaces its own earlier output instead of duplicating it. JDBC output
(the original target was a PostgreSQL table) goes through a staging table and
one transaction, which replaces the batch likewise (``sinks/jdbc.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.project import to_event_alerts, to_sensor_data
from .jdbc import replace_batch

OUTPUTS = ("sensor_data", "event_alerts", "notifications", "quarantine")


def sink_options(sinks: dict[str, dict] | None, fmt: str = "parquet") -> dict[str, dict]:
    """Of each output the format and writer options: those of ``sinks``, by
    the output's name, else ``fmt`` without options."""
    unknown = set(sinks or {}) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"no such output: {', '.join(sorted(unknown))}")
    return {name: {"fmt": fmt, **(sinks or {}).get(name, {})} for name in OUTPUTS}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", batch_id: int | None = None,
                **options) -> None:
    """Append ``df`` to a table folder, or to the table named by the option
    ``dbtable``; with ``batch_id`` the write is idempotent per batch."""
    if fmt == "jdbc":
        if batch_id is None:
            df.write.format("jdbc").options(**options).mode("append").save()
        else:
            replace_batch(df, batch_id, options)
        return
    if fmt == "console":
        for line in df.toJSON().toLocalIterator():  # every row, a partition at a time
            print(line)
        return
    target = path if batch_id is None else f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    mode = "append" if batch_id is None else "overwrite"
    df.write.format(fmt).options(**options).mode(mode).save(target)


def write_sensor_data(readings: DataFrame, path: str, batch_id: int | None = None,
                      fmt: str = "parquet", **options) -> None:
    """K1: every reading, rejected and suspicious ones included."""
    write_table(to_sensor_data(readings), path, fmt, batch_id, **options)


def write_event_alerts(alerts: DataFrame, path: str, batch_id: int | None = None,
                       fmt: str = "parquet", **options) -> None:
    """K2."""
    write_table(to_event_alerts(alerts), path, fmt, batch_id, **options)


def write_notifications(notifications: DataFrame, path: str, batch_id: int | None = None,
                        fmt: str = "parquet", **options) -> None:
    """K3: the outbox a mail relay reads."""
    write_table(notifications, path, fmt, batch_id, **options)


def write_quarantine(bad: DataFrame, path: str, batch_id: int | None = None,
                     fmt: str = "parquet", **options) -> None:
    """K5: malformed messages with their reason."""
    write_table(bad, path, fmt, batch_id, **options)
