"""The streaming job: raw messages -> parse -> keyed cleaning -> per batch:
sensor_data, limits check, event_alerts, notifications (T5-T7, K1-K5).

Limits are re-read at every micro-batch inside ``foreachBatch`` (a stream-
static join would keep serving the limits it saw first), so a change is
visible from the next batch on, while the per-device edge state survives it:
that state is a log of changes, keyed by batch id and compacted now and then,
in the shared checkpoint folder. Batch N reads what lies below N and writes the
devices it saw, so a replayed batch starts from the same prior state, and every
output folder is keyed by batch id, so a replay overwrites instead of
duplicating. Good and bad messages leave one parse under a tag and one query,
so the dead letter shares the checkpoint of the other sinks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.notify import build_notifications
from ..operators.parse import parse_messages
from ..operators.thresholds import alerts_from_edges, detect_anomalies_incremental, empty_edge_state
from ..plans.slices import STATE as SLICE_STATE, SliceCleaning
from ..sinks.tables import (sink_options, write_event_alerts, write_notifications, write_quarantine,
                            write_sensor_data, write_table)
from ..sources.config import resolve_limits
from ..schema import READING_COLUMNS
from ..session import checkpoint_path
from .processor import clean_stream


def _versions(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """Completed folders ``<kind>=<batch id>``, by batch id."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith(f"{kind}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[len(kind) + 1:]))
    return sorted(out)


class StateLog:
    """A state of one row a device (``schema``, with ``device``) across
    micro-batches, as a log of changes.

    Batch N writes the rows of the devices it saw (``delta=N``); after
    ``compact_every`` deltas also the whole state up to N (``base=N``), less what
    ``alive`` leaves out. The state
    before N is the newest base below N with the deltas after it, the newest
    entry of a device counting. A replayed batch reads only what lies below it
    and overwrites its own folders. The last two bases and the deltas since the
    older one are kept."""

    def __init__(self, spark: SparkSession, folder: str, schema, compact_every: int = 16,
                 alive: Callable[[DataFrame], DataFrame] = lambda df: df):
        self.spark, self.folder, self.compact_every = spark, folder.rstrip("/"), int(compact_every)
        self.empty, self.alive = spark.createDataFrame([], schema), alive

    def _parts(self, below: int) -> tuple[int | None, list[int]]:
        bases = [v for v in _versions(self.spark, self.folder, "base") if v < below]
        base = bases[-1] if bases else None
        deltas = [v for v in _versions(self.spark, self.folder, "delta")
                  if v < below and (base is None or v > base)]
        return base, deltas

    def read_before(self, batch_id: int) -> DataFrame:
        base, deltas = self._parts(batch_id)
        schema = self.empty.schema
        frames = [self.spark.read.schema(schema).parquet(f"{self.folder}/{kind}={v}").withColumn("_v", F.lit(v))
                  for kind, v in [("base", base)] * (base is not None) + [("delta", v) for v in deltas]]
        if not frames:
            return self.empty
        log = reduce(DataFrame.union, frames)
        rest = ", ".join(c for c in schema.fieldNames() if c != "device")
        return log.groupBy("device").agg(F.expr(f"max_by(struct({rest}), _v)").alias("s")).select("device", "s.*")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """``changes``: one row per device seen in the batch."""
        changes.write.mode("overwrite").parquet(f"{self.folder}/delta={batch_id}")
        if len(self._parts(batch_id + 1)[1]) >= self.compact_every:
            self.alive(self.read_before(batch_id + 1)).write.mode("overwrite").parquet(f"{self.folder}/base={batch_id}")
            bases = _versions(self.spark, self.folder, "base")
            if len(bases) > 1:
                self._drop([("base", v) for v in bases[:-2]]
                           + [("delta", v) for v in _versions(self.spark, self.folder, "delta") if v <= bases[-2]])

    def _drop(self, parts: list[tuple[str, int]]) -> None:
        jvm = self.spark._jvm
        for kind, v in parts:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}={v}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class EdgeStateTable(StateLog):
    """(device, exc_<sensor>...): the last verdicts of W4."""

    def __init__(self, spark: SparkSession, folder: str, compact_every: int = 16):
        super().__init__(spark, folder, empty_edge_state(spark).schema, compact_every)


def make_batch_writer(spark: SparkSession, out_dir: str,
                      limits_loader: Callable[[SparkSession], object] | None = None,
                      recipients_loader: Callable[[SparkSession], object] | None = None,
                      state_dir: str | None = None, zone: str = "UTC",
                      debug_rows: int = 0, sinks: dict[str, dict] | None = None,
                      slices: SliceCleaning | None = None):
    """The ``foreachBatch`` function for cleaned readings (with ``slices``: for
    readings that it cleans itself, from the states it keeps; ``debug_rows``
    also prints every cleaned reading of a batch: the debug print, K4). Bad
    messages that come along under a ``reason`` go to the dead letter (K5).
    ``sinks`` gives an output a format and writer options of its own
    ({"sensor_data": {"fmt": "jdbc", "url": .., "dbtable": ..}}); the others
    are Parquet folders."""
    out = out_dir.rstrip("/")
    to = sink_options(sinks)
    folder = state_dir or checkpoint_path(spark, "edge-state")
    states = EdgeStateTable(spark, folder) if slices is None else StateLog(
        spark, folder, SLICE_STATE, alive=slices.alive)

    def handle(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.persist()
        try:
            if "reason" in batch.columns:
                write_quarantine(arrived.where("reason IS NOT NULL").select("seq", "value", "reason"),
                                 f"{out}/quarantine", batch_id, **to["quarantine"])
                batch = arrived.where("reason IS NULL").drop("value", "reason")
            limits = resolve_limits(limits_loader(spark) if limits_loader else None)
            if slices is None:
                alerts, changes = detect_anomalies_incremental(batch, states.read_before(batch_id), limits)
            else:
                batch, changes = slices.run(batch, states.read_before(batch_id), limits)
                alerts = alerts_from_edges(batch)
            batch = batch.select(*READING_COLUMNS)
            write_sensor_data(batch, f"{out}/sensor_data", batch_id, **to["sensor_data"])
            if debug_rows:
                write_table(batch, "", "console")
            alerts.persist()
            try:
                write_event_alerts(alerts, f"{out}/event_alerts", batch_id, **to["event_alerts"])
                recipients = recipients_loader(spark) if recipients_loader else None
                write_notifications(build_notifications(alerts, recipients, zone),
                                    f"{out}/notifications", batch_id, **to["notifications"])
                states.write(changes, batch_id)
            finally:
                alerts.unpersist()
        finally:
            arrived.unpersist()

    return handle


def start_pipeline(spark: SparkSession, messages: DataFrame, out_dir: str, *,
                   limits_loader=None, recipients_loader=None,
                   checkpoint_dir: str | None = None, trigger_seconds: float | None = 10.0,
                   available_now: bool = False, parse: bool = True,
                   debug_rows: int = 0, sinks: dict[str, dict] | None = None,
                   slices: SliceCleaning | None = None, **params) -> list[StreamingQuery]:
    """Start the one query that parses, cleans and alerts, with all its sinks
    under one checkpoint (``debug_rows`` prints cleaned readings per batch, K4;
    ``sinks``: see ``make_batch_writer``).
    ``messages`` is a streaming (seq, value) frame, or a stream of typed
    readings when ``parse=False``.

    ``slices`` cleans each micro-batch as a slice instead of in Spark's keyed
    state: a device that holds much of a micro-batch is split over tasks, and
    states can expire. A started job keeps to the form it began with, as the
    states of the two are not exchanged."""
    ckpt = (checkpoint_dir or checkpoint_path(spark, "stream")).rstrip("/")
    out = out_dir.rstrip("/")
    # keyed state for many devices lives off-heap in RocksDB unless the
    # deployment chose a provider already
    if not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                       "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def trig(writer):
        if available_now:
            return writer.trigger(availableNow=True)
        if trigger_seconds:
            return writer.trigger(processingTime=f"{trigger_seconds} seconds")
        return writer

    # every message is parsed once; good and bad ones travel under a tag
    rows = parse_messages(messages) if parse else messages
    if slices is not None:
        slices, cleaned = replace(slices, params={**slices.params, **params}), rows
    else:
        cleaned = clean_stream(rows, **params)
    handler = make_batch_writer(spark, out, limits_loader, recipients_loader,
                                state_dir=f"{ckpt}/{'edge' if slices is None else 'slice'}-state",
                                debug_rows=debug_rows, sinks=sinks, slices=slices)
    return [trig(cleaned.writeStream.foreachBatch(handler)
                 .option("checkpointLocation", f"{ckpt}/clean")).start()]
