"""Streaming: batch = stream, restart from checkpoint, limits changing between
micro-batches, replay of a batch."""

import os
import shutil

import pytest

from pyspark.sql import functions as F

from tests_helpers import SF_SMALL
from tidewatch.operators.thresholds import detect_anomalies
from tidewatch.plans.pipeline import clean_readings
from tidewatch.schema import READING
from tidewatch.sources.config import limits_frame, limits_from_record, read_limits
from tidewatch.sources.streams import file_readings
from tidewatch.sources.tables import readings
from tidewatch.streaming.pipeline import make_batch_writer, start_pipeline


def _feed(spark, r, folder, parts, start_index=0):
    """Contiguous seq ranges, one file each, rows shuffled inside a file;
    modification times fix the arrival order of the files."""
    os.makedirs(folder, exist_ok=True)
    for i in parts:
        tmp = f"{folder}-tmp{i}"
        r.where((F.col("seq") / 250).cast("int") == i).orderBy(F.rand(i)) \
            .coalesce(1).write.parquet(tmp)
        src = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        dst = f"{folder}/f{i:03d}.parquet"
        shutil.copy(f"{tmp}/{src}", dst)
        os.utime(dst, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def test_stream_equals_batch_with_restart(spark, scratch):
    r = readings(spark, SF_SMALL)
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _feed(spark, r, src, [0, 1])
    for q in start_pipeline(spark, file_readings(spark, src, max_files_per_trigger=1), out,
                            checkpoint_dir=ck, available_now=True, parse=False):
        q.awaitTermination()
    _feed(spark, r, src, [2, 3])       # more data arrives; the query restarts
    for q in start_pipeline(spark, file_readings(spark, src, max_files_per_trigger=1), out,
                            checkpoint_dir=ck, available_now=True, parse=False):
        q.awaitTermination()
    sd = spark.read.parquet(f"{out}/sensor_data")
    c = clean_readings(r)
    a = sd.select("seq", "rejected", "suspicious", "time")
    b = c.select("seq", "rejected", "suspicious",
                 F.timestamp_millis("ts").cast("timestamp_ntz").alias("time"))
    assert sd.count() == r.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ea = spark.read.parquet(f"{out}/event_alerts").select("seq", "sensor_type", "event_type")
    ba = detect_anomalies(c).select("seq", F.col("sensorType").alias("sensor_type"),
                                    F.col("eventType").alias("event_type"))
    assert ea.exceptAll(ba).count() == 0 and ba.exceptAll(ea).count() == 0


def _smoke_rows(spark, first_seq, n=2, smoke=6.0):
    rows = [(first_seq + i, 1000 * (first_seq + i), "d", 4.0, 50.0, False, 100.0, False,
             smoke, 21.0, False, False) for i in range(n)]
    return spark.createDataFrame(rows, READING)


def test_limits_change_between_batches_and_replay(spark, scratch):
    limits_path = f"{scratch}/limits"

    def set_smoke(hi):
        rec = limits_from_record({"coUpper": 10.0, "humidityUpper": 100.0, "lpgUpper": 1000.0,
                                  "temperatureUpper": 50.0, "temperatureLower": -40.0,
                                  "smokeUpper": hi})
        limits_frame(spark, rec).write.mode("overwrite").parquet(limits_path)

    handler = make_batch_writer(spark, f"{scratch}/out",
                                limits_loader=lambda s: read_limits(s, limits_path),
                                recipients_loader=lambda s: ["ops@example.com"],
                                state_dir=f"{scratch}/edges")
    for batch_id, hi in enumerate([5.0, 7.0, 5.0]):
        set_smoke(hi)
        handler(_smoke_rows(spark, 10 * batch_id), batch_id)
    alerts = spark.read.parquet(f"{scratch}/out/event_alerts")
    got = [(r.seq, r.event_type) for r in alerts.orderBy("seq").collect()]
    assert got == [(0, "anomaly_start"), (10, "anomaly_end"), (20, "anomaly_start")]
    # replaying batch 2 (same prior state, same limits) leaves the output unchanged
    handler(_smoke_rows(spark, 20), 2)
    again = [(r.seq, r.event_type) for r in
             spark.read.parquet(f"{scratch}/out/event_alerts").orderBy("seq").collect()]
    assert again == got
    notes = spark.read.parquet(f"{scratch}/out/notifications").collect()
    assert len(notes) == 3 and all(n.recipients == "ops@example.com" for n in notes)


def test_stream_from_raw_messages_with_quarantine(spark, scratch):
    from tidewatch.operators.parse import parse_readings, readings_as_messages
    from tidewatch.sources.streams import file_messages
    r = readings(spark, SF_SMALL)
    msgs = readings_as_messages(r, 50)
    src, out, ck = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(src)
    for i in range(2):
        tmp = f"{scratch}/tmp{i}"
        msgs.where((F.col("seq") / 500).cast("int") == i).coalesce(1).write.parquet(tmp)
        f = [x for x in os.listdir(tmp) if x.endswith(".parquet")][0]
        shutil.copy(f"{tmp}/{f}", f"{src}/m{i}.parquet")
        os.utime(f"{src}/m{i}.parquet", (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    qs = start_pipeline(spark, file_messages(spark, src, max_files_per_trigger=1), out,
                        checkpoint_dir=ck, available_now=True, parse=True)
    assert len(qs) == 1
    for q in qs:
        q.awaitTermination()
    dead = spark.read.parquet(f"{out}/quarantine")
    assert dead.count() == 12
    assert {r.reason for r in dead.select("reason").distinct().collect()} == {
        "invalid field: co", "invalid field: device", "malformed", "invalid field: light",
        "invalid field: smoke"}
    sd = spark.read.parquet(f"{out}/sensor_data")
    expected = clean_readings(parse_readings(msgs))
    b = expected.select("seq", "rejected", "suspicious",
                        F.timestamp_millis("ts").cast("timestamp_ntz").alias("time"))
    a = sd.select("seq", "rejected", "suspicious", "time")
    assert sd.count() == 988
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_keeps_nan_readings(spark, scratch):
    from tests_helpers import nan_rows
    rows = nan_rows()
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    spark.createDataFrame(rows, READING).coalesce(1).write.parquet(src)
    for q in start_pipeline(spark, file_readings(spark, src), out, checkpoint_dir=ck,
                            available_now=True, parse=False):
        q.awaitTermination()
    sd = spark.read.parquet(f"{out}/sensor_data")
    got = {r.seq: r.co for r in sd.collect()}
    assert len(got) == len(rows)
    assert all((g != g) == (r[3] != r[3]) for r in rows for g in [got[r[0]]])


def test_crash_mid_batch_then_restart(spark, scratch, monkeypatch):
    """Batch 1 dies after writing sensor_data and event_alerts but before its
    notifications, edge state and commit; the restarted query replays it."""
    import tidewatch.streaming.pipeline as sp
    r = readings(spark, SF_SMALL)
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _feed(spark, r, src, [0, 1, 2, 3])
    real = sp.write_notifications
    crashed = []

    def flaky(df, path, batch_id=None, **kw):
        if batch_id == 1 and not crashed:
            crashed.append(1)
            raise RuntimeError("executor lost")
        return real(df, path, batch_id, **kw)

    monkeypatch.setattr(sp, "write_notifications", flaky)
    with pytest.raises(Exception):
        for q in start_pipeline(spark, file_readings(spark, src, max_files_per_trigger=1), out,
                                checkpoint_dir=ck, available_now=True, parse=False):
            q.awaitTermination()
    assert crashed
    for q in start_pipeline(spark, file_readings(spark, src, max_files_per_trigger=1), out,
                            checkpoint_dir=ck, available_now=True, parse=False):
        q.awaitTermination()
    c = clean_readings(r)
    sd = spark.read.parquet(f"{out}/sensor_data")
    assert sd.count() == r.count()
    a = sd.select("seq", "rejected", "suspicious")
    assert a.exceptAll(c.select("seq", "rejected", "suspicious")).count() == 0
    ea = spark.read.parquet(f"{out}/event_alerts").select("seq", "sensor_type", "event_type")
    ba = detect_anomalies(c).select("seq", F.col("sensorType").alias("sensor_type"),
                                    F.col("eventType").alias("event_type"))
    assert ea.count() == ba.count()
    assert ea.exceptAll(ba).count() == 0 and ba.exceptAll(ea).count() == 0
    assert spark.read.parquet(f"{out}/notifications").count() == ba.count()


def test_edge_state_is_a_log_of_changes(spark, scratch):
    """Rows written follow the devices seen; replays, compaction and clean-up change nothing."""
    from tidewatch.operators.thresholds import empty_edge_state
    from tidewatch.streaming.pipeline import EdgeStateTable
    table = EdgeStateTable(spark, f"{scratch}/edges", compact_every=3)
    schema = empty_edge_state(spark).schema

    def rows(names, on):
        return spark.createDataFrame([(n, on, False, False, False, False) for n in names], schema)

    def state(below):
        return {r.device: r.exc_co for r in table.read_before(below).collect()}

    table.write(rows([f"d{i}" for i in range(50)], True), 0)
    want = {f"d{i}": True for i in range(50)}
    assert state(0) == {} and state(1) == want
    for batch in range(1, 12):
        seen = {f"d{batch}": False, f"new{batch}": True}
        before = state(batch)
        assert before == want
        for _ in range(2):  # the second time is a replay
            table.write(rows([f"d{batch}"], False).union(rows([f"new{batch}"], True)), batch)
            assert spark.read.parquet(f"{scratch}/edges/delta={batch}").count() == 2
            assert state(batch) == before
        want = {**want, **seen}
    assert state(12) == want
    kept = sorted(os.listdir(f"{scratch}/edges"))
    assert sum(k.startswith("base=") for k in kept) == 2 and sum(k.startswith("delta=") for k in kept) <= 6
