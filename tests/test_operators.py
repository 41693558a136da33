"""Operators on Spark: hand-traced cases, properties, plan shape."""

from pyspark.sql import functions as F

from tests_helpers import SF_SMALL
from tidewatch.operators.notify import build_notifications
from tidewatch.operators.outliers import flag_outliers
from tidewatch.operators.parse import parse_readings, quarantine
from tidewatch.operators.stuck import flag_stuck_values
from tidewatch.operators.thresholds import detect_anomalies
from tidewatch.plans.pipeline import clean_readings, clean_readings_composed
from tidewatch.schema import ALERT, READING, READING_COLUMNS
from tidewatch.sources.config import limits_frame, resolve_limits
from tidewatch.sources.tables import readings

NAN = float("nan")


def reading(seq, ts=0, device="d", co=4.0, humidity=50.0, light=False, lpg=100.0,
            motion=False, smoke=3.0, temp=21.0, rejected=False, suspicious=False):
    return (seq, ts, device, co, humidity, light, lpg, motion, smoke, temp, rejected, suspicious)


def frame(spark, rows):
    return spark.createDataFrame(rows, READING)


def by_seq(df, *cols):
    return [tuple(r) for r in df.orderBy("seq").select(*cols).collect()]


def test_flag_outliers_bounds(spark):
    rows = [reading(1, co=0.0), reading(2, co=50.0), reading(3, co=-0.01), reading(4, co=50.01),
            reading(5, humidity=100.01), reading(6, lpg=1000.0), reading(7, smoke=1000.01),
            reading(8, temp=-90.0), reading(9, temp=85.01), reading(10, co=NAN),
            reading(11, rejected=True)]
    got = dict(by_seq(flag_outliers(frame(spark, rows)), "seq", "rejected"))
    assert got == {1: False, 2: False, 3: True, 4: True, 5: True, 6: False, 7: True,
                   8: False, 9: True, 10: False, 11: True}


def test_flag_stuck_values_window(spark):
    temps = [(0, 21.5), (60000, 21.5), (119999, 21.5), (120000, 21.5), (180000, 22.0), (300000, 22.0)]
    rows = [reading(i, ts=t, temp=v) for i, (t, v) in enumerate(temps)]
    got = [s for _, s in by_seq(flag_stuck_values(frame(spark, rows)), "seq", "suspicious")]
    # co/humidity/... are constant too: the row is stuck as soon as any sensor is
    assert got == [False, False, False, True, True, True]
    rows = [reading(0, ts=0, co=1.0, temp=1.0, humidity=1.0, lpg=1.0, smoke=1.0),
            reading(1, ts=60000, co=2.0, temp=2.0, humidity=2.0, lpg=2.0, smoke=2.0, suspicious=True),
            reading(2, ts=120000, co=1.0, temp=1.0, humidity=1.0, lpg=1.0, smoke=1.0)]
    got = [s for _, s in by_seq(flag_stuck_values(frame(spark, rows)), "seq", "suspicious")]
    assert got == [False, True, True]


def _alerts(spark, smokes, limits=None):
    rows = [reading(i, ts=1000 * i, device=dev, smoke=v, rejected=rej, suspicious=sus)
            for i, (dev, v, rej, sus) in enumerate(smokes)]
    out = detect_anomalies(frame(spark, rows), limits)
    return [tuple(r) for r in out.orderBy("seq", "sensorType")
            .select("seq", "deviceId", "eventType", "sensorType", "suspicious").collect()]


def test_detect_anomalies_edges(spark):
    got = _alerts(spark, [("a", 5.0, False, False), ("a", 5.01, False, True),
                          ("a", 6.0, False, False), ("a", 4.0, True, False),
                          ("a", 5.0, False, False)])
    assert got == [(1, "a", "anomaly_start", "smoke", True), (4, "a", "anomaly_end", "smoke", False)]


def test_detect_anomalies_devices_independent(spark):
    got = _alerts(spark, [("a", 6.0, False, False), ("b", 6.0, False, False),
                          ("a", 6.0, False, False), ("b", 1.0, False, False)])
    assert got == [(0, "a", "anomaly_start", "smoke", False),
                   (1, "b", "anomaly_start", "smoke", False),
                   (3, "b", "anomaly_end", "smoke", False)]


def test_detect_anomalies_schema_and_order(spark):
    rows = [reading(0, co=11.0, humidity=101.0, smoke=6.0)]
    out = detect_anomalies(frame(spark, rows))
    assert out.schema.fieldNames() == ALERT.fieldNames()
    assert [r.sensorType for r in out.collect()] == ["co", "humidity", "smoke"]


def test_limits_resolution(spark):
    assert resolve_limits(None)["smoke"] == (0.0, 5.0)
    partial = limits_frame(spark).select("coUpper", "coLower")
    lim = resolve_limits(partial)
    assert lim["co"] == (0.0, 10.0) and lim["smoke"] == (0.0, 0.0)
    empty = limits_frame(spark).limit(0)
    assert resolve_limits(empty) == resolve_limits(None)


def test_parse_cases(spark):
    good = ('{"ts":1704067200000,"device":"b8:27:eb:bf:9d:51","co":4.1,"humidity":51.0,'
            '"light":false,"lpg":120.0,"motion":false,"smoke":3.2,"temp":22.7}')
    msgs = [
        (1, good),
        (2, good.replace('1704067200000', '"1704067200000"')),
        (3, good.replace('"co":4.1', '"co":"4.1"')),
        (4, good.replace('1704067200000', '1704067200000.9')),
        (5, good.replace('"light":false', '"light":"TRUE"')),
        (6, good.replace('"light":false', '"light":1')),
        (7, good.replace('"b8:27:eb:bf:9d:51"', '7')),
        (8, good.replace('"co":4.1,', '')),
        (9, good.replace('"co":4.1', '"co":null')),
        (10, good.replace('"co":4.1', '"co":4.1,"co":4.2')),
        (11, good.replace('}', ',"extra":1}')),
        (12, 'not json'),
        (13, ''),
        (14, '[1,2]'),
    ]
    raw = spark.createDataFrame(msgs, "seq long, value string")
    ok = {r.seq: r for r in parse_readings(raw).collect()}
    assert sorted(ok) == [1, 2, 3, 4, 5, 11]
    assert ok[1].ts == 1704067200000 and ok[1].co == 4.1 and ok[1].rejected is False
    assert ok[4].ts == 1704067200000 and ok[5].light is True and ok[3].co == 4.1
    bad = {r.seq: r.reason for r in quarantine(raw).collect()}
    assert sorted(bad) == [6, 7, 8, 9, 10, 12, 13, 14]
    assert bad[7] == "invalid field: device" and bad[6] == "invalid field: light"
    assert bad[8] == "invalid field: co" and bad[12] == "malformed"


def test_notification_text(spark):
    alerts = spark.createDataFrame(
        [(1, "dev-1", "anomaly_start", "co", 1704067207179, False, 0.125)], ALERT)
    row = build_notifications(alerts, ["b@x", "a@x", "b@x"]).collect()[0]
    assert row.subject == "co Anomaly start Alert"
    assert row.body == (
        "This is an automated message informing you that there has been an `Anomaly start` "
        "event for sensor `co` on device `dev-1`.\n"
        "Timestamp of the event:            2024-01-01 00:00:07\n"
        "Value that triggered the event:    0.13\n"
        "Can be false flag:                 false\n"
        "\n"
        "Please take action!\n")
    assert row.recipients == "a@x,b@x"


def test_fused_equals_composed(spark):
    r = readings(spark, SF_SMALL)
    fused = clean_readings(r)
    windowed = clean_readings(r, stuck="window")
    composed = clean_readings_composed(r)
    assert fused.exceptAll(composed).count() == 0 and composed.exceptAll(fused).count() == 0
    assert windowed.exceptAll(composed).count() == 0
    assert fused.columns == list(READING_COLUMNS)


def test_counts_match_fixtures(spark):
    r = readings(spark, SF_SMALL)
    c = clean_readings(r).join(r.select("seq", F.col("ts").alias("raw")), "seq")
    row = c.agg(F.sum((F.col("ts") != F.col("raw")).cast("int")).alias("adj"),
                F.sum(F.col("rejected").cast("int")).alias("rej"),
                F.sum(F.col("suspicious").cast("int")).alias("sus")).collect()[0]
    assert (row.adj, row.rej, row.sus) == (7, 7, 311)
    a = detect_anomalies(clean_readings(r)).groupBy("eventType").count().collect()
    assert {x.eventType: x["count"] for x in a} == {"anomaly_start": 117, "anomaly_end": 116}


def test_partitioning_and_input_order_do_not_matter(spark):
    r = readings(spark, SF_SMALL)
    base = clean_readings(r)
    shuffled = clean_readings(r.repartition(7).orderBy(F.rand(3)))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        fewer = clean_readings(r)
        assert fewer.exceptAll(base).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert shuffled.exceptAll(base).count() == 0


def test_alerts_alternate_per_sensor(spark):
    from pyspark.sql import Window
    a = detect_anomalies(clean_readings(readings(spark, SF_SMALL)))
    w = Window.partitionBy("deviceId", "sensorType").orderBy("seq")
    bad = (a.withColumn("prev", F.lag("eventType").over(w))
           .where((F.col("prev") == F.col("eventType"))
                  | (F.col("prev").isNull() & (F.col("eventType") != "anomaly_start"))))
    assert bad.count() == 0


def test_single_exchange_in_fused_plan(spark):
    plan = clean_readings(readings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_fused_alerts_equal_composed(spark):
    from tidewatch.plans.pipeline import pipeline_alerts
    from tidewatch.plans.queries import CUSTOM_LIMITS
    r = readings(spark, SF_SMALL)
    for lim in (None, CUSTOM_LIMITS):
        a = pipeline_alerts(r, lim)
        b = detect_anomalies(clean_readings(r), lim)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = pipeline_alerts(r)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_write_batch_outputs(spark, scratch):
    from tidewatch.plans.pipeline import write_batch
    r = readings(spark, SF_SMALL)
    write_batch(r, scratch, recipients=["ops@example.com"])
    sd = spark.read.parquet(f"{scratch}/sensor_data")
    ea = spark.read.parquet(f"{scratch}/event_alerts")
    nt = spark.read.parquet(f"{scratch}/notifications")
    assert sd.count() == 1000 and ea.count() == 233 and nt.count() == 233
    assert sd.where("suspicious").count() == 311
    assert set(sd.columns) == {"seq", "time", "device", "temperature", "humidity", "co", "light",
                               "lpg", "motion", "smoke", "rejected", "suspicious"}


def test_config_files(spark, scratch):
    import json
    from tidewatch.operators.notify import recipients_header
    from tidewatch.sources.config import read_limits, read_recipients
    with open(f"{scratch}/limits.json", "w") as f:
        f.write(json.dumps({"coUpper": 4.8, "coLower": 0.0, "smokeUpper": 5.0, "other": 1}) + "\n")
    lim = resolve_limits(read_limits(spark, f"{scratch}/limits.json", fmt="json"))
    assert lim["co"] == (0.0, 4.8) and lim["smoke"] == (0.0, 5.0) and lim["temp"] == (0.0, 0.0)
    spark.createDataFrame([("b@x",), ("a@x",), ("b@x",)], "email string") \
        .write.parquet(f"{scratch}/recipients")
    assert recipients_header(read_recipients(spark, f"{scratch}/recipients")).first()[0] == "a@x,b@x"


def test_parse_more_edge_cases(spark):
    import math
    good = ('{"ts":1704067200000,"device":"d","co":4.1,"humidity":51.0,'
            '"light":false,"lpg":120.0,"motion":false,"smoke":3.2,"temp":22.7}')
    msgs = [
        (1, good.replace('1704067200000', 'true')),            # boolean where a long is read
        (2, good.replace('"co":4.1', '"co":"abc"')),             # not a number
        (3, good.replace('"co":4.1', '"co":"NaN"')),             # numeric string NaN
        (4, good.replace('"co":4.1', '"co":1e400')),             # overflows to infinity
        (5, good.replace('"light":false', '"light":"True"')),
        (6, good.replace('"device":"d"', '"device":""')),        # empty string is a string
        (7, good.replace('"co":4.1', '"co":{"v":4.1}')),         # object where a number is read
        (8, '  ' + good + '\n'),                                 # surrounding whitespace
        (9, good.replace('"motion":false', '"motion":"yes"')),
    ]
    raw = spark.createDataFrame(msgs, "seq long, value string")
    ok = {r.seq: r for r in parse_readings(raw).collect()}
    bad = {r.seq: r.reason for r in quarantine(raw).collect()}
    assert sorted(ok) == [3, 4, 5, 6, 8]
    assert math.isnan(ok[3].co) and math.isinf(ok[4].co) and ok[5].light is True
    assert ok[6].device == ""
    assert bad == {1: "invalid field: ts", 2: "invalid field: co", 7: "invalid field: co",
                   9: "invalid field: motion"}


def test_flagship_plan_prunes_columns(spark):
    from tidewatch.plans.pipeline import pipeline_alerts
    plan = pipeline_alerts(readings(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "MapInArrow" in plan and "BatchEvalPython" not in plan


def test_one_parse_serves_good_and_bad(spark):
    from tidewatch.operators.parse import parse_messages, readings_as_messages
    from tidewatch.schema import READING_COLUMNS
    from tidewatch.sources.tables import readings
    raw = readings_as_messages(readings(spark, SF_SMALL), 50)
    both = parse_messages(raw)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1, plan
    good = both.where("reason IS NULL").select(*READING_COLUMNS)
    assert good.exceptAll(parse_readings(raw)).count() == 0 and good.count() == 988
    bad = both.where("reason IS NOT NULL").select("seq", "value", "reason")
    assert bad.exceptAll(quarantine(raw)).count() == 0 and bad.count() == 12
