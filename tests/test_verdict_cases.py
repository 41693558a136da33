"""Inputs that once lost flags or ended a job."""

import pytest

from tidewatch.operators.notify import build_notifications
from tidewatch.operators.parse import parse_readings, quarantine
from tidewatch.operators.project import to_sensor_data
from tidewatch.plans.pipeline import clean_readings
from tidewatch.plans.skew import SkewPlan, find_hot
from tidewatch.schema import READING

GOOD = ('{"ts":%s,"device":"d","co":%s,"humidity":50.0,"light":true,"lpg":100.0,'
        '"motion":false,"smoke":5.0,"temp":20.0}')


def _frame(spark, rows):
    return spark.createDataFrame([{**dict(zip(READING.fieldNames(), [None] * len(READING.fields))), **r}
                                  for r in rows], READING)


def _reading(seq, **over):
    return {"seq": seq, "ts": 1_704_067_200_000 + 3_600_000 * seq, "device": "d", "co": 5.0, "humidity": 50.0,
            "light": True, "lpg": 100.0, "motion": False, "smoke": 5.0, "temp": 20.0, "rejected": False,
            "suspicious": False, **over}


@pytest.mark.parametrize("first", ["zero", "rejected"])
@pytest.mark.parametrize("span", [20, 50, 130])
def test_split_fold_late_start(spark, first, span):
    """Chunks before a device's first eligible reading carry no run start."""
    over = {"smoke": 0.0} if first == "zero" else {"rejected": True, "humidity": 500.0}
    df = _frame(spark, [_reading(i, **(over if i < 60 else {})) for i in range(400)])
    want = {r.seq: r.suspicious for r in clean_readings(df, skew=None).collect()}
    plan = SkewPlan(min_rows=10, span=span, warm_rows=12)
    got = {r.seq: r.suspicious for r in clean_readings(df, skew=find_hot(df, plan)).collect()}
    assert got == want and any(want.values())


@pytest.mark.parametrize("ts,co,good", [
    ("99999999999999999999", "1.0", False), ("1e20", "1.0", False), ('"1704067200000.9"', "1.0", False),
    ('" 17 "', "1.0", False), ('"1e3"', "1.0", False), ("17", '"inf"', False), ('"17"', '"NaN"', True),
    ('"+17"', '"-Infinity"', True), ("17.9", '"1e3"', True)])
def test_no_message_ends_the_job(spark, ts, co, good):
    raw = spark.createDataFrame([(1, GOOD % (ts, co))], "seq long, value string")
    assert parse_readings(raw).count() == int(good) and quarantine(raw).count() == int(not good)


def test_stamp_beyond_the_calendar(spark):
    rows = to_sensor_data(_frame(spark, [_reading(1, ts=1_704_067_200_000_000_000)])).collect()
    assert len(rows) == 1 and rows[0].time is None


def test_many_recipients(spark):
    alerts = spark.createDataFrame([(1, "d", "co", "anomaly_start", 0, False, 1.5)],
                                   "seq long, deviceId string, sensorType string, eventType string, "
                                   "timestamp long, suspicious boolean, value double")
    to = spark.range(10_001).selectExpr("concat('u', id, '@x') AS email")
    row = build_notifications(alerts, to).collect()
    assert len(row) == 1 and row[0].recipients.count(",") == 10_000


def test_console_prints_every_row(spark, capsys):
    from tidewatch.sinks.tables import write_table

    write_table(spark.range(50), "", "console")
    assert len(capsys.readouterr().out.strip().split("\n")) == 50


def test_hot_set_beyond_the_broadcast_bound(spark, monkeypatch):
    from tidewatch.plans import skew

    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 1)
    df = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 'h' ELSE concat('d', id % 20) END AS device",
                                      "id AS seq")
    hot = find_hot(df, SkewPlan(min_rows=1, min_share=0.2))
    assert hot.count == 1 and hot.devices.first().device == "h"
    assert find_hot(df, SkewPlan(min_rows=1)).count == 11
