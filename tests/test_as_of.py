"""As-of joins: limits and recipients as they were at a reading's place."""

import random

import pytest

from tidewatch.operators.as_of import as_of
from tidewatch.operators.notify import notifications_as_of, recipients_over_time
from tidewatch.operators.thresholds import detect_anomalies, detect_anomalies_as_of
from tidewatch.schema import READING
from tidewatch.sources.config import limits_frame, limits_from_record


def smoke(spark, values, device="d"):
    return spark.createDataFrame([(i, 1000 * i, device, 4.0, 50.0, False, 100.0, False, v, 21.0, False, False)
                                  for i, v in enumerate(values)], READING)


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_as_of_equals_brute_force(spark, span):
    rng = random.Random(span)
    places = [rng.randrange(-50, 400) for _ in range(300)]
    log = [(rng.randrange(-40, 380), f"r{rng.randrange(99):02d}") for _ in range(60)] + [(100 + i % 3, f"x{i}") for i in range(40)]
    rows = spark.createDataFrame([(p, i, "k") for i, p in enumerate(places)], "seq long, _row int, _chunk string")
    records = spark.createDataFrame(log + [(None, "never")], "from_seq long, v string").selectExpr(
        "from_seq", "named_struct('v', v) AS rec")
    got = {r._row: (r.seq, r._chunk, r.rec and r.rec.v) for r in as_of(rows, records, span=span).collect()}
    for i, p in enumerate(places):
        last = max((x for x in log if x[0] <= p), default=(None, None))
        assert got[i] == (p, "k", last[1])


def test_empty_log_and_empty_rows(spark):
    rows = spark.createDataFrame([(1, "a")], "seq long, x string")
    log = spark.createDataFrame([], "from_seq long, rec struct<v: string>")
    assert [tuple(r) for r in as_of(rows, log).collect()] == [(1, "a", None)]
    assert as_of(rows.limit(0), spark.createDataFrame([(0, ("z",))], log.schema)).count() == 0


def test_anomaly_open_across_a_change_of_limits(spark):
    """As in the stream: 0..5, then 0..7, then 0..5 again around a constant 6."""
    record = {"coUpper": 10.0, "humidityUpper": 100.0, "lpgUpper": 1000.0, "temperatureUpper": 50.0,
              "temperatureLower": -40.0}
    changes = None
    for at, high in ((10, 7.0), (20, 5.0)):
        one = limits_frame(spark, limits_from_record({**record, "smokeUpper": high})).selectExpr(f"{at}L AS seq", "*")
        changes = one if changes is None else changes.union(one)
    got = sorted((r.seq, r.eventType) for r in detect_anomalies_as_of(smoke(spark, [6.0] * 30), changes, span=8).collect())
    assert got == [(0, "anomaly_start"), (10, "anomaly_end"), (20, "anomaly_start")]


def test_no_change_equals_the_default_limits(spark):
    nan = float("nan")
    r = smoke(spark, [1.0, 6.0, nan, 7.0, 5.0, 5.1])
    none = spark.createDataFrame([], "seq long, smokeUpper double")
    a, b = detect_anomalies_as_of(r, none), detect_anomalies(r)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_and_null_fields_read_as_zero(spark):
    changes = spark.createDataFrame([(2, None)], "seq long, smokeUpper double")
    got = {(x.seq, x.sensorType) for x in detect_anomalies_as_of(smoke(spark, [1.0, 1.0, 1.0]), changes).collect()}
    assert got == {(2, s) for s in ("co", "humidity", "lpg", "smoke", "temp")}


def test_recipients_over_time(spark):
    log = spark.createDataFrame([
        (1, "b", "add"), (1, "a", "add"), (3, "a", "add"), (5, "a", "remove"), (5, "zz", "remove"), (7, "b", "remove"),
        (9, "c", "add"), (9, "c", "remove"), (9, None, "add"), (11, "a", "add"), (12, "a", "noise"), (None, "q", "add")],
        "seq long, email string, op string")
    got = {r.from_seq: r.rec.recipients for r in recipients_over_time(log).collect()}
    assert got == {1: "a,b", 3: "a,b", 5: "b", 7: "", 9: "", 11: "a"}
    alerts = spark.createDataFrame([(i, "d", "anomaly_start", "co", 0, False, 1.0) for i in range(13)],
                                   "seq long, deviceId string, eventType string, sensorType string, timestamp long, "
                                   "suspicious boolean, value double")
    at = {r.seq: r.recipients for r in notifications_as_of(alerts, log, span=4).collect()}
    assert [at[i] for i in range(13)] == ["", "a,b", "a,b", "a,b", "a,b", "b", "b", "", "", "", "", "a", "a"]
