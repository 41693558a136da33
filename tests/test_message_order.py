"""Order over topics and partitions: offsets count within one partition of one topic."""

import json

from pyspark.sql import functions as F

from tidewatch.operators.parse import parse_messages, parse_readings
from tidewatch.plans.pipeline import clean_readings
from tidewatch.sources.streams import devices_out_of_place

RAW = "seq long, value string, topic string, partition int"


def message(device, ts, co=4.0):
    return json.dumps({"ts": ts, "device": device, "co": co, "humidity": 50.0, "light": False, "lpg": 100.0,
                       "motion": False, "smoke": 3.0, "temp": 21.0})


def test_readings_carry_topic_and_partition(spark):
    raw = spark.createDataFrame([(7, message("a", 1), "t1", 0), (7, message("b", 2), "t1", 1), (7, "bad", "t2", 0)], RAW)
    got = {(r.topic, r.partition, r.seq): r.device for r in parse_readings(raw).collect()}
    assert got == {("t1", 0, 7): "a", ("t1", 1, 7): "b"}
    assert {(r.topic, r.reason) for r in parse_messages(raw).collect()} == {("t1", None), ("t2", "malformed")}


def test_equal_offsets_of_two_partitions_are_told_apart(spark):
    """Rows of one device with equal offsets are folded partition after partition, whatever
    their order in the input: here the jump stands in the second one."""
    rows = [(i, message("d", 1000 * i), "t", 0) for i in range(12)]
    rows += [(i, message("d", 10 ** 9 + 1000 * i), "t", 1) for i in range(12)]
    raw = spark.createDataFrame(rows, RAW)
    for df in (raw, raw.orderBy(F.rand(3))):
        out = {(r.partition, r.seq): r.ts for r in clean_readings(parse_readings(df)).collect()}
        assert [out[0, i] for i in range(12)] == [1000 * i for i in range(12)]
        assert [out[1, i] for i in range(12)] == [1000 * (12 + i) for i in range(12)]  # all repaired


def test_devices_in_several_partitions_are_reported(spark):
    raw = spark.createDataFrame([(1, message("a", 1), "t1", 0), (1, message("a", 2), "t1", 1), (2, message("a", 3), "t2", 0),
                                 (3, message("b", 1), "t1", 0), (4, message("b", 2), "t1", 0)], RAW)
    got = [(r.device, r.places, tuple(r.first), tuple(r.last)) for r in devices_out_of_place(parse_readings(raw)).collect()]
    assert got == [("a", 3, ("t1", 0), ("t2", 0))]
