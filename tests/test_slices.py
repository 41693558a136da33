"""Slices of an unbounded input: states in and out, hot devices split, states that expire."""

import random

import pytest
from pyspark.sql import functions as F

from tests_helpers import SF_SMALL, nan_rows
from tidewatch.operators.thresholds import detect_anomalies
from tidewatch.plans import chunked_fold
from tidewatch.plans.pipeline import clean_readings, pipeline_alerts
from tidewatch.plans.skew import SkewPlan, find_hot
from tidewatch.plans.slices import STATE, SliceCleaning
from tidewatch.schema import READING, READING_COLUMNS
from tidewatch.sources.tables import readings
from tidewatch.streaming.pipeline import StateLog

SPLIT = SkewPlan(min_rows=40, span=64, min_share=0.4, warm_rows=12)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def feed(spark, n=900, seed=7):
    """Three devices, "h" with most readings; spikes, stuck runs over many chunks and slices,
    broken stamps, outliers, NaN, and silences of 10 to 40 places."""
    rng = random.Random(seed)
    rows, quiet = [], {"a": 0, "b": 0, "h": 0}
    for i in range(n):
        d = rng.choice("abhhhh")
        if i < quiet[d]:
            continue
        if rng.random() < 0.02:
            quiet[d] = i + rng.randrange(10, 40)
        stuck = 100 < i < 700
        rows.append((i, 1000 * i + rng.choice([0] * 30 + [10 ** 7]), d,
                     rng.choice([4.0 + rng.random() / 10] * 25 + [60.0, float("nan"), 12.0]), 50.0 + rng.random(), False,
                     100.0 + rng.random(), False, rng.choice([3.0, 6.0]) + rng.random() / 10,
                     21.5 if stuck else 20.0 + rng.random(), False, False))
    return spark.createDataFrame(rows, READING)


def by_lives(df, after):
    """The same readings, every life of a device under a name of its own."""
    rows, last, life = [], {}, {}
    for r in sorted(df.collect()):
        d = r.device
        if d in last and r.seq - last[d] > after:
            life[d] = life.get(d, 0) + 1
        last[d] = r.seq
        rows.append((*r[:2], f"{d}#{life.get(d, 0)}", *r[3:]))
    return df.sparkSession.createDataFrame(rows, READING), sum(life.values())


@pytest.mark.parametrize("plan", [None, SPLIT])
def test_expired_device_starts_anew(spark, plan):
    df = feed(spark)
    renamed, ends = by_lives(df, 15)
    assert ends > 10
    hot = find_hot(df, plan) if plan else None
    if plan:
        assert hot.count == 1
    want = clean_readings(renamed, skew=None).withColumn("device", F.split("device", "#")[0])
    got = clean_readings(df, skew=hot, expire_after=15)
    assert same(got, want)
    assert not same(got, clean_readings(df, skew=None))
    alerts = detect_anomalies(clean_readings(renamed, skew=None)).withColumn("deviceId", F.split("deviceId", "#")[0])
    assert same(pipeline_alerts(df, skew=hot, expire_after=15), alerts)


def test_gap_of_exactly_the_bound_keeps_the_state(spark):
    df = spark.createDataFrame([(20 * i, 1000 * i, "d", 4.0, 50.0, False, 100.0, False, 6.0, 20.0, False, False)
                                for i in range(12)], READING)
    assert pipeline_alerts(df, skew=None, expire_after=20).count() == 1
    assert pipeline_alerts(df, skew=None, expire_after=19).count() == 12
    with pytest.raises(ValueError):
        clean_readings(df, expire_after=5, stuck="window")
    with pytest.raises(ValueError):
        clean_readings(df, skew=None, expire_after=0)


def run_slices(spark, df, job, folder, bounds, compact_every=2, limits=None):
    log = StateLog(spark, folder, STATE, compact_every, job.alive)
    out = None
    for batch, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        part = df.where(f"seq >= {lo} AND seq < {hi}")
        for _ in range(2 if batch == 1 else 1):  # the second time is a replay
            both, states = job.run(part, log.read_before(batch), limits)
            log.write(states, batch)
        assert spark.read.parquet(f"{folder}/delta={batch}").count() == part.select("device").distinct().count()
        out = both if out is None else out.union(both)
    return out, log


@pytest.mark.parametrize("expire", [None, 15])
def test_slices_equal_batch(spark, scratch, expire):
    """A hot device over several slices and chunks; runs of equal values that began slices ago."""
    df = feed(spark)
    out, log = run_slices(spark, df, SliceCleaning(SPLIT, expire), f"{scratch}/s", [0, 300, 301, 620, 900])
    assert same(out.select(*READING_COLUMNS), clean_readings(df, skew=None, expire_after=expire))
    edges = out.where("_edge_smoke <> 0").select("seq", "_edge_smoke")
    alerts = pipeline_alerts(df, skew=None, expire_after=expire).where("sensorType = 'smoke'")
    assert edges.count() == alerts.count() > 10
    assert {r.device for r in log.read_before(99).collect()} == {"a", "b", "h"}


def test_hot_device_of_a_slice_is_split(spark):
    """No task holds all its readings: every chunk is folded on its own."""
    df = readings(spark, SF_SMALL, hot_every=3).where("seq < 800")
    plan = SkewPlan(min_rows=100, span=100, min_share=0.2, warm_rows=20)
    assert [r.device for r in find_hot(df, plan).devices.collect()] == ["dev-hot"]
    none = spark.createDataFrame([], STATE)
    both, states = SliceCleaning(plan).run(df, none)
    assert same(both.select(*READING_COLUMNS), clean_readings(df, skew=None))
    assert states.count() == 21
    # of the 8 chunks only those whose warm-up was too short ran again
    assert chunked_fold.LAST_RUN["rerun"] < 8


def test_states_that_nothing_can_meet_leave_the_log(spark, scratch):
    rows = [(i, 1000 * i, "old" if i == 0 else "d", 4.0, 50.0, False, 100.0, False, 3.0, 20.0 + i % 3, False, False)
            for i in range(60)]
    df = spark.createDataFrame(rows, READING)
    job = SliceCleaning(expire_after=15)
    _, log = run_slices(spark, df, job, f"{scratch}/s", [0, 20, 40, 60], compact_every=1)
    assert {r.device for r in log.read_before(99).collect()} == {"d"}
    _, log = run_slices(spark, df, SliceCleaning(), f"{scratch}/t", [0, 20, 40, 60], compact_every=1)
    assert {r.device for r in log.read_before(99).collect()} == {"d", "old"}


def test_places_expire_by_their_own_offsets(spark):
    """Two partitions whose offsets lie far apart: neither ages the other's devices."""
    rows = [(r[0], r[1], d, *r[3:], "t", p) for r in nan_rows() for d, p in (("d", 0),)]
    rows += [(r[0] + 10 ** 6, *r[1:2], "e", *r[3:-2], "t", 1) for r in rows]
    df = spark.createDataFrame(rows, READING.simpleString()[7:-1] + ",topic:string,partition:int")
    job = SliceCleaning(expire_after=5)
    both, states = job.run(df, spark.createDataFrame([], STATE))
    assert both.count() == 60 and both.where("isnan(co)").count() == 20
    assert {(r.device, r.last, r.place) for r in job.alive(states).collect()} == {("d", 29, "t/0"), ("e", 10 ** 6 + 29, "t/1")}


def test_empty_slice(spark):
    none = spark.createDataFrame([], STATE)
    both, states = SliceCleaning(expire_after=5).run(spark.createDataFrame([], READING), none)
    assert both.count() == 0 and states.count() == 0
