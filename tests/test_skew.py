"""Hot devices: the split plans give exactly the unsplit results."""

import pytest
from pyspark.sql import functions as F

from tests_helpers import SF_MID
from tidewatch.operators.outliers import flag_outliers
from tidewatch.operators.stuck import flag_stuck_values
from tidewatch.operators.thresholds import detect_anomalies
from tidewatch.plans import chunked_fold
from tidewatch.plans.pipeline import CleaningFold, clean_readings, with_outlier_verdict
from tidewatch.plans.skew import SkewPlan, find_hot
from tidewatch.sources.tables import readings


@pytest.fixture(scope="module")
def hot_readings(spark):
    r = readings(spark, SF_MID, hot_every=3)
    return r.withColumn("suspicious", (F.col("seq") % 37) == 0)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_find_hot_share(spark, hot_readings):
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=512))
    assert hot.count == 1
    assert [r.device for r in hot.devices.collect()] == ["dev-hot"]
    assert find_hot(hot_readings, SkewPlan(min_rows=100, span=512)).count == 21
    assert not find_hot(hot_readings, SkewPlan()).any


@pytest.mark.parametrize("span", [7, 300, 4096])
def test_stuck_split_is_exact(spark, hot_readings, span):
    base = flag_outliers(hot_readings).cache()
    hot = find_hot(base, SkewPlan(min_rows=100, min_share=0.2, span=span))
    assert same(flag_stuck_values(base, skew=hot), flag_stuck_values(base, skew=None))


@pytest.mark.parametrize("span", [11, 1000])
def test_alerts_split_is_exact(spark, hot_readings, span):
    cleaned = clean_readings(hot_readings, skew=None).cache()
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=span))
    assert same(detect_anomalies(cleaned, skew=hot), detect_anomalies(cleaned, skew=None))


@pytest.mark.parametrize("warm,reruns", [(None, False), (2, True)])
def test_fold_split_is_exact_with_and_without_rerun(spark, hot_readings, warm, reruns):
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=600))
    fold = CleaningFold()
    got = chunked_fold.chunked_device_fold(with_outlier_verdict(hot_readings), fold, hot,
                                           schema=hot_readings.schema, warm=warm)
    ref = clean_readings(hot_readings, skew=None)
    assert same(got, ref)
    assert bool(chunked_fold.LAST_RUN["rerun"]) == reruns


def count_fold():
    class Fold:  # local, so that it travels to the workers by value
        """Emits the running sum since the last reset; the state is that sum."""

        def init_state(self):
            return 0

        def step(self, a, state):
            out = a["ts"].copy()
            for i, ts in enumerate(out.tolist()):
                state = 0 if ts < 0 else state + ts
                out[i] = state
            return {"ts": out}, state
    return Fold()


@pytest.mark.parametrize("broken", [[], [3, 10, 17], [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]])
def test_only_chunks_whose_entry_changed_run_again(spark, broken):
    """A state that every chunk resets; in the last case the broken ones do not, their sums run on."""
    from tidewatch.schema import READING
    span, chunks = 100, 25
    rows = []
    for i in range(span * chunks):
        # a value after the reset before a broken border, beyond the reach of the warm-up
        c, p = divmod(i, span)
        reset = p == 50 and (c not in broken or len(broken) == 3)
        ts = -1 if reset else (7 if p == 60 and c + 1 in broken else 0)
        rows.append((i, ts, "h", 1.0, 1.0, False, 1.0, False, 1.0, 1.0, False, False))
    df = spark.createDataFrame(rows, READING)
    hot = find_hot(df, SkewPlan(min_rows=10, span=span, warm_rows=5))
    got = chunked_fold.chunked_device_fold(df, count_fold(), hot)
    state, want = 0, []
    for r in rows:
        state = 0 if r[1] < 0 else state + r[1]
        want.append((r[0], state))
    assert sorted((r.seq, r.ts) for r in got.select("seq", "ts").collect()) == want
    assert chunked_fold.LAST_RUN["rerun"] <= 2 * len(broken)
    if len(broken) == 3:  # three borders, one round, nothing else
        assert dict(chunked_fold.LAST_RUN) == {"rounds": 1, "rerun": 3}
    if len(broken) > 3:  # the rounds double what they cover
        assert chunked_fold.LAST_RUN["rounds"] < len(broken)


def test_rounds_do_not_grow_with_the_broken_borders(spark):
    """A sum that nothing resets: every third border is broken, and each depends on all before it."""
    from tidewatch.schema import READING
    span, chunks = 20, 60
    stamps = [7 if i % (3 * span) == 10 else 0 for i in range(span * chunks)]
    df = spark.createDataFrame([(i, ts, "h", 1.0, 1.0, False, 1.0, False, 1.0, 1.0, False, False)
                                for i, ts in enumerate(stamps)], READING)
    hot = find_hot(df, SkewPlan(min_rows=10, span=span, warm_rows=5))
    got = chunked_fold.chunked_device_fold(df, count_fold(), hot)
    ran = dict(chunked_fold.LAST_RUN)
    assert sorted((r.seq, r.ts) for r in got.select("seq", "ts").collect()) == [
        (i, sum(stamps[:i + 1])) for i in range(len(stamps))]
    assert ran["rounds"] <= chunked_fold.SINGLE_ROUNDS + 3  # blocks of 4, 16, 64; one a border before


def test_three_broken_borders_of_a_hot_device(spark):
    """The cleaning fold: spikes and stamps that differ before three borders only."""
    from tidewatch.schema import READING
    rows = []
    for i in range(3000):
        odd = any(b - 40 <= i < b for b in (600, 1500, 2400))  # a level that holds up to the border
        rows.append((i, 1000 * i, "h", 4.0 + (9.0 if odd else 0.0) + (i % 7) * 0.01, 50.0, False, 100.0, False,
                     3.0 + (i % 5) * 0.01, 20.0 + (i % 9) * 0.1, False, False))
    df = spark.createDataFrame(rows, READING)
    hot = find_hot(df, SkewPlan(min_rows=10, span=300, warm_rows=3))
    got = clean_readings(df, skew=hot)
    ran = dict(chunked_fold.LAST_RUN)
    assert same(got, clean_readings(df, skew=None))
    assert ran["rerun"] >= 3


def test_fold_split_carries_long_stuck_runs(spark):
    """A sensor stuck across many chunk borders: its run start must be
    carried from chunk to chunk, not guessed from a warm-up."""
    from tidewatch.schema import READING
    rows = [(i, 1000 * i, "h", 4.0 + (i % 7) * 0.01, 50.0, False, 100.0, False,
             3.0 + (i % 5) * 0.01, 21.5 if 40 <= i < 400 else 20.0 + (i % 9) * 0.1,
             False, False) for i in range(600)]
    df = spark.createDataFrame(rows, READING)
    hot = find_hot(df, SkewPlan(min_rows=10, span=50, warm_rows=30))
    got = clean_readings(df, skew=hot)
    assert chunked_fold.LAST_RUN["rerun"] == 0        # decided by the carry, not a rerun
    ref = clean_readings(df, skew=None)
    assert same(got, ref)
    assert ref.where("suspicious").count() > 200


def test_clean_readings_split_is_exact(spark, hot_readings):
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=1024))
    assert same(clean_readings(hot_readings, skew=hot), clean_readings(hot_readings, skew=None))


def test_standalone_folds_split_are_exact(spark, hot_readings):
    from tidewatch.operators.spikes import flag_spikes
    from tidewatch.operators.timestamps import repair_timestamps
    from tidewatch.plans.pipeline import clean_readings_composed
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=700))
    assert same(repair_timestamps(hot_readings, skew=hot), repair_timestamps(hot_readings, skew=None))
    base = flag_outliers(hot_readings)
    assert same(flag_spikes(base, skew=hot), flag_spikes(base, skew=None))
    assert same(clean_readings_composed(hot_readings, skew=hot), clean_readings(hot_readings, skew=None))


def test_many_hot_devices_use_shuffle_joins(spark, hot_readings, monkeypatch):
    """Above the broadcast bound the hot set stays distributed (shuffle
    joins); results are unchanged."""
    from tidewatch.plans import skew
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 1)
    monkeypatch.setattr(chunked_fold, "MAX_BROADCAST_KEYS", 1)
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, span=1500))
    assert hot.count > 1
    plan = clean_readings(hot_readings, skew=hot)
    assert same(plan, clean_readings(hot_readings, skew=None))
    base = flag_outliers(hot_readings)
    assert same(flag_stuck_values(base, skew=hot), flag_stuck_values(base, skew=None))


def test_write_batch_with_hot_device(spark, hot_readings, scratch):
    from tidewatch.plans.pipeline import write_batch
    hot = find_hot(hot_readings, SkewPlan(min_rows=100, min_share=0.2, span=900))
    write_batch(hot_readings, f"{scratch}/split", skew=hot)
    write_batch(hot_readings, f"{scratch}/plain", skew=None)
    for table in ("sensor_data", "event_alerts", "notifications"):
        a = spark.read.parquet(f"{scratch}/split/{table}")
        b = spark.read.parquet(f"{scratch}/plain/{table}")
        assert a.count() == b.count() and same(a, b)
