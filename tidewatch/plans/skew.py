"""Hot devices: find them, split them into seq-range chunks.

Every rule here is ordered per device, so a device is the natural unit of
work; one device holding a large share of all readings would otherwise be a
single task. A *hot* device has at least ``min_rows`` readings. Its readings
are split into chunks of ``span`` consecutive ``seq`` values that are
processed in parallel; what crosses a chunk border is carried by a small
per-chunk summary (one row per chunk), never by moving rows to one task.

The hot set is found once, on the source readings, with one aggregate over
the device column (map-side partial counts, so the shuffle carries one row per
device and map task). It has at most rows / ``min_rows`` entries; its size is
checked before it is broadcast. Pass the same ``HotSet`` to every operator of
a pipeline so the detection runs once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_MIN_ROWS = 4_000_000      # a device with more readings gets split
DEFAULT_SPAN = 1 << 21            # seq values per chunk of a hot device
DEFAULT_WARM_ROWS = 256           # readings a speculative chunk is warmed on
MAX_BROADCAST_KEYS = 200_000      # hot sets above this are joined by shuffle


@dataclass(frozen=True)
class SkewPlan:
    """A device is hot when it has at least ``min_rows`` readings and at
    least ``min_share`` of all readings."""
    min_rows: int = DEFAULT_MIN_ROWS
    span: int = DEFAULT_SPAN
    min_share: float = 0.0
    warm_rows: int = DEFAULT_WARM_ROWS


@dataclass(frozen=True)
class HotSet:
    devices: DataFrame | None     # (device, warm); None when nothing is hot
    count: int
    plan: SkewPlan

    @property
    def any(self) -> bool:
        return self.count > 0


NO_SKEW = HotSet(None, 0, SkewPlan())


def find_hot(df: DataFrame, plan: SkewPlan = SkewPlan(), key: str = "device",
             order: str = "seq") -> HotSet:
    """One aggregate (per-device counts and seq extent) over two columns, held
    against the total in Spark; only hot devices reach the driver. Each hot device also gets its warm-up
    length in seq values, ``warm_rows`` readings at its average density."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("lo"),
                                 F.max(order).alias("hi"))
    share = float(plan.min_share)
    stats = (counts.where(f"n >= {int(plan.min_rows)}") if share <= 0 else
             counts.join(F.broadcast(counts.agg(F.sum("n").alias("total"))),
                         F.expr(f"n >= greatest({int(plan.min_rows)}, {share!r} * total)")).drop("total"))
    hot = stats.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not hot:
        return HotSet(None, 0, plan)
    spark = df.sparkSession
    if len(hot) > MAX_BROADCAST_KEYS:
        # very many hot devices: the whole set stays distributed
        ensure_checkpoint_dir(spark)
        devices = stats.select(key, _warm_expr(plan).alias("warm")).checkpoint()
        return HotSet(devices, devices.count(), plan)
    data = [(r[key], _warm(plan, r["n"], r["lo"], r["hi"])) for r in hot]
    devices = spark.createDataFrame(data, f"{key} string, warm long")
    return HotSet(devices, len(data), plan)


def _warm(plan: SkewPlan, n: int, lo: int, hi: int) -> int:
    extent = max(hi - lo + 1, 1)
    return int(min(plan.span, max(1, math.ceil(plan.warm_rows * extent / max(n, 1)))))


def _warm_expr(plan: SkewPlan):
    extent = F.greatest(F.col("hi") - F.col("lo") + 1, F.lit(1))
    w = F.ceil(F.lit(plan.warm_rows) * extent / F.col("n"))
    return F.least(F.lit(plan.span), F.greatest(F.lit(1), w)).cast("long")


def resolve(df: DataFrame, skew) -> HotSet:
    """``skew``: a HotSet (used as is), a SkewPlan (detect on ``df``), or
    None / False (no splitting)."""
    if isinstance(skew, HotSet):
        return skew
    if isinstance(skew, SkewPlan):
        return find_hot(df, skew)
    return NO_SKEW


def assign_chunks(df: DataFrame, hot: HotSet, key: str = "device",
                  order: str = "seq") -> DataFrame:
    """Add ``_chunk``: ``seq div span`` for hot devices, 0 for the others."""
    if not hot.any:
        return df.withColumn("_chunk", F.lit(0).cast("long"))
    flagged = hot.devices.selectExpr(key, "true AS _hot")
    if hot.count <= MAX_BROADCAST_KEYS:
        flagged = F.broadcast(flagged)
    chunk = f"CAST(CASE WHEN _hot THEN {order} div {int(hot.plan.span)} ELSE 0 END AS BIGINT)"
    return df.join(flagged, key, "left").selectExpr(*df.columns, f"{chunk} AS _chunk")
