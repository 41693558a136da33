"""The cleaning chain for one slice of an unbounded input, states in and states out.

A slice (a micro-batch) is folded by the verified chunk pass (``plans.chunked_fold``): a device
with a large share of the slice is split into seq-range chunks that run in parallel, so no task
holds all its readings. The first chunk of a device goes on from the state the device had
before the slice; the state it has after it comes out of the chunk summaries, one row a device
seen. Where the states are kept is the caller's affair (``streaming.pipeline`` keeps a log by
batch id, so a replayed slice starts from the same states and ends in the same).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MESSAGE_PLACE, PHYSICAL_BOUNDS
from ..sources.config import resolve_limits
from .chunked_fold import chunked_fold_states
from .pipeline import EDGE_COLUMNS, cleaning_fold, with_outlier_verdict
from .skew import SkewPlan, resolve

#: state: the fold's state as text; starts: the first stamps of the runs of equal values (W3),
#: which chunks cannot know and the summaries carry; last, place: the device's last seq and the
#: (topic, partition) it stands in, both used by expiry only.
STATE = "device string, state string, starts array<bigint>, last bigint, place string"


@dataclass(frozen=True)
class SliceCleaning:
    """``plan`` says which devices of a slice are split, ``expire_after`` after how many places
    of silence a device starts anew (None: never), ``params`` are those of ``clean_readings``.

    A device is to stay in one (topic, partition), see ``devices_out_of_place``: the chunks of a
    slice are cut and ordered by ``seq`` alone."""
    plan: SkewPlan = SkewPlan()
    expire_after: int | None = None
    params: dict = field(default_factory=dict)

    def run(self, readings: DataFrame, prior: DataFrame, limits=None) -> tuple[DataFrame, DataFrame]:
        """(readings cleaned, with ``_edge_<sensor>`` as ``clean_and_detect`` gives them; the
        states of the devices seen, as ``STATE``). ``prior`` holds the states before, at most one
        row a device; a device without one is new. An empty slice gives no rows."""
        more = dict(self.params)
        bounds = more.pop("bounds", PHYSICAL_BOUNDS)
        fold = cleaning_fold(limits=resolve_limits(limits), expire_after=self.expire_after, **more)
        schema = T.StructType(list(readings.schema.fields)
                              + [T.StructField(c, T.ByteType(), False) for c in EDGE_COLUMNS])
        both, states = chunked_fold_states(with_outlier_verdict(readings, bounds), fold,
                                           resolve(readings, self.plan), schema=schema, prior=prior)
        at = [c for c in MESSAGE_PLACE if c in readings.columns]
        if self.expire_after is None or not at:
            states = states.withColumn("place", F.lit(""))
        else:
            states = states.join(readings.groupBy("device").agg(F.max(F.concat_ws("/", *at)).alias("place")), "device")
        return both, states.select("device", "state", "starts", "last", "place")

    def alive(self, states: DataFrame) -> DataFrame:
        """``states`` without those that no later reading can meet: a place's next reading stands
        beyond its last one, so more than ``expire_after`` behind it means anew in any case."""
        if self.expire_after is None:
            return states
        tops = states.groupBy("place").agg(F.max("last").alias("top"))
        return states.join(tops, "place").where(f"last >= top - {int(self.expire_after)}").select(*states.columns)
