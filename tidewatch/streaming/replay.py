"""The streaming job over a bounded feed, run to its end and read back.

The readings of a table set are rendered as JSON messages and arrive in slices
of ``seq``, appended to one folder. After each slice the query starts from its
checkpoint, takes what is new as one micro-batch and stops: the state, the edge
table and the sinks go through a restart with every slice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import readings_as_messages
from ..session import checkpoint_path
from ..sources.streams import file_messages
from ..sources.tables import readings
from .pipeline import start_pipeline

SLICES = 3
STATE_ROWS = 2_000_000  # readings of a slice per partition of the state


def replay(spark: SparkSession, sf_dir: str, damage_every: int, restarts: int = SLICES,
           hot_every: int | None = None, **options) -> str:
    """Run the job over all readings (``hot_every``: see ``readings_from_events``); the folder
    of its sinks' tables."""
    base = checkpoint_path(spark, f"replay-{uuid.uuid4().hex}")
    # a session of its own: the state's partitions and store are the job's, not the caller's
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    source = readings(own, sf_dir, hot_every=hot_every)
    rows, first, last = source.agg(F.count("*"), F.min("seq"), F.max("seq")).first()
    own.conf.set("spark.sql.shuffle.partitions", str(max(8, -(-rows // (restarts * STATE_ROWS)))))
    messages = readings_as_messages(source, damage_every)
    first, last = first or 0, last or 0
    step = (last - first) // restarts + 1
    for i in range(restarts):
        low = first + i * step
        messages.where(f"seq >= {low} AND seq < {low + step}").write.mode("append").parquet(f"{base}/in")
        for query in start_pipeline(own, file_messages(own, f"{base}/in"), f"{base}/out",
                                    checkpoint_dir=f"{base}/checkpoint", available_now=True, **options):
            query.awaitTermination()
    return f"{base}/out"


def replayed_table(spark: SparkSession, sf_dir: str, table: str, damage_every: int, **options) -> DataFrame:
    """One sink's table after the run, without the batch folders' column."""
    return spark.read.parquet(f"{replay(spark, sf_dir, damage_every, **options)}/{table}").drop("batch_id")
