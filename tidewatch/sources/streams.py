"""Streaming sources (S1, U1): raw messages as (seq, value, topic, partition).

``seq`` is the arrival order inside a device: the Kafka offset. Offsets count
within one partition of one topic, so the whole order is (topic, partition,
offset); it is the order of arrival as long as a device publishes to one
partition (the original deployment had one topic per device). Readings carry
the three, and ``devices_out_of_place`` reports the devices that break the rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MESSAGE_PLACE, READING, RAW_MESSAGE


def kafka_messages(spark: SparkSession, servers: str, topics,
                   starting_offsets: str = "latest",
                   max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """S1 + U1: one subscription over all topics (the union of the sources).
    Needs the spark-sql-kafka connector on the classpath."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        F.col("offset").alias("seq"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition")


def file_messages(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw messages (seq, value) from files dropped into a folder; the test
    and replay stand-in for the Kafka source."""
    reader = spark.readStream.schema(RAW_MESSAGE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def file_readings(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Already typed readings from files (bypasses parsing)."""
    reader = spark.readStream.schema(READING).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def devices_out_of_place(readings: DataFrame) -> DataFrame:
    """(device, places, first, last): the devices whose readings come from more than one
    (topic, partition), with their number and the least and greatest. One aggregate with
    map-side partial results; a device in one place gives no row."""
    place = F.struct(*[F.col(c) for c in MESSAGE_PLACE])
    seen = readings.select("device", place.alias("_p")).distinct()
    return seen.groupBy("device").agg(F.count("*").alias("places"), F.min("_p").alias("first"),
                                      F.max("_p").alias("last")).where("places > 1")
