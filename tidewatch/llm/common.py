"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import checkpoint_path, ship_package

ARROW_ROWS = 256  # rows per Arrow batch: bounds the texts a Python task holds at once


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = checkpoint_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, operator) -> DataFrame:
    """``operator`` on ``docs`` whose columns beside doc_id and text go by names that no operator
    uses; they get their own back. A result that adds a column must not bear one of theirs."""
    names = {c if c in ("doc_id", "text") else f"__column_{i}": c for i, c in enumerate(docs.columns)}
    out = operator(docs.toDF(*names))
    return out.toDF(*[names.get(c, c) for c in out.columns])


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with small batches and this package on the workers."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, ``label``): of each label 0 and 1 the ``rows`` documents with the smallest
    hash of doc_id among those with a text of at most ``max_bytes`` bytes. Only ids are joined
    with the labels; the texts are read for the chosen ids, at most 2 x ``rows``."""
    ids = docs.where(f"octet_length(text) <= {max_bytes}").select("doc_id").join(
        labels.select("doc_id", label), "doc_id")
    chosen = [ids.where(F.col(label) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for v in (0, 1)]
    texts = docs.select("doc_id", "text").where(f"octet_length(text) <= {max_bytes}")
    return cut(texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id"), "sample")
