"""Documents to packed training sequences: language ID, line dedup, SimHash near-dedup, PII, packing.

Each stage works on all that the one before it kept and is written as Parquet below
``spark.checkpoint.dir``. Null texts have no language and go in the first stage; an empty
table gives no rows; extra columns, whatever their names, pass through every stage but the last.
Repeated rows are one place to the line stage and one document to the near-duplicate stage,
which keeps of a group the row least by doc_id, then by its hashes; texts are worked on whole,
whatever their length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import language_id, line_dedup, packing, pii, queries, simhash_dedup
from tidewatch.llm.common import apart, cut, table
from tidewatch.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    ensure_checkpoint_dir(spark)
    return language_id.keep_identified(docs, queries.language_model(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen earlier go; ``n_chars`` follows the text."""
    out = apart(docs, lambda d: line_dedup.line_dedup(d).select(*d.columns))
    return out.selectExpr(*["cast(length(text) AS bigint) AS n_chars" if c == "n_chars" else f"`{c}`"
                            for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group stays."""
    return simhash_dedup.near_dedup(docs, width=3, max_bits=3)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values are replaced; texts keep their lengths."""
    return apart(docs, lambda d: pii.pseudonymise(d, queries.PII_KEY, luhn=True).select(*d.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of at most 2048 tokens."""
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: The stages are models, fingerprints and tokens: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
