"""The registered queries of the operators and of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (bm25_search, collocations, language_id, license_scan, line_dedup, packing, piece_encoding, pii,
                           quality, simhash_dedup, suffix_dedup, toxicity, whitening)
from tidewatch.llm.common import labelled_sample, table
from tidewatch.session import ensure_checkpoint_dir

PII_KEY = "pseudonym-key-1"
_SPLIT = "crc32(cast(doc_id AS string)) % {m} = {r}"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return table(spark, sf_dir, "documents")


def _labelled(spark: SparkSession, sf_dir: str, label: str, bounds, where: str = "true") -> DataFrame:
    return labelled_sample(_documents(spark, sf_dir), table(spark, sf_dir, "labels").where(where), label,
                           bounds.TRAIN_ROWS, bounds.TRAIN_BYTES)


def _held_out(df: DataFrame, m: int, r: int) -> DataFrame:
    return df.withColumn("held_out", F.expr(f"coalesce({_SPLIT.format(m=m, r=r)}, false)"))


def language_model(docs: DataFrame) -> language_id.Model:
    return language_id.fit(docs.where(f"NOT ({_SPLIT.format(m=4, r=2)})").select("doc_id", "text", "lang"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_documents(spark, sf_dir).select("doc_id", "text"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return _held_out(language_id.identify(docs, language_model(docs)), 4, 2).select(
        "doc_id", "held_out", "lang_pred", "score")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("piece_bpe_32k.model")
    return piece_encoding.digest(piece_encoding.encode_as_model(_documents(spark, sf_dir), path), path)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(_documents(spark, sf_dir).select("doc_id", "text"), PII_KEY, luhn=True)
    return out.selectExpr("doc_id", "text", "cast(size(filter(pii, p -> p.kind IS NOT NULL)) AS bigint) AS n_pii")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_documents(spark, sf_dir), quality.fit(_labelled(spark, sf_dir, "quality", quality)))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20 against all documents; the benchmark items
    whose ids are, too, as query_id -1 - item_id."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").where("item_id % 20 = 0").selectExpr("-1 - item_id AS query_id", "text")
    asked = docs.where("doc_id % 20 = 0").selectExpr("doc_id AS query_id", "text").union(items)
    return bm25_search.search(docs, asked)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(_documents(spark, sf_dir), width=3, max_bits=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = _labelled(spark, sf_dir, "toxic", toxicity, f"NOT ({_SPLIT.format(m=3, r=1)})")
    return _held_out(toxicity.score_toxicity(_documents(spark, sf_dir), toxicity.fit(learn)), 3, 1).select(
        "doc_id", "held_out", "score", "predicted")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_documents(spark, sf_dir))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_packing, op3_language_id, op4_sentencepiece, op5_pii, op6_quality, op7_topk_search,
    op8_simhash, op9_license_scan, op10_toxicity, op11_collocations,
    op12_suffix_dedup, op13_whitening)}
