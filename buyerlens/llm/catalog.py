"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm import (
    alignment,
    bytebpe,
    filter_audit,
    flatgraph,
    licenses,
    packing,
    pages,
    pii,
    quality,
    quality_rules,
    simhash,
    toxicity,
    vptree,
)
from buyerlens.llm.base import table
from buyerlens.llm.training import held_out

PII_KEY = "buyerlens-surrogates"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _decided(scored: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


def op1_vptree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    p = quality.QualityParams()
    return _decided(quality.with_score(docs, quality.train(docs, table(spark, sf_dir, "labels"), p)), p.threshold)


def op6_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    p = toxicity.ToxicityParams()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), p)
    scored = toxicity.with_language_decision(toxicity.with_score(docs, model), model, p)
    return _decided(scored, p.threshold, "lang_threshold", "lang_predicted")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count_col="n_mentions")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), tokenizer_pattern())


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.dedup(table(spark, sf_dir, "embeddings"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_pattern())


def op11_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_pattern(),
                             tokenizer_path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vptree_search": op1_vptree_search,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_html_text": op3_html_text,
    "op4_license_scan": op4_license_scan,
    "op5_quality_gam": op5_quality_gam,
    "op6_toxicity_cnn": op6_toxicity_cnn,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_risk_rules": op11_risk_rules,
    "op12_token_alignment": op12_token_alignment,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {"op11_risk_rules": quality_rules.oracle(), "op13_filter_audit": filter_audit.ORACLE}
