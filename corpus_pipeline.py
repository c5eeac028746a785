"""The corpus pipeline: toxic and poor documents go, near copies go, personal
data is replaced, and what is left is packed into sequences.

Each stage takes ``(spark, docs, sf_dir)``; :func:`run` writes every stage's
rows as Parquet in a fresh folder below the application's scratch folder and
reads them again as the next stage's documents. Null texts are scored as empty
ones; null ids, repeated rows and extra columns pass as each operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.llm import packing, pii, quality, simhash, toxicity
from buyerlens.llm.base import table
from buyerlens.llm.catalog import PII_KEY, tokenizer_path, tokenizer_pattern
from buyerlens.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p = toxicity.ToxicityParams()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), p)
    return toxicity.with_score(docs, model, "__toxic").where(F.col("__toxic") < p.threshold).drop("__toxic")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p = quality.QualityParams()
    model = quality.train(docs, table(spark, sf_dir, "labels"), p)
    return quality.with_score(docs, model, "__quality").where(F.col("__quality") >= p.threshold).drop("__quality")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the new text, where the table has it."""
    out = pii.with_surrogates(docs, PII_KEY)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_pattern())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("pii", replace_pii),
    ("packing", pack),
]
# Trained models, native surrogates and the library's tokenizers are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
