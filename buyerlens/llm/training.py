"""Labelled rows for the two classifiers: which count, and a bounded sample of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD_OUT = 1  # crc32(doc_id as text) mod 3


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == HELD_OUT, F.lit(False))


def one_mark(labels: DataFrame, target: str, id_col: str = "doc_id") -> DataFrame:
    """``(__id, target)`` of the ids that are not held out and have one mark: no null id, no null mark, no two different ones."""
    return (labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
            .groupBy(F.col(id_col).alias("__id")).agg(F.min(target).alias("__lo"), F.max(target).alias("__hi"))
            .where("__lo = __hi").select("__id", F.col("__lo").cast("int").alias("target")))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, limit: int, id_col: str = "doc_id",
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """``(__id, target, text, *extra)`` of at most ``limit`` labelled rows that are not held out, by a hash of the id.

    Labels meet the documents' ids first, so labels of absent documents use up
    nothing; the chosen ids (at most ``limit``: that is what is broadcast) then
    meet the texts in one scan. Ids labelled more than once with different
    marks, null marks and null ids are left out; an id on several rows counts
    once, with its smallest text. Null texts are empty.
    """
    present = one_mark(labels, target, id_col).join(docs.select(F.col(id_col).alias("__id")), "__id", "left_semi")
    chosen = present.orderBy(F.xxhash64("__id"), "__id").limit(limit)
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce("text", F.lit("")).alias("text"), *extra)
    met = texts.join(F.broadcast(chosen), "__id")
    one_text = met.groupBy("__id", "target").agg(F.min(F.struct("text", *extra)).alias("__row"))
    return one_text.select("__id", "target", "__row.*").orderBy(F.xxhash64("__id"), "__id")


def folds(n: int, k: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).permutation(n) % k


def texts_of(s: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in s]
