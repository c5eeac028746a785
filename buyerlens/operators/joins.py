"""Join helpers: a size-checked broadcast and a salted join for a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType


def _approx_bytes(name: str, data_type) -> Column:
    col = F.col(name)
    if isinstance(data_type, (StringType, BinaryType)):
        size = F.length(col)
    elif isinstance(data_type, (ArrayType, MapType, StructType)):
        size = F.length(F.to_json(col))
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(0)).cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and about ``max_bytes``
    of data. Counts and lengths are added up where the rows are; only the two
    totals reach the driver."""
    row_bytes = sum((_approx_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0).cast("bigint"))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def salted_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt_of: Sequence[str],
                     buckets: int) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING ``keys`` where few key values carry
    a large share of ``left``'s rows and ``right`` is unique per key.

    Each left row gets a salt in ``[0, buckets)`` from a hash of ``salt_of``
    (deterministic, so a recomputed task after an executor loss assigns the
    same salt); each right row is copied once per salt. A hot key is thereby
    spread over ``buckets`` join tasks; the copied side grows only with the
    number of distinct right keys times ``buckets``.
    """
    keys = list(keys)
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_of), F.lit(buckets)).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_left.join(salted_right, on=[*keys, "_salt"], how="left").drop("_salt")
