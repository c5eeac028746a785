"""Cell layout of the profile (C1-C8); :mod:`buyerlens.sources.cellstore` stores it.

A profile row becomes sparse ``(rowkey, family, qualifier) -> value`` cells:
every non-NULL column gives one cell whose qualifier is the lower-cased
column name and whose value is its text (arrays, maps and structs as JSON).
Empty strings are kept; NULLs are dropped.

A buyer that is both a member and a non-member yields two profile rows with
one rowkey. Its cells are the union of both rows': per column the member row's
value, else the non-member row's (among equals of a side, the greatest text).

Plan: one wide exchange and no sampling. The key starts with a hash, so its
space is uniform: a row's key range is computed from its first eight digits and
is itself the partition's number. A partition is sorted by key once, as whole
rows; grouped there by rowkey (which also removes duplicate rows) and unpivoted
with its columns in (family, qualifier) order, its cells come out in key order.
The texts that all non-members of a tenant share stay outside of the rows and
are attached after the exchange, where the cells are rendered.

Rowkey and bucket are inferred: no published helper defines them. The rowkey
comes with the profile (:func:`buyerlens.functions.scalars.default_rowkey`, or
the user's own column); ``n`` buckets are equal ranges of its first eight hex
digits, so an own rowkey starts with those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.functions.scalars import render_value
from buyerlens.operators.joins import fits_broadcast
from buyerlens.schema import DEFAULT_FAMILIES

CELL_COLUMNS = ["rowkey", "family", "qualifier", "value", "bucket"]
CELL_ORDER = ["bucket", "rowkey", "family", "qualifier"]
BESIDE = ("rowkey", "_tenant")  # what a profile for the sink has beside its columns
PREFIX_SPACE = 1 << 32
LISTS_BROADCAST_BYTES = 64 << 20


def bucket_of(key: Column, n: int) -> Column:
    """``n`` equal ranges over the 32-bit value of the first 8 hex digits.

    Monotone in the rowkey, so key order within a bucket is global key order.
    """
    width = PREFIX_SPACE // n
    return F.least(F.floor(_prefix(key) / F.lit(width)), F.lit(n - 1)).cast("int")


def bucket_of_splits(key: Column, splits: Sequence[str]) -> Column:
    """The bucket of a key among given boundaries: how many of them are not above it."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in splits]).cast("array<string>"), lambda s: s <= key))


def check_splits(splits: Sequence[str]) -> None:
    """Boundaries are distinct, ascend as UTF-8 bytes, and start with the eight hex digits of a rowkey."""
    as_bytes = [s.encode() for s in splits]
    if as_bytes != sorted(set(as_bytes)):
        raise ValueError("split points must ascend and differ")
    bad = [s for s in splits if len(s) < 8 or any(c not in "0123456789abcdef" for c in s[:8])]
    if bad:
        raise ValueError(f"split points without eight leading hex digits: {bad}")


def _prefix(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def check_families(columns: Sequence[str], families: Mapping[str, str]) -> None:
    """C6 guard: every column must map to a family, and lower-cased names
    must stay distinct. Raised before any job runs."""
    lowered = [c.lower() for c in columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError("column names collide after lower-casing")
    missing = [c for c in lowered if c not in families]
    if missing:
        raise ValueError(f"columns without a column family: {missing}")


def family_of(families: Mapping[str, str]) -> Column:
    """The family of the ``qualifier`` column, from a name -> family map."""
    by_family: dict[str, list[str]] = {}
    for q, fam in families.items():
        by_family.setdefault(fam, []).append(q)
    expr = None
    for fam, qs in by_family.items():
        cond = F.col("qualifier").isin(qs)
        expr = F.when(cond, F.lit(fam)) if expr is None else expr.when(cond, F.lit(fam))
    return expr


def cell_values(profile: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """Unpivot to (ids..., qualifier, value), NULL values dropped."""
    value_cols = [c for c in profile.columns if c not in id_columns]
    rendered = profile.select(
        *id_columns,
        *[render_value(c, profile.schema[c].dataType).alias(c.lower()) for c in value_cols],
    )
    long = rendered.unpivot(list(id_columns), [c.lower() for c in value_cols], "qualifier", "value")
    return long.where(F.col("value").isNotNull())


def _picked(column: str) -> Column:
    """The member row's text of a column, else the non-member row's."""
    member = F.col("_member")
    return F.coalesce(F.max(F.when(member, F.col(column))), F.max(F.when(~member, F.col(column)))).alias(column)


def range_of(key: Column, n_buckets: int, per_bucket: int, splits: Sequence[str] | None = None) -> Column:
    """The key range: ``per_bucket`` equal parts of the digits that a bucket spans. Monotone in the rowkey."""
    if splits is None:
        edges = [i * (PREFIX_SPACE // n_buckets) for i in range(n_buckets)]
        bucket = bucket_of(key, n_buckets)
    else:
        edges = [0, *(int(s[:8], 16) for s in splits)]
        bucket = bucket_of_splits(key, splits)
    edges.append(PREFIX_SPACE)
    at = lambda values: F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), bucket + 1)
    lo, hi = at(edges[:-1]), at(edges[1:])
    inner = F.floor((_prefix(key) - lo) * F.lit(per_bucket) / F.greatest(hi - lo, F.lit(1)))
    inside = F.least(F.greatest(inner, F.lit(0)), F.lit(per_bucket - 1))
    return F.coalesce(bucket * per_bucket + inside, F.lit(0)).cast("int")


def ranges_per_bucket(spark: SparkSession, n_buckets: int) -> int:
    """So many that the sink has about ``spark.sql.shuffle.partitions`` tasks, a bucket one at least."""
    return max(1, round(int(spark.conf.get("spark.sql.shuffle.partitions")) / n_buckets))


def cells(profile: DataFrame, n_buckets: int, families: Mapping[str, str] | None = None, per_bucket: int | None = None,
          splits: Sequence[str] | None = None, tenant_lists: DataFrame | None = None) -> DataFrame:
    """One row per stored cell: rowkey, family, qualifier, value, bucket.

    ``profile`` has ``rowkey`` beside its columns. Each partition holds one key
    range, its cells in the order of :data:`CELL_ORDER`. ``splits`` are a
    store's own region boundaries, ascending rowkeys, instead of ``n_buckets``
    equal ranges. ``tenant_lists`` (``_tenant`` and some of the profile's
    columns) gives the texts of the rows that name a ``_tenant``.
    """
    families = dict(DEFAULT_FAMILIES if families is None else families)
    if splits is not None:
        check_splits(splits)
        n_buckets = len(splits) + 1
    cols = [c for c in profile.columns if c not in BESIDE]
    check_families(cols, families)
    names = sorted((c.lower() for c in cols), key=lambda c: (families[c].encode(), c.encode()))
    per = per_bucket or ranges_per_bucket(profile.sparkSession, n_buckets)
    n_ranges = n_buckets * per
    key = F.col("rowkey")
    is_member = F.coalesce(F.col("is_member") == 1, F.lit(False)).alias("_member")
    tenant = [F.col("_tenant")] if tenant_lists is not None else []
    rendered = profile.select("rowkey", is_member, range_of(key, n_buckets, per, splits).alias("_range"), *tenant,
                              *[render_value(c, profile.schema[c].dataType).alias(c.lower()) for c in cols])
    unique = (rendered.repartitionById(n_ranges, F.col("_range")).groupBy("_range", "rowkey")
              .agg(*[_picked(c) for c in names], *[F.max(t).alias("_tenant") for t in tenant]))
    if tenant_lists is not None:
        unique = _with_tenant_lists(unique, tenant_lists, n_ranges)
    bucket = bucket_of(key, n_buckets) if splits is None else bucket_of_splits(key, splits)
    long = (unique.sortWithinPartitions("_range", "rowkey").select("rowkey", bucket.alias("bucket"), *names)
            .unpivot(["rowkey", "bucket"], names, "qualifier", "value"))
    return long.where(F.col("value").isNotNull()).select(
        "rowkey", family_of(families).alias("family"), "qualifier", "value", "bucket")


def _with_tenant_lists(unique: DataFrame, lists: DataFrame, n_ranges: int) -> DataFrame:
    """A row's own text, else its tenant's. The texts come by broadcast if a size check proves them
    small; beyond, each key range gets them once, and the rows do not move again."""
    texts = [c for c in lists.columns if c != "_tenant"]
    side = lists.select(F.col("_tenant").alias("_t"), *[F.col(c).alias(f"_t_{c}") for c in texts])
    if fits_broadcast(side, 100_000, LISTS_BROADCAST_BYTES):
        met = unique.join(F.broadcast(side), F.col("_tenant") == F.col("_t"), "left")
    else:
        side = side.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(n_ranges - 1)))).repartitionById(n_ranges, F.col("_r"))
        met = unique.join(side, (F.col("_range") == F.col("_r")) & (F.col("_tenant") == F.col("_t")), "left")
    return met.select(*[F.coalesce(F.col(c), F.col(f"_t_{c}")).alias(c) if c in texts else F.col(c) for c in unique.columns])


def sorted_cells(cell_df: DataFrame) -> DataFrame:
    """O2: cells of any frame sorted within each partition by bucket and full cell key."""
    return cell_df.sortWithinPartitions(*CELL_ORDER)
