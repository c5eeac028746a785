"""The five input scans with the snapshot-day and tenant filters.

Filters are plain column predicates on the scans, so Catalyst pushes them into
the parquet reader (and prunes ``day_id`` partitions when the tables are
partitioned by day). Only the columns the job reads are selected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.params import ProfileParams
from buyerlens.schema import BASE_TYPES, RECEIVER_COLUMNS

MEMBER_COLUMNS = [c for c in BASE_TYPES if c not in ("is_member", "city_level", *RECEIVER_COLUMNS)]
ORDER_COLUMNS = [
    "order_id", "merchant_num", "brand_code", "platform_type", "platform_open_id", "nick",
    "is_member", "pay_at", "status", "payment", "updated_at",
    "province", "province_code", "city", "city_code",
]
# Columns that the job compares as numbers: text that does not parse is NULL.
MEMBER_TYPES = {c: t for c, t in BASE_TYPES.items() if c in MEMBER_COLUMNS}
ORDER_TYPES = {"is_member": "int", "status": "int", "payment": "decimal(15,2)"}
ACTIVITY_TYPES = {"member_id": "bigint", "activity_type": "int", "status": "int"}
POINTS_TYPES = {"member_id": "bigint", "right_type": "int", "num_change": "bigint"}
ACTIVITY_COLUMNS = ["merchant_num", "member_id", "activity_type", "status", "created_at"]
STORE_PARTS = 16  # parts that a day's rows of a tenant are dealt to
POINTS_COLUMNS = ["merchant_num", "member_id", "right_type", "num_change"]


@dataclass(frozen=True)
class Inputs:
    """The five scanned inputs of one run."""

    members: DataFrame
    orders: DataFrame
    activity: DataFrame
    points: DataFrame
    city_level: DataFrame


def _tenant(df: DataFrame, params: ProfileParams) -> DataFrame:
    if params.tenants is None:
        return df
    return df.where(F.col("merchant_num").isin(list(params.tenants)))


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns of other types than pinned become them by ``try_cast``; those of the pinned type stay
    plain columns, so their filters are pushed into the scan."""
    have = dict(df.dtypes)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in have and have[c] != t})


def _with_order_id(df: DataFrame) -> DataFrame:
    """Orders without an ``order_id`` get a hash of the whole row: a tie-break that a rerun repeats."""
    if "order_id" in df.columns:
        return df
    return df.withColumn("order_id", F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)]))


def scan_members(df: DataFrame, params: ProfileParams) -> DataFrame:
    """The member snapshot of ``as_of`` (tenant scoped)."""
    return _typed(_tenant(df.where(F.col("day_id") == params.as_of), params).select(*MEMBER_COLUMNS), MEMBER_TYPES)


def store_members(df: DataFrame, path: str) -> None:
    """The member snapshots as a table by day and tenant, the form that :func:`scan_members` prunes.

    A write by folder sorts what a task holds, so the rows are dealt first, a
    folder's over several tasks: a task's share does not depend on how few
    files the input has.
    """
    part = F.pmod(F.xxhash64("user_id", "member_id"), F.lit(STORE_PARTS))
    df.repartition(F.col("day_id"), F.col("merchant_num"), part).write.partitionBy("day_id", "merchant_num").parquet(path)


def scan_orders(df: DataFrame, params: ProfileParams) -> DataFrame:
    """The order snapshot of ``as_of`` (tenant scoped)."""
    today = _tenant(df.where(F.col("day_id") == params.as_of), params)
    return _typed(_with_order_id(today).select(*ORDER_COLUMNS), ORDER_TYPES)


def scan_activity(df: DataFrame, params: ProfileParams) -> DataFrame:
    """The activity-participation log (whole history, tenant scoped).

    Scoping the logs by tenant does not change the result: every later join
    keys on ``merchant_num``.
    """
    return _typed(_tenant(df, params).select(*ACTIVITY_COLUMNS), ACTIVITY_TYPES)


def scan_points(df: DataFrame, params: ProfileParams) -> DataFrame:
    """The points-change log (whole history, tenant scoped)."""
    return _typed(_tenant(df, params).select(*POINTS_COLUMNS), POINTS_TYPES)


def scan_city_level(df: DataFrame) -> DataFrame:
    """S3: city-level dimension; a level that is not an integer becomes NULL."""
    return df.select("name", F.col("level").try_cast("int").alias("level"))


def scan_inputs(raw: dict[str, DataFrame], params: ProfileParams) -> Inputs:
    """Apply S1-S5 to the raw tables keyed by their view names."""
    return Inputs(
        members=scan_members(raw["member_base_info_day"], params),
        orders=scan_orders(raw["user_orders"], params),
        activity=scan_activity(raw["hd_join_log"], params),
        points=scan_points(raw["right_change_log"], params),
        city_level=scan_city_level(raw["city_level"]),
    )
