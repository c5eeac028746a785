"""The same results as separate grouped reads put together afterwards: what the
fused forms are compared with, in tests and in the bench."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.functions.scalars import sorted_set_text
from buyerlens.operators import activity as act
from buyerlens.operators import orders as ords
from buyerlens.operators.cells import bucket_of, cell_values, family_of
from buyerlens.operators.members import all_users, members_with_facts, nonmembers_with_facts
from buyerlens.operators.points import points_total
from buyerlens.operators.profile import JOINED_COLUMNS, label_profile
from buyerlens.params import ProfileParams
from buyerlens.schema import DEFAULT_FAMILIES, ORDER_FACT_COLUMNS
from buyerlens.sources.tables import Inputs


def attach(first: DataFrame, others: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left joins one after the other; NULL keys meet nothing."""
    return reduce(lambda left, right: left.join(right, keys, "left"), others, first)


def newest(rows: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Number one of each key's rows, newest first."""
    order = [F.col(c).desc_nulls_last() for c in ("updated_at", "order_id", *payload)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, *payload)


def order_summary(orders: DataFrame, p: ProfileParams) -> DataFrame:
    days = orders.where(ords.paid_in_window(p)).groupBy("merchant_num", F.col("platform_open_id").alias("user_id"))
    detail = days.agg(F.least(F.count_distinct(F.substring("pay_at", 1, 10)), F.lit(2)).cast("int").alias("pay_detail"))
    today = orders.where(ords.paid_today(p)).groupBy("merchant_num", F.col("platform_open_id").alias("user_id")).agg(
        F.count(F.lit(1)).alias("today_order_num"), F.sum("payment").alias("today_order_amount"))
    out = attach(ords.order_window_count(orders, p), [today, detail], ["merchant_num", "user_id"])
    return out.withColumn("history_order_num_360", F.col("order_num_360") - F.col("today_order_num")).select(*ords.SUMMARY_COLUMNS)


def activity_summary(activity: DataFrame, p: ProfileParams) -> DataFrame:
    times = sorted_set_text(F.substring("created_at", 1, 19))
    exchanges = activity.where("activity_type = 2").groupBy(*act.MEMBER_KEYS).agg(
        times.alias("exchange_time_list"), F.count_if(F.col("status") == 1).alias("exchange_num"))
    all_times = activity.groupBy(*act.MEMBER_KEYS).agg(times.alias("interactive_time_list"))
    figures = [exchanges, act.recent_interaction(activity, p), all_times]
    return attach(activity.select(*act.MEMBER_KEYS).distinct(), figures, act.MEMBER_KEYS).select(*act.SUMMARY_COLUMNS)


def _packed(rows: DataFrame, payload: list[str], name: str) -> DataFrame:
    return rows.select("merchant_num", "user_id", F.struct(*payload).alias(name))


def user_profile(i: Inputs, p: ProfileParams) -> DataFrame:
    orders = i.orders.withColumn("user_id", F.col("platform_open_id"))
    keys = ["merchant_num", "user_id"]
    member = _packed(newest(orders.where("is_member = 1"), keys, ords.MEMBER_ORDER_PAYLOAD), ords.MEMBER_ORDER_PAYLOAD, "latest_member_order")
    other = _packed(newest(orders.where("is_member = 0"), keys, ords.NONMEMBER_ORDER_PAYLOAD), ords.NONMEMBER_ORDER_PAYLOAD, "latest_nonmember_order")
    none = [F.lit(None).cast("int").alias(c) for c in ORDER_FACT_COLUMNS]
    users = all_users(members_with_facts(i.members, member.select("*", *none), i.city_level, city_broadcast=True),
                      nonmembers_with_facts(other.select("*", *none))).drop(*ORDER_FACT_COLUMNS)
    out = attach(users, [order_summary(i.orders, p)], keys)
    out = attach(out, [activity_summary(i.activity, p), points_total(i.points)], ["merchant_num", "member_id"])
    return label_profile(out.select(*JOINED_COLUMNS)).distinct()


def cells(profile: DataFrame, n_buckets: int) -> DataFrame:
    """All rows' cells first, then the best candidate of each coordinate."""
    member = F.coalesce(F.col("is_member") == 1, F.lit(False))
    long = cell_values(profile.withColumn("_of_member", member), ["rowkey", "_of_member"])
    value: Column = F.coalesce(F.max(F.when(F.col("_of_member"), F.col("value"))), F.max("value"))
    best = long.groupBy("rowkey", "qualifier").agg(value.alias("value"))
    return best.select("rowkey", family_of(DEFAULT_FAMILIES).alias("family"), "qualifier", "value",
                       bucket_of(F.col("rowkey"), n_buckets).alias("bucket"))
