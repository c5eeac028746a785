"""Named queries over the fixture inputs, one per operator group.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
fixture views; the profile queries checkpoint their aggregates when built. The matching DuckDB texts are
in :mod:`buyerlens.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.functions import labels
from buyerlens.functions.scalars import day_of
from buyerlens.operators import activity as act
from buyerlens.operators import cells as cl
from buyerlens.operators import members as mem
from buyerlens.operators import orders as ords
from buyerlens.operators import profile as prof
from buyerlens.operators import rolling as roll
from buyerlens.operators.points import points_total
from buyerlens.params import FIXTURE_PARAMS, ProfileParams
from buyerlens.schema import BASE_COLUMNS
from buyerlens.session import materialize, scratch_dir
from buyerlens.sources.cellstore import order_report, write_cells
from buyerlens.sources.fixtures import fixture_inputs
from buyerlens.sources.tables import Inputs, scan_inputs, scan_members, store_members

Query = Callable[[SparkSession, str], DataFrame]

P: ProfileParams = FIXTURE_PARAMS
LABEL_KEYS = ["merchant_num", "user_id", "is_member"]


def inputs(spark: SparkSession, sf_dir: str, params: ProfileParams = P) -> Inputs:
    return scan_inputs(fixture_inputs(spark, sf_dir), params)


def _facts(i: Inputs) -> DataFrame:
    return ords.buyer_facts(i.orders, P)


# --- sources ---------------------------------------------------------------

def member_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs(spark, sf_dir).members


def order_snapshot_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs(spark, sf_dir).orders
    return o.where(ords.paid_in_window(P)).select(
        "order_id", "merchant_num", "platform_open_id", day_of("pay_at").alias("pay_day"), "status", "payment")


def city_level_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs(spark, sf_dir).city_level


def activity_log_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = inputs(spark, sf_dir).activity
    return a.where(day_of("created_at").between(F.lit(P.activity_start), F.lit(P.as_of)))


def points_log_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = inputs(spark, sf_dir).points
    return p.where((F.col("num_change") > 0) & (F.col("right_type") == 1))


# --- orders ----------------------------------------------------------------

def latest_member_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ords.latest_member_orders(inputs(spark, sf_dir).orders)
    return f.select("merchant_num", "user_id", *[
        F.col(f"latest_member_order.{src}").alias(dst) for dst, src in (
            ("receive_province", "province"), ("receive_province_code", "province_code"),
            ("receive_city", "city"), ("receive_city_code", "city_code"))])


def latest_nonmember_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ords.latest_nonmember_orders(inputs(spark, sf_dir).orders)
    return f.select("merchant_num", F.col("user_id").alias("platform_open_id"),
                    *[F.col(f"latest_nonmember_order.{c}").alias(c) for c in ords.NONMEMBER_ORDER_PAYLOAD])


def pay_day_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ords.pay_day_rank(inputs(spark, sf_dir).orders, P)


def order_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ords.order_window_count(inputs(spark, sf_dir).orders, P)


def today_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ords.today_orders(inputs(spark, sf_dir).orders, P)


def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ords.order_summary(inputs(spark, sf_dir).orders, P)


def pay_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ords.pay_detail(inputs(spark, sf_dir).orders, P)


# --- activity and points ---------------------------------------------------

def exchange_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act.exchange_stats(inputs(spark, sf_dir).activity, P)


def recent_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act.recent_interaction(inputs(spark, sf_dir).activity, P)


def recent_interaction_90(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 at its default of 90 days."""
    return act.recent_interaction(inputs(spark, sf_dir).activity, ProfileParams(as_of=P.as_of))


def recent_interaction_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3, A7, A8 as sums of daily partials, after three consecutive daily runs."""
    from dataclasses import replace

    path = f"{scratch_dir(spark)}/daily-{uuid.uuid4().hex}"
    a = inputs(spark, sf_dir).activity
    for as_of in ("2024-01-28", "2024-01-29", P.as_of):
        roll.advance(a, path, replace(P, as_of=as_of))
    return roll.recent_interaction(spark, path, P)


def member_snapshot_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, T4 on a table stored by day and tenant: only the day's and the tenants' folders are read."""
    from dataclasses import replace

    from buyerlens.plans.oracle import SCOPED_TENANTS

    path = f"{scratch_dir(spark)}/members-{uuid.uuid4().hex}"
    store_members(fixture_inputs(spark, sf_dir)["member_base_info_day"], path)
    return scan_members(spark.read.parquet(path), replace(P, tenants=SCOPED_TENANTS))


def interaction_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act.interaction_list(inputs(spark, sf_dir).activity, P)


def activity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act.activity_summary(inputs(spark, sf_dir).activity, P)


def points_total_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_total(inputs(spark, sf_dir).points)


# --- users and profile -----------------------------------------------------

def members_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = inputs(spark, sf_dir)
    return mem.members_enriched(i.members, _facts(i), i.city_level)


def nonmembers_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mem.nonmembers_default(_facts(inputs(spark, sf_dir)))


def all_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = inputs(spark, sf_dir)
    f = materialize(_facts(i))
    return mem.all_users(mem.members_with_facts(i.members, f, i.city_level),
                         mem.nonmembers_with_facts(f)).select(*BASE_COLUMNS)


def profile_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.joined_profile(inputs(spark, sf_dir), P)


def _labelled(spark: SparkSession, sf_dir: str, *cols, figures: bool = False) -> DataFrame:
    """A label beside its inputs; most need the orders alone."""
    j = prof.joined_profile(inputs(spark, sf_dir), P, figures=figures)
    return j.select(*LABEL_KEYS, *cols)


def label_buy_charact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, "is_new_member", "today_order_num", "history_order_num_360",
                     labels.buy_charact().alias("buy_charact"))


def label_buy_subdivision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, "is_new_member", "today_order_num", "history_order_num_360",
                     labels.buy_subdivision().alias("buy_subdivision"))


def label_is_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, "member_id", "join_num_90", labels.is_silent().alias("is_silent"), figures=True)


def label_pay_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, labels.pay_detail_label().alias("pay_detail"))


def today_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, labels.today_order_num_or_zero().alias("today_order_num"),
                     labels.today_order_amount_or_zero().alias("today_order_amount"))


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_profile(inputs(spark, sf_dir), P)


def tenant_scoped_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the profile of two tenants; every input is scoped, logs included."""
    from dataclasses import replace

    from buyerlens.plans.oracle import SCOPED_TENANTS

    p = replace(P, tenants=SCOPED_TENANTS)
    return prof.user_profile(inputs(spark, sf_dir, p), p)


# --- cells -----------------------------------------------------------------

def _sink_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.user_profile(inputs(spark, sf_dir), P, final_distinct=False, keyed=True)


def cell_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _sink_profile(spark, sf_dir).drop("rowkey")
    ids = p.select(F.col("merchant_num").alias("row_merchant_num"), F.col("user_id").alias("row_user_id"),
                   F.col("is_member").alias("row_is_member"), *p.columns)
    return cl.cell_values(ids, ["row_merchant_num", "row_user_id", "row_is_member"])


def cell_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays, maps and structs as JSON, NULLs inside kept or left out, mixed-case names in lower case."""
    m = inputs(spark, sf_dir).members.distinct()
    typed = m.select(
        "user_id", F.array(F.col("member_id"), F.col("sex").cast("bigint")).alias("MixedIds"),
        F.create_map(F.lit("age"), F.col("age"), F.lit("sex"), F.col("sex")).alias("figureMap"),
        F.struct(F.col("sex").alias("Sex"), F.col("age").alias("age")).alias("PAIR"), F.col("birthday").alias("Birth_Day"))
    return cl.cell_values(typed, ["user_id"])


def cell_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).groupBy("family", "qualifier").agg(F.count(F.lit(1)).alias("n_cells"))


def cell_rowkey_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _sink_profile(spark, sf_dir)
    return p.select("merchant_num", "user_id", "is_member", "rowkey", cl.bucket_of(F.col("rowkey"), P.n_buckets).alias("bucket"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile, lists = prof.sink_profile(inputs(spark, sf_dir), P)
    return cl.cells(profile, P.n_buckets, tenant_lists=lists)


def cells_at_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 with a store's own region boundaries: cells and first key of each region."""
    profile, lists = prof.sink_profile(inputs(spark, sf_dir), P)
    from buyerlens.plans.oracle import SPLITS

    c = cl.cells(profile, P.n_buckets, splits=SPLITS, tenant_lists=lists)
    return c.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_cells"), F.min("rowkey").alias("first_key"))


def cells_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells stored twice and read back from the current version: per family and bucket their
    number, the first and last rowkey, the files' codec, and the neighbours within a file that are out of order."""
    path = f"{scratch_dir(spark)}/cells-{uuid.uuid4().hex}"
    c = cells(spark, sf_dir)
    for _ in range(2):
        write_cells(c, path)
    return order_report(spark, path)


QUERIES: dict[str, Query] = {
    "member_snapshot": member_snapshot,
    "order_snapshot_paid": order_snapshot_paid,
    "city_level_dim": city_level_dim,
    "activity_log_window": activity_log_window,
    "points_log_positive": points_log_positive,
    "latest_member_order": latest_member_order,
    "latest_nonmember_order": latest_nonmember_order,
    "pay_day_rank": pay_day_rank,
    "order_window_count": order_window_count,
    "today_orders": today_orders,
    "order_summary": order_summary,
    "pay_detail": pay_detail,
    "exchange_stats": exchange_stats,
    "recent_interaction": recent_interaction,
    "interaction_list": interaction_list,
    "activity_summary": activity_summary,
    "points_total": points_total_q,
    "members_enriched": members_enriched,
    "nonmembers_default": nonmembers_default,
    "all_users": all_users,
    "profile_joined": profile_joined,
    "label_buy_charact": label_buy_charact,
    "label_buy_subdivision": label_buy_subdivision,
    "label_is_silent": label_is_silent,
    "label_pay_detail": label_pay_detail,
    "today_defaults": today_defaults,
    "user_profile": user_profile,
    "tenant_scoped_profile": tenant_scoped_profile,
    "cell_values": cell_values,
    "cell_family": cell_family,
    "cell_rowkey_bucket": cell_rowkey_bucket,
    "cells": cells,
    "cells_stored": cells_stored,
    "cell_rendering": cell_rendering,
    "cells_at_splits": cells_at_splits,
    "recent_interaction_90": recent_interaction_90,
    "recent_interaction_rolled": recent_interaction_rolled,
    "member_snapshot_partitioned": member_snapshot_partitioned,
}
