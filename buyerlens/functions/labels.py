"""Label rules as native column expressions (no UDF, stays in codegen).

``buy_charact`` and ``buy_subdivision`` follow an inferred rule: the
reference registers them as opaque UDFs over (is member, is new member, orders
today, orders before today in the window) and documents only their value
domains. Both treat "bought" as "paid today". Callers may pass other
expressions to :func:`buyerlens.operators.profile.label_profile`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _today(c: str = "today_order_num") -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _history(c: str = "history_order_num_360") -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _member() -> Column:
    # A NULL is_member is "not a member", as if(is_member = 1, true, false).
    return F.coalesce(F.col("is_member") == 1, F.lit(False))


def _new_member() -> Column:
    return F.coalesce(F.col("is_new_member") == 1, F.lit(False))


def buy_charact() -> Column:
    """0 did not buy today, 1 first-purchase member, 2 repeat-purchase member,
    3 non-member buyer."""
    return (
        F.when(_today() == 0, F.lit(0))
        .when(~_member(), F.lit(3))
        .when(_history() == 0, F.lit(1))
        .otherwise(F.lit(2))
        .cast("int")
    )


def buy_subdivision() -> Column:
    """0 unknown, 1 joined and bought on the same day, 2 first purchase not on
    the joining day."""
    bought_member = _member() & (_today() > 0)
    return (
        F.when(bought_member & _new_member(), F.lit(1))
        .when(bought_member & (_history() == 0), F.lit(2))
        .otherwise(F.lit(0))
        .cast("int")
    )


def is_silent() -> Column:
    """1 when the user took part in an activity in the window and has a real
    member id (> 1), else 0. Despite the name, 1 means *active*."""
    return F.when((F.col("join_num_90") >= 1) & (F.col("member_id") > 1), F.lit(1)).otherwise(F.lit(0)).cast("int")


def pay_detail_label() -> Column:
    """0 never paid in the window, 1 paid on one day, 2 paid on two or more."""
    return F.coalesce(F.col("pay_detail"), F.lit(0)).cast("int")


def today_order_num_or_zero() -> Column:
    return F.coalesce(F.col("today_order_num"), F.lit(0).cast("bigint"))


def today_order_amount_or_zero() -> Column:
    amount = F.col("today_order_amount")
    return (
        F.when(amount.isNotNull(), amount.try_cast("decimal(15,3)"))
        .otherwise(F.lit(0).cast("decimal(15,3)"))
    )
