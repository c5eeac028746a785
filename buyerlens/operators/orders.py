"""Order aggregates (A1-A4, W1-W3, J1) over the order snapshot of ``as_of``.

:func:`buyer_facts` is the fused form used by the job: ONE scan and ONE
shuffle of the orders give, per (merchant, buyer), the 360-day count, today's
count and amount, the pay-day spread and the latest member / non-member order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.functions.scalars import day_of
from buyerlens.operators.latest import latest_struct
from buyerlens.params import ProfileParams

BUYER_KEYS = ["merchant_num", "user_id"]

# Payload of the latest member order: the receiver address.
MEMBER_ORDER_PAYLOAD = ["province", "province_code", "city", "city_code"]
# Payload of the latest non-member order: what a non-member row can know.
NONMEMBER_ORDER_PAYLOAD = ["brand_code", "platform_type", "nick", "is_member",
                           "province", "province_code", "city", "city_code"]
LATEST_ORDER = ["updated_at", "order_id"]


def _pay_day() -> Column:
    return day_of("pay_at")


def paid(params: ProfileParams) -> Column:
    return F.col("status").isin(list(params.paid_status))


def paid_in_window(params: ProfileParams) -> Column:
    """F1 + F2: paid, and paid on a day of the order window."""
    return paid(params) & _pay_day().between(F.lit(params.order_start), F.lit(params.as_of))


def paid_today(params: ProfileParams) -> Column:
    """F1 + F3: paid on ``as_of``."""
    return paid(params) & (_pay_day() == F.lit(params.as_of))


def _figures(params: ProfileParams) -> list[Column]:
    """Aggregates of a buyer's orders: all numbers, so they hash-aggregate. A pay day is its day number; a text in
    the window that is no date is told from others by its hash."""
    in_win, today = paid_in_window(params), paid_today(params)
    date = _pay_day().try_cast("date")
    is_date = F.coalesce(date.cast("string") == _pay_day(), F.lit(False))
    day, odd = F.when(in_win & is_date, F.unix_date(date)), F.when(in_win & ~is_date, F.xxhash64(_pay_day()))
    return [F.count_if(in_win).alias("_n_win"), F.count_if(today).alias("_n_today"),
            F.sum(F.when(today, F.col("payment"))).alias("_amount_today"),
            F.min(day).alias("_low_day"), F.max(day).alias("_high_day"), F.min(odd).alias("_low_odd"), F.max(odd).alias("_high_odd")]


def _figure_columns() -> list[Column]:
    """The order figures; those of today and the pay detail need a key without a NULL part."""
    keyed = F.col("merchant_num").isNotNull() & F.col("user_id").isNotNull()
    has_win = F.col("_n_win") > 0
    has_today = keyed & (F.col("_n_today") > 0)
    one_day = (F.col("_low_odd").isNull() & (F.col("_low_day") == F.col("_high_day"))) | (
        F.col("_low_day").isNull() & (F.col("_low_odd") == F.col("_high_odd")))
    return [
        F.when(has_win, F.col("_n_win")).alias("order_num_360"),
        F.when(has_today, F.col("_n_win") - F.col("_n_today")).alias("history_order_num_360"),
        F.when(has_today, F.col("_n_today")).alias("today_order_num"),
        F.when(has_today, F.col("_amount_today")).alias("today_order_amount"),
        # A4: the highest pay-day rank exceeds 1 iff there are >= 2 pay days.
        F.when(keyed & has_win, F.when(one_day, F.lit(1)).otherwise(F.lit(2)))
        .cast("int").alias("pay_detail"),
    ]


def _by_buyer(orders: DataFrame):
    return orders.groupBy(F.col("merchant_num"), F.col("platform_open_id").alias("user_id"))


def _latest(kind: int, payload: list[str], name: str) -> Column:
    return latest_struct(LATEST_ORDER, payload, F.col("is_member") == kind, name)


def buyer_facts(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """Everything the job needs from orders, one row per (merchant, buyer).

    Columns: merchant_num, user_id, order_num_360, history_order_num_360,
    today_order_num, today_order_amount, pay_detail (all NULL when the buyer
    has no paid order in the window; the today figures and history are NULL
    when nothing was paid today), latest_member_order and
    latest_nonmember_order structs (NULL when the buyer has no such order).
    """
    g = _by_buyer(orders).agg(*_figures(params), _latest(1, MEMBER_ORDER_PAYLOAD, "latest_member_order"),
                              _latest(0, NONMEMBER_ORDER_PAYLOAD, "latest_nonmember_order"))
    return g.select("merchant_num", "user_id", *_figure_columns(), "latest_member_order", "latest_nonmember_order")


def latest_member_orders(orders: DataFrame) -> DataFrame:
    """The latest member order of each buyer that has one; the filter is pushed into the scan."""
    return _by_buyer(orders.where(F.col("is_member") == 1)).agg(_latest(1, MEMBER_ORDER_PAYLOAD, "latest_member_order"))


def latest_nonmember_orders(orders: DataFrame) -> DataFrame:
    """The latest non-member order of each buyer that has one."""
    return _by_buyer(orders.where(F.col("is_member") == 0)).agg(_latest(0, NONMEMBER_ORDER_PAYLOAD, "latest_nonmember_order"))


SUMMARY_COLUMNS = ["merchant_num", "user_id", "order_num_360", "history_order_num_360",
                   "today_order_num", "today_order_amount", "pay_detail"]


def order_summary(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """J1 + A1-A4 fused: buyers with a paid order in the window (today lies in it), filtered before grouping."""
    g = _by_buyer(orders.where(paid_in_window(params))).agg(*_figures(params))
    return g.select("merchant_num", "user_id", *_figure_columns()).select(*SUMMARY_COLUMNS)


def order_window_count(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """A1: paid orders in the window per (merchant, buyer)."""
    return (orders.where(paid_in_window(params))
            .groupBy(F.col("merchant_num"), F.col("platform_open_id").alias("user_id"))
            .agg(F.count(F.lit(1)).alias("order_num_360")))


def today_orders(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """A2: count and amount of orders paid today; buyers without one are absent."""
    return (orders.where(paid_today(params))
            .groupBy(F.col("merchant_num"), F.col("platform_open_id").alias("user_id"))
            .agg(F.count(F.lit(1)).alias("today_order_num"),
                 F.sum("payment").try_cast("decimal(15,3)").alias("today_order_amount")))


def pay_detail(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """A4: 1 if every paid order of the window is on one day, 2 otherwise."""
    return (orders.where(paid_in_window(params))
            .groupBy(F.col("merchant_num"), F.col("platform_open_id").alias("user_id"))
            .agg(F.when(F.min(_pay_day()) != F.max(_pay_day()), F.lit(2)).otherwise(F.lit(1))
                 .cast("int").alias("pay_detail")))


def pay_day_rank(orders: DataFrame, params: ProfileParams) -> DataFrame:
    """``rank()`` of each paid order of the window by pay day, newest first.

    Computed without a window over all of a buyer's orders: rank = 1 + number
    of the buyer's orders on later days. The order rows are read and moved once,
    by (buyer, day), so a buyer's orders spread over as many tasks as it has
    days. Their counts come out of the same exchange; the running sum over at
    most ``order_days`` counts per buyer goes back to the (buyer, day) parts.
    """
    keys = ["merchant_num", "platform_open_id"]
    # As one struct: NULL keys form a group of their own in a window, and equal structs may hold NULLs.
    rows = (orders.where(paid_in_window(params)).select(F.struct(*keys).alias("_buyer"), "order_id", _pay_day().alias("pay_day"))
            .repartition("_buyer", "pay_day"))
    # Counted over the same columns that the join below needs, so that both read one exchange.
    number = F.count("order_id") + F.count_if(F.col("order_id").isNull())
    per_day = rows.groupBy("_buyer", "pay_day").agg(number.alias("_n"))
    w = Window.partitionBy("_buyer").orderBy(F.col("pay_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_day.select("_buyer", "pay_day", (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("int").alias("rn"))
    return rows.join(ranks, ["_buyer", "pay_day"]).select("_buyer.*", "order_id", "pay_day", "rn")
