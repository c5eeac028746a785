"""Activity-participation aggregates (A5-A10, J2) per (merchant, member).

:func:`activity_summary` is the fused form: filtered aggregates and the
distinct seconds of a key, one scan and one exchange by key. Its NULL rules:

* exchange list / count: NULL unless the key has a row of type 2; then the
  list may be ``''`` and the count 0;
* window flag / interaction count: NULL unless the key has a row in the window;
* all-time list: ``''`` when every ``created_at`` is NULL;
* a key with a NULL part has no figures: all five are NULL.

A key of more than ``list_rows`` log rows is hot (a count by key tells them
first): its rows are combined per second and per day, over as many tasks as it
has days, and only the days' finished texts meet, in order, so no task sorts a
hot key's seconds. A day is a prefix of its seconds, so the texts are the same
by either way. The list of a key is part of its output row, so it is as long
as the key has distinct seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import day_of, second_of
from buyerlens.operators.joins import fits_broadcast
from buyerlens.params import ProfileParams
from buyerlens.session import materialize

MEMBER_KEYS = ["merchant_num", "member_id"]
EXCHANGE_TYPE = 2
SUMMARY_COLUMNS = ["merchant_num", "member_id", "exchange_time_list", "exchange_num",
                   "join_num_90", "interactive_num", "interactive_time_list"]


def _in_window(params: ProfileParams) -> Column:
    return day_of("created_at").between(F.lit(params.activity_start), F.lit(params.as_of))


def _ok() -> Column:
    return F.col("status") == 1


def _exchange() -> Column:
    return F.col("activity_type") == EXCHANGE_TYPE


def hot_keys(activity: DataFrame, list_rows: int) -> DataFrame:
    """Keys of more than ``list_rows`` rows: at most one in ``list_rows`` rows of the log."""
    return activity.groupBy(*MEMBER_KEYS).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_rows).select(*MEMBER_KEYS)


def _joined(texts: Column) -> Column:
    return F.array_join(texts, ",")


def _by_key(activity: DataFrame, figures: dict[str, Column], exchange: Column, other: Column) -> DataFrame:
    """Per key the figures and both lists, by one exchange: ``exchange`` and ``other`` are the seconds to collect."""
    g = activity.groupBy(*MEMBER_KEYS).agg(*[f.alias(n) for n, f in figures.items()],
                                           F.collect_set(exchange).alias("_x"), F.collect_set(other).alias("_o"))
    return g.select(*MEMBER_KEYS, *figures, _joined(F.array_sort("_x")).alias("_exchange_list"),
                    _joined(F.array_sort(F.array_union("_x", "_o"))).alias("_all_list"))


def _by_day(activity: DataFrame, figures: dict[str, Column], exchange: Column, other: Column) -> DataFrame:
    """The same, per (key, day) first: a day's seconds are sorted by themselves, then the days' texts follow one another."""
    day = day_of(F.coalesce(exchange, other)).alias("_day")
    second = F.coalesce(exchange, other).alias("_second")
    parts = activity.groupBy(*MEMBER_KEYS, day, second).agg(*[f.alias(n) for n, f in figures.items()],
                                                            F.max(exchange.isNotNull()).alias("_is_x"))
    sums = [F.sum(n).alias(n) for n in figures]
    moment = F.when(F.col("_second").isNotNull(), F.struct("_second", F.col("_is_x").alias("x")))
    days = parts.groupBy(*MEMBER_KEYS, "_day").agg(*sums, F.array_sort(F.collect_list(moment)).alias("_m"))
    seconds = lambda m: F.transform(m, lambda x: x["_second"])
    exchanges = F.filter("_m", lambda x: x["x"])
    days = days.select(*MEMBER_KEYS, "_day", *figures, _joined(seconds(F.col("_m"))).alias("_all"),
                       F.when(F.size(exchanges) > 0, _joined(seconds(exchanges))).alias("_x"))
    whole = days.groupBy(*MEMBER_KEYS).agg(*sums, F.array_sort(F.collect_list(
        F.when(F.col("_day").isNotNull(), F.struct("_day", "_all", "_x")))).alias("_days"))
    in_order = lambda field: F.filter(F.transform("_days", lambda d: d[field]), lambda t: t.isNotNull())
    return whole.select(*MEMBER_KEYS, *figures, _joined(in_order("_x")).alias("_exchange_list"),
                        _joined(in_order("_all")).alias("_all_list"))


def _with_lists(activity: DataFrame, figures: dict[str, Column], exchange: Column, other: Column, params: ProfileParams,
                hot: DataFrame | None) -> DataFrame:
    """Every key's figures and lists; ``hot`` passes the hot keys where they are known."""
    known = hot is not None
    hot = hot if known else hot_keys(activity, params.list_rows)
    if hot.isEmpty():
        return _by_key(activity, figures, exchange, other)
    hot = hot if known else materialize(hot)
    if not fits_broadcast(hot, params.hot_broadcast_max_rows, params.hot_broadcast_max_bytes):
        return _by_day(activity, figures, exchange, other)
    h = F.broadcast(hot.select(*[F.col(k).alias(f"_h_{k}") for k in MEMBER_KEYS]))
    is_hot = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in MEMBER_KEYS]
    return _by_key(activity.join(h, is_hot, "left_anti"), figures, exchange, other).unionByName(
        _by_day(activity.join(h, is_hot, "left_semi"), figures, exchange, other))


def activity_summary(activity: DataFrame, params: ProfileParams, hot: DataFrame | None = None) -> DataFrame:
    """J2 + A5-A10 fused: one row per distinct (merchant, member) of the log."""
    in_win = _in_window(params)
    keyed = F.col("merchant_num").isNotNull() & F.col("member_id").isNotNull()
    figures = {"_n_exchange": F.count_if(_exchange()), "_n_exchange_ok": F.count_if(_exchange() & _ok()),
               "_n_window": F.count_if(in_win), "_n_window_ok": F.count_if(in_win & _ok())}
    second = second_of("created_at")
    of_exchange = F.coalesce(_exchange(), F.lit(False))
    g = _with_lists(activity, figures, F.when(keyed & of_exchange, second), F.when(keyed & ~of_exchange, second), params, hot)
    has_x = keyed & (F.col("_n_exchange") > 0)
    has_w = keyed & (F.col("_n_window") > 0)
    return g.select(
        *MEMBER_KEYS,
        F.when(has_x, F.col("_exchange_list")).alias("exchange_time_list"),
        F.when(has_x, F.col("_n_exchange_ok")).alias("exchange_num"),
        F.when(has_w, F.lit(1)).alias("join_num_90"),
        F.when(has_w, F.col("_n_window_ok")).alias("interactive_num"),
        F.when(keyed, F.col("_all_list")).alias("interactive_time_list"),
    )


def exchange_stats(activity: DataFrame, params: ProfileParams = ProfileParams(), hot: DataFrame | None = None) -> DataFrame:
    """A5 + A6: per key with exchange rows, the sorted exchange-time list and
    the count of successful exchanges (0 possible)."""
    g = _with_lists(activity.where(_exchange()), {"exchange_num": F.count_if(_ok())}, second_of("created_at"),
                    F.lit(None).cast("string"), params, hot)
    return g.select(*MEMBER_KEYS, F.col("_exchange_list").alias("exchange_time_list"), "exchange_num")


def recent_interaction(activity: DataFrame, params: ProfileParams) -> DataFrame:
    """A7 + A8: keys active in the window, a participation flag of 1 and the
    count of successful participations."""
    return (activity.where(_in_window(params)).groupBy(*MEMBER_KEYS)
            .agg(F.lit(1).alias("join_num_90"), F.count_if(_ok()).alias("interactive_num")))


def interaction_list(activity: DataFrame, params: ProfileParams = ProfileParams(), hot: DataFrame | None = None) -> DataFrame:
    """All-time sorted participation-time list of every key."""
    g = _with_lists(activity, {}, F.lit(None).cast("string"), second_of("created_at"), params, hot)
    return g.select(*MEMBER_KEYS, F.col("_all_list").alias("interactive_time_list"))
