"""The labelled profile: J5-J7, P1, P2, P6, L1-L5.

Plan shape at scale:

* the three per-key aggregates (buyer facts, activity, points) are each one
  scan with partial aggregation, written once as Parquet below the shared
  checkpoint folder;
* member rows are shuffled once on (merchant_num, user_id) to meet the buyer
  facts (the member ``distinct`` then needs no shuffle of its own) and once
  on (merchant_num, member_id) to meet activity and then points;
* non-member rows come straight from the buyer facts. All carry
  ``member_id = 0``, one hot key per tenant; they meet the ``member_id = 0``
  figures by a size-checked broadcast (they do not move), or beyond the
  bound through a salted join, so no task gets a tenant's whole non-member
  population.

Each right side is unique per key, so the joins keep rows distinct; a final
row-wide ``distinct`` is added only when tenant texts make it necessary (see
:func:`user_profile`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions import labels
from buyerlens.functions.scalars import default_rowkey, tolerant_cast
from buyerlens.operators.activity import activity_summary
from buyerlens.operators.joins import fits_broadcast, salted_left_join
from buyerlens.operators.members import (
    city_fits_broadcast,
    members_with_facts,
    non_canonical_tenant_text,
    nonmembers_with_facts,
)
from buyerlens.operators.orders import buyer_facts
from buyerlens.operators.points import points_total
from buyerlens.params import ProfileParams
from buyerlens.schema import (
    ACTIVITY_COLUMNS,
    BASE_COLUMNS,
    ORDER_FACT_COLUMNS,
    POINTS_COLUMNS,
    PROFILE_COLUMNS,
)
from buyerlens.session import materialize as materialize_one
from buyerlens.session import run_concurrently
from buyerlens.sources.tables import Inputs

MEMBER_KEYS = ["merchant_num", "member_id"]
STAT_TYPES = {"join_num_90": "int", "exchange_time_list": "string", "exchange_num": "bigint", "interactive_num": "bigint",
              "interactive_time_list": "string", "total_point": "bigint"}
STAT_COLUMNS = [*ACTIVITY_COLUMNS, *POINTS_COLUMNS]
LIST_COLUMNS = ["exchange_time_list", "interactive_time_list"]
JOINED_COLUMNS = [*BASE_COLUMNS, *ORDER_FACT_COLUMNS, *STAT_COLUMNS]


def hot_member_figures(activity: DataFrame, points: DataFrame) -> DataFrame:
    """The ``member_id = 0`` figures: at most one row per tenant."""
    return (activity.where(F.col("member_id") == 0)
            .join(points.where(F.col("member_id") == 0), on=MEMBER_KEYS, how="full"))


def hot_fits_broadcast(hot: DataFrame, params: ProfileParams) -> bool:
    return fits_broadcast(hot, params.hot_broadcast_max_rows, params.hot_broadcast_max_bytes)


def without_figures(side: DataFrame) -> DataFrame:
    """A side whose activity and points figures are all NULL."""
    return side.select("*", *[F.lit(None).cast(STAT_TYPES[c]).alias(c) for c in STAT_COLUMNS]).select(*JOINED_COLUMNS)


def profile_joined(members_side: DataFrame, nonmembers_side: DataFrame, activity: DataFrame,
                   points: DataFrame, params: ProfileParams, hot: DataFrame | None = None, lists_apart: bool = False) -> DataFrame:
    """J5-J7 + P1: 45 base columns, the order figures and the activity and
    points figures (55 columns).

    ``activity`` and ``points`` are the per-(merchant, member) aggregates.
    Members meet them one after the other, so only the member rows are
    shuffled. Non-members meet the ``member_id = 0`` rows (one per tenant) by
    a broadcast when a size check proves them small (``hot`` passes rows already
    made), so they do not move at all; beyond the bound, through a salted join.
    With ``lists_apart`` non-members get the numbers only: the lists, one text
    for a whole tenant, are left to whoever renders the rows.
    """
    m = (members_side.join(activity, on=MEMBER_KEYS, how="left")
         .join(points, on=MEMBER_KEYS, how="left"))
    if not params.nonmember_figures:
        return m.select(*JOINED_COLUMNS).unionByName(without_figures(nonmembers_side))
    hot = hot_member_figures(activity, points) if hot is None else hot
    if lists_apart:
        hot = hot.withColumns({c: F.lit(None).cast("string") for c in LIST_COLUMNS})
    if hot_fits_broadcast(hot, params):
        n = nonmembers_side.join(F.broadcast(hot), on=MEMBER_KEYS, how="left")
    else:
        n = salted_left_join(nonmembers_side, hot, MEMBER_KEYS, ["merchant_num", "user_id"], params.salt_buckets)
    return m.select(*JOINED_COLUMNS).unionByName(n.select(*JOINED_COLUMNS))


@dataclass(frozen=True)
class Rules:
    """What a user replaces: the two purchase labels (L1, L2) and the rowkey (C1), as columns over the
    joined profile, where tenant and user are still raw text."""

    buy_charact: Column | None = None
    buy_subdivision: Column | None = None
    rowkey: Column | None = None


def label_profile(joined: DataFrame, rules: Rules = Rules(), keyed: bool = False, tenant: bool = False) -> DataFrame:
    """P2 + P6 + L1-L5: the 56 output columns with their casts and labels; with ``keyed`` also ``rowkey``, with
    ``tenant`` also ``_tenant``, the raw tenant text of the non-member rows."""
    to_int = {c: tolerant_cast(c, "int") for c in (
        "merchant_num", "status", "channel", "member_identity", "point", "total_point", "member_grade",
        "receive_province_code", "receive_city_code", "exchange_num", "interactive_num")}
    exprs = {
        **to_int,
        "today_order_num": labels.today_order_num_or_zero(),
        "today_order_amount": labels.today_order_amount_or_zero(),
        "buy_charact": labels.buy_charact() if rules.buy_charact is None else rules.buy_charact,
        "buy_subdivision": labels.buy_subdivision() if rules.buy_subdivision is None else rules.buy_subdivision,
        "is_silent": labels.is_silent(),
        "pay_detail": labels.pay_detail_label(),
    }
    key = [(default_rowkey() if rules.rowkey is None else rules.rowkey).alias("rowkey")] if keyed else []
    if tenant:
        key.append(F.when(F.coalesce(F.col("is_member") != 1, F.lit(True)), F.col("merchant_num")).alias("_tenant"))
    return joined.select(*[(exprs[c] if c in exprs else F.col(c)).alias(c) for c in PROFILE_COLUMNS], *key)


def _profile_parts(inputs: Inputs, params: ProfileParams, materialize: bool, cast_early: bool, tenant_check: bool = False,
                   figures: bool = True, lists_apart: bool = False) -> tuple[DataFrame, bool, DataFrame | None]:
    """The joined profile, whether tenant texts may be ambiguous, and the ``member_id = 0`` rows.
    Without ``figures`` neither log is read.

    Guard jobs run next to the work they do not depend on: the city size
    check and the member half of the tenant-text check alongside the three
    aggregate tables; the ``member_id = 0`` table and the facts half of the
    tenant-text check together afterwards.
    """
    spark = inputs.orders.sparkSession
    aggregates: dict = {"buyer_facts": lambda: buyer_facts(inputs.orders, params)}
    if figures:
        aggregates |= {
            "activity_stats": lambda: activity_summary(inputs.activity, params).select(*MEMBER_KEYS, *ACTIVITY_COLUMNS),
            "points_stats": lambda: points_total(inputs.points),
        }
    first: dict = {"city": lambda: city_fits_broadcast(inputs.city_level)}
    if tenant_check:
        first["members_tenants"] = lambda: non_canonical_tenant_text(inputs.members)
    first.update({k: (lambda v=v: materialize_one(v())) if materialize else v for k, v in aggregates.items()})
    done = run_concurrently(spark, first)
    aggregates = {k: done[k] for k in aggregates}
    facts = aggregates["buyer_facts"]
    second: dict = {}
    if figures and params.nonmember_figures:
        hot = hot_member_figures(aggregates["activity_stats"], aggregates["points_stats"])
        second["hot"] = lambda: materialize_one(hot) if materialize else hot
    if tenant_check and not done["members_tenants"]:
        second["facts_tenants"] = lambda: non_canonical_tenant_text(facts)
    later = run_concurrently(spark, second)
    ambiguous = tenant_check and (done["members_tenants"] or later.get("facts_tenants", False))
    members_side = members_with_facts(inputs.members, facts, inputs.city_level, cast_early=cast_early,
                                      city_broadcast=done["city"]).distinct()
    nonmembers_side = nonmembers_with_facts(facts, cast_early=cast_early)
    if not figures:
        return without_figures(members_side).unionByName(without_figures(nonmembers_side)), ambiguous, None
    joined = profile_joined(members_side, nonmembers_side, aggregates["activity_stats"], aggregates["points_stats"], params,
                            later.get("hot"), lists_apart)
    return joined, ambiguous, later.get("hot")


def joined_profile(inputs: Inputs, params: ProfileParams, materialize: bool = True, figures: bool = True) -> DataFrame:
    """Source to the 55-column joined profile (base columns as raw text).

    With ``materialize`` the three per-key aggregates are written once under
    the shared checkpoint folder: each input is then scanned and shuffled
    once although two profile sides read the aggregates. Without it the plan
    stays lazy and the aggregates are recomputed per consumer (the buyer
    facts twice): meant for small inputs and tests. Without ``figures`` the
    activity and points figures are NULL and their logs are not read.
    """
    return _profile_parts(inputs, params, materialize, cast_early=False, figures=figures)[0]


def user_profile(inputs: Inputs, params: ProfileParams, final_distinct: bool | None = None,
                 materialize: bool = True, rules: Rules = Rules(), keyed: bool = False) -> DataFrame:
    """The 56-column labelled profile of every shop user.

    The labelled rows must be distinct. The text-to-int casts of base columns
    run before the sides' ``distinct``, so a final row-wide ``distinct`` (a
    full shuffle of the profile) is needed only when two raw tenant texts
    can cast to the same number; ``final_distinct=None`` runs the cheap,
    conservative tenant-text check (see
    :func:`buyerlens.operators.members.non_canonical_tenant_text`) and adds
    the ``distinct`` only then. The cell sink passes ``False`` (its step per
    rowkey subsumes it) and ``keyed``, as the rowkey is made of the raw texts.
    """
    joined, ambiguous, _ = _profile_parts(inputs, params, materialize, cast_early=True, tenant_check=final_distinct is None)
    out = label_profile(joined, rules, keyed)
    if final_distinct is None:
        final_distinct = ambiguous
    return out.distinct() if final_distinct else out


def sink_profile(inputs: Inputs, params: ProfileParams, materialize: bool = True,
                 rules: Rules = Rules()) -> tuple[DataFrame, DataFrame | None]:
    """The labelled profile for the cell sink, with ``rowkey``, and the tenants' lists apart.

    The ``member_id = 0`` time lists, one text per tenant, belong to every
    non-member of the tenant. They stay a table ``(_tenant, *LIST_COLUMNS)`` of
    one row per tenant; a non-member row carries its ``_tenant`` instead, so
    what the sink shuffles does not grow with list times non-members.
    """
    joined, _, hot = _profile_parts(inputs, params, materialize, cast_early=True, lists_apart=True)
    lists = None if hot is None else hot.where(F.col("merchant_num").isNotNull()).select(F.col("merchant_num").alias("_tenant"), *LIST_COLUMNS)
    return label_profile(joined, rules, keyed=True, tenant=lists is not None), lists
