"""Profile sides: members (J3 J4 X4 X11 P4), non-members (P3 P5 W1), union.

Both sides come out with the 45 base columns in the same order and pinned
types, plus the buyer's order figures (``ORDER_FACT_COLUMNS``), which the
reference attaches after the union by a join on (merchant, user) — the same
key both sides are built on, so attaching them here saves that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import blank_to, strip_city_suffix, tolerant_cast
from buyerlens.operators.joins import fits_broadcast
from buyerlens.operators.orders import BUYER_KEYS
from buyerlens.schema import (
    BASE_COLUMNS,
    NONMEMBER_DEFAULTS,
    NONMEMBER_FROM_ORDER,
    ORDER_FACT_COLUMNS,
    pinned,
)

# Base columns the labelled profile casts from text to int (merchant_num is
# not among them: the joins key on its raw text).
EARLY_INT_COLUMNS = ("status", "channel", "member_identity", "point", "member_grade",
                     "receive_province_code", "receive_city_code")

# A city dimension larger than this is joined by a shuffle, not broadcast.
CITY_BROADCAST_MAX_ROWS = 1_000_000
CITY_BROADCAST_MAX_BYTES = 64 << 20

_RECEIVER_FROM_ORDER = {
    "receive_province": "province",
    "receive_province_code": "province_code",
    "receive_city": "city",
    "receive_city_code": "city_code",
}


def _cast_early(cols: list[Column], cast_early: bool) -> list[Column]:
    """With ``cast_early``, the base columns the labelled profile casts to int
    are cast here already, so the side's ``distinct`` sees the final values."""
    if not cast_early:
        return cols
    return [tolerant_cast(c, "int").alias(name) if name in EARLY_INT_COLUMNS else c
            for c, name in zip(cols, BASE_COLUMNS)]


def city_fits_broadcast(city_level: DataFrame, max_rows: int = CITY_BROADCAST_MAX_ROWS,
                        max_bytes: int = CITY_BROADCAST_MAX_BYTES) -> bool:
    """The size check behind the city dimension's broadcast."""
    return fits_broadcast(city_level, max_rows, max_bytes)


def members_with_facts(members: DataFrame, facts: DataFrame, city_level: DataFrame,
                       city_max_rows: int = CITY_BROADCAST_MAX_ROWS, cast_early: bool = False,
                       city_broadcast: bool | None = None) -> DataFrame:
    """Member rows with receiver address, city level and order figures.

    J3: left join with the buyer facts on (merchant_num, user_id); the latest
    member order gives the receiver address. J4: left join with the city
    dimension on the city name without its suffix (broadcast when small;
    ``city_broadcast`` passes a check already made).
    Duplicate member rows stay; the union removes them (non-member rows are
    unique by construction and never equal a member row).
    """
    f = facts.select(*BUYER_KEYS, "latest_member_order", *ORDER_FACT_COLUMNS)
    dim = city_level.select(F.col("name").alias("_city_name"), F.col("level").alias("_city_level"))
    if city_broadcast is None:
        city_broadcast = city_fits_broadcast(dim, city_max_rows)
    if city_broadcast:
        dim = F.broadcast(dim)
    joined = (members.join(f, on=BUYER_KEYS, how="left")
              .join(dim, strip_city_suffix("city") == F.col("_city_name"), "left"))

    special = {
        "is_member": F.lit(1),
        "birthday": blank_to("birthday", "0001-01-01", F.substring("birthday", 1, 10)),
        "unbind_time": blank_to("unbind_time", "0001-01-01 00:00:00"),
        "city": strip_city_suffix("city"),
        "city_level": F.col("_city_level"),
        **{k: F.col(f"latest_member_order.{v}") for k, v in _RECEIVER_FROM_ORDER.items()},
    }
    cols = _cast_early([pinned(c, special.get(c)) for c in BASE_COLUMNS], cast_early)
    return joined.select(*cols, *ORDER_FACT_COLUMNS)


def members_enriched(members: DataFrame, facts: DataFrame, city_level: DataFrame) -> DataFrame:
    """The 45-column member side."""
    return members_with_facts(members, facts, city_level).select(*BASE_COLUMNS)


def nonmembers_with_facts(facts: DataFrame, cast_early: bool = False) -> DataFrame:
    """One row per (merchant, buyer) with a non-member order: fields from the
    latest such order, fixed defaults for the rest, plus order figures."""
    src = {
        "merchant_num": F.col("merchant_num"),
        "user_id": F.col("user_id"),
        "platform_open_id": F.col("user_id"),
        **{k: F.col(f"latest_nonmember_order.{v}") for k, v in NONMEMBER_FROM_ORDER.items()
           if k not in ("merchant_num", "user_id", "platform_open_id")},
        **{k: F.lit(v) for k, v in NONMEMBER_DEFAULTS.items()},
    }
    return (facts.where(F.col("latest_nonmember_order").isNotNull())
            .select(*_cast_early([pinned(c, src[c]) for c in BASE_COLUMNS], cast_early), *ORDER_FACT_COLUMNS))


def nonmembers_default(facts: DataFrame) -> DataFrame:
    """The 45-column non-member side."""
    return nonmembers_with_facts(facts).select(*BASE_COLUMNS)


def all_users(members_side: DataFrame, nonmembers_side: DataFrame) -> DataFrame:
    """Every shop user, once."""
    return members_side.distinct().unionByName(nonmembers_side)


def non_canonical_tenant_text(df: DataFrame) -> bool:
    """True if some ``merchant_num`` text of ``df`` is not the canonical
    decimal form of its int (NULL counts as canonical). A filtered scan of one
    column that stops at the first hit; no shuffle.

    Only if two texts shared a number (say '7' and '07', or two non-numeric
    texts both NULL) could two distinct profile rows become equal in the
    labelled output: every other cast runs before the sides' ``distinct``, and
    every joined figure is keyed by the raw tenant plus an output column.
    """
    m = F.col("merchant_num")
    non_canonical = ~m.eqNullSafe(tolerant_cast(m, "int").cast("string"))
    return df.select("merchant_num").where(non_canonical).limit(1).count() > 0

