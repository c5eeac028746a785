"""Column lists, pinned types, non-member defaults and the family map.

Every profile side is projected onto ``BASE_COLUMNS`` with the types in
``BASE_TYPES`` before the union, so the union never coerces (a string column
meeting an int literal would otherwise widen to bigint and fail on text).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 45 base columns of a profile row, in the order both sides are unioned.
BASE_TYPES: dict[str, str] = {
    "merchant_num": "string",
    "brand_code": "string",
    "platform_type": "string",
    "user_id": "string",
    "nick": "string",
    "platform_open_id": "string",
    "user_name": "string",
    "is_member": "int",
    "member_id": "bigint",
    "sex": "int",
    "birthday": "string",
    "age": "int",
    "phone": "string",
    "mix_mobile": "string",
    "status": "string",
    "register_time": "string",
    "unbind_time": "string",
    "channel": "string",
    "member_identity": "string",
    "province": "string",
    "city": "string",
    "city_level": "int",
    "district": "string",
    "address": "string",
    "point": "string",
    "member_grade": "string",
    "is_new_member": "int",
    "is_loss_member": "int",
    "receive_province": "string",
    "receive_province_code": "string",
    "receive_city": "string",
    "receive_city_code": "string",
    "chinese_zodiac": "string",
    "zodiac": "string",
    "is_have_phone": "int",
    "is_have_baby": "int",
    "baby_age": "int",
    "medal_list": "string",
    "is_focus": "int",
    "tags_list": "string",
    "member_point_end_time": "string",
    "member_grade_end_time": "string",
    "medal_end_time": "string",
    "member_ship_num": "int",
    "receive_msg_num": "int",
}
BASE_COLUMNS: list[str] = list(BASE_TYPES)

# Columns a non-member row takes from its latest order (target <- order column).
NONMEMBER_FROM_ORDER: dict[str, str] = {
    "merchant_num": "merchant_num",
    "brand_code": "brand_code",
    "platform_type": "platform_type",
    "user_id": "platform_open_id",
    "nick": "nick",
    "platform_open_id": "platform_open_id",
    "is_member": "is_member",
    "receive_province": "province",
    "receive_province_code": "province_code",
    "receive_city": "city",
    "receive_city_code": "city_code",
}

# What a non-member row holds for fields an order cannot know.
NONMEMBER_DEFAULTS: dict[str, object] = {
    "user_name": "",
    "member_id": 0,
    "sex": 0,
    "birthday": "0001-01-01",
    "age": 0,
    "phone": "",
    "mix_mobile": "",
    "status": "1",
    "register_time": "0001-01-01 00:00:00",
    "unbind_time": "0001-01-01 00:00:00",
    "channel": "6",
    "member_identity": "0",
    "province": "",
    "city": "",
    "city_level": -1,
    "district": "",
    "address": "",
    "point": "0",
    "member_grade": "0",
    "is_new_member": 0,
    "is_loss_member": 0,
    "chinese_zodiac": "未知",
    "zodiac": "未知",
    "is_have_phone": 0,
    "is_have_baby": 0,
    "baby_age": 0,
    "medal_list": "",
    "is_focus": 0,
    "tags_list": "",
    "member_point_end_time": "0001-01-01 00:00:00",
    "member_grade_end_time": "0001-01-01 00:00:00",
    "medal_end_time": "0001-01-01 00:00:00",
    "member_ship_num": 0,
    "receive_msg_num": 0,
}

# Member columns replaced by the latest member order (receiver address).
RECEIVER_COLUMNS: list[str] = [
    "receive_province",
    "receive_province_code",
    "receive_city",
    "receive_city_code",
]

# Order aggregates carried per buyer, and activity / points aggregates carried
# per (merchant_num, member_id).
ORDER_FACT_COLUMNS: list[str] = [
    "history_order_num_360",
    "today_order_num",
    "today_order_amount",
    "pay_detail",
]
ACTIVITY_COLUMNS: list[str] = [
    "join_num_90",
    "exchange_time_list",
    "exchange_num",
    "interactive_num",
    "interactive_time_list",
]
POINTS_COLUMNS: list[str] = ["total_point"]

# The 56 columns of the labelled profile, in output order.
PROFILE_COLUMNS: list[str] = [
    "merchant_num", "brand_code", "platform_type", "user_id", "nick",
    "platform_open_id", "user_name", "is_member", "member_id", "sex",
    "birthday", "age", "phone", "mix_mobile", "status", "register_time",
    "unbind_time", "channel", "member_identity", "province", "city",
    "city_level", "district", "address", "point", "total_point",
    "member_grade", "is_new_member", "is_loss_member", "receive_province",
    "receive_province_code", "receive_city", "receive_city_code",
    "today_order_num", "today_order_amount", "buy_charact", "buy_subdivision",
    "is_silent", "pay_detail", "exchange_time_list", "exchange_num",
    "interactive_num", "interactive_time_list", "chinese_zodiac", "zodiac",
    "is_have_phone", "is_have_baby", "baby_age", "medal_list", "is_focus",
    "tags_list", "member_point_end_time", "member_grade_end_time",
    "medal_end_time", "member_ship_num", "receive_msg_num",
]

DERIVED_COLUMNS: list[str] = [c for c in PROFILE_COLUMNS if c not in BASE_TYPES]

# Column-family routing of the cell sink. The reference's family lists are not
# published; the split used here is base attributes -> "base", derived
# aggregates and labels -> "model". Callers may pass their own map.
BASE_FAMILY = "base"
MODEL_FAMILY = "model"
DEFAULT_FAMILIES: dict[str, str] = {
    **{c: BASE_FAMILY for c in BASE_COLUMNS},
    **{c: MODEL_FAMILY for c in DERIVED_COLUMNS},
}

assert len(BASE_COLUMNS) == 45
assert len(PROFILE_COLUMNS) == 56 and len(set(PROFILE_COLUMNS)) == 56
assert len(DERIVED_COLUMNS) == 11
assert set(NONMEMBER_DEFAULTS) | set(NONMEMBER_FROM_ORDER) == set(BASE_COLUMNS)


def pinned(name: str, value: Column | object | None = None) -> Column:
    """``value`` (default: the column ``name``) in the pinned base type; NULL where it does not parse."""
    col = F.col(name) if value is None else (value if isinstance(value, Column) else F.lit(value))
    return col.try_cast(BASE_TYPES[name]).alias(name)
