"""Small literal input frames with the fixture schemas, for edge cases."""

from __future__ import annotations

from buyerlens.sources.tables import Inputs

MEMBER_SCHEMA = (
    "merchant_num string, brand_code string, platform_type string, user_id string, nick string, "
    "platform_open_id string, user_name string, member_id bigint, sex int, birthday string, age int, "
    "phone string, mix_mobile string, status string, register_time string, unbind_time string, "
    "channel string, member_identity string, province string, city string, district string, address string, "
    "point string, member_grade string, is_new_member int, is_loss_member int, chinese_zodiac string, "
    "zodiac string, is_have_phone int, is_have_baby int, baby_age int, medal_list string, is_focus int, "
    "tags_list string, member_point_end_time string, member_grade_end_time string, medal_end_time string, "
    "member_ship_num int, receive_msg_num int"
)
ORDER_SCHEMA = (
    "order_id bigint, merchant_num string, brand_code string, platform_type string, platform_open_id string, "
    "nick string, is_member int, pay_at string, status int, payment decimal(15,2), updated_at string, "
    "province string, province_code string, city string, city_code string"
)
ACTIVITY_SCHEMA = "merchant_num string, member_id bigint, activity_type int, status int, created_at string"
POINTS_SCHEMA = "merchant_num string, member_id bigint, right_type int, num_change bigint"
CITY_SCHEMA = "name string, level int"

MEMBER_FIELDS = [f.split()[0] for f in MEMBER_SCHEMA.split(", ")]


def member(merchant="1", user="u1", member_id=10, **kw):
    base = dict(merchant_num=merchant, brand_code="B", platform_type="P", user_id=user, nick="n",
                platform_open_id=user, user_name="name", member_id=member_id, sex=1,
                birthday="1990-02-03 11:00:00", age=30, phone="p", mix_mobile="m", status="1",
                register_time="2023-06-01 00:00:00", unbind_time="", channel="2", member_identity="1",
                province="P1", city="C1市", district="D", address="A", point="5", member_grade="1",
                is_new_member=0, is_loss_member=0, chinese_zodiac="z", zodiac="s", is_have_phone=1,
                is_have_baby=0, baby_age=0, medal_list="", is_focus=0, tags_list="",
                member_point_end_time="t", member_grade_end_time="t", medal_end_time="t",
                member_ship_num=1, receive_msg_num=0)
    base.update(kw)
    return tuple(base[f] for f in MEMBER_FIELDS)


def order(order_id, merchant="1", user="u1", is_member=1, day="2024-01-30", status=3, payment="10.00",
          updated_at="2024-01-30 10:00:00", province="RP", city="RC"):
    from decimal import Decimal

    return (order_id, merchant, "B", "P", user, "n", is_member, f"{day} 10:00:00" if day else None, status,
            Decimal(payment) if payment is not None else None, updated_at, province, "11", city, "22")


def make_inputs(spark, members=(), orders=(), activity=(), points=(), city=()) -> Inputs:
    return Inputs(
        members=spark.createDataFrame(list(members), MEMBER_SCHEMA),
        orders=spark.createDataFrame(list(orders), ORDER_SCHEMA),
        activity=spark.createDataFrame(list(activity), ACTIVITY_SCHEMA),
        points=spark.createDataFrame(list(points), POINTS_SCHEMA),
        city_level=spark.createDataFrame(list(city), CITY_SCHEMA),
    )
