"""Randomised equivalence: fused forms vs the plain forms
on small generated inputs with NULL keys, NULL times and ties."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from buyerlens.operators import activity as act
from buyerlens.operators import orders as ords
import plain_forms as plain
from buyerlens.params import ProfileParams
from frames import ACTIVITY_SCHEMA, ORDER_SCHEMA
from helpers import assert_df_equal

P = ProfileParams(as_of="2024-01-30", order_days=30, activity_days=5)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

merchant = st.sampled_from(["1", "2", None])
user = st.sampled_from(["a", "b", "c", None])
day = st.sampled_from(["2024-01-30", "2024-01-29", "2024-01-02", "2023-12-01", None])
second = st.sampled_from(["2024-01-30 10:00:00", "2024-01-28 09:00:00", "2024-01-02 08:00:00", None])

order_row = st.tuples(
    st.integers(1, 6), merchant, user, st.sampled_from([0, 1, None]), day,
    st.sampled_from([1, 3, 101, None]), st.sampled_from(["1.00", "2.50", None]), second,
    st.sampled_from(["p1", "p2", None]),
)
activity_row = st.tuples(
    merchant, st.sampled_from([0, 1, 2, None]), st.sampled_from([1, 2, 3, None]),
    st.sampled_from([0, 1, None]), second,
)


def _orders(spark, rows):
    data = [(oid, m, "B", "P", u, "n", im, f"{d} 10:00:00" if d else None, stt,
             Decimal(pay) if pay else None, upd, prov, "11", "c", "22")
            for oid, m, u, im, d, stt, pay, upd, prov in rows]
    return spark.createDataFrame(data, ORDER_SCHEMA)


@SETTINGS
@given(st.lists(order_row, min_size=1, max_size=25))
def test_order_summary_fused_equals_joined(spark, rows):
    o = _orders(spark, rows)
    assert_df_equal(ords.order_summary(o, P), plain.order_summary(o, P))


@SETTINGS
@given(st.lists(order_row, min_size=1, max_size=25))
def test_latest_by_equals_window(spark, rows):
    o = _orders(spark, rows)
    got = ords.latest_member_orders(o).select("merchant_num", F.col("user_id").alias("platform_open_id"), "latest_member_order.*")
    want = plain.newest(o.where("is_member = 1"), ["merchant_num", "platform_open_id"], ords.MEMBER_ORDER_PAYLOAD)
    assert_df_equal(got.select(*want.columns), want)


@SETTINGS
@given(st.lists(activity_row, min_size=1, max_size=25))
def test_activity_summary_fused_equals_joined(spark, rows):
    a = spark.createDataFrame(rows, ACTIVITY_SCHEMA)
    assert_df_equal(act.activity_summary(a, P), plain.activity_summary(a, P))


@SETTINGS
@given(st.lists(order_row, min_size=1, max_size=25))
def test_pay_day_rank_equals_window(spark, rows):
    from pyspark.sql import Window

    o = _orders(spark, rows)
    w = Window.partitionBy("merchant_num", "platform_open_id").orderBy(F.col("pay_day").desc())
    want = (o.where(ords.paid_in_window(P))
            .select("merchant_num", "platform_open_id", "order_id", F.substring("pay_at", 1, 10).alias("pay_day"))
            .withColumn("rn", F.rank().over(w)))
    assert_df_equal(ords.pay_day_rank(o, P), want)
