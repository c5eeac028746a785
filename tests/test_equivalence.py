"""Fused forms equal the plain forms."""

from pyspark.sql import functions as F

from buyerlens.operators import activity as act
from buyerlens.operators import orders as ords
import plain_forms as plain
from buyerlens.params import FIXTURE_PARAMS as P
from buyerlens.plans.catalog import inputs
from conftest import SF_MID
from helpers import assert_df_equal


def test_order_summary_fused_equals_joined(spark):
    o = inputs(spark, SF_MID).orders
    fused = ords.order_summary(o, P)
    assert_df_equal(fused, plain.order_summary(o, P))


def test_activity_summary_fused_equals_joined(spark):
    a = inputs(spark, SF_MID).activity
    assert_df_equal(act.activity_summary(a, P), plain.activity_summary(a, P))


def test_latest_by_aggregate_equals_window(spark):
    o = inputs(spark, SF_MID).orders
    keys = ["merchant_num", "platform_open_id"]
    for kind, latest, payload in ((1, ords.latest_member_orders, ords.MEMBER_ORDER_PAYLOAD),
                                  (0, ords.latest_nonmember_orders, ords.NONMEMBER_ORDER_PAYLOAD)):
        got = latest(o).select("merchant_num", F.col("user_id").alias("platform_open_id"), f"latest_{'non' * (1 - kind)}member_order.*")
        want = plain.newest(o.where(F.col("is_member") == kind), keys, payload)
        assert_df_equal(got.select(*want.columns), want)


def test_profile_and_cells_equal_plain_forms(spark):
    from buyerlens.operators.cells import cells
    from buyerlens.operators.profile import user_profile

    i = inputs(spark, SF_MID)
    assert_df_equal(user_profile(i, P), plain.user_profile(i, P))
    sink = user_profile(i, P, final_distinct=False, keyed=True)
    assert_df_equal(cells(sink, P.n_buckets), plain.cells(sink, P.n_buckets))


def test_pay_day_rank_equals_window_rank(spark):
    from pyspark.sql import Window

    o = inputs(spark, SF_MID).orders
    got = ords.pay_day_rank(o, P)
    w = Window.partitionBy("merchant_num", "platform_open_id").orderBy(F.col("pay_day").desc())
    want = (o.where(ords.paid_in_window(P))
            .select("merchant_num", "platform_open_id", "order_id", F.substring("pay_at", 1, 10).alias("pay_day"))
            .withColumn("rn", F.rank().over(w)))
    assert_df_equal(got, want)


def test_pay_detail_zero_iff_no_paid_order(spark):
    from buyerlens.operators.profile import joined_profile

    j = joined_profile(inputs(spark, SF_MID), P).cache()
    facts = ords.order_window_count(inputs(spark, SF_MID).orders, P)
    no_paid = j.join(facts, ["merchant_num", "user_id"], "left_anti")
    assert no_paid.where(F.col("pay_detail").isNotNull()).count() == 0
    assert j.join(facts, ["merchant_num", "user_id"], "left_semi").where(F.col("pay_detail").isNull()).count() == 0
    j.unpersist()
