"""Label truth tables against plain-Python statements of the rules."""

import itertools

from pyspark.sql import functions as F

from buyerlens.functions import labels


def _charact(is_member, new, today, hist):
    t, h = today or 0, hist or 0
    if t == 0:
        return 0
    if is_member != 1:
        return 3
    return 1 if h == 0 else 2


def _subdivision(is_member, new, today, hist):
    t, h = today or 0, hist or 0
    if is_member == 1 and t > 0 and new == 1:
        return 1
    if is_member == 1 and t > 0 and h == 0:
        return 2
    return 0


def test_buy_labels_truth_table(spark):
    combos = list(itertools.product([None, 0, 1], [None, 0, 1], [None, 0, 1, 2], [None, 0, 1]))
    df = spark.createDataFrame(combos, "is_member int, is_new_member int, today_order_num bigint, "
                                       "history_order_num_360 bigint")
    out = df.select("*", labels.buy_charact().alias("c"), labels.buy_subdivision().alias("s")).collect()
    assert len(out) == len(combos)
    for r in out:
        args = (r.is_member, r.is_new_member, r.today_order_num, r.history_order_num_360)
        assert r.c == _charact(*args), args
        assert r.s == _subdivision(*args), args


def test_is_silent_and_defaults(spark):
    combos = list(itertools.product([None, 1], [None, 0, 1, 2]))
    df = spark.createDataFrame(combos, "join_num_90 int, member_id bigint")
    for r in df.select("*", labels.is_silent().alias("v")).collect():
        want = 1 if (r.join_num_90 is not None and r.join_num_90 >= 1 and r.member_id is not None
                     and r.member_id > 1) else 0
        assert r.v == want
    d = spark.createDataFrame([(None, None, None), (3, 2, "7.50")],
                              "pay_detail int, today_order_num bigint, today_order_amount string")
    d = d.withColumn("today_order_amount", F.col("today_order_amount").cast("decimal(25,2)"))
    got = d.select(labels.pay_detail_label().alias("p"), labels.today_order_num_or_zero().alias("n"),
                   labels.today_order_amount_or_zero().alias("a")).collect()
    assert [(r.p, r.n, str(r.a)) for r in got] == [(0, 0, "0.000"), (3, 2, "7.500")]
