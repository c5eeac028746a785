"""Branches the given tables cannot reach, on literal frames."""

import pytest
from pyspark.sql import functions as F

from buyerlens.operators.activity import activity_summary
from buyerlens.operators.orders import buyer_facts
from buyerlens.operators.profile import joined_profile, user_profile
from buyerlens.params import ProfileParams
from frames import MEMBER_SCHEMA, ORDER_SCHEMA, make_inputs, member, order

P = ProfileParams(as_of="2024-01-30", order_days=360, activity_days=10)


def _one(df, **where):
    cond = None
    for k, v in where.items():
        c = F.col(k).isNull() if v is None else (F.col(k) == v)
        cond = c if cond is None else cond & c
    rows = df.where(cond).collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_activity_null_guards(spark):
    rows = [
        ("1", 1, 2, 1, None),                   # exchange, NULL time
        ("1", 1, 2, 0, None),
        ("1", 2, 1, 0, "2024-01-25 08:00:00"),  # in window, not ok -> count 0
        ("1", 3, 2, 0, "2023-12-01 08:00:00"),  # exchange, none ok -> 0; nothing in window
        ("1", None, 2, 1, "2024-01-25 08:00:00"),  # NULL member: every figure NULL
        ("1", 4, 1, 1, "2024-01-25 08:00:00"),
        ("1", 4, 1, 1, "2024-01-25 08:00:00"),  # duplicate second listed once
    ]
    inp = make_inputs(spark, activity=rows)
    s = activity_summary(inp.activity, P)
    r1 = _one(s, member_id=1)
    assert (r1.exchange_time_list, r1.exchange_num, r1.join_num_90, r1.interactive_num,
            r1.interactive_time_list) == ("", 1, None, None, "")
    r2 = _one(s, member_id=2)
    assert (r2.exchange_time_list, r2.exchange_num, r2.join_num_90, r2.interactive_num) == (None, None, 1, 0)
    r3 = _one(s, member_id=3)
    assert (r3.exchange_num, r3.join_num_90, r3.interactive_time_list) == (0, None, "2023-12-01 08:00:00")
    rn = _one(s, member_id=None)
    assert (rn.exchange_time_list, rn.exchange_num, rn.join_num_90, rn.interactive_num,
            rn.interactive_time_list) == (None, None, None, None, None)
    r4 = _one(s, member_id=4)
    assert (r4.interactive_num, r4.interactive_time_list) == (2, "2024-01-25 08:00:00")


def test_latest_order_ties_and_nulls(spark):
    orders = [
        order(1, updated_at="2024-01-01 00:00:00", city="old"),
        order(3, updated_at="2024-01-02 00:00:00", city="tie-low"),
        order(5, updated_at="2024-01-02 00:00:00", city="tie-high"),   # same time, larger order_id wins
        order(9, updated_at=None, city="null-time"),                   # NULL time loses
    ]
    f = buyer_facts(make_inputs(spark, orders=orders).orders, P)
    assert _one(f, user_id="u1").latest_member_order.city == "tie-high"


def test_order_figures(spark):
    orders = [
        order(1, day="2024-01-30", payment="10.00"),
        order(2, day="2024-01-30", payment="5.50"),
        order(3, day="2023-03-01"),
        order(4, day="2023-01-01"),                   # outside the 360 days
        order(5, day="2024-01-30", status=1),         # unpaid
        order(6, user="u2", day="2023-06-01"),        # bought, not today
        order(7, user="u3", day="2024-01-30", payment="1.00"),
        order(8, user="u3", day="2024-01-30", payment="2.00"),
    ]
    f = buyer_facts(make_inputs(spark, orders=orders).orders, P)
    u1 = _one(f, user_id="u1")
    assert (u1.order_num_360, u1.today_order_num, u1.history_order_num_360, str(u1.today_order_amount),
            u1.pay_detail) == (3, 2, 1, "15.50", 2)
    u2 = _one(f, user_id="u2")
    assert (u2.order_num_360, u2.today_order_num, u2.history_order_num_360, u2.pay_detail) == (1, None, None, 1)
    u3 = _one(f, user_id="u3")
    assert (u3.history_order_num_360, u3.pay_detail) == (0, 1)


def test_null_buyer_key_nonmember(spark):
    orders = [order(1, user=None, is_member=0, city="x")]
    prof = joined_profile(make_inputs(spark, orders=orders), P, materialize=False)
    r = _one(prof, user_id=None)
    assert (r.is_member, r.receive_city, r.today_order_num, r.pay_detail) == (0, "x", None, None)


def test_member_columns_and_city(spark):
    members = [
        member(user="a", birthday="", unbind_time="", city="市中心市", member_identity=""),
        member(user="b", birthday=None, unbind_time="2024-01-01 00:00:00", city="C2", status="x"),
        member(user="c", city="C3"),
    ]
    city = [("中心", 3), ("C2", 2), ("C2", 2), ("C3", 1), ("C3", 4)]
    prof = user_profile(make_inputs(spark, members=members, city=city), P, materialize=False)
    a = _one(prof, user_id="a")
    assert (a.birthday, a.unbind_time, a.city, a.city_level, a.member_identity) == (
        "0001-01-01", "0001-01-01 00:00:00", "中心", 3, None)
    b = _one(prof, user_id="b")  # duplicate dimension rows collapse in the distinct
    assert (b.birthday, b.unbind_time, b.status) == (None, "2024-01-01 00:00:00", None)
    assert sorted(r.city_level for r in prof.where("user_id = 'c'").collect()) == [1, 4]


def test_decimal_overflow_gives_null(spark):
    orders = [order(1, payment="9999999999999.00"), order(2, payment="9999999999999.00")]
    members = [member()]
    prof = user_profile(make_inputs(spark, members=members, orders=orders), P, materialize=False)
    r = _one(prof, user_id="u1")
    assert r.today_order_amount is None and r.today_order_num == 2


def test_nonmember_zero_key_gets_zero_member_figures(spark):
    orders = [order(1, user="x", is_member=0), order(2, user="y", is_member=0), order(3, user="m", merchant="2")]
    activity = [("1", 0, 1, 1, "2024-01-29 00:00:00"), ("1", 10, 1, 1, "2024-01-28 00:00:00")]
    points = [("1", 0, 1, 7), ("1", 0, 1, -3)]
    prof = joined_profile(make_inputs(spark, members=[member(user="m0")], orders=orders,
                                      activity=activity, points=points), P, materialize=False)
    for u in ("x", "y"):
        r = _one(prof, user_id=u)
        assert (r.member_id, r.interactive_num, r.total_point, r.join_num_90) == (0, 1, 7, 1)
    m0 = _one(prof, user_id="m0")
    assert (m0.member_id, m0.interactive_num, m0.total_point) == (10, 1, None)


def test_hot_key_strategies_agree(spark):
    orders = [order(i, user=f"u{i}", is_member=0) for i in range(40)]
    activity = [("1", 0, 2, 1, "2024-01-29 00:00:00")]
    inp = make_inputs(spark, orders=orders, activity=activity)

    def run(**kw):
        return joined_profile(inp, ProfileParams(as_of="2024-01-30", activity_days=10, **kw), False)

    a = run()                                                # broadcast (small)
    b = run(salt_buckets=1, hot_broadcast_max_bytes=0)       # salted, one bucket
    c = run(salt_buckets=7, hot_broadcast_max_rows=0)        # salted, seven buckets
    for x in (b, c):
        assert a.exceptAll(x).count() == 0 and x.exceptAll(a).count() == 0
    assert a.where("exchange_num = 1").count() == 40
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()


def test_fits_broadcast_bounds(spark):
    from buyerlens.operators.joins import fits_broadcast

    df = spark.createDataFrame([("x" * 100, 1)] * 10, "s string, n int")
    assert fits_broadcast(df, 10, 10_000)
    assert not fits_broadcast(df, 9, 10_000)
    assert not fits_broadcast(df, 10, 500)


def test_bad_params():
    with pytest.raises(ValueError):
        ProfileParams(as_of="2024-02-30")
    with pytest.raises(ValueError):
        ProfileParams(order_days=0)


def test_rows_equal_after_casts_are_merged(spark):
    from buyerlens.operators.members import non_canonical_tenant_text

    # Differ only in texts that both cast to NULL: merged by the member-side distinct.
    members = [member(user="u", status="x"), member(user="u", status="y")]
    inp = make_inputs(spark, members=members)
    prof = user_profile(inp, P, materialize=False)
    assert prof.where("user_id = 'u'").count() == 1
    assert not non_canonical_tenant_text(inp.members)


def test_tenant_spellings_trigger_final_distinct(spark):
    from buyerlens.operators.members import non_canonical_tenant_text

    members = [member(merchant="7", user="u"), member(merchant="07", user="u")]
    inp = make_inputs(spark, members=members)
    assert non_canonical_tenant_text(inp.members)
    prof = user_profile(inp, P, materialize=False)
    rows = prof.where("user_id = 'u'").collect()
    assert len(rows) == 1 and rows[0].merchant_num == 7
    assert user_profile(inp, P, final_distinct=False, materialize=False).where("user_id = 'u'").count() == 2


def test_text_inputs_with_junk_are_null(spark):
    from buyerlens.sources.tables import scan_activity, scan_members, scan_orders, scan_points

    o = spark.createDataFrame([("1", "2024-01-30", s) for s in ("3", "", "paid", None)], "merchant_num string, day_id string, status string")
    o = o.selectExpr("*", "'B' brand_code", "'P' platform_type", "'u' platform_open_id", "'n' nick", "'1' is_member", "'2024-01-30 10:00:00' pay_at",
                     "'x' payment", "'2024-01-30' updated_at", "'p' province", "'1' province_code", "'c' city", "'2' city_code")
    got = scan_orders(o, P)
    assert sorted(r.status or 0 for r in got.collect()) == [0, 0, 0, 3]
    assert [r.payment for r in got.collect()] == [None] * 4 and dict(got.dtypes)["order_id"] == "bigint"
    assert buyer_facts(got, P).first().order_num_360 == 1
    a = spark.createDataFrame([("1", "7", "2", "1", "2024-01-29 00:00:00"), ("1", "", "x", "", "t")],
                              "merchant_num string, member_id string, activity_type string, status string, created_at string")
    assert {(r.member_id, r.activity_type, r.status) for r in scan_activity(a, P).collect()} == {(7, 2, 1), (None, None, None)}
    p = spark.createDataFrame([("1", "7", "1", "5"), ("1", "7", "1", "n/a")], "merchant_num string, member_id string, right_type string, num_change string")
    from buyerlens.operators.points import points_total

    assert points_total(scan_points(p, P)).first().total_point == 5
    m = spark.createDataFrame([member()], MEMBER_SCHEMA).drop("sex").selectExpr("*", "'' sex", "'2024-01-30' day_id")
    assert scan_members(m, P).first().sex is None


def test_members_enriched_keeps_repeated_rows(spark):
    from buyerlens.operators.members import all_users, members_enriched, nonmembers_default

    inp = make_inputs(spark, members=[member(user="u"), member(user="u")])
    facts = buyer_facts(inp.orders, P)
    side = members_enriched(inp.members, facts, inp.city_level)
    assert side.count() == 2 and all_users(side, nonmembers_default(facts)).count() == 1


def test_nonmembers_without_figures(spark):
    inp = make_inputs(spark, orders=[order(1, user="a", is_member=0)], activity=[("1", 0, 2, 1, "2024-01-29 00:00:00")])
    on = joined_profile(inp, P, False).first()
    off = joined_profile(inp, ProfileParams(as_of="2024-01-30", nonmember_figures=False), False).first()
    assert on.exchange_num == 1 and off.exchange_num is None and off.user_id == "a"


def test_filters_reach_the_scan_of_single_queries(spark):
    import tempfile

    from buyerlens.operators.orders import latest_member_orders, order_summary

    path = tempfile.mkdtemp(prefix="orders-") + "/o"
    spark.createDataFrame([order(1)], ORDER_SCHEMA).write.parquet(path)
    o = spark.read.parquet(path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "In(status" in plan(order_summary(o, P)) and "EqualTo(is_member,1)" in plan(latest_member_orders(o))
    assert "SortAggregate" not in plan(order_summary(o, P))


def test_lists_of_hot_keys_equal_those_of_one_task(spark):
    """A key with half the log, NULL keys and odd times among the rows: by day or in one go, the same lists."""
    from dataclasses import replace

    from buyerlens.operators.activity import exchange_stats, hot_keys, interaction_list

    rows = [("1", 1, 1 + i % 3, i % 2, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00") for i in range(600)]
    rows += [("1", 10 + i % 40, 1 + i % 3, i % 2, f"2024-01-{1 + i % 28:02d} 08:00:00") for i in range(500)]
    rows += [(None, 5, 2, 1, "2024-01-05 00:00:00")] * 30 + [("2", None, 2, 1, f"2024-01-05 00:00:{i:02d}") for i in range(40)]
    rows += [("3", 7, 2, 1, t) for t in (None, "", "2024", "2024-01-05", "2024-01-05 08", "not a time at all", "2024-01-05 08:00:00.123")] * 9
    rows += [("3", 8, 1, None, None)] * 60 + [("3", 9, None, 1, "2024-01-06 00:00:00")] * 60
    log = make_inputs(spark, activity=rows).activity.repartition(4)
    few, many = replace(P, list_rows=20), P
    assert hot_keys(log, 20).count() == 6
    for whole, by_day in ((activity_summary(log, many), activity_summary(log, few)),
                          (exchange_stats(log, many), exchange_stats(log, few)),
                          (interaction_list(log, many), interaction_list(log, few))):
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, by_day.collect()))
    # Too many hot keys for a broadcast: every key goes by day.
    none = replace(P, list_rows=20, hot_broadcast_max_rows=0)
    assert sorted(map(repr, activity_summary(log, none).collect())) == sorted(map(repr, activity_summary(log, many).collect()))


def test_a_hot_keys_seconds_spread_over_tasks(spark):
    """With half the log in one key, its (key, day) rows stand in several partitions before they meet."""
    from buyerlens.operators import activity as act

    rows = [("1", 1, 2, 1, f"2024-01-{1 + i % 28:02d} 00:{i // 60 % 60:02d}:{i % 60:02d}") for i in range(4000)]
    rows += [("1", 2 + i, 2, 1, "2024-01-01 00:00:00") for i in range(4000)]
    log = make_inputs(spark, activity=rows).activity
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = act._by_day(log, {}, F.col("created_at"), F.lit(None).cast("string"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(merchant_num") == 3 and "_day" in plan
        days = log.groupBy("merchant_num", "member_id", F.substring("created_at", 1, 10).alias("d")).count()
        assert days.where("member_id = 1").select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_pay_days_that_are_no_dates(spark):
    def of(user, *days):
        return [order(100 + i, user=user, day=d) for i, d in enumerate(days)]

    orders = (of("a", "2023-05-xx", "2023-05-xx") + of("b", "2023-05-xx", "2023-05-yy") + of("c", "2023-05-xx", "2023-05-06")
              + of("d", "2023-05-06", "2023-05-06") + of("e", "2023-05-06", "2023-05-07") + of("f", "2023-05-6 ", "2023-05-06"))
    f = buyer_facts(make_inputs(spark, orders=orders).orders, P)
    assert {r.user_id: r.pay_detail for r in f.collect()} == {"a": 1, "b": 2, "c": 2, "d": 1, "e": 2, "f": 2}
