"""Plan shape: fused aggregates shuffle once, no Python in any plan."""

import re
import tempfile
from dataclasses import replace

from pyspark.sql import functions as F

from buyerlens.operators.activity import activity_summary
from buyerlens.operators.cells import cells
from buyerlens.operators.orders import buyer_facts, pay_day_rank
from buyerlens.operators.profile import LIST_COLUMNS, joined_profile, sink_profile, user_profile
from buyerlens.params import FIXTURE_PARAMS as P
from buyerlens.plans.catalog import QUERIES, inputs
from buyerlens.sources.fixtures import fixture_inputs
from buyerlens.sources.tables import scan_members, store_members
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", _plan(df)))


def test_fused_activity_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        a = activity_summary(inputs(spark, SF_SMALL).activity, P)
        assert _exchanges(a) == 1 and "SinglePartition" not in _plan(a)
        # With hot keys: per second, per day, per key beside it; no sort of a key's seconds in one task.
        hot = activity_summary(inputs(spark, SF_SMALL).activity, replace(P, list_rows=3))
        assert _exchanges(hot) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fused_orders_one_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Buyer facts over an already-scanned order table: exactly one exchange.
        path = tempfile.mkdtemp(prefix="orders-") + "/o"
        inputs(spark, SF_SMALL).orders.write.parquet(path)
        assert _exchanges(buyer_facts(spark.read.parquet(path), P)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_cells_one_exchange_no_sampling(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = tempfile.mkdtemp(prefix="profile-") + "/p"
        user_profile(inputs(spark, SF_SMALL), P, final_distinct=False, keyed=True).write.parquet(path)
        plan = _plan(cells(spark.read.parquet(path), P.n_buckets))
        # By the computed range's own number; one sort, of whole rows below the unpivot.
        assert re.findall(r"Exchange (\w+)", plan) == ["shufflepartitionidpassthrough"]
        assert len(re.findall(r"\bSort \[", plan)) == 1 and plan.index("Expand") < plan.index("Sort [")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_tenant_lists_stay_out_of_the_sinks_rows(spark):
    """Above the aggregates the non-members' lists are NULL literals until the cells are rendered."""
    i = inputs(spark, SF_SMALL)
    profile, lists = sink_profile(i, P)
    assert lists.where("interactive_time_list is not null").count() >= 0 and lists.columns == ["_tenant", *LIST_COLUMNS]
    others = profile.where("is_member = 0")
    assert others.where(" or ".join(f"{c} is not null" for c in LIST_COLUMNS)).count() == 0 and others.count() > 0


def test_profile_reads_each_aggregate_input_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(joined_profile(inputs(spark, SF_SMALL), P))
        # After materialization the profile reads the written aggregates, not the raw orders/events.
        assert "orders.parquet" not in plan and "events.parquet" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_in_plans(spark):
    for name in ("user_profile", "cells", "pay_day_rank", "activity_summary"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_pay_day_rank_reads_and_moves_the_orders_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = tempfile.mkdtemp(prefix="orders-") + "/o"
        inputs(spark, SF_SMALL).orders.write.parquet(path)
        plan = _plan(pay_day_rank(spark.read.parquet(path), P))
        assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
        # A buyer's orders are dealt by day too, so no task holds all of a hot buyer's.
        assert re.search(r"Exchange hashpartitioning\(_buyer#\d+, pay_day", plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshots_stored_by_day_and_tenant_are_pruned(spark):
    path = tempfile.mkdtemp(prefix="members-") + "/m"
    raw = fixture_inputs(spark, SF_SMALL)["member_base_info_day"]
    raw.write.partitionBy("day_id", "merchant_num").parquet(path)
    one = scan_members(spark.read.parquet(path), replace(P, tenants=("1", "3")))
    plan = _plan(one)
    (filters,) = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S)
    assert "day_id" in filters and "merchant_num" in filters and " IN " in filters
    folders = {f.split("/m/")[1].rsplit("/", 1)[0] for f in one.select("user_id").inputFiles()}
    assert folders and all(f.startswith("day_id=") for f in folders)
    rows = raw.where((F.col("day_id") == P.as_of) & F.col("merchant_num").isin("1", "3"))
    assert one.count() == rows.count() > 0
    read = spark.read.parquet(path).where((F.col("day_id") == P.as_of) & F.col("merchant_num").isin("1", "3"))
    assert {r.f.split("/m/")[1].rsplit("/", 1)[0] for r in read.select(F.col("_metadata.file_path").alias("f")).distinct().collect()} == {
        f"day_id={P.as_of}/merchant_num={t}" for t in ("1", "3")}


def test_members_of_one_file_are_stored_by_several_tasks(spark):
    """A day's rows of one tenant, all in one input partition, do not meet in one sort; none is lost, repeats stay."""
    path = tempfile.mkdtemp(prefix="members-") + "/m"
    raw = spark.range(4000).selectExpr("cast(id % 1999 as string) user_id", "id % 1999 member_id", "'7' merchant_num", "'d' day_id").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store_members(raw, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.select(F.col("_metadata.file_path").alias("f")).distinct().count() > 1
    assert sorted(r.member_id for r in back.collect()) == sorted(i % 1999 for i in range(4000))
