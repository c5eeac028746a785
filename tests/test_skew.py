"""AQE splits a skewed member key on the real member path (join + distinct)."""

from buyerlens.operators.members import members_with_facts
from buyerlens.operators.orders import buyer_facts
from buyerlens.params import ProfileParams
from buyerlens.session import materialize
from frames import make_inputs, member, order

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def test_hot_member_key_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
        p = ProfileParams(as_of="2024-01-30", activity_days=10)
        # A third of the members share one (merchant, user) key: user id ''.
        members = ([member(user="", member_id=i, address=f"A{i}") for i in range(20000)]
                   + [member(user=f"u{i}", member_id=100000 + i) for i in range(40000)])
        orders = [order(i, user="" if i % 3 == 0 else f"u{i}") for i in range(6000)]
        inp = make_inputs(spark, members=members, orders=orders)
        # As in the profile: the buyer facts are materialized, so both join
        # sides are plain shuffle stages, the pattern AQE's skew split needs.
        facts = materialize(buyer_facts(inp.orders, p))
        df = members_with_facts(inp.members, facts, inp.city_level)
        assert len(df.collect()) == 60000
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
