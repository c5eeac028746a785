"""Properties of the fixture data and of the outputs over it."""

from pyspark.sql import functions as F

from buyerlens.operators.profile import user_profile
from buyerlens.params import FIXTURE_PARAMS as P
from buyerlens.plans.catalog import QUERIES, inputs
from conftest import SF_MID, SF_SMALL


def test_city_names_unique(spark):
    dim = inputs(spark, SF_SMALL).city_level
    assert dim.groupBy("name").count().where("count > 1").count() == 0


def test_one_profile_row_per_user_and_side(spark):
    prof = QUERIES["user_profile"](spark, SF_SMALL)
    dup = prof.groupBy("merchant_num", "user_id", "is_member").count().where("count > 1")
    assert dup.count() == 0


def test_no_coordinate_is_lost(spark):
    """Every (rowkey, column) that some row of the profile fills is a cell, and no other; mixed buyers included."""
    prof = user_profile(inputs(spark, SF_MID), P, final_distinct=False, keyed=True).cache()
    cols = [c for c in prof.columns if c != "rowkey"]
    want = prof.groupBy("rowkey").agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in cols], F.count_distinct("is_member").alias("_sides"))
    n = sum(F.col(c).cast("int") for c in cols).alias("want")
    got = QUERIES["cells"](spark, SF_MID).groupBy("rowkey").agg(F.count(F.lit(1)).alias("got"))
    both = want.select("rowkey", n, "_sides").join(got, "rowkey", "full")
    assert both.where("not (want <=> got)").count() == 0 and both.where("_sides = 2").count() > 50
    prof.unpersist()
