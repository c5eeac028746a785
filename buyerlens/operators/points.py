"""Points earned per (merchant, member), all time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EARN_TYPE = 1


def points_total(points: DataFrame) -> DataFrame:
    """Sum of positive changes of the earning type; keys without one are absent."""
    return (points.where((F.col("num_change") > 0) & (F.col("right_type") == EARN_TYPE))
            .groupBy("merchant_num", "member_id")
            .agg(F.sum(F.coalesce(F.col("num_change"), F.lit(0))).alias("total_point")))
