"""T3, A7, A8 from day to day: the activity window as a sum of daily partials.

The log is only added to, so a day's counts per (merchant, member) are made
once, from that day's rows, and kept as one partition of a state table. A run
makes the days of its window that the state lacks (from one day to the next
that is one day; the last ``late_days`` are made again, for rows that come
late), and the window's figures are sums over its partitions: what leaves the
window is just not read. The result is that of the whole window counted anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.functions.scalars import day_of
from buyerlens.operators.activity import MEMBER_KEYS
from buyerlens.params import ProfileParams

STATE = "merchant_num string, member_id bigint, n bigint, n_ok bigint, made boolean, day string"


def window_days(params: ProfileParams) -> list[str]:
    """The days of the activity window, first to last."""
    first = dt.date.fromisoformat(params.activity_start)
    return [(first + dt.timedelta(days=i)).isoformat() for i in range(params.activity_days)]


def state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state table, or None where there is none yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def made_days(spark: SparkSession, path: str, params: ProfileParams) -> set[str]:
    """Days of the window that the state holds (a day without log rows too)."""
    have = state(spark, path)
    if have is None:
        return set()
    return {r["day"] for r in have.where(F.col("day").isin(window_days(params)) & F.col("made")).select("day").distinct().collect()}


def daily_counts(activity: DataFrame, days: list[str]) -> DataFrame:
    """Per (day, merchant, member): participations and successful ones, of ``days`` alone."""
    day = day_of("created_at")
    return (activity.where(day.isin(days)).groupBy(*MEMBER_KEYS, day.alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == 1).alias("n_ok")))


def advance(activity: DataFrame, path: str, params: ProfileParams, late_days: int = 1) -> list[str]:
    """Bring the state at ``path`` to ``params.as_of``; the days that were made.

    A day's partition is replaced as a whole, so a run that dies is simply run
    again. A marker row tells a day without log rows from one not made yet.
    """
    spark = activity.sparkSession
    days = window_days(params)
    have = made_days(spark, path, params)
    todo = [d for i, d in enumerate(days) if d not in have or i >= len(days) - late_days]
    if todo:
        marks = spark.createDataFrame([(d,) for d in todo], "day string").select(
            F.lit(None).cast("string").alias("merchant_num"), F.lit(None).cast("bigint").alias("member_id"),
            F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_ok"), F.lit(True).alias("made"), "day")
        rows = daily_counts(activity, todo).withColumn("made", F.lit(False)).select(*marks.columns)
        # One file or a few a day: rows of a day meet by day and a part of the key.
        dealt = rows.unionByName(marks).repartition("day", F.pmod(F.xxhash64(*MEMBER_KEYS), F.lit(8)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return todo


def recent_interaction(spark: SparkSession, path: str, params: ProfileParams) -> DataFrame:
    """A7 + A8 out of the state: keys active in the window, a flag of 1 and the count of successful participations."""
    days = window_days(params)
    missing = set(days) - made_days(spark, path, params)
    if missing:
        raise ValueError(f"the state lacks {sorted(missing)}: advance it to {params.as_of} first")
    return (state(spark, path).where(F.col("day").isin(days) & ~F.col("made")).groupBy(*MEMBER_KEYS)
            .agg(F.lit(1).alias("join_num_90"), F.sum("n_ok").alias("interactive_num")))
