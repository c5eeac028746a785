"""Fixture views: the job's five input tables derived from the given tables.

Each view is one SQL text that runs unchanged in Spark and in DuckDB. In Spark
the ``{customer}``-style placeholders are bound to DataFrames read from the
parquet files (no global temp views); for DuckDB they become the plain table
names. All rows of the given tables are kept: branches are exercised by
derived columns, never by dropping rows; some members come twice. Code columns
are text with blanks and junk in between, as a log may hold them.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

# Given tables read once per session: a read lists the files and infers the
# schema from the parquet footers (a small job each time); the plan it yields
# is immutable and safe to share between queries.
_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The given table ``table`` under ``sf_dir``, read once per session."""
    per_session = _READS.setdefault(spark, {})
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]

MEMBER_SQL = """
select cast(c_custkey % 7 as string) merchant_num, 'B' || cast(c_custkey % 3 as string) brand_code,
  'P' || cast(c_custkey % 2 as string) platform_type, cast(c_custkey as string) user_id, c_name nick,
  cast(c_custkey as string) platform_open_id, c_name user_name, c_custkey member_id, case when c_custkey % 17 = 0 then '' else cast(c_custkey % 3 as string) end sex,
  case when c_custkey % 5 = 0 then '' when c_custkey % 5 = 1 then cast(null as string) else '1990-02-03 11:00:00' end birthday,
  cast(20 + c_custkey % 50 as int) age, 'T' || cast(c_custkey as string) phone, 'M' || cast(c_custkey as string) mix_mobile,
  '1' status, '2023-06-01 00:00:00' register_time,
  case when c_custkey % 4 = 0 then '' else '2024-01-02 03:04:05' end unbind_time,
  cast(c_custkey % 6 as string) channel,
  case when c_custkey % 11 = 0 then '' else cast(c_custkey % 3 as string) end member_identity,
  n_name province, n_name || '市' city, 'D' || cast(n_nationkey as string) district, 'A' || cast(c_custkey as string) address,
  cast(c_custkey % 1000 as string) point, cast(c_custkey % 5 as string) member_grade,
  case when c_custkey % 3 = 0 then 1 else 0 end is_new_member, case when c_custkey % 13 = 0 then 1 else 0 end is_loss_member,
  'Z' || cast(c_custkey % 12 as string) chinese_zodiac, 'S' || cast(c_custkey % 12 as string) zodiac, 1 is_have_phone,
  cast(c_custkey % 2 as int) is_have_baby, cast(c_custkey % 9 as int) baby_age, 'm1,m2' medal_list,
  cast(c_custkey % 2 as int) is_focus, 't' || cast(c_custkey % 4 as string) tags_list,
  '2025-01-01 00:00:00' member_point_end_time, '2025-01-01 00:00:00' member_grade_end_time,
  '2025-01-01 00:00:00' medal_end_time, 1 member_ship_num, cast(c_custkey % 8 as int) receive_msg_num,
  case when c_custkey % 50 = 49 or c_mktsegment = 'MACHINERY' then '2024-01-29' else '2024-01-30' end day_id
from (select * from {customer} union all select * from {customer} where c_custkey % 40 = 7) c
join {nation} on c_nationkey = n_nationkey
"""

ORDER_SQL = """
select o_orderkey order_id, cast(o_custkey % 7 as string) merchant_num, 'B' || cast(o_custkey % 3 as string) brand_code,
  'P' || cast(o_custkey % 2 as string) platform_type, cast(o_custkey as string) platform_open_id, c_name nick,
  case when c_mktsegment <> 'MACHINERY' and o_orderkey % 97 <> 0 then 1 else 0 end is_member,
  cast(date '2024-01-30' - cast(o_orderkey % 400 as int) as string) || ' 10:00:00' pay_at,
  case when o_orderkey % 83 = 1 then '' when o_orderkey % 89 = 1 then 'paid?' when o_custkey % 4 = 0 and o_orderkey % 400 > 20 then '2'
       when o_orderstatus = 'F' then '3' when o_orderstatus = 'O' then '101' else '1' end status,
  cast(o_totalprice as decimal(15,2)) payment, substr(cast(o_orderdate as string), 1, 19) updated_at,
  n_name province, cast(n_regionkey as string) province_code, n_name city, cast(n_nationkey as string) city_code,
  case when o_orderkey % 50 = 49 then '2024-01-29' else '2024-01-30' end day_id
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

ACTIVITY_SQL = """
select event_id, cast(user_id % 7 as string) merchant_num,
  case when event_id % 101 = 0 then cast(null as bigint) else user_id end member_id,
  case when event_id % 67 = 1 then 'x' when event_type = 'purchase' and user_id % 10 <> 3 then '2' when event_type = 'click' then '1' else '3' end activity_type,
  case when event_id % 71 = 1 then '' when value >= 20 then '1' else '0' end status,
  case when event_type = 'error' and event_id % 5 = 0 then cast(null as string)
       when user_id % 10 = 4 and ts >= timestamp '2024-01-10 00:00:00'
         then substr(cast(ts - interval '30' day as string), 1, 19)
       else substr(cast(ts as string), 1, 19) end created_at
from {events}
"""

POINTS_SQL = """
select cast(user_id % 7 as string) merchant_num, user_id member_id,
  case when event_type in ('signup', 'view') then '1' when event_type = 'error' then '' else '2' end right_type,
  case when event_id % 73 = 1 then 'n/a' else cast(cast(round(value) as bigint) - 30 as string) end num_change
from {events}
"""

CITY_LEVEL_SQL = """
select n_name name, case when n_nationkey = 24 then 'x' else cast(n_regionkey + 1 as string) end level
from {nation}
"""

# view name -> (SQL text, given tables it reads)
FIXTURE_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "member_base_info_day": (MEMBER_SQL, ("customer", "nation")),
    "user_orders": (ORDER_SQL, ("orders", "customer", "nation")),
    "hd_join_log": (ACTIVITY_SQL, ("events",)),
    "right_change_log": (POINTS_SQL, ("events",)),
    "city_level": (CITY_LEVEL_SQL, ("nation",)),
}


def fixture_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a Spark DataFrame over ``sf_dir``'s parquet files."""
    text, tables = FIXTURE_SQL[name]
    dfs = {t: read_given(spark, sf_dir, t) for t in tables}
    return spark.sql(text, **dfs)


def fixture_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five fixture views, unfiltered (the snapshot filters are S1/S2)."""
    return {name: fixture_view(spark, sf_dir, name) for name in FIXTURE_SQL}


def fixture_sql_for_duckdb(name: str) -> str:
    """The same view text with the given tables named directly."""
    text, tables = FIXTURE_SQL[name]
    return text.format(**{t: t for t in tables})


def fixture_ctes(placeholders: bool = False) -> str:
    """``WITH`` clause defining all fixture views, for self-contained SQL.

    With ``placeholders`` the given tables stay as ``{customer}``-style
    placeholders, for ``spark.sql(text, customer=df, ...)``.
    """
    parts = [f"{name} as ({FIXTURE_SQL[name][0] if placeholders else fixture_sql_for_duckdb(name)})"
             for name in FIXTURE_SQL]
    return "with " + ",\n".join(parts)
