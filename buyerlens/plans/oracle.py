"""DuckDB oracle: one self-contained SQL text per catalog query.

Each text starts with the fixture views as CTEs (DuckDB has only the given
tables), pins their code columns, and then states every figure from its
definition: one set of definitions per buyer, per member and per day, the
latest order as the first of an ordered list, a cell as the best candidate of
its coordinate. The Spark side plans these differently, so a match checks both.

Tie-breaks and set orders that the Spark side makes deterministic are spelled
out here the same way (latest order: ``updated_at``, then ``order_id``, then
the payload, all descending with NULLs last; time lists sorted).
"""

from __future__ import annotations

from buyerlens.operators.orders import MEMBER_ORDER_PAYLOAD as MEMBER_PAYLOAD
from buyerlens.operators.orders import NONMEMBER_ORDER_PAYLOAD as NONMEMBER_PAYLOAD
from buyerlens.params import FIXTURE_PARAMS, ProfileParams
from buyerlens.schema import (
    BASE_COLUMNS,
    DERIVED_COLUMNS,
    NONMEMBER_DEFAULTS,
    NONMEMBER_FROM_ORDER,
    PROFILE_COLUMNS,
    RECEIVER_COLUMNS,
)
from buyerlens.sources.fixtures import fixture_ctes
from buyerlens.sources.tables import MEMBER_COLUMNS

TO_INT = ("merchant_num", "status", "channel", "member_identity", "point", "total_point", "member_grade",
          "receive_province_code", "receive_city_code", "exchange_num", "interactive_num")


def _lit(v: object) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _types() -> dict[str, str]:
    from buyerlens.schema import BASE_TYPES
    return {k: {"string": "string", "int": "integer", "bigint": "bigint"}[v] for k, v in BASE_TYPES.items()}


LATEST = "updated_at desc nulls last, order_id desc nulls last"


def _newest(payload: list[str], kind: int) -> str:
    """Per buyer, the newest order of a kind as a struct: first of the list in the order of the tie-breaks."""
    ties = ", ".join(f"{c} desc nulls last" for c in payload)
    fields = ", ".join(f"{c} := {c}" for c in payload)
    return (f"select merchant_num, platform_open_id as user_id, list(struct_pack({fields}) order by {LATEST}, {ties})[1] as o"
            f" from orders_today where is_member = {kind} group by all")


def stages(p: ProfileParams = FIXTURE_PARAMS, tenants: tuple[str, ...] | None = None) -> str:
    """All CTEs after the fixture views, in dependency order. ``tenants`` scopes both snapshots and the result."""
    scope = "" if tenants is None else " and merchant_num in (" + ", ".join(_lit(t) for t in tenants) + ")"
    ty = _types()
    paid = f"status in ({', '.join(map(str, p.paid_status))})"

    of_member = {
        "is_member": "1", "birthday": "case m.birthday when '' then '0001-01-01' else m.birthday[:10] end",
        "unbind_time": "case m.unbind_time when '' then '0001-01-01 00:00:00' else m.unbind_time end",
        "city": "replace(m.city, '市', '')", "city_level": "cl.level",
        **{c: f"r.o.{c.removeprefix('receive_')}" for c in RECEIVER_COLUMNS},
    }
    member_select = ", ".join(f"try_cast({of_member.get(c, 'm.' + c)} as {ty[c]}) as {c}" for c in BASE_COLUMNS)
    of_order = {"merchant_num": "merchant_num", "user_id": "user_id", "platform_open_id": "user_id",
                **{c: f"o.{src}" for c, src in NONMEMBER_FROM_ORDER.items() if src in NONMEMBER_PAYLOAD}}
    nonmember_select = ", ".join(f"try_cast({of_order.get(c) or _lit(NONMEMBER_DEFAULTS[c])} as {ty[c]}) as {c}" for c in BASE_COLUMNS)
    member_pins = ", ".join(f"try_cast({c} as {ty[c]}) as {c}" for c in MEMBER_COLUMNS)

    return f"""
, members_today as (select {member_pins} from member_base_info_day where day_id = '{p.as_of}'{scope})
, orders_today as (
  select * replace (try_cast(status as integer) as status) from user_orders where day_id = '{p.as_of}'{scope})
, activity as (
  select merchant_num, member_id, try_cast(activity_type as integer) as activity_type, try_cast(status as integer) as status, created_at
  from hd_join_log)
, points as (
  select merchant_num, member_id, try_cast(right_type as integer) as right_type, try_cast(num_change as bigint) as num_change
  from right_change_log)
, city_levels as (select name, try_cast(level as integer) as level from city_level)
, paid_orders as (
  select merchant_num, platform_open_id as user_id, order_id, payment, status, pay_at[:10] as pay_day
  from orders_today where {paid} and pay_at[:10] between '{p.order_start}' and '{p.as_of}')
, buyer_days as (
  select merchant_num, user_id, pay_day, count(*) as n, sum(payment) as amount from paid_orders group by all)
, buyers as (
  select merchant_num, user_id, sum(n)::bigint as n_orders, count(*) as n_days,
    (sum(n) filter (pay_day = '{p.as_of}'))::bigint as n_today, sum(amount) filter (pay_day = '{p.as_of}') as amount_today,
    merchant_num is not null and user_id is not null as keyed
  from buyer_days group by merchant_num, user_id)
, order_summary as (
  select merchant_num, user_id, n_orders as order_num_360, case when keyed then n_orders - n_today end as history_order_num_360,
    case when keyed then n_today end as today_order_num, case when keyed then amount_today::decimal(25, 2) end as today_order_amount,
    case when keyed then least(n_days, 2)::integer end as pay_detail
  from buyers)
, newest_member_order as ({_newest(MEMBER_PAYLOAD, 1)})
, newest_nonmember_order as ({_newest(NONMEMBER_PAYLOAD, 0)})
, members_enriched as (
  select {member_select} from members_today m
  left join newest_member_order r using (merchant_num, user_id)
  left join city_levels cl on cl.name = replace(m.city, '市', ''))
, nonmembers_default as (select {nonmember_select} from newest_nonmember_order)
, all_users as (select distinct * from (from members_enriched union all from nonmembers_default))
, moments as (
  select merchant_num, member_id, created_at[:19] as second, count(*) as n, count(*) filter (activity_type = 2) as n_exchange,
    count(*) filter (activity_type = 2 and status = 1) as n_exchange_ok, count(*) filter (status = 1) as n_ok,
    coalesce(created_at[:10] between '{p.activity_start}' and '{p.as_of}', false) as recent
  from activity group by merchant_num, member_id, second, recent)
, actors as (
  select merchant_num, member_id, merchant_num is not null and member_id is not null as keyed,
    sum(n_exchange)::bigint as exchanges, sum(n_exchange_ok)::bigint as exchanges_ok,
    coalesce(sum(n) filter (recent), 0)::bigint as recents, coalesce(sum(n_ok) filter (recent), 0)::bigint as recents_ok,
    array_to_string(list_sort(list(distinct second) filter (second is not null and n_exchange > 0)), ',') as exchange_times,
    array_to_string(list_sort(list(distinct second) filter (second is not null)), ',') as all_times
  from moments group by merchant_num, member_id)
, activity_summary as (
  select merchant_num, member_id, case when keyed and exchanges > 0 then coalesce(exchange_times, '') end as exchange_time_list,
    case when keyed and exchanges > 0 then exchanges_ok end as exchange_num, case when keyed and recents > 0 then 1 end as join_num_90,
    case when keyed and recents > 0 then recents_ok end as interactive_num,
    case when keyed then coalesce(all_times, '') end as interactive_time_list
  from actors)
, points_total as (
  select merchant_num, member_id, sum(num_change)::bigint as total_point
  from points where right_type = 1 and num_change > 0 group by all)
, profile_joined as (
  select distinct u.*, o.history_order_num_360, o.today_order_num, o.today_order_amount, o.pay_detail,
    j.join_num_90, j.exchange_time_list, j.exchange_num, j.interactive_num, j.interactive_time_list, p.total_point
  from all_users u
  left join order_summary o using (merchant_num, user_id)
  left join activity_summary j using (merchant_num, member_id)
  left join points_total p using (merchant_num, member_id))
, facts as (
  select *, coalesce(is_member = 1, false) as member, coalesce(today_order_num, 0) > 0 as bought,
    coalesce(history_order_num_360, 0) > 0 as bought_before
  from profile_joined)
, labelled as (
  select *,
    (case when not bought then 0 when not member then 3 when bought_before then 2 else 1 end)::integer as l_buy_charact,
    (case when not (member and bought) then 0 when is_new_member = 1 then 1 when bought_before then 0 else 2 end)::integer as l_buy_subdivision,
    coalesce(join_num_90 >= 1 and member_id > 1, false)::integer as l_is_silent,
    coalesce(pay_detail, 0)::integer as l_pay_detail,
    coalesce(today_order_num, 0) as l_today_order_num,
    case when today_order_amount is null then 0::decimal(15, 3) else try_cast(today_order_amount as decimal(15, 3)) end as l_today_order_amount
  from facts)
, user_profile as (
  select distinct {", ".join(_profile_select())} from labelled{" where " + scope[5:] if scope else ""})
"""


def _profile_select() -> list[str]:
    out = []
    for c in PROFILE_COLUMNS:
        if c in TO_INT:
            out.append(f"try_cast({c} as integer) as {c}")
        elif c in ("buy_charact", "buy_subdivision", "is_silent", "pay_detail", "today_order_num",
                   "today_order_amount"):
            out.append(f"l_{c} as {c}")
        else:
            out.append(c)
    return out


def _cells_stages(p: ProfileParams = FIXTURE_PARAMS) -> str:
    """A coordinate's candidates are the non-NULL values of all its rows; the member's comes first, then the greatest."""
    width = (1 << 32) // p.n_buckets
    as_text = ", ".join(f"cast({c} as varchar) as {c}" for c in PROFILE_COLUMNS)
    model = ", ".join(f"'{c}'" for c in DERIVED_COLUMNS)
    return f"""
, bucketed as (
  select *, cast(least(cast(('0x' || rowkey[:8]) as bigint) // {width}, {p.n_buckets - 1}) as integer) as bucket from keyed)
, as_text as (select rowkey, bucket, coalesce(is_member = 1, false) as of_member, {as_text} from bucketed)
, candidates as (
  select rowkey, bucket, of_member, qualifier, value
  from (unpivot as_text on {", ".join(PROFILE_COLUMNS)} into name qualifier value value))
, cells as (
  select rowkey, case when qualifier in ({model}) then 'model' else 'base' end as family, qualifier,
    coalesce(max(value) filter (of_member), max(value)) as value, bucket
  from candidates group by rowkey, qualifier, bucket)
"""


def _with(*tail: str) -> str:
    return fixture_ctes() + stages() + "".join(tail)


def _sink_profile() -> str:
    """The profile with the rowkey of its raw texts, before the last distinct (a cell's candidates subsume it)."""
    user = "coalesce(replace(user_id, '\\', '\\\\'), '\\N')"
    tenant = "coalesce(replace(replace(merchant_num, '\\', '\\\\'), '_', '\\_'), '\\N')"
    return (f"\n, keyed as (select md5({user} || '_' || {tenant})[:8] || '_' || {tenant} || '_' || {user} as rowkey,"
            f" {', '.join(_profile_select())} from labelled)\n")


LABEL_KEYS = "merchant_num, user_id, is_member"
# Region boundaries of the query with a store's own.
SPLITS = ("10000000_", "1fffffff_3_", "80000000_", "80000000_2_", "c0ffee00_")
# Tenants of the tenant-scoped query (T4).
SCOPED_TENANTS = ("1", "3")


def oracle_sql() -> dict[str, str]:
    hi, lo_a = FIXTURE_PARAMS.as_of, FIXTURE_PARAMS.activity_start
    q = {
        "member_snapshot": "select * from members_today",
        "order_snapshot_paid": "select order_id, merchant_num, user_id as platform_open_id, pay_day, status, payment"
                               " from paid_orders",
        "city_level_dim": "select * from city_levels",
        "activity_log_window": "select merchant_num, member_id, activity_type, status, created_at from activity"
                               f" where created_at[:10] between '{lo_a}' and '{hi}'",
        "points_log_positive": "select merchant_num, member_id, right_type, num_change from points"
                               " where num_change > 0 and right_type = 1",
        "latest_member_order": "select merchant_num, user_id, " + ", ".join(f"o.{c} as receive_{c}" for c in MEMBER_PAYLOAD)
                               + " from newest_member_order",
        "latest_nonmember_order": "select merchant_num, user_id as platform_open_id, "
                                  + ", ".join(f"o.{c}" for c in NONMEMBER_PAYLOAD) + " from newest_nonmember_order",
        # Rank one plus the buyer's orders on later days.
        "pay_day_rank": "select o.merchant_num, o.user_id as platform_open_id, o.order_id, o.pay_day,"
                        " (1 + coalesce((select sum(d.n) from buyer_days d where d.merchant_num is not distinct from o.merchant_num"
                        " and d.user_id is not distinct from o.user_id and d.pay_day > o.pay_day), 0))::integer as rn from paid_orders o",
        "order_window_count": "select merchant_num, user_id, n_orders as order_num_360 from buyers",
        "today_orders": "select merchant_num, user_id, n_today as today_order_num,"
                        " amount_today::decimal(15, 3) as today_order_amount from buyers where n_today > 0",
        "order_summary": "select * from order_summary",
        "pay_detail": "select merchant_num, user_id, least(n_days, 2)::integer as pay_detail from buyers",
        "exchange_stats": "select merchant_num, member_id, coalesce(exchange_times, '') as exchange_time_list,"
                          " exchanges_ok as exchange_num from actors where exchanges > 0",
        "recent_interaction": "select merchant_num, member_id, 1 as join_num_90, recents_ok as interactive_num from actors where recents > 0",
        "interaction_list": "select merchant_num, member_id, coalesce(all_times, '') as interactive_time_list from actors",
        "activity_summary": "select * from activity_summary",
        "points_total": "select * from points_total",
        "members_enriched": "select * from members_enriched",
        "nonmembers_default": "select * from nonmembers_default",
        "all_users": "select * from all_users",
        "profile_joined": "select * from profile_joined",
        "label_buy_charact": f"select {LABEL_KEYS}, is_new_member, today_order_num, history_order_num_360,"
                             " l_buy_charact as buy_charact from labelled",
        "label_buy_subdivision": f"select {LABEL_KEYS}, is_new_member, today_order_num, history_order_num_360,"
                                 " l_buy_subdivision as buy_subdivision from labelled",
        "label_is_silent": f"select {LABEL_KEYS}, member_id, join_num_90, l_is_silent as is_silent from labelled",
        "label_pay_detail": f"select {LABEL_KEYS}, l_pay_detail as pay_detail from labelled",
        "today_defaults": f"select {LABEL_KEYS}, l_today_order_num as today_order_num,"
                          " l_today_order_amount as today_order_amount from labelled",
        "user_profile": "select * from user_profile",
    }
    out = {k: _with() + v for k, v in q.items()}
    as_text = ", ".join(f"cast({c} as varchar) as {c}" for c in PROFILE_COLUMNS)
    out["tenant_scoped_profile"] = (fixture_ctes() + stages(tenants=SCOPED_TENANTS)
                                    + "select * from user_profile")
    out["cell_values"] = _with(_sink_profile(), f"""
, as_text as (select merchant_num as row_merchant_num, user_id as row_user_id, is_member as row_is_member, {as_text}
  from keyed)
""") + (f"select row_merchant_num, row_user_id, row_is_member, qualifier, value from "
        f"(unpivot as_text on {', '.join(PROFILE_COLUMNS)} into name qualifier value value)")
    out["cell_family"] = _with(_sink_profile(), _cells_stages()) + \
        "select family, qualifier, count(*) as n_cells from cells group by family, qualifier"
    out["cell_rowkey_bucket"] = _with(_sink_profile(), _cells_stages()) + \
        "select merchant_num, user_id, is_member, rowkey, bucket from bucketed"
    out["cells"] = _with(_sink_profile(), _cells_stages()) + "select * from cells"
    out["cells_stored"] = _with(_sink_profile(), _cells_stages()) + (
        "select family, bucket, count(*) as n_cells, min(rowkey) as first_key, max(rowkey) as last_key, 'snappy' as codec,"
        " 0::bigint as out_of_order from cells group by family, bucket")
    below = " + ".join(f"(rowkey >= {_lit(s)})::integer" for s in SPLITS)
    out["cells_at_splits"] = _with(_sink_profile(), _cells_stages()) + (
        f"select {below} as bucket, count(*) as n_cells, min(rowkey) as first_key from cells group by 1")
    number = "coalesce(cast({} as varchar), 'null')"
    out["cell_rendering"] = _with() + f"""
select user_id, qualifier, value from (
  select distinct user_id, unnest(['mixedids', 'figuremap', 'pair', 'birth_day']) as qualifier,
    unnest(['[' || {number.format("member_id")} || ',' || {number.format("sex")} || ']',
            '{{"age":' || {number.format("age")} || ',"sex":' || {number.format("sex")} || '}}',
            '{{' || concat_ws(',', '"Sex":' || sex, '"age":' || age) || '}}', birthday]) as value
  from members_today) where value is not null"""
    out["recent_interaction_rolled"] = out["recent_interaction"]
    out["member_snapshot_partitioned"] = (fixture_ctes() + stages(tenants=SCOPED_TENANTS) + "select * from members_today")
    wide = ProfileParams(as_of=FIXTURE_PARAMS.as_of)
    out["recent_interaction_90"] = _with() + f"""
select merchant_num, member_id, 1 as join_num_90, (count(*) filter (status = 1))::bigint as interactive_num from activity
where created_at[:10] between '{wide.activity_start}' and '{wide.as_of}' group by merchant_num, member_id"""
    return out
