"""The same queries in SQL, for checking results with another engine.

The statements are written for DuckDB over the same tables and share nothing
with the DataFrame code.
"""

from __future__ import annotations

PAYMENTS = """payments as (
  select event_id // 2 as order_id, value as pay_amount,
    cast(event_id % 4 as smallint) as pay_source,
    cast(case when event_id % 97 = 96 then 9 else event_id % 2 end as smallint) as pay_platform,
    epoch_us(ts) // 1000 as create_time,
    (epoch_us(ts) // 1000 // 60000) * 60 as minute
  from events where value > 0)"""

ORDER_MESSAGES = """order_messages as (
  select order_id, concat('buyer', order_id % 10000) as buyer_id,
    concat('product', order_id % 2000) as product_id,
    concat(case when order_id % 2 = 0 then 'tb_saler' else 'tm_saler' end, order_id % 10000) as saler_id,
    min(create_time) as create_time,
    cast(sum(cast(pay_amount as decimal(18,2)))
         + case when order_id % 10 = 0 then 5 else 0 end as double) as total_price,
    case when order_id % 2 = 0 then 'tb_order' else 'tm_order' end as topic
  from payments where order_id % 50 <> 7 group by order_id
  union all
  select 1000000000 + o_orderkey, concat('buyer', o_custkey), 'product0',
    case when o_orderkey % 2 = 0 then 'tb_saler0' else 'tm_saler0' end,
    cast(1704067200000 as bigint), o_totalprice,
    case when o_orderkey % 2 = 0 then 'tb_order' else 'tm_order' end
  from orders)"""

SLIM = """slim as (
  select order_id, case when topic = 'tb_order' then 'tb' else 'tm' end as plat, total_price
  from order_messages)"""

MATCHED = """matched as (
  select p.order_id, s.plat, p.minute, p.pay_amount, p.create_time
  from payments p join slim s on p.order_id = s.order_id)"""

PLATFORM = """platform as (
  select plat, minute, cast(sum(cast(pay_amount as decimal(18,2))) as double) as trade
  from matched group by plat, minute)"""

TERMINAL = """terminal as (
  select pay_platform, minute, cast(sum(cast(pay_amount as decimal(18,2))) as double) as trade
  from payments where pay_platform in (0, 1) group by pay_platform, minute)"""

TURNOVER = """turnover as (
  select concat(case when plat = 'tb' then 'platform_tb_' else 'platform_tm_' end, minute) as key,
    floor(trade * 100 + 0.5) / 100 as value
  from platform)"""

# What a job that never lost an order would have published.
EXPECTED = """expected_turnover as (
  select concat(case when order_id % 2 = 0 then 'platform_tb_' else 'platform_tm_' end, minute) as key,
    floor(cast(sum(cast(pay_amount as decimal(18,2))) as double) * 100 + 0.5) / 100 as expected
  from payments group by order_id % 2, minute)"""

COMPARED = """compared as (
  select e.key, e.expected, a.value as actual,
    case when a.value is null then e.expected else abs(a.value - e.expected) end as abs_error
  from expected_turnover e left join turnover a on e.key = a.key)"""

BALANCES = """balances as (
  select s.order_id, s.plat, s.total_price,
    cast(coalesce(sum(cast(p.pay_amount as decimal(18,2))), 0) as double) as paid
  from slim s left join payments p on p.order_id = s.order_id
  group by s.order_id, s.plat, s.total_price)"""


def _dense(source: str, prefix: str = "") -> str:
    """Grid, filled series and running total of a (pay_platform, minute, trade) table.

    The grid is added to the series with 0.0 and both are summed, and both terminals
    are picked out of one series: no table is joined with itself.
    """
    return f"""{prefix}bounds as (
  select pay_platform, min(minute) as lo, max(minute) as hi from {source} group by pay_platform),
{prefix}dense as materialized (
  select pay_platform, minute, sum(trade) as trade from (
    select pay_platform, unnest(range(lo, hi + 60, 60)) as minute, 0.0::double as trade from {prefix}bounds
    union all select pay_platform, minute, trade from {source})
  group by pay_platform, minute),
{prefix}cumulative as materialized (
  select pay_platform, minute, trade,
    cast(sum(cast(trade as decimal(18,2)))
      over (partition by pay_platform order by minute) as double) as cum_trade,
    cast(sum(cast(trade as decimal(18,2))) over (partition by pay_platform order by minute)
      + first_value(cast(trade as decimal(18,2)))
        over (partition by pay_platform order by minute) as double) as cum_compat
  from {prefix}dense),
{prefix}both_terminals as materialized (
  select minute, max(cum_trade) filter (pay_platform = 1) as mobile_trade,
    max(cum_trade) filter (pay_platform = 0) as pc_trade,
    max(cum_compat) filter (pay_platform = 1) as mobile_compat,
    max(cum_compat) filter (pay_platform = 0) as pc_compat
  from {prefix}cumulative group by minute having count(distinct pay_platform) = 2),
{prefix}ratios as (
  select minute, mobile_trade / pc_trade as ratio,
    case when pc_compat <> 0 then mobile_compat / pc_compat end as ratio_compat
  from {prefix}both_terminals where pc_trade <> 0)"""


DENSE = _dense("terminal")

SEEN = """seen_terminal as (
  select pay_platform, minute, cast(sum(cast(pay_amount as decimal(18,2))) as double) as trade
  from payments
  where pay_platform in (0, 1) and order_id in (select order_id from slim)
  group by pay_platform, minute),
""" + _dense("seen_terminal", "seen_")


def _draw(index: str, below: str, stream: int) -> str:
    shifted = f"(({index}) + ({index}) // 2147483647 * 16807)"
    linear = f"({shifted} % 2147483647 * 1327217885 + {stream * 1000003}) % 2147483647"
    return f"((({linear}) * ({linear}) + ({linear})) % 2147483647 * ({below}) // 2147483647)"


def _generated(step_ms: int) -> str:
    return f"""generated as (
  select o_orderkey + 1700000000000 as order_id,
    concat('buyer', {_draw('o_orderkey', '10000', 2)}) as buyer_id,
    concat('product', {_draw('o_orderkey', '2000', 3)}) as product_id,
    concat(case when {_draw('o_orderkey', '2', 1)} = 0 then 'tb_saler' else 'tm_saler' end,
      {_draw('o_orderkey', '10000', 4)}) as saler_id,
    o_orderkey * {step_ms} + 1704067200000 as create_time,
    ({_draw('o_orderkey', '10000000', 5)} + 10) / 100.0 as total_price,
    case when {_draw('o_orderkey', '2', 1)} = 0 then 'tb_order' else 'tm_order' end as topic
  from orders),
split as (
  select *, {_draw('order_id', 'cast(floor(total_price / 2) as bigint)', 8)} as first_amount,
    cast(floor(total_price * 100 + 0.5) as bigint) as cents
  from generated where total_price >= 2),
generated_payments as (
  select order_id, cast(first_amount as double) as pay_amount, cast(0 as smallint) as pay_source,
    cast(0 as smallint) as pay_platform,
    create_time + {_draw('order_id', '100', 6)} as create_time, topic
  from split
  union all
  select order_id, (cents - first_amount * 100) / 100.0, cast(1 as smallint),
    cast(1 as smallint), create_time + {_draw('order_id', '100', 7)}, topic
  from split)"""


GENERATED = _generated(10)


def _with(body: str, *parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + body


_P = (PAYMENTS,)
_O = (PAYMENTS, ORDER_MESSAGES)
_S = (PAYMENTS, ORDER_MESSAGES, SLIM)
_M = (*_S, MATCHED)
_A = (*_M, PLATFORM)
_T = (PAYMENTS, TERMINAL)
_D = (PAYMENTS, TERMINAL, DENSE)
_U = (*_A, TURNOVER)
_C = (*_U, EXPECTED, COMPARED)
_B = (*_S, BALANCES)

_HALF = "(l_extendedprice * l_discount - 500.0) / 2"
_RATIO_KEY = "concat('ratio_', minute)"

_TAGGED = """select order_id, 'pay' as type, pay_amount, pay_source, pay_platform, create_time,
    cast(null as varchar) as plat, cast(null as double) as total_price from payments
  union all
  select order_id, 'order', null, null, null, {time}, plat, total_price from {orders}"""

_MATCHED_SUMS = """select order_id, plat, minute,
    cast(sum(cast(pay_amount as decimal(18,2))) as double) as pay_amount
  from matched group by order_id, plat, minute"""

ORACLE = {
    # sources and ingest
    "ingest_topics": _with(
        """select 'pay' as topic, order_id, create_time from payments
  union all select topic, order_id, create_time from order_messages
  union all select unnest(['pay', 'tb_order', 'tm_order']), null, null""", *_O),
    "route_topic": _with(
        """select 'pay' as route, 'pay' as topic,
    (select count(*) from payments) + (select count(*) from supplier) + 1 as messages
  union all select 'order', topic, count(*) + 1 from order_messages group by topic
  union all select 'unknown', 'refund', count(*) from customer""", *_O),
    "decode_payload": _with(
        """select order_id, buyer_id, product_id, saler_id, create_time, total_price, topic,
    cast(null as double) as pay_amount, cast(null as smallint) as pay_source,
    cast(null as smallint) as pay_platform from order_messages
  union all select order_id, null, null, null, create_time, null, 'pay',
    pay_amount, pay_source, pay_platform from payments""", *_O),
    "quarantine": """select 'refund' as topic, 'topic' as reason, count(*) as messages from customer
  union all select 'pay', 'body', count(*) from supplier""",
    "drop_end_markers": _with(
        """select 'pay' as topic, true as ended,
    (select count(*) from payments) + (select count(*) from supplier) as messages
  union all select topic, true, count(*) from order_messages group by topic
  union all select 'refund', false, count(*) from customer""", *_O),
    "slim_orders": _with("select * from slim", *_S),
    "tagged_union": _with(_TAGGED.format(time="null", orders="slim"), *_S),
    "decode_messages": _with(
        _TAGGED.format(
            time="create_time",
            orders="(select *, case when topic = 'tb_order' then 'tb' else 'tm' end as plat"
            " from order_messages)",
        ), *_O),
    "catch_up": _with(
        """select 'pay' as topic, count(*) as messages from payments
  union all select topic, count(*) from order_messages group by topic""", *_O),
    "tail_topic": _with("select * from order_messages where topic = 'tb_order'", *_O),
    "gen_orders": _with("select * from generated", GENERATED),
    "gen_payments": _with("select * from generated_payments", GENERATED),
    "hello_rate": "select event_id, 'Hello' as message from events",
    # projections, filters, scalar functions
    "minute_bucket": _with("select order_id, pay_source, minute from payments", *_P),
    "filter_type": _with("select * exclude (minute) from payments", *_P),
    "decode_trade_platform": _with("select order_id, plat from slim", *_S),
    "decode_pay_platform": _with(
        """select order_id, pay_source, case pay_platform when 0 then 'pc' else 'mobile' end as terminal
  from payments where pay_platform in (0, 1)""", *_P),
    "invalid_pay_platform": _with(
        "select * exclude (minute) from payments where pay_platform not in (0, 1)", *_P),
    "decode_pay_source": _with(
        """select order_id, pay_source, case pay_source when 0 then 'wallet' when 1 then 'coupon'
    when 2 then 'bank_card' when 3 then 'other' end as source_name from payments""", *_P),
    "round_cents": f"""select l_orderkey, l_linenumber, floor({_HALF} * 100 + 0.5) / 100 as rounded
  from lineitem""",
    "round_half_even": f"""select l_orderkey, l_linenumber,
    round_even({_HALF} * 100, 0) / 100 as rounded from lineitem""",
    "result_key": _with(f"select pay_platform, {_RATIO_KEY} as key from terminal", *_T),
    "positive_amounts": """select event_id, cast(floor(value) as bigint) as pay_amount
  from events where floor(value) > 0""",
    "amount_check": """select count(*) filter (floor(c_acctbal) > 0) as published,
    count(*) filter (floor(c_acctbal) = 0) as zero,
    count(*) filter (floor(c_acctbal) < 0) as negative from customer""",
    "order_total_check": _with("select * from balances where paid <> total_price", *_B),
    "parse_number": """select event_id, try_cast(case when event_id % 7 = 0 then event_type
    else concat(user_id, '.25') end as double) as number from events""",
    "concat_world": "select event_id, concat(event_type, 'World') as message from events",
    # joins
    "match_payments": _with("select order_id, plat, minute, pay_amount from matched", *_M),
    "settled_orders": _with(
        "select * from balances where abs(total_price - paid) <= 0.000001", *_B),
    "pending_payments": _with(
        """select * exclude (minute) from payments
  where order_id not in (select order_id from slim)""", *_S),
    "open_orders": _with("select * from balances where abs(total_price - paid) > 0.000001", *_B),
    "orders_seen": _with(
        """select distinct order_id from payments
  where order_id in (select order_id from slim)""", *_S),
    "rematch_pending": _with(
        """select p.order_id, p.pay_amount,
    case when s.order_id is null then 'pending' else 'matched' end as status
  from payments p left join slim s on p.order_id = s.order_id
  where s.order_id is null or s.plat = 'tm'""", *_S),
    "ratio_join": _with(
        "select minute, mobile_trade, pc_trade from both_terminals", *_D),
    "reconcile": _with("select * from compared", *_C),
    "reconcile_ratio": _with(
        """select count(*) as keys, count(l.ratio) as present,
    count(*) - count(l.ratio) as missing, max(abs(l.ratio - r.ratio)) as max_error
  from ratios r left join seen_ratios l on r.minute = l.minute""", *_S, TERMINAL, DENSE, SEEN),
    # aggregations
    "minute_trade_by_platform": _with("select * from platform", *_A),
    "minute_trade_by_terminal": _with("select * from terminal", *_T),
    "turnover_report": _with("select * from turnover", *_U),
    "running_minute_trade": _with(
        """select pay_platform, minute, create_time, order_id, pay_source, pay_amount,
    cast(sum(cast(pay_amount as decimal(18,2))) over (
      partition by pay_platform, minute order by create_time, order_id, pay_source
      rows between unbounded preceding and current row) as double) as running_trade
  from payments where pay_platform in (0, 1)""", *_P),
    "minute_bounds": _with(
        """select pay_platform, min(minute) as first_minute, max(minute) as last_minute
  from terminal group by pay_platform""", *_T),
    "message_counts": _with(
        """select 'pay' as type, cast(null as varchar) as plat, count(*) as messages from payments
  union all select 'order', plat, count(*) from slim group by plat""", *_S),
    "distinct_minutes": _with("select count(distinct minute) as minutes from payments", *_P),
    "result_keys": _with("select distinct key from turnover", *_U),
    "paid_per_order": _with(
        """select order_id, cast(sum(cast(pay_amount as decimal(18,2))) as double) as paid
  from payments group by order_id""", *_P),
    "reconcile_totals": _with(
        """select count(*) as keys, count(*) - count(actual) as missing,
    cast(sum(cast(expected as decimal(18,2))) as double) as total_expected,
    cast(sum(cast(abs_error as decimal(18,2))) as double) as total_error from compared""", *_C),
    "expected_results": _with(
        """select case when topic = 'tb_order' then 'tb' else 'tm' end as series,
    create_time // 60000 * 60 as minute,
    cast(sum(cast(pay_amount as decimal(18,2))) as double) as expected
  from generated_payments group by 1, 2
  union all
  select case when pay_platform = 0 then 'pc' else 'mobile' end, create_time // 60000 * 60,
    cast(sum(cast(pay_amount as decimal(18,2))) as double)
  from generated_payments group by 1, 2""", _generated(20_000)),
    # window, time series
    "dense_minutes": _with("select pay_platform, minute, trade from dense", *_D),
    "cumulative_trade": _with("select pay_platform, minute, cum_trade from cumulative", *_D),
    "mobile_pc_ratio": _with("select minute, ratio from ratios", *_D),
    "mobile_pc_ratio_compat": _with("select minute, ratio_compat as ratio from ratios", *_D),
    "ladder_sum": _with(
        """select pay_platform, minute, cast(sum(cast(trade as decimal(18,2)))
    over (partition by pay_platform order by minute) as double) as cum_trade
  from terminal""", *_T),
    "latest_key": _with(
        """select pay_platform, max(minute) as minute,
    cast(sum(cast(trade as decimal(18,2))) as double) as cum_trade
  from terminal group by pay_platform""", *_T),
    # sort, set operations
    "sort_series": _with("select * from platform order by minute", *_A),
    "key_union": _with(f"select distinct {_RATIO_KEY} as key from terminal", *_T),
    # streaming
    "stream_minute_trade": _with("select * from terminal", *_T),
    "stream_match": _with(_MATCHED_SUMS, *_M),
    "stream_match_keyed": _with(_MATCHED_SUMS, *_M),
    "stream_match_backlog": _with(_MATCHED_SUMS, *_M),
    "reconcile_job": _with(
        f"""select key, expected, actual, abs_error from compared
  union all select {_RATIO_KEY}, ratio, ratio, 0.0 from ratios""", *_C, TERMINAL, DENSE),
    "periodic_report": _with(
        f"select key, value from turnover union all select {_RATIO_KEY}, ratio from ratios",
        *_U, TERMINAL, DENSE),
    "state_report": _with(
        """select 'orders_seen' as metric, cast(count(*) as double) as value from slim
  union all select 'payments_seen', count(*) from payments
  union all select 'open_orders', count(*) from balances where abs(total_price - paid) > 0.000001
  union all select 'pending_payments', count(*) from payments
    where order_id not in (select order_id from slim)
  union all select 'pending_orders', count(distinct order_id) from payments
    where order_id not in (select order_id from slim)
  union all select 'orders_held', count(*) from slim
  union all select 'pending_minutes_held', count(distinct (order_id, create_time // 60000)) from payments
    where order_id not in (select order_id from slim)
  union all select 'input_rows', (select count(*) from slim) + (select count(*) from payments) + 3
  union all select 'backlog_files', 0""", *_B),
    # sinks
    "upsert_results": _with("select * from turnover", *_U),
    "lookup_results": _with("select key, actual as value from compared", *_C),
    "delete_results": _with("select * from turnover where value >= 20", *_U),
    "reset_results": _with(
        f"""select key, cast(0.0 as double) as value from turnover
  union all select {_RATIO_KEY}, 0.0 from ratios""", *_U, TERMINAL, DENSE),
    "increment_results": _with(
        """select e.key, cast(cast(coalesce(a.value, 0) as decimal(18,2))
    + cast(e.expected as decimal(18,2)) as double) as value
  from expected_turnover e left join turnover a on e.key = a.key""", *_U, EXPECTED),
    "publish_messages": _with(
        """select 'order' as type, order_id, create_time, cast(null as double) as pay_amount,
    cast(null as smallint) as pay_source, cast(null as smallint) as pay_platform, total_price,
    case when topic = 'tb_order' then 'tb' else 'tm' end as plat from generated
  union all
  select 'pay', order_id, create_time, pay_amount, pay_source, pay_platform, null, null
  from generated_payments where pay_amount > 0""", GENERATED),
    "append_text": "select concat(event_type, 'World') as value from events",
}
