"""SQL for the registered queries, as DuckDB runs it on the driver's tables."""

from __future__ import annotations

from tillstream.plans.catalog import DAU_DAY, DOC_ID, SALES_DAY, SEARCH_ACTOR
from tillstream.sources.shop import HASH_MULTIPLIERS, HASH_PRIME

_LINE_CONTENT = ["l_orderkey", "cast(l_linenumber as bigint)", "l_partkey", "l_suppkey"]
_LINE_CONTENT += [f"cast(round({c} * 100) as bigint)" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
_LINE_CONTENT += ["cast(cast(l_shipdate as date) - date '1970-01-01' as bigint)"]


def _line_hash(multiplier: int) -> str:
    h = "cast(7 as bigint)"
    for value in _LINE_CONTENT:
        h = f"(({h} * {multiplier} + {value} % {HASH_PRIME}) % {HASH_PRIME})"
    return h


# Common table expressions for the views of sources/shop.py and the flow. A query names the last one it needs.
VIEWS: dict[str, str] = {
    "province_info": """
        select cast(n_nationkey as varchar) as id, n_name as name,
               cast(100000 + n_nationkey * 1000 as varchar) as area_code, 'XX-' || cast(n_nationkey as varchar) as iso_code
        from nation""",
    "user_info": """
        select cast(c_custkey as varchar) as id, case when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
               case c_custkey % 4 when 0 then '<20' when 1 then '20-29' when 2 then '30-39' else '40+' end as age_group
        from customer""",
    "user_status": "select c_custkey as user_id from customer where c_custkey % 10 = 0",
    "sku_info": """
        select cast(p_partkey as varchar) as id, cast(cast('0x' || left(md5(p_name), 15) as bigint) as varchar) as spu_id,
               cast(p_retailprice as varchar) as price, p_name as sku_name, split_part(p_brand, '#', 2) as tm_id,
               cast(cast('0x' || left(md5(p_type), 15) as bigint) as varchar) as category3_id,
               cast(null as varchar) as create_time, p_type as category3_name, p_name as spu_name, p_brand as tm_name
        from part""",
    "line": f"""
        select {_line_hash(HASH_MULTIPLIERS[0])} * {HASH_PRIME} + {_line_hash(HASH_MULTIPLIERS[1])} as id,
               l_orderkey as order_id, l_partkey as sku_id, cast(round(l_quantity) as bigint) as sku_num,
               cast(round(l_extendedprice * 100 / l_quantity) as bigint) as order_price_c
        from lineitem""",
    "head": """
        select o_orderkey as id, cast(c_nationkey as bigint) as province_id, o_orderstatus as order_status,
               o_custkey as user_id, (o_orderkey % 50) * 100 as benefit_reduce_c, (o_orderkey % 20) * 100 as feight_fee_c,
               cast(o_orderdate + (o_orderkey * 7919 % 86400) * interval '1' second as varchar) as create_time
        from orders join customer on c_custkey = o_custkey""",
    "ord": """
        select head.*, amt as original_total_c, amt - benefit_reduce_c + feight_fee_c as final_total_c
        from head join (select order_id, cast(sum(order_price_c * sku_num) as bigint) as amt from line group by 1) t
             on t.order_id = head.id""",
    "flagged": """
        select o.*, case when s.user_id is null
                 and rank() over (partition by o.user_id order by o.create_time, o.id) = 1 then '1' else '0' end
               as if_first_order
        from {orders} o left join user_status s on s.user_id = o.user_id""",
    "pair": """
        select distinct l.order_id, l.id as order_detail_id, l.sku_id, l.sku_num, l.order_price_c,
               l.order_price_c * l.sku_num as amount_c, o.original_total_c, o.final_total_c, o.create_time, o.province_id
        from line l join (select distinct * from ord) o on o.id = l.order_id""",
    "share": """
        select *, case when original_total_c = 0 then 0 else
               cast((cast(2 as hugeint) * final_total_c * amount_c + original_total_c) // (2 * original_total_c) as bigint)
               end as share_c, row_number() over (partition by order_id order by order_detail_id desc) as rn
        from pair""",
    "alloc": """
        select *, cast(case when rn = 1 then final_total_c
                   - coalesce(sum(case when rn > 1 then share_c end) over (partition by order_id), 0)
                   else share_c end as bigint) as final_detail_c
        from share""",
    "start_log": """
        select event_id, 'mid_' || user_id as mid, cast(user_id as varchar) as uid, 'ar_' || (user_id % 34) as ar,
               'ch_' || (user_id % 5) as ch, 'v2.' || (user_id % 3) as vc, epoch_us(ts) // 1000 as ts,
               date_trunc('millisecond', ts) + interval '8' hour as local_ts
        from events where event_type = 'view'""",
    "dau": """
        select mid, uid, ar, ch, vc, dt, hr, mi, ts from (
          select *, cast(cast(local_ts as date) as varchar) as dt, cast(extract(hour from local_ts) as varchar) as hr,
                 '00' as mi,
                 row_number() over (partition by cast(local_ts as date), mid order by ts, event_id) as rn
          from start_log) where rn = 1""",
    "change": """
        select o_orderkey as k, case when o_orderkey % 5 = 0 then 'ods_order_detail' else 'ods_order_info' end as topic,
               cast(o_custkey as varchar) as user_id, o_orderstatus as order_status
        from orders where o_orderkey % 7 <> 0""",
    "entry": """
        select o_orderkey as k, case when o_orderkey % 3 = 0 then 'order_detail' else 'order_info' end as "table",
               o_orderstatus as s
        from orders where o_orderkey % 10 not in (0, 9) and o_orderkey % 4 <> 0""",
    "token": """
        select doc_id as id, n_chars as score, lang, source, text,
               list_has_any(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), ['the', 'eau']) as hit
        from documents""",
}

NEEDS = {
    "ord": ["head", "line"], "flagged": ["user_status"], "pair": ["line", "ord"], "share": ["pair"], "alloc": ["share"],
    "dau": ["start_log"],
}


def _with(views: list[str], select: str, flagged_from: str = "ord") -> str:
    order: list[str] = []

    def add(name):
        needs = NEEDS.get(name, []) + ([flagged_from] if name == "flagged" else [])
        for needed in needs:
            add(needed)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    texts = [f"{name} as ({VIEWS[name].replace('{orders}', flagged_from)})" for name in order]
    return f"with {', '.join(texts)} {select}"


_PAIR_ROWS = """
    select a.order_id, a.order_detail_id, a.sku_id, a.amount_c, k.tm_name, p.name as province_name
    from pair a left join sku_info k on k.id = cast(a.sku_id as varchar)
         left join province_info p on p.id = cast(a.province_id as varchar)"""

_MARK = r"(^|[^\p{L}\p{N}" "\x01" r"])(the|eau)([^\p{L}\p{N}" "\x02" r"]|$)"
_MARKED = "\\1\x01\\2\x02\\3"

CHECKS: dict[str, str] = {
    "log_route": """
        select event_id, case when event_type = 'view' then 'startup_log' else 'event_log' end as topic from events""",
    "cdc_insert_route": _with(["change"], """
        select topic, cast(k as varchar) as id, user_id, order_status from change where k % 4 in (2, 3) and k % 11 <> 0
        union all
        select topic, k || '-b', user_id, order_status from change where k % 4 in (2, 3) and k % 11 <> 0 and k % 3 = 0"""),
    "cdc_object_route": _with(["change"], """
        select topic, cast(k as varchar) as id, user_id, order_status from change
        where k % 4 = 1 or (k % 4 in (2, 3) and k % 11 <> 0)
        union all
        select topic, k || '-b', user_id, order_status from change where k % 4 in (2, 3) and k % 11 <> 0 and k % 3 = 0"""),
    "rowchange_flatten": _with(["entry"], """
        select "table", '{"id":"' || k || '","order_status":"' || s || '"}' as value from entry
        union all select "table", '{"id":"' || k || '-b","order_status":"' || s || '"}' from entry where k % 7 = 0"""),
    "rowchange_one_table": _with(["entry"], """
        select "table", '{"id":"' || k || '","order_status":"' || s || '"}' as value from entry where "table" = 'order_info'
        union all select "table", '{"id":"' || k || '-b","order_status":"' || s || '"}' from entry
        where k % 7 = 0 and "table" = 'order_info'"""),
    "dau_first_visit": _with(["dau"], "select * from dau"),
    "dau_total": _with(["dau"], f"select count(*) as value from dau where dt = '{DAU_DAY}'"),
    "dau_by_hour": _with(["dau"], f"select hr, count(*) as value from dau where dt = '{DAU_DAY}' group by hr"),
    "dau_hour_map": _with(["dau"], f"""
        select '{{' || coalesce(string_agg('"' || hr || '":' || n, ',' order by hr), '') || '}}' as result
        from (select hr, count(*) as n from dau where dt = '{DAU_DAY}' group by hr)"""),
    "dau_two_days": _with(["dau"], f"""
        select hr, nullif(count(*) filter (where dt = cast(date '{DAU_DAY}' - 1 as varchar)), 0) as yesterday,
               nullif(count(*) filter (where dt = '{DAU_DAY}'), 0) as today
        from dau where dt in ('{DAU_DAY}', cast(cast(date '{DAU_DAY}' - 1 as date) as varchar)) group by hr"""),
    "order_date_parts": """
        select o_orderkey as id, o_custkey as user_id, o_orderstatus as order_status,
               cast(cast(round(o_totalprice * 100) as bigint) as double) as final_total_amount, cast(0 as double) as feight_fee,
               substr(t, 1, 10) as create_date, substr(t, 12, 2) as create_hour
        from (select *, cast(o_orderdate + (o_orderkey * 7919 % 86400) * interval '1' second as varchar) as t from orders)""",
    "first_order_flag": _with(["flagged"], "select id, user_id, create_time, if_first_order from flagged", "head"),
    "first_order_users": _with(
        ["flagged"], "select cast(user_id as varchar) as user_id, '1' as if_consumed from flagged where if_first_order = '1'", "head"
    ),
    "first_orders_only": _with(["head"], """
        select user_id, id, create_time from (
          select *, row_number() over (partition by user_id order by create_time, id) as rn from head) where rn = 1"""),
    "single_order_users": "select o_custkey as user_id from orders group by 1 having count(*) = 1",
    "order_province": _with(["head", "province_info"], """
        select h.id, province_id, p.name as province_name, p.area_code as province_area_code, p.iso_code as province_iso_code
        from head h left join province_info p on p.id = cast(h.province_id as varchar)"""),
    "order_user": _with(["head", "user_info"], """
        select h.id, h.user_id, u.age_group as user_age_group, u.gender as user_gender
        from head h left join user_info u on u.id = cast(h.user_id as varchar)"""),
    "dim_sku": _with(["sku_info"], "select * from sku_info"),
    "dim_upsert_latest": """
        select cast(p_partkey as varchar) as id, case when p_partkey % 3 = 0 then 'new ' || p_name else p_name end as sku_name,
               cast(case when p_partkey % 3 = 0 then 2 else 1 end as integer) as version from part""",
    "order_detail_sku": _with(["line", "sku_info"], """
        select l.id, order_id, sku_id, sku_num, cast(order_price_c as double) / 100 as order_price,
               coalesce(cast(spu_id as bigint), 0) as spu_id, coalesce(cast(tm_id as bigint), 0) as tm_id,
               coalesce(cast(category3_id as bigint), 0) as category3_id, spu_name, tm_name, category3_name
        from line l left join sku_info k on k.id = cast(l.sku_id as varchar)"""),
    "order_wide": _with(["alloc", "flagged", "province_info", "user_info", "sku_info"], """
        select a.order_detail_id, a.order_id, f.order_status, f.create_time, f.user_id, a.sku_id,
               cast(a.order_price_c as double) / 100 as sku_price, a.sku_num, 'sku ' || a.sku_id as sku_name,
               cast(f.benefit_reduce_c as double) / 100 as benefit_reduce_amount,
               cast(f.feight_fee_c as double) / 100 as feight_fee,
               cast(f.original_total_c as double) / 100 as original_total_amount,
               cast(f.final_total_c as double) / 100 as final_total_amount,
               cast(a.final_detail_c as double) / 100 as final_detail_amount, f.if_first_order,
               p.name as province_name, p.area_code as province_area_code, u.age_group as user_age_group,
               u.gender as user_gender, substr(f.create_time, 1, 10) as dt,
               coalesce(cast(k.spu_id as bigint), 0) as spu_id, coalesce(cast(k.tm_id as bigint), 0) as tm_id,
               coalesce(cast(k.category3_id as bigint), 0) as category3_id, k.spu_name, k.tm_name, k.category3_name
        from alloc a join (select distinct * from flagged) f on f.id = a.order_id
             left join province_info p on p.id = cast(f.province_id as varchar)
             left join user_info u on u.id = cast(f.user_id as varchar)
             left join sku_info k on k.id = cast(a.sku_id as varchar)"""),
    "order_line_outer": _with(["line"], """
        select l.id as order_detail_id, l.order_id, l.sku_id, o.o_orderkey as id, o.o_orderstatus as order_status,
               case when o.o_orderkey is null then 'line_only' when l.id is null then 'order_only' else 'both' end as side
        from line l full outer join orders o on o.o_orderkey = l.order_id"""),
    "order_running_sums": _with(["alloc"], """
        select order_id, order_detail_id, amount_c, final_detail_c,
               cast(sum(amount_c) over w as bigint) as origin_sum_c, cast(sum(final_detail_c) over w as bigint) as split_sum_c
        from alloc window w as (partition by order_id order by order_detail_id rows unbounded preceding)"""),
    "paid_allocation": _with(["alloc"], """
        select order_id, order_detail_id, sku_id, amount_c, cast(final_detail_c as double) / 100 as final_detail_amount
        from alloc"""),
    "trademark_sales": _with(["alloc", "sku_info"], """
        select coalesce(cast(tm_id as bigint), 0) as tm_id, tm_name,
               cast(cast(sum(final_detail_c) as bigint) as double) / 100 as amount
        from alloc left join sku_info k on k.id = cast(alloc.sku_id as varchar) group by 1, 2"""),
    "sales_day_total": _with(["alloc"], f"""
        select cast(cast(sum(final_detail_c) as bigint) as double) / 100 as sum_amount from alloc
        where substr(create_time, 1, 10) = '{SALES_DAY}'"""),
    "sales_by_hour": _with(["alloc"], f"""
        select substr(create_time, 12, 2) as hr, cast(cast(sum(final_detail_c) as bigint) as double) / 100 as am from alloc
        where substr(create_time, 1, 10) = '{SALES_DAY}' group by 1"""),
    "sliding_window_sales": """
        select cast(s as varchar) as window_start, cast(s + interval '20' second as varchar) as window_end,
               cast(cast(sum(value_c) as bigint) as double) / 100 as amount, count(*) as n
        from (select value_c, time_bucket(interval '5 seconds', ts) - b * interval '5' second as s
              from (select ts, cast(round(value * 100) as bigint) as value_c from events), range(4) r(b))
        group by s""",
    "doc_by_id": f"select doc_id as id, text as name, n_chars as score from documents where doc_id = {DOC_ID}",
    "search_match": _with(["token"], "select id, score from token where hit"),
    "search_term": f"""
        select doc_id as id, n_chars as score from documents where lang = '{SEARCH_ACTOR}' or source = '{SEARCH_ACTOR}'""",
    "search_bool": _with(["token"], f"""
        select id, score from token where hit and (lang = '{SEARCH_ACTOR}' or source = '{SEARCH_ACTOR}')"""),
    "search_page": _with(["token"], f"""
        select id, score from token where hit and (lang = '{SEARCH_ACTOR}' or source = '{SEARCH_ACTOR}')
        order by score desc, id limit 20"""),
    "search_page_ascending": _with(["token"], f"""
        select id, score from token where hit and (lang = '{SEARCH_ACTOR}' or source = '{SEARCH_ACTOR}')
        order by score, id limit 10 offset 10"""),
    "search_highlight": _with(["token"], f"""
        select id, replace(replace(regexp_replace(regexp_replace(text, '{_MARK}', '{_MARKED}', 'gi'), '{_MARK}', '{_MARKED}', 'gi'),
                           '\x01', '<em>'), '\x02', '</em>') as highlight
        from token where hit"""),
    "search_total": "select count(*) as total from documents",
    "offset_ledger_resume": """
        select 'event_readers' as group_id, 'events' as topic, cast(event_id % 4 as integer) as partition_id,
               max(event_id // 4) + 1 as topic_offset
        from events group by 3""",
    "dau_first_visit_stream": _with(["dau"], "select dt, mid, uid from dau"),
    "first_order_flag_stream": _with(["flagged"], """
        select user_id, count(*) as n_orders, cast(sum(cast(if_first_order as integer)) as bigint) as n_first
        from flagged group by user_id"""),
    "order_wide_stream": _with(["pair", "sku_info", "province_info"], _PAIR_ROWS),
    "order_wide_stream_delayed": _with(["pair", "sku_info", "province_info"], _PAIR_ROWS),
    # An order whose lines never add up to its total stays open: its lines keep their plain shares.
    "paid_allocation_stream": _with(["share"], """
        select order_id, count(*) as n_lines,
               cast(cast(case when sum(amount_c) = max(original_total_c) then max(final_total_c) else sum(share_c) end as bigint)
                    as double) / 100 as paid
        from share group by order_id"""),
    "trademark_sales_stream": _with(["alloc", "sku_info"], """
        select coalesce(tm_id, '0') as trademark_id, tm_name as trademark_name,
               cast(cast(sum(final_detail_c) as bigint) as double) / 100 as amount
        from alloc left join sku_info k on k.id = cast(alloc.sku_id as varchar) group by 1, 2"""),
    "topic_offsets_resume": "select event_id, event_type from events",
    "trademark_stats_published": _with(["alloc", "sku_info"], """
        select coalesce(tm_id, '0') as trademark_id, tm_name as trademark_name,
               cast(cast(sum(final_detail_c) as bigint) as double) / 100 as amount
        from alloc left join sku_info k on k.id = cast(alloc.sku_id as varchar) group by 1, 2"""),
    "first_order_flag_keyed": _with(["flagged"], """
        select id, user_id, province_id, order_status, create_time, cast(final_total_c as double) / 100 as final_total_amount,
               cast(benefit_reduce_c as double) / 100 as benefit_reduce_amount,
               cast(original_total_c as double) / 100 as original_total_amount, cast(feight_fee_c as double) / 100 as feight_fee,
               if_first_order
        from flagged"""),
    # The lines of an order come by the remainder of their id; what is left goes to the greatest of the last to come.
    "paid_allocation_keyed": _with(["share"], """
        select order_id, order_detail_id, sku_id, sku_num, order_status, create_time, amount_c,
               cast(cast(case when k = 1 then final_total_c - total + share_c else share_c end as bigint) as double) / 100
               as final_detail_amount
        from (select share.*, head.order_status, sum(share_c) over (partition by order_id) as total,
                     row_number() over (partition by order_id order by order_detail_id % 5 desc, order_detail_id desc) as k
              from share join (select distinct id, order_status from ord) head on head.id = share.order_id)"""),
    "dau_first_visit_keyed": _with(["dau"], "select * from dau"),
    "order_line_outer_stream": _with(["line"], """
        select l.id as order_detail_id, l.order_id, l.sku_id, o.o_orderkey as id, o.o_orderstatus as order_status,
               case when o.o_orderkey is null then 'line_only' when l.id is null then 'order_only' else 'both' end as side
        from (select distinct id, order_id, sku_id from line where order_id % 17 <> 0) l
             full outer join (select * from orders where o_orderkey % 13 <> 0) o on o.o_orderkey = l.order_id"""),
    "sku_snapshot_lookup": _with(["line"], """
        select l.id, cast(sku_id as varchar) as sku_id, case when p_partkey % 3 = 0 then 'new ' || p_name else p_name end as sku_name
        from line l left join part on p_partkey = l.sku_id"""),
    "batch_ranges_ledger": "select count(*) as records, count(*) as span from events",
    "dau_on_days_of_a_user": _with(["dau"], """
        select dt, count(*) as value from dau where dt in (select dt from dau where uid = '1') group by dt"""),
    "order_user_sharded": _with(["head", "user_info"], """
        select h.id, h.user_id, u.age_group as user_age_group, u.gender as user_gender
        from head h left join user_info u on u.id = cast(h.user_id as varchar)"""),
}
