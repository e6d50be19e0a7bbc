"""The registered queries in SQL, written from the definitions and not from the Spark code."""

from __future__ import annotations

from checks.queries import AS_OF, REPORT_DAY
from tidemart.testbed import BRANDS, CATEGORIES, KEYWORD_TYPES


BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]

# Share of each factor, and its weight per level for the bands above.
FACTOR_SHARE = {"category": "0.30", "brand": "0.20", "price": "0.15", "day_part": "0.10",
                "keyword": "0.15", "os": "0.10"}
FACTOR_WEIGHTS = {
    "category": {"潮流服饰": [.9, .8, .6, .4, .2, .1],
                 "家具用品": [.2, .4, .6, .8, .9, .7],
                 "健康食品": [.1, .2, .4, .6, .8, .9]},
    "brand": {"设备类": [.9, .7, .5, .3, .2, .1],
              "服饰类": [.1, .3, .5, .7, .8, .9]},
    "price": {"高价商品": [.1, .2, .3, .4, .5, .6],
              "中价商品": [.2, .4, .6, .7, .8, .7],
              "低价商品": [.8, .6, .4, .3, .2, .1]},
    "day_part": {"凌晨": [.2, .1, .1, .1, .1, .1],
                 "早晨": [.1, .1, .1, .1, .2, .3],
                 "上午": [.2, .2, .2, .2, .3, .4],
                 "中午": [.4, .4, .4, .4, .4, .3],
                 "下午": [.4, .5, .5, .5, .5, .4],
                 "晚上": [.8, .7, .6, .5, .4, .3],
                 "夜间": [.9, .7, .5, .3, .2, .1]},
    "keyword": {"时尚与潮流": [.9, .7, .5, .3, .2, .1],
                "性价比": [.2, .4, .6, .7, .8, .8],
                "健康与养生": [.1, .2, .4, .6, .8, .9],
                "家庭与育儿": [.1, .2, .4, .6, .8, .7],
                "科技与数码": [.8, .6, .4, .3, .2, .1],
                "学习与发展": [.4, .5, .6, .7, .8, .7]},
    "os": {"Android": [.8, .7, .6, .5, .4, .3],
           "iOS": [.7, .6, .5, .4, .3, .2]},
}

# The types of categories and brands, and which belong to which.
CATEGORY_LEVELS = {
    "潮流服饰": ["珠宝", "礼品箱包", "鞋靴", "服饰内衣", "个护化妆"],
    "家具用品": ["母婴", "钟表", "厨具", "电脑办公", "家居家装", "家用电器", "图书、音像、电子书刊", "手机", "汽车用品", "数码"],
    "健康食品": ["运动健康", "食品饮料、保健食品"],
}
BRAND_LEVELS = {
    "设备类": ["Redmi", "苹果", "联想", "TCL", "小米"],
    "服饰类": ["长粒香", "金沙河", "索芙特", "CAREMiLLE", "欧莱雅", "香奈儿"],
}


def _ms(key: str) -> str:
    return f"(1704067200000 + (({key}) * 7919 % 2592000) * 1000)"


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _day(ms: str) -> str:
    return f"cast(epoch_ms({ms}) as date)"


def _text(ms: str, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(epoch_ms(cast({ms} as bigint)), '{pattern}')"


def _window(ts: str, size_ms: int) -> str:
    """The three label columns of a tumbling window."""
    start = f"({ts} - {ts} % {size_ms})"
    return (f"{_text(start)} as stt, {_text(f'{start} + {size_ms}')} as edt, "
            f"{_text(start, '%Y-%m-%d')} as cur_date")


SECOND, HOUR, DAY = 1000, 3_600_000, 86_400_000

# -- derived inputs -------------------------------------------------------------------------

CTE = {
    "logs": """select event_id, user_id, event_type, cast(user_id as varchar) as uid, 'mid_' || user_id as mid,
        'v' || (user_id % 3) as vc, 'ch' || (event_id % 5) as ch, cast(user_id % 25 as varchar) as ar,
        cast(event_id % 2 as varchar) as is_new,
        case when user_id % 2 = 0 then 'Android' else 'iOS' end as os,
        case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'signup' then 'login'
            when 'purchase' then 'payment' else 'error' end as page_id,
        case event_id % 4 when 1 then 'login' when 2 then 'search' when 3 then 'home' end as last_page_id,
        case when event_id % 4 = 2 then 'k' || regexp_extract(props, '(\\d+)', 1) || ' ' || event_type
            else cast(event_id % 100 as varchar) end as item,
        event_id % 4 = 2 as is_keyword, case when event_id % 4 = 2 then 'k' || regexp_extract(props, '(\\d+)', 1)
            || ' ' || event_type end as keyword,
        cast(trunc(value * 1000) as bigint) as during_time, epoch_us(ts) // 1000 as ts from events""",
    "sent": "select * from logs where event_id % 500 <> 7 and event_id % 50 <> 0",
    "first_visit": f"""select mid, arg_min(case when is_new = '1' then {_day('ts')} else {_day('ts')} - 1 end, ts) as d
        from sent group by mid""",
    "repaired": f"""select s.* exclude (is_new), case when is_new = '1' and d <> {_day('ts')} then '0' else is_new end
        as is_new from sent s join first_visit using (mid)""",
    "lines": f"""select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as sku_id,
        'sku ' || l_partkey as sku_name, {_ms('l_orderkey')} as create_time, cast(l_quantity as bigint) as sku_num,
        cast(l_extendedprice as decimal(16,2)) as price,
        cast(cast(l_extendedprice as decimal(16,2)) * cast(l_discount as decimal(4,2)) as decimal(16,2)) as off,
        cast(cast(l_extendedprice as decimal(16,2)) * cast(l_tax as decimal(4,2)) as decimal(16,2)) as coupon,
        l_orderkey % 25 as province_id, l_linenumber as line, l_suppkey as supp,
        {_ms('l_orderkey')} + l_partkey % 90 * 1000 + l_linenumber * 100 as ts_ms,
        l_partkey * 100000 + date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as seq, l_returnflag from lineitem""",
    "amounts": """select *, cast(sku_num as decimal(16,2)) * price as original, price - off - coupon as paid
        from lines""",
    "activity": """select distinct l_orderkey * 10 + l_linenumber as id from lineitem where l_discount > 0.05""",
    "coupon_ids": """select distinct l_orderkey * 10 + l_linenumber as id from lineitem where l_tax > 0.04""",
    "details": f"""select a.id, a.order_id, o_custkey as user_id, a.sku_id, a.sku_name, a.province_id,
        case when act.id is not null then a.id % 4 + 1 end as activity_id,
        case when act.id is not null then a.id % 7 + 1 end as activity_rule_id,
        case when cou.id is not null then a.id % 3 + 1 end as coupon_id,
        {_text('create_time', '%Y-%m-%d')} as date_id, create_time, sku_num,
        cast(original as double) as split_original_amount, cast(off as double) as split_activity_amount,
        cast(coupon as double) as split_coupon_amount, cast(paid as double) as split_total_amount, ts_ms
        from amounts a join orders on a.order_id = o_orderkey left join activity act on a.id = act.id
        left join coupon_ids cou on a.id = cou.id""",
    "order_rows": f"""select o_orderkey as id, o_custkey as user_id, o_orderstatus as st, o_orderpriority as prio,
        cast(cast(o_totalprice as decimal(16,2)) * 0.02 as decimal(16,2)) as total, {_ms('o_orderkey')} as t0,
        {_ms('o_orderkey')} + o_orderkey % 40 * 60000 as t1 from orders""",
    "order_events": """select id, user_id, prio, total, 'c' as op, '1001' as status, t0 as ts_ms from order_rows
        union all select id, user_id, prio, total, 'u',
            case st when 'F' then '1002' when 'O' then '1003' else '1005' end, t1 from order_rows
        union all select id, user_id, prio, total, 'u', '1006', t1 + 60000 from order_rows
            where st = 'P' and id % 2 = 0""",
    "dic": """select cast(b + n_nationkey as varchar) as dic_code, 'name ' || (b + n_nationkey) as dic_name
        from nation, (values (1100), (1200), (1300), (1500)) v(b)""",
    "carts": f"""select l_orderkey * 10 + l_linenumber as id, l_suppkey as user_id, l_partkey as sku_id,
        case when l_linenumber % 3 = 1 then l_partkey % 5 - 2 else cast(l_quantity as bigint) end as sku_num,
        {_ms('l_orderkey')} + l_linenumber * 1000 as ts_ms from lineitem
        where l_linenumber % 3 <> 1 or l_partkey % 5 - 2 > 0""",
    "returned": f"""select l_orderkey * 10 + l_linenumber as id, l_suppkey as user_id, l_orderkey as order_id,
        l_partkey as sku_id, cast(l_quantity as bigint) as refund_num, l_extendedprice as amount,
        l_linenumber as line, {_ms('l_orderkey')} + 3600000 as t0 from lineitem where l_returnflag = 'R'""",
    "comments": f"""select doc_id as id, case when doc_id % 4 = 0 then text || ',badword' || doc_id % 40 else text end as msg, doc_id % 150 as user_id,
        doc_id % 200 as sku_id, doc_id % 50 as spu_id, cast(1200 + doc_id % 30 as varchar) as appraise,
        source as nick_name, {_ms('doc_id')} as create_time, {_ms('doc_id')} + (doc_id % 5 - 2) * 40000 as ts_ms
        from documents""",
    "words": """select distinct unnest(regexp_extract_all(lower(text), '(\\p{L}{9,})', 1)) as word from benchmark
        union select 'badword' || n_nationkey from nation""",
    "users": f"""select c_custkey as id, c_name as name, date '1970-01-01' + cast(c_custkey * 137 % 21000 - 3650 as int)
        as birthday, case c_custkey % 3 when 1 then 'M' when 2 then 'F' else 'home' end as gender,
        {_ms('c_custkey * 3')} as ts_ms, {_ms('c_custkey * 3')} + (c_custkey % 7 - 3) * 1500000 as body_ms
        from customer""",
    "aged": f"""select *, year(date '{AS_OF}') - year(birthday)
        - cast(strftime(date '{AS_OF}', '%m%d') < strftime(birthday, '%m%d') as bigint) as age from users""",
    "banded": """select *, case when age < 18 then '0-17' when age < 25 then '18-24' when age < 30 then '25-29'
        when age < 35 then '30-34' when age < 40 then '35-39' when age < 50 then '40-49' else '50+' end as age_band,
        (year(birthday) // 10 * 10) || '年代' as era,
        case when md < 120 or md >= 1222 then '摩羯座' when md < 219 then '水瓶座' when md < 321 then '双鱼座'
            when md < 420 then '白羊座' when md < 521 then '金牛座' when md < 621 then '双子座'
            when md < 723 then '巨蟹座' when md < 823 then '狮子座' when md < 923 then '处女座'
            when md < 1023 then '天秤座' when md < 1122 then '天蝎座' else '射手座' end as sign
        from (select *, month(birthday) * 100 + day(birthday) as md from aged)""",
    "attributes": """select *, cast(id % 50 + 150 as varchar) as height, cast(id % 60 + 40 as varchar) as weight
        from banded where abs(body_ms - ts_ms) <= 3600000""",
    "products": f"""select p_partkey as sku_id, p_name as sku_name, p_partkey % 100 as spu_id, s_name as spu_name,
        p_partkey % 12 as tm_id, {_list(BRANDS)}[p_partkey % 12 + 1] as tm_name,
        cast(p_size % 25 as bigint) as category3_id, n.n_name as category3_name,
        cast(p_size % 25 % 30 as bigint) as category2_id, 'sub ' || n.n_name as category2_name,
        cast(p_size % 25 % 18 as bigint) as category1_id, {_list(CATEGORIES)}[p_size % 25 % 18 + 1] as category1_name
        from part left join supplier on p_partkey % 100 = s_suppkey left join nation n on p_size % 25 = n_nationkey""",
    "part_events": """select p_partkey as id, 'r' as op, 1704067200000 + p_partkey as ts_ms, null as old_name,
            p_name as new_name, p_brand as brand, p_size as size from part
        union all select p_partkey, 'u', 1705067200000 + p_partkey, p_name, p_name || ' new', p_brand, p_size
            from part where p_partkey % 3 = 0
        union all select p_partkey, 'd', 1706067200000 + p_partkey, p_name, null, p_brand, p_size
            from part where p_partkey % 7 = 0""",
    "views": """select *, case when last_page_id is null then 1 else 0 end as sv from logs""",
    "logins": "select * from logs where last_page_id is null or last_page_id = 'login'",
    "login_days": f"""select uid, {_day('ts')} as day, min(ts) as ts from logins group by all""",
    "login_gaps": "select *, lag(day) over (partition by uid order by day) as last_day from login_days",
    "ranked_lines": """select *, row_number() over (partition by id order by ts_ms desc, seq desc) as rn from amounts""",
}

# What each derived input needs before it.
NEEDS = {
    "sent": ["logs"], "first_visit": ["sent"], "repaired": ["first_visit"], "amounts": ["lines"],
    "details": ["amounts", "activity", "coupon_ids"], "order_events": ["order_rows"], "aged": ["users"],
    "banded": ["aged"], "attributes": ["banded"], "views": ["logs"], "logins": ["logs"], "login_days": ["logins"],
    "login_gaps": ["login_days"], "ranked_lines": ["amounts"],
}

_ORACLE: dict[str, str] = {}


def _with(names: list[str], sql: str) -> str:
    order: list[str] = []

    def add(name):
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return sql
    head = ", ".join(f"{n} as ({CTE[n]})" for n in order)
    return f"with {head}, " + sql[5:] if sql.startswith("with ") else f"with {head} {sql}"


def oracle(name: str, needs: str, sql: str) -> None:
    _ORACLE[name] = _with(needs.split(), sql)


def statements() -> dict[str, str]:
    return dict(_ORACLE)


# -- sources --------------------------------------------------------------------------------

oracle("src_change_feed", "part_events", f"""select 'part' as source_table, op, ts_ms, {_text('ts_ms')} as et,
    old_name, new_name from part_events where ts_ms % 100 <> 77""")
oracle("src_snapshot_events", "", """select 'r' as op, 1704067200000 as ts_ms, c_custkey, c_name, c_acctbal,
    c_mktsegment from customer""")
oracle("src_page_log_maps", "logs", f"""select mid, page_id, during_time, ts, {_text('ts')} as et from logs""")
oracle("src_word_list", "words", "select word from words")

oracle("src_word_list_file", "words", "select word from words")
oracle("src_text_messages", "", "select event_id || ' ' || event_type as value from events")
oracle("src_dictionary", "dic", "select dic_code, dic_name from dic")

# -- event filters and projections ----------------------------------------------------------

oracle("src_snapshot_then_changes", "", """with c as (select c_custkey as id, cast(c_acctbal as double) as balance,
        c_custkey * 37 % 1000 + 1 as "at", 300 + (c_custkey // 100) * 29 % 500 as high from customer)
    select 'r' as op, id, case when id % 15 = 0 and "at" + 520 <= high then cast(0 as double) when id % 3 = 0 and "at" <= high then balance + 1
        else balance end as balance, high as pos from c
        where id % 5 <> 0 or "at" + 500 > high or (id % 15 = 0 and "at" + 520 <= high)
    union all select 'u', id, balance + 1, "at" from c where id % 3 = 0 and "at" > high
    union all select 'd', id, null, "at" + 500 from c where id % 5 = 0 and "at" + 500 > high
    union all select 'c', id, cast(0 as double), "at" + 520 from c where id % 15 = 0 and "at" + 520 > high
    union all select 'c', id + 10000000, balance, "at" from c where id % 7 = 0 and "at" > 200""")
oracle("etl_valid_events", "part_events", """select op, id, ts_ms from part_events
    union all select 'r', s_suppkey, 1704067200000 + s_suppkey from supplier""")
oracle("etl_drop_bootstrap", "part_events", "select op, id, ts_ms from part_events where ts_ms % 2 = 0")
oracle("etl_drop_deletes", "part_events", "select op, id, ts_ms from part_events where op <> 'd'")
oracle("etl_transitions", "order_rows returned", """
    select 'cancelled' as kind, id as order_id, t1 as ts_ms from order_rows where st = 'O'
    union all select 'paid', id, t1 from order_rows where st = 'F'
    union all select 'refunding', id, t1 from order_rows where st = 'P'
    union all select 'refunded', id, t1 + 60000 from order_rows where st = 'P' and id % 2 = 0
    union all select 'returned', order_id, t0 + 60000 from returned where line % 2 = 1
    union all select 'paid_back', order_id, t0 + 90000 from returned where line % 2 = 1""")
oracle("etl_logins", "logins", "select event_id, uid, ts from logins")
oracle("etl_searches", "logs", "select event_id, item as full_word, ts from logs where is_keyword")
oracle("etl_page_views", "views", """select mid, vc, ch, ar, is_new, cast(sv as bigint) as sv, cast(1 as bigint) as pv,
    during_time, ts from views""")
oracle("etl_log_profile", "logs", "select uid, ts, os, keyword from logs")
oracle("etl_keyword_profile", "logs", "select uid, ts, os, keyword from logs where keyword is not null")
oracle("etl_flat_comments", "comments", """select ts_ms, 'shop' as db, 'comment_info' as "table", '1' as server_id,
    'c' as op, appraise, nick_name, create_time, user_id, sku_id, id, spu_id, id as order_id, md5(msg) as comment_txt
    from comments""")
oracle("etl_flat_orders", "order_events", f"""select op, ts_ms as tm_ms, id, user_id, id % 25 as province_id,
    status as order_status, cast(total as double) as original_total_amount, 'c' || user_id as consignee,
    prio as trade_body, {_text('ts_ms', '%Y%m%d')} as ds from order_events""")

# -- logs -----------------------------------------------------------------------------------

oracle("log_errors", "repaired", """select mid, is_new, cast(event_id % 10 + 1000 as varchar) as error_code, ts
    from repaired where event_type = 'error'""")
oracle("log_starts", "repaired", "select mid, is_new, 'icon' as entry, ts from repaired where event_type = 'signup'")
oracle("log_displays", "repaired", """select mid, is_new, page_id, i as pos_seq,
    cast((event_id + i) % 35 as varchar) as item, ts
    from (select *, unnest(range(1, event_id % 3 + 1)) as i from repaired where event_type <> 'signup')""")
oracle("log_actions", "repaired", """select mid, is_new, page_id, 'cart_add' as action_id,
    cast(event_id % 35 as varchar) as item from repaired where event_type = 'click'""")
oracle("log_pages", "repaired", """select mid, is_new, page_id, last_page_id, item, during_time, ts from repaired
    where event_type <> 'signup'""")
oracle("log_records", "repaired", """select 'err' as kind, mid, is_new, item from repaired where event_type = 'error'
    union all select 'start', mid, is_new, item from repaired where event_type = 'signup'
    union all select 'page', mid, is_new, item from repaired where event_type <> 'signup'
    union all select 'action', mid, is_new, cast(event_id % 35 as varchar) from repaired where event_type = 'click'
    union all select 'display', mid, is_new, cast((event_id + i) % 35 as varchar)
    from (select *, unnest(range(1, event_id % 3 + 1)) as i from repaired where event_type <> 'signup')""")
oracle("log_dirty", "", "select '{cut ' || event_id as dirty from events where event_id % 50 = 0 and event_id % 500 <> 7")
for _name in ("visitor_repair", "visitor_repair_hot_devices"):
    oracle(_name, "logs", f"""with fv as (select mid, arg_min(case when is_new = '1' then {_day('ts')} else
        {_day('ts')} - 1 end, ts) as d from logs group by mid)
        select mid, case when is_new = '1' and d <> {_day('ts')} then '0' else is_new end as is_new, event_id
        from logs join fv using (mid)""")

# -- routing --------------------------------------------------------------------------------

oracle("dim_changes", "part_events", """select 'dim_part' as sink_table, 'info' as sink_family,
        cast(id as varchar) as row_key, op, ts_ms, 'brand=' || brand || ',id=' || id || ',name='
        || case when op = 'd' then old_name else new_name end as data from part_events
    union all select 'dim_supplier', 'info', cast(s_suppkey as varchar), 'r', 1704067200000 + s_suppkey,
        'id=' || s_suppkey || ',name=' || s_name || ',nation=' || s_nationkey from supplier""")
oracle("dim_current_rows", "part_events", """with newest as (select *, row_number() over
        (partition by id order by ts_ms desc) as rn from part_events)
    select 'dim_part' as sink_table, cast(id as varchar) as row_key,
        'brand=' || brand || ',id=' || id || ',name=' || new_name as data, ts_ms from newest where rn = 1 and op <> 'd'
    union all select 'dim_supplier', cast(s_suppkey as varchar),
        'id=' || s_suppkey || ',name=' || s_name || ',nation=' || s_nationkey, 1704067200000 + s_suppkey
        from supplier""")
oracle("fact_routed_rows", "part_events", f"""select 'dwd_part_r' as sink_table,
        'brand=' || brand || ',id=' || id || ',size=' || size as data, ts_ms from part_events where op = 'r'
    union all select 'dwd_cart_info_c', 'id=' || (l_orderkey * 10 + l_linenumber) || ',sku_id=' || l_partkey
        || ',sku_num=' || cast(l_quantity as bigint) || ',user_id=' || l_suppkey,
        {_ms('l_orderkey')} + l_linenumber * 1000 from lineitem where l_linenumber % 3 = 0""")

oracle("fact_routed_as_of", "part_events", f"""select case when ts_ms < 1705067200100 then 'dwd_part_u' else 'dwd_part_later' end as sink_table,
        case when ts_ms < 1705067200100 then 'id=' || id || ',name=' || new_name else 'brand=' || brand || ',id=' || id end as data,
        ts_ms from part_events where op = 'u'
    union all select case when moment < 1704767200000 then 'dwd_cart' else 'dwd_cart_again' end, 'id=' || id || case when moment < 1704767200000
        then ',sku_num=' || num else '' end || ',user_id=' || supp, moment from (
        select l_orderkey * 10 + l_linenumber as id, cast(l_quantity as bigint) as num, l_suppkey as supp,
          {_ms('l_orderkey')} + l_linenumber * 1000 as moment from lineitem where l_linenumber % 3 = 0)
      where moment < 1704767200000 or moment >= 1705372000000""")

# -- facts ----------------------------------------------------------------------------------

oracle("fact_cart_add", "carts", "select id, user_id, sku_id, sku_num, ts_ms from carts")
for _name in ("fact_order_detail", "fact_order_detail_of_mixed_feed"):
    oracle(_name, "details", "select * from details")
_CANCEL = f"""select d.id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id,
    d.activity_rule_id, d.coupon_id, {_text('t1', '%Y-%m-%d')} as date_id, t1 as cancel_time, d.sku_num,
    d.split_original_amount, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, t1 as ts_ms
    from details d join order_rows o on d.order_id = o.id where st = 'O'"""
oracle("fact_order_cancel", "details order_rows", _CANCEL)
oracle("fact_order_cancel_recent", "details order_rows", f"{_CANCEL} and abs(t1 - d.ts_ms) <= 1805000")
oracle("fact_payment", "details order_rows dic", """select d.id as order_detail_id, d.order_id, d.user_id, d.sku_id,
    d.sku_name, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id, dic_code as payment_type_code,
    dic_name as payment_type_name, t1 as callback_time, d.sku_num, d.split_original_amount, d.split_activity_amount,
    d.split_coupon_amount, d.split_total_amount as split_payment_amount, t1 as ts_ms
    from order_rows o join details d on d.order_id = o.id join dic on dic_code = cast(1100 + o.id % 30 as varchar)
    where st = 'F' and d.ts_ms between t1 - 1800000 and t1 + 5000""")
oracle("fact_refund", "returned order_rows dic", f"""select r.id, r.user_id, order_id, sku_id, order_id % 25 as province_id,
    {_text('r.t0', '%Y-%m-%d')} as date_id, r.t0 as create_time, a.dic_code as refund_type_code,
    a.dic_name as refund_type_name, b.dic_code as refund_reason_type_code, b.dic_name as refund_reason_type_name,
    'reason ' || sku_id as refund_reason_txt, refund_num, amount as refund_amount, r.t0 as ts_ms
    from returned r join order_rows o on o.id = order_id and st = 'P'
    join dic a on a.dic_code = cast(1500 + sku_id % 27 as varchar)
    join dic b on b.dic_code = cast(1300 + sku_id % 26 as varchar)""")
oracle("fact_refund_payment", "returned order_rows dic", f"""select p.id, o.user_id, p.order_id, p.sku_id,
    p.order_id % 25 as province_id, dic_code as payment_type_code, dic_name as payment_type_name,
    {_text('p.t0 + 90000', '%Y-%m-%d')} as date_id, p.t0 + 90000 as callback_time, q.refund_num,
    p.amount as refund_amount, p.t0 + 90000 as ts_ms
    from returned p join returned q on p.order_id = q.order_id and p.sku_id = q.sku_id and q.line % 2 = 1
    join order_rows o on o.id = p.order_id and st = 'P' and o.id % 2 = 0
    join dic on dic_code = cast(1100 + p.sku_id % 28 as varchar) where p.line % 2 = 1""")
oracle("fact_comment", "comments dic", """select id, user_id, sku_id, appraise, dic_name as appraise_name,
    md5(msg) as comment_txt, ts_ms from comments join dic on appraise = dic_code""")
_COMMENT_ORDER = f"""select c.ts_ms, 'shop' as db, 'comment_info' as "table", '1' as server_id, 'c' as op, c.appraise,
    c.nick_name, c.create_time, c.user_id, c.sku_id, c.id, c.spu_id, c.id as order_id, c.msg,
    coalesce(dic_name, 'N/A') as dic_name, o.op as info_op, o.ts_ms as info_tm_ms, o.id as info_id,
    o.user_id as info_user_id, o.id % 25 as info_province_id, o.status as info_order_status,
    cast(o.total as double) as info_original_total_amount, 'c' || o.user_id as info_consignee,
    o.prio as info_trade_body, {_text('c.ts_ms', '%Y%m%d')} as ds
    from comments c left join dic on appraise = dic_code join order_events o on o.id = c.id
    and o.ts_ms between c.ts_ms - 60000 and c.ts_ms + 60000"""
oracle("fact_comment_order", "comments dic order_events",
       f"select * exclude (msg), md5(msg) as comment_txt from ({_COMMENT_ORDER})")

# -- joins ----------------------------------------------------------------------------------

oracle("join_lookup_sku", "lines", """select id, sku_id, seq, cast(p_size % 25 as bigint) as category3_id, p_partkey % 12 as tm_id
    from lines left join part on sku_id = p_partkey""")
oracle("join_lookup_as_of", "lines part_events", """select l.id, l.sku_id, l.seq, l.ts_ms,
    case when v.op <> 'd' then v.new_name end as part_name from lines l asof left join part_events v
    on l.sku_id = v.id and l.ts_ms >= v.ts_ms""")
oracle("join_lookup_two_roles", "dic", """select c_custkey, a.dic_code as type_code, b.dic_code as reason_code,
    a.dic_name as type_name, b.dic_name as reason_name from customer
    join dic a on a.dic_code = cast(1500 + c_custkey % 27 as varchar)
    join dic b on b.dic_code = cast(1300 + c_custkey % 26 as varchar)""")
oracle("join_lookup_default", "dic", """select c_custkey, cast(1200 + c_custkey % 30 as varchar) as appraise,
    coalesce(dic_name, 'N/A') as dic_name from customer left join dic
    on dic_code = cast(1200 + c_custkey % 30 as varchar)""")
oracle("join_product_chain", "products", "select * from products")
oracle("join_interval_changes", "lines order_events", """select l.id, l.order_id, l.seq, l.ts_ms,
    o.status as order_status, o.ts_ms as changed_ms from lines l join order_events o on o.id = l.order_id
    and o.op = 'u' and o.ts_ms between l.ts_ms - 60000 and l.ts_ms + 600000""")
oracle("join_interval_left", "lines order_rows", """select l.id, l.order_id, l.seq, l.ts_ms, o.t1 as paid_ms
    from lines l left join order_rows o on o.id = l.order_id and st = 'F'
    and t1 between l.ts_ms and l.ts_ms + 1200000""")

# -- deduplication --------------------------------------------------------------------------

oracle("ded_repeats", "users", "select id, name, ts_ms from users")
oracle("ded_equal_rows", "", "select distinct md5(text) as text, lang from documents")
oracle("ded_retracted_lines", "ranked_lines", """select id, ts_ms, seq, province_id, cast(paid as double) as amount
        from ranked_lines
    union all select id, ts_ms, seq, province_id, cast(-paid as double) from ranked_lines where rn > 1""")
oracle("ded_latest_lines", "ranked_lines", """select id, ts_ms, seq, sku_id, cast(paid as double) as amount
    from ranked_lines where rn = 1""")
oracle("ded_latest_records", "logs", """with late as (select event_id, uid,
        case when event_id % 3 = 0 then ts - 43200000 else ts end as ts from logs),
    seen as (select *, max(ts) over (partition by uid order by event_id
        rows between unbounded preceding and 1 preceding) as top from late)
    select event_id, uid, ts from seen where top is null or ts > top""")
oracle("ded_first_per_customer", "", f"""select o_custkey, o_orderkey, ts_ms, o_orderstatus from (select *,
    {_ms('o_orderkey')} as ts_ms, row_number() over (partition by o_custkey order by {_ms('o_orderkey')}, o_orderkey)
    as rn from orders) where rn = 1""")
oracle("ded_last_per_window", "logs", """select uid, ts, event_id from (select *, row_number() over
    (partition by uid, ts // 7200000 order by ts desc, event_id desc) as rn from logs) where rn = 1""")
oracle("running_profile", "logs", """select uid, event_id, count(*) over w as pv,
    array_to_string(list_sort(list_distinct(array_agg(os) over w)), ',') as os,
    coalesce(array_to_string(list_sort(list_distinct(list_filter(array_agg(keyword) over w, lambda x: x is not null))), ','),
        '') as keyword
    from logs window w as (partition by uid order by event_id rows between unbounded preceding and current row)""")

# -- first time today -----------------------------------------------------------------------

oracle("uv_daily_flag", "logs", f"""select mid, ts, event_id, cast(row_number() over
    (partition by mid, {_day('ts')} order by ts, event_id) = 1 as bigint) as uv from logs""")
oracle("uv_home_detail", "logs", f"""select mid, page_id, cast({_day('ts')} as varchar) as day, min(ts) as ts from logs
    where page_id in ('home', 'good_detail') group by all""")
oracle("uv_cart_users", "carts", f"""select user_id, cast({_day('ts_ms')} as varchar) as day, min(ts_ms) as ts_ms
    from carts group by all""")
oracle("uv_returning_users", "login_gaps", """select uid, ts, cast(1 as bigint) as uu_ct,
    cast(coalesce((ts - epoch_ms(last_day)) // 86400000 >= 2, false) as bigint) as back_ct from login_gaps""")

# -- windows --------------------------------------------------------------------------------


def _traffic(size: int) -> str:
    return f"""with flagged as (select *, cast(row_number() over (partition by mid, {_day('ts')}
        order by ts, vc, ch, ar, is_new) = 1 as bigint) as uv from views)
    select {_window('ts', size)}, vc, ch, ar, is_new, cast(sum(uv) as bigint) as uv_ct, cast(sum(sv) as bigint) as sv_ct,
    count(*) as pv_ct, cast(sum(during_time) as bigint) as dur_sum from flagged group by all"""


oracle("dws_traffic", "views", _traffic(10 * SECOND))
oracle("dws_traffic_daily", "views", _traffic(DAY))
oracle("dws_home_detail", "logs", f"""with firsts as (select mid, page_id, min(ts) as ts from logs
        where page_id in ('home', 'good_detail') group by mid, page_id, {_day('ts')})
    select {_window('ts', 10 * SECOND)}, cast(count(*) filter (page_id = 'home') as bigint) as home_uv_ct,
    cast(count(*) filter (page_id = 'good_detail') as bigint) as good_detail_uv_ct from firsts group by all""")


def _keywords(size: int) -> str:
    return f"""with found as (select ts, unnest(list_distinct(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')))
        as keyword from logs where is_keyword)
    select {_window('ts', size)}, keyword, count(*) as keyword_count from found group by all"""


oracle("dws_keywords", "logs", _keywords(SECOND))
oracle("dws_keywords_daily", "logs", _keywords(DAY))


def _logins(size: int) -> str:
    return f"""select {_window('ts', size)}, cast(sum(cast(coalesce((ts - epoch_ms(last_day)) // 86400000 >= 8, false)
        as bigint)) as bigint) as back_ct, count(*) as uu_ct from login_gaps group by all"""


oracle("dws_logins", "login_gaps", _logins(10 * SECOND))
oracle("dws_logins_daily", "login_gaps", _logins(DAY))


def _carts(size: int) -> str:
    return f"""with firsts as (select user_id, min(ts_ms) as ts from carts group by user_id, {_day('ts_ms')})
    select {_window('ts', size)}, count(*) as cart_add_uu_ct from firsts group by all"""


oracle("dws_cart_users", "carts", _carts(SECOND))
oracle("dws_cart_users_of_day", "carts", f"select * from ({_carts(HOUR)}) where cur_date = '{REPORT_DAY}'")


def _provinces(size: int) -> str:
    return f"""with summed as (select {_window('ts_ms', size)}, province_id, count(distinct order_id) as order_count,
        cast(sum(case when rn = 1 then paid else 0 end) as double) as order_amount from ranked_lines group by all)
    select stt, edt, cur_date, province_id, n_name as province_name, order_count, order_amount
    from summed left join nation on province_id = n_nationkey"""


oracle("dws_province_orders", "ranked_lines", _provinces(SECOND))
oracle("dws_province_orders_hourly", "ranked_lines", _provinces(HOUR))


def _skus(size: int) -> str:
    def net(column, name):
        return f"cast(sum(case when rn = 1 then {column} else 0 end) as double) as {name}"
    return f"""with summed as (select {_window('ts_ms', size)}, sku_id, {net('original', 'original_amount')},
        {net('off', 'activity_reduce_amount')}, {net('coupon', 'coupon_reduce_amount')}, {net('paid', 'order_amount')}
        from ranked_lines group by all)
    select stt, edt, cur_date, tm_id as trademark_id, tm_name as trademark_name, category1_id, category1_name,
    category2_id, category2_name, category3_id, category3_name, sku_id, sku_name, spu_id, spu_name, original_amount,
    activity_reduce_amount, coupon_reduce_amount, order_amount from summed left join products using (sku_id)"""


oracle("dws_sku_orders", "ranked_lines products", _skus(10 * SECOND))
oracle("dws_sku_orders_daily", "ranked_lines products", _skus(DAY))

# -- serving --------------------------------------------------------------------------------

oracle("ads_gmv", "ranked_lines", f"""select cast(sum(paid) as double) as order_amount from ranked_lines
    where rn = 1 and {_text('ts_ms', '%Y-%m-%d')} = '{REPORT_DAY}'""")
oracle("ads_province_amounts", "ranked_lines", f"""select n_name as province_name,
    cast(sum(case when rn = 1 then paid else 0 end) as double) as order_amount
    from ranked_lines left join nation on province_id = n_nationkey
    where {_text('ts_ms', '%Y-%m-%d')} = '{REPORT_DAY}' group by n_name""")
oracle("ads_top_channels", "views", f"""with flagged as (select *, row_number() over (partition by mid, {_day('ts')}
        order by ts, vc, ch, ar, is_new) as rn from views)
    select ch, cast(sum(cast(rn = 1 as bigint)) as bigint) as uv_ct from flagged
    where {_text('ts', '%Y-%m-%d')} = '{REPORT_DAY}' group by ch order by uv_ct desc, ch limit 3""")

# -- scalar functions -----------------------------------------------------------------------

_T = _ms("o_orderkey")
_T8 = f"({_T} + 28800000)"
oracle("fn_dates", "", f"""select o_orderkey, {_text(_T, '%Y-%m-%d')} as day, {_text(_T)} as at,
    {_text(_T8, '%Y-%m-%d')} as local_day, {_text(_T8, '%Y%m%d')} as day_key,
    {_T8} // 86400000 * 86400000 - 28800000 as local_midnight, {_T} as back, {_text(_T)} as from_seconds from orders""")
oracle("fn_people", "banded", """select id as c_custkey, cast(birthday as varchar) as birthday, age, age_band, era, sign,
    gender from banded""")


def _part(ms: str) -> str:
    hour = f"hour(epoch_ms({ms} + 28800000))"
    return (f"case when {hour} < 6 then '凌晨' when {hour} < 9 then '早晨' when {hour} < 12 then '上午' "
            f"when {hour} < 14 then '中午' when {hour} < 18 then '下午' when {hour} < 22 then '晚上' else '夜间' end")


def _price(amount: str) -> str:
    return f"case when {amount} < 1000 then '低价商品' when {amount} <= 4000 then '中价商品' else '高价商品' end"


oracle("fn_day_part_and_price_band", "", f"""select o_orderkey, {_part(_T)} as day_part,
    {_price('o_totalprice / 50')} as price_band from orders""")

_WEIGHTS = ", ".join(
    f"('{factor}', '{level}', '{band}', cast(round({weight} * {FACTOR_SHARE[factor]}, 3) as decimal(4,3)))"
    for factor, levels in FACTOR_WEIGHTS.items() for level, row in levels.items()
    for band, weight in zip(BANDS, row))
_LEVELS = ", ".join(f"('category', '{n}', '{level}')" for level, names in CATEGORY_LEVELS.items() for n in names) + \
    ", " + ", ".join(f"('brand', '{n}', '{level}')" for level, names in BRAND_LEVELS.items() for n in names)
_FACTORS = {"category": "category_score", "brand": "tm_score", "price": "price_sensitive_score",
            "day_part": "time_period_score", "keyword": "keyword_type_score", "os": "os_score"}


def _scored(source: str, band: str, columns: dict[str, str]) -> str:
    """``source`` with the six scores, looked up one by one in the table of weights."""
    joins, scores = "", []
    for factor, column in columns.items():
        level = f"r.{column}"
        if factor in ("category", "brand"):
            joins += f" left join levels l_{factor} on l_{factor}.factor = '{factor}' and l_{factor}.name = {level}"
            level = f"l_{factor}.level"
        joins += (f" left join weights w_{factor} on w_{factor}.factor = '{factor}' and w_{factor}.level = {level}"
                  f" and w_{factor}.band = r.{band}")
        score = f"w_{factor}.score"
        if factor == "category":
            score = f"case when list_contains({_list(BANDS)}, r.{band}) then {score} else -1 end"
        scores.append(f"cast({score} as decimal(6,3)) as {_FACTORS[factor]}")
    scores += ["l_category.level as category_type", "l_brand.level as tm_type"]
    parts = " + ".join(f"coalesce({c}, 0)" for c in _FACTORS.values())
    return f"""with weights(factor, level, band, score) as (values {_WEIGHTS}), levels(factor, name, level) as (values
        {_LEVELS}), rws as ({source}), parts as (select r.*, {', '.join(scores)} from rws r {joins}),
        totals as (select *, {parts} as total from parts)
        select * exclude ({', '.join(_FACTORS.values())}, total),
        {', '.join(f'cast({c} as double) as {c}' for c in _FACTORS.values())}, cast(total as double) as total_score,
        case when total >= .75 then '18-24' when total >= .69 then '25-29' when total >= .585 then '30-34'
            when total >= .47 then '35-39' when total >= .365 then '40-49' when total >= .26 then '50+' end
            as new_age_group from totals"""


_COLUMNS = {"category": "category", "brand": "brand", "price": "price", "day_part": "part", "keyword": "keyword_type",
            "os": "os"}
oracle("fn_age_scores", "", _scored(f"""select o_orderkey, {_list([*BANDS, '0-17'])}[o_orderkey % 7 + 1] as band,
    {_list(CATEGORIES)}[o_orderkey % 18 + 1] as category, {_list(BRANDS)}[o_orderkey % 12 + 1] as brand,
    {_price('o_totalprice / 50')} as price, {_part(_T)} as part, {_list(KEYWORD_TYPES)}[o_orderkey % 5 + 1]
    as keyword_type, ['Android', 'iOS', 'other'][o_orderkey % 3 + 1] as os from orders""", "band", _COLUMNS))

# -- text -----------------------------------------------------------------------------------

_WORDS_OF = "list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))"
oracle("txt_keywords", "", f"""with found as (select lang, unnest({_WORDS_OF.format('text')}) as keyword from documents)
    select lang, keyword, count(*) as texts from found group by all""")
_HAN = "['手机', '健康', '健康食品', '白色', '华为']"
oracle("txt_segments", "", f"""with found as (select lang, unnest(list_distinct(list_concat({_WORDS_OF.format('text')},
        case when doc_id % 2 = 0 then [{_HAN}[doc_id % 5 + 1], {_HAN}[doc_id % 3 + 1], '的'] else [] end))) as word from documents)
    select lang, word, count(*) as texts from found group by all""")
oracle("dws_keywords_segmented", "logs", f"""with found as (select ts, unnest(list_distinct(
        [{_HAN}[event_id % 5 + 1], {_HAN}[event_id % 3 + 1], '的'])) as keyword from logs
        where last_page_id = 'search' and event_id % 4 = 2)
    select {_window('ts', HOUR)}, keyword, count(*) as keyword_count from found group by all""")
_LAST = "regexp_extract(regexp_replace(msg, ',+$', ''), '([^,]*)$', 1)"
oracle("txt_last_piece_in_dictionary", "comments words", f"""with pieces as (select id, {_LAST} as piece from comments)
    select id, md5(piece) as piece, cast(word is not null as bigint) as in_dictionary
    from pieces left join words on piece = word""")
oracle("txt_membership_map", "words", f"""with found as (select doc_id, {_WORDS_OF.format('text')} as pieces
        from documents), flagged as (select doc_id, piece, word from (select doc_id, unnest(pieces) as piece from found)
        left join words on piece = word)
    select doc_id, count(*) as pieces, coalesce(string_agg(word, ',' order by word), '') as hits from flagged
    group by doc_id""")
_INSIDE = "list_sort(list_filter((select list(word) from words), lambda w: contains({0}, w)))"
oracle("txt_words_inside", "words", f"""select doc_id, array_to_string({_INSIDE.format('text')}, ',') as found
    from documents""")
oracle("txt_grade_last_piece", "comments words", f"""with pieces as (select id, {_LAST} as piece from comments)
    select id, cast(word is not null as bigint) as is_violation, case when word is not null then 'P0' else '' end
    as violation_grade, coalesce(word, '') as violation_msg from pieces left join words on piece = word""")
oracle("comment_moderation", "comments dic order_events words", f"""with joined as ({_COMMENT_ORDER}),
    once as (select order_id, ts_ms, min(row(user_id, info_consignee, ds, msg)) as r from joined group by all),
    rws as (select order_id, ts_ms, r[1] as user_id, r[2] as consignee, r[3] as ds, r[4] as msg from once),
    graded as (select rws.*, word, {_INSIDE.format('msg')} as inside from rws left join words on {_LAST} = word)
    select user_id, consignee, ts_ms, ds, md5(msg) as msg, cast(word is not null as bigint) as is_violation,
    case when word is not null then 'P0' when len(inside) > 0 then 'P1' else '' end as violation_grade,
    case when word is not null then word else array_to_string(inside, ', ') end as violation_msg from graded""")

# -- tags -----------------------------------------------------------------------------------

oracle("tag_user_attributes", "attributes", """select id, ts_ms, name, cast(birthday as varchar) as birthday, gender, age,
    age_band as age_group, era, sign as constellation, height, 'cm' as unit_height, weight, 'kg' as unit_weight
    from attributes""")
_ORDER_ROWS = """once_lines as (select id, ts_ms, min(row(sku_id, order_id, create_time)) as r from lines group by all),
    once_orders as (select id, ts_ms, min(user_id) as user_id, min(total) as total from order_events group by all),
    met as (select l.id, r[3] as create_time, greatest(l.ts_ms, o.ts_ms) as te,
        r[1] as sku_id, r[2] as order_id, o.user_id, o.total from once_lines l join once_orders o on o.id = r[2]
        and o.ts_ms between l.ts_ms - 60000 and l.ts_ms + 60000),
    order_age as (select m.id, m.sku_id, m.order_id, m.create_time, m.user_id, cast(m.total as double)
        as original_total_amount, m.te, category3_id, category2_id, category1_id, tm_id, tm_name,
        category1_name as category_name
        from (select *, row_number() over (partition by id, create_time order by te, sku_id) as rn from met) m
        left join products p on p.sku_id = m.sku_id where rn = 1)"""
oracle("tag_order_rows", "lines order_events products",
       "with " + _ORDER_ROWS + " select * from order_age")
_TAG_SOURCE = f"""select user_id, name, age_band as age_group, id, greatest(te, ts) as te, ts, category_name, tm_name,
    {_price('original_total_amount')} as price_sensitive, {_part('create_time')} as time_period, keyword,
    {_list(KEYWORD_TYPES)}[k % 7 + 1] as keyword_type, os from searched"""
_TAG = _scored(_TAG_SOURCE, "age_group", {"category": "category_name", "brand": "tm_name", "price": "price_sensitive",
                                          "day_part": "time_period", "keyword": "keyword_type", "os": "os"})
oracle("tag_age", "lines order_events products attributes logs", "with " + _ORDER_ROWS + """,
    known as (select a.* exclude (te), u.name, u.age_band, greatest(a.te, u.ts_ms) as te from order_age a
        join attributes u on u.id = a.user_id and u.ts_ms between a.te - 432000000 and a.te + 432000000),
    searches as (select cast(uid as bigint) as log_uid, ts, os, keyword,
        cast(substr(split_part(keyword, ' ', 1), 2) as bigint) as k from (select *, max(ts) over (partition by uid
        order by event_id rows between unbounded preceding and 1 preceding) as top from logs)
        where (top is null or ts > top) and keyword is not null),
    searched as (select known.*, ts, os, keyword, k from known join searches on log_uid = user_id
        and ts between te - 172800000 and te + 172800000 where k < 100),
    """ + f"""scored as ({_TAG})
    select * exclude (rn) from (select *, row_number() over (partition by user_id, name order by te, id, ts) as rn
    from scored) where rn = 1""")

CTE["users2"] = f"""select o_custkey as id, 'user ' || o_custkey as name, date '1970-01-01'
    + cast(o_custkey * 137 % 21000 - 3650 as int) as birthday, {_ms('o_orderkey')} + o_orderkey % 5 * 20000 as ts_ms from orders"""
CTE["aged2"] = CTE["aged"].replace("from users", "from users2")
CTE["banded2"] = CTE["banded"].replace("from aged", "from aged2")
NEEDS["aged2"], NEEDS["banded2"] = ["users2"], ["aged2"]
oracle("tag_age_default_bounds", "lines order_events products banded2", "with " + _ORDER_ROWS + f""",
    known as (select a.* exclude (te), u.name, u.age_band, greatest(a.te, u.ts_ms) as te from order_age a
        join banded2 u on u.id = a.user_id and u.ts_ms between a.te - 60000 and a.te + 60000),
    searches as (select log_uid, ts, if(log_uid % 2 = 0, 'Android', 'iOS') as os, 'k' || k || ' view' as keyword, k
        from (select *, max(ts) over (partition by log_uid order by event_id rows between unbounded preceding
            and 1 preceding) as top from (select o_custkey as log_uid, {_ms('o_orderkey')} + o_orderkey % 3 * 2400000 as ts,
            o_orderkey % 100 as k, o_orderkey as event_id from orders)) where top is null or ts > top),
    searched as (select known.*, ts, os, keyword, k from known join searches on log_uid = user_id
        and ts between te - 3600000 and te + 3600000),
    scored as ({_TAG})
    select * exclude (rn) from (select *, row_number() over (partition by user_id, name order by te, id, ts) as rn
    from scored) where rn = 1""")

# -- records for sinks ----------------------------------------------------------------------

oracle("sink_json_records", "carts", """select 'dwd_trade_cart_add' as topic, cast(id as varchar) as "key",
    '{"id":' || id || ',"user_id":' || user_id || ',"sku_id":' || sku_id || ',"sku_num":' || sku_num
    || ',"ts_ms":' || ts_ms || '}' as "value" from carts""")


def _of(name: str) -> str:
    """The SQL of another query as a table."""
    return f"({_ORACLE[name]})"


oracle("src_stored_table", "", f"select * from {_of('fact_cart_add')}")
oracle("sink_topics_per_record", "", f"""select sink_table as topic, cast(ts_ms as varchar) as "key", count(*) as n
    from {_of('fact_routed_rows')} group by all""")
oracle("sink_appended_windows", "", f"select * exclude (cur_date) from ({_with(['ranked_lines'], _provinces(DAY))})")
oracle("sink_upserted", "lines", """select id, ts_ms, seq, sku_id from (select *, row_number() over (partition by id
    order by ts_ms desc, seq desc) as rn from lines) where rn = 1""")
oracle("sink_dimension_view", "", f"select * from {_of('dim_current_rows')} where sink_table = 'dim_part'")
oracle("sink_table_lives", "part_events", """select 'dim_part' as sink_table, cast(id as varchar) as row_key,
        'brand=' || brand || ',id=' || id || ',name=' || new_name as data, ts_ms from part_events
        where op = 'u' and ts_ms >= 1705067200100 and id % 7 <> 0
    union all select 'dim_supplier', cast(s_suppkey as varchar), 'id=' || s_suppkey || ',name=' || s_name,
        1704067200000 + s_suppkey from supplier where s_suppkey >= 6""")
oracle("sink_split_outputs", "", f"select kind, count(*) as n from {_of('log_records')} group by kind")
oracle("ads_reports_of_today", "", f"""select 'gmv' as report, '' as name, round(sum(order_amount), 2) as v from {_of('dws_province_orders_hourly')}
    union all select 'province', province_name, round(sum(order_amount), 2) from {_of('dws_province_orders_hourly')} group by province_name
    union all (select 'channel', ch, cast(sum(uv_ct) as double) as v from {_of('dws_traffic')} group by ch order by v desc, ch limit 10)""")
