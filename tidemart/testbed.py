"""Shop-shaped inputs derived from the test tables by plain arithmetic.

Order times are spread over 30 days from the order key, so orders and their lines agree on
them without a join.  ``checks/oracle.py`` states the same arithmetic for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.functions.score import BRAND_LEVELS, CATEGORY_LEVELS
from tidemart.operators.changes import union_all
from tidemart.sources.feeds import as_change_events, clean_words, text_map, typed_row

DB = "shop"
SPREAD = "tidemart.testbed.spread"
SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id", "documents": "doc_id"}
# Words of the segmenter's dictionary, one for each of the five regions, and the phrases made of them.
HAN_WORDS = ["手机", "健康", "健康食品", "白色", "华为"]
HAN_PHRASE = "concat({0}, {1}, '的', {0})"
DAY0_MS = 1_704_067_200_000
BRANDS = [b for names in BRAND_LEVELS.values() for b in names] + ["other"]
CATEGORIES = [c for names in CATEGORY_LEVELS.values() for c in names] + ["other"]
KEYWORD_TYPES = ["时尚与潮流", "性价比", "健康与养生", "家庭与育儿", "科技与数码", "学习与发展", "other"]


def ms(key: str) -> str:
    """SQL for the time of an order."""
    return f"({DAY0_MS} + ({key}) * 7919 % 2592000 * 1000)"


def order_ms(key: str) -> Column:
    return F.expr(ms(key))


def pick(values: list[str], index: str) -> str:
    """SQL for the value at a position from 0, null beyond the last."""
    return f"get(array({', '.join(repr(v) for v in values)}), cast({index} as int))"


def han_phrase(key: str) -> str:
    """SQL for a phrase without spaces, of two dictionary words and a character that is none."""
    return HAN_PHRASE.format(pick(HAN_WORDS, f"({key}) % 5"), pick(HAN_WORDS, f"({key}) % 3"))


def money(sql: str) -> str:
    return f"cast({sql} as decimal(16,2))"


_PRICE = money("l_extendedprice")
_OFF = money(f"{_PRICE} * cast(l_discount as decimal(4,2))")
_COUPON = money(f"{_PRICE} * cast(l_tax as decimal(4,2))")
_LINE_ID = "l_orderkey * 10 + l_linenumber"
_OPERATE = f"{ms('o_orderkey')} + o_orderkey % 40 * 60000"


def _order_row(status: str) -> dict[str, str]:
    return {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "cast(o_orderkey % 25 as int)",
            "order_status": status, "total_amount": money("o_totalprice"),
            "original_total_amount": money(f"{money('o_totalprice')} * 0.02"),
            "consignee": "concat('c', o_custkey)", "trade_body": "o_orderpriority",
            "create_time": ms("o_orderkey"), "operate_time": _OPERATE}


class Testbed:
    """``row`` chooses how the events hold rows: typed structs, or text maps as a mixed feed does."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, row=typed_row):
        self.spark, self.dir, self.row = spark, sf_dir.rstrip("/"), row
        self._tables: dict[str, DataFrame] = {}
        # The tables hold zone-less timestamps; they are read as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        """A test table as its files come.

        The test files hold one row group each, so they are read by one task.  Where the session sets ``SPREAD`` to a
        number, as ``bench.py`` does, the large ones are dealt to as many partitions first, like tables of many files.
        """
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            parts = self.spark.conf.get(SPREAD, None)
            self._tables[name] = df.repartition(int(parts), SPREAD_BY[name]) if parts and name in SPREAD_BY else df
        return self._tables[name]

    # -- logs -------------------------------------------------------------------------

    def logs(self) -> DataFrame:
        """Nested app logs; ``event_id`` is the position in the log."""
        keyword = "concat('k', regexp_extract(props, '(\\\\d+)', 1), ' ', event_type)"
        return self.table("events").selectExpr(
            """named_struct('ar', cast(user_id % 25 as string), 'ba', 'acme', 'ch', concat('ch', event_id % 5),
                'is_new', cast(event_id % 2 as string), 'md', 'acme x', 'mid', concat('mid_', user_id),
                'os', if(user_id % 2 = 0, 'Android 10.1', 'iOS 13.2'), 'sid', concat('sid_', event_id),
                'uid', cast(user_id as string), 'vc', concat('v', user_id % 3)) as common""",
            f"""named_struct('page_id', case event_type when 'view' then 'home' when 'click' then 'good_detail'
                    when 'signup' then 'login' when 'purchase' then 'payment' else 'error' end,
                'last_page_id', case event_id % 4 when 1 then 'login' when 2 then 'search' when 3 then 'home' end,
                'item', if(event_id % 4 = 2, {keyword}, cast(event_id % 100 as string)),
                'item_type', if(event_id % 4 = 2, 'keyword', 'sku_id'),
                'during_time', cast(value * 1000 as bigint)) as page""",
            """if(event_id % 3 > 0, transform(sequence(1, cast(event_id % 3 as int)), i -> named_struct('pos_seq', i,
                'pos_id', 5, 'item', cast((event_id + i) % 35 as string), 'item_type', 'sku_id')), null) as displays""",
            """if(event_type = 'click', array(map('action_id', 'cart_add', 'item', cast(event_id % 35 as string))), null)
                as actions""",
            "if(event_type = 'signup', map('entry', 'icon'), null) as start",
            "if(event_type = 'error', map('error_code', cast(event_id % 10 + 1000 as string)), null) as err",
            "unix_millis(cast(ts as timestamp)) as ts", "event_id")

    def messages(self) -> DataFrame:
        """The logs as JSON lines; every 50th line is cut off, one in 500 is empty."""
        return self.logs().selectExpr("""explode(array(case when event_id % 500 = 7 then null
            when event_id % 50 = 0 then concat('{cut ', event_id)
            else to_json(struct(common, page, displays, actions, start, err, ts)) end)) as value""")

    # -- change events ----------------------------------------------------------------

    def feed(self, *tables: str) -> dict[str, DataFrame]:
        """The shop's change feed, one typed feed per table."""
        return {t: getattr(self, f"{t}_events")() for t in tables}

    def mixed_feed(self, *tables: str) -> DataFrame:
        """The shop's change feed with all tables in one, rows as text maps."""
        return union_all(list(Testbed(self.spark, self.dir, text_map).feed(*tables).values()))

    def _events(self, df: DataFrame, table: str, op: str, ts: str, after, before=None, before_when=None) -> DataFrame:
        return as_change_events(df, DB, table, f"'{op}'" if op.isalpha() else op, ts, after, before, before_when,
                                self.row)

    def order_info_events(self) -> DataFrame:
        """Created unpaid; then paid (F), cancelled (O) or refunding (P); half of P refunded.

        One pass over the orders: each is exploded into its two or three events.
        """
        status = "case i when 0 then '1001' when 1 then case o_orderstatus when 'F' then '1002' when 'O' then '1003' " \
                 "else '1005' end else '1006' end"
        old_status = "case i when 1 then '1001' else '1005' end"
        steps = self.table("orders").selectExpr("*", """explode(if(o_orderstatus = 'P' and o_orderkey % 2 = 0,
            array(0, 1, 2), array(0, 1))) as i""")
        at = f"case i when 0 then {ms('o_orderkey')} when 1 then {_OPERATE} else {_OPERATE} + 60000 end"
        return self._events(steps, "order_info", "if(i = 0, 'c', 'u')", at, _order_row(status),
                            _order_row(old_status), "i > 0")

    def lines(self) -> DataFrame:
        """Order lines; an ``id`` may come several times, (id, ts_ms, seq) is unique."""
        return self.table("lineitem").selectExpr(
            f"{_LINE_ID} as id", "l_orderkey as order_id", "l_partkey as sku_id",
            "concat('sku ', l_partkey) as sku_name", f"{ms('l_orderkey')} as create_time",
            "cast(l_quantity as bigint) as sku_num", f"{_PRICE} as order_price", f"{_OFF} as split_activity_amount",
            f"{_COUPON} as split_coupon_amount", f"{money(f'{_PRICE} - {_OFF} - {_COUPON}')} as split_total_amount",
            "cast(l_orderkey % 25 as int) as province_id",
            f"{ms('l_orderkey')} + l_partkey % 90 * 1000 + l_linenumber * 100 as ts_ms",
            "l_partkey * 100000 + unix_date(cast(l_shipdate as date)) as seq")

    def line_changelog(self) -> DataFrame:
        """The order-line fact as a log with re-sent rows."""
        return self.lines().selectExpr("*", f"{money(f'{money('sku_num')} * order_price')} as split_original_amount")

    def order_detail_events(self) -> DataFrame:
        columns = ["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price",
                   "split_activity_amount", "split_coupon_amount", "split_total_amount"]
        return self._events(self.lines(), "order_detail", "c", "ts_ms", {c: c for c in columns})

    def _line_ids(self, condition: str) -> DataFrame:
        return self.table("lineitem").filter(condition).selectExpr(f"{_LINE_ID} as id", "l_orderkey").distinct()

    def order_detail_activity_events(self) -> DataFrame:
        return self._events(self._line_ids("l_discount > 0.05"), "order_detail_activity", "c", ms("l_orderkey"), {
            "order_detail_id": "id", "activity_id": "id % 4 + 1", "activity_rule_id": "id % 7 + 1"})

    def order_detail_coupon_events(self) -> DataFrame:
        return self._events(self._line_ids("l_tax > 0.04"), "order_detail_coupon", "c", ms("l_orderkey"), {
            "order_detail_id": "id", "coupon_id": "id % 3 + 1"})

    def cart_info_events(self) -> DataFrame:
        """New (line % 3 = 0), changed (1) and snapshot (2) cart rows."""
        columns = {"id": _LINE_ID, "user_id": "l_suppkey", "sku_id": "l_partkey", "sku_num": "cast(l_quantity as int)"}
        before = {**columns, "sku_num": "cast(cast(l_quantity as int) - (l_partkey % 5 - 2) as int)"}
        return self._events(self.table("lineitem"), "cart_info", "get(array('c', 'u', 'r'), l_linenumber % 3)",
                            f"{ms('l_orderkey')} + l_linenumber * 1000", columns, before, "l_linenumber % 3 = 1")

    def payment_info_events(self) -> DataFrame:
        """Paid orders (F); the callback comes up to 39 minutes after the order."""
        columns = {"order_id": "o_orderkey", "user_id": "o_custkey",
                   "payment_type": "cast(o_orderkey % 30 + 1100 as string)", "payment_status": "'1602'",
                   "callback_time": _OPERATE}
        return self._events(self.table("orders").filter("o_orderstatus = 'F'"), "payment_info", "u", _OPERATE, columns,
                            {**columns, "payment_status": "'1601'"})

    def order_refund_info_events(self) -> DataFrame:
        """Refund requests; those of odd lines are later completed."""
        steps = self.table("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "*", "explode(if(l_linenumber % 2 = 1, array(0, 1), array(0))) as i")
        columns = {"id": _LINE_ID, "user_id": "l_suppkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
                   "refund_type": "cast(l_partkey % 27 + 1500 as string)", "refund_num": "cast(l_quantity as bigint)",
                   "refund_amount": _PRICE, "refund_reason_type": "cast(l_partkey % 26 + 1300 as string)",
                   "refund_reason_txt": "concat('reason ', l_partkey)", "refund_status": "if(i = 0, '0701', '0705')",
                   "create_time": f"{ms('l_orderkey')} + 3600000"}
        return self._events(steps, "order_refund_info", "if(i = 0, 'c', 'u')",
                            f"{ms('l_orderkey')} + 3600000 + i * 60000", columns,
                            {**columns, "refund_status": "'0701'"}, "i > 0")

    def refund_payment_events(self) -> DataFrame:
        at = f"{ms('l_orderkey')} + 3690000"
        columns = {"id": _LINE_ID, "order_id": "l_orderkey", "sku_id": "l_partkey",
                   "payment_type": "cast(l_partkey % 28 + 1100 as string)", "total_amount": _PRICE,
                   "refund_status": "'1602'", "callback_time": at}
        completed = self.table("lineitem").filter("l_returnflag = 'R' and l_linenumber % 2 = 1")
        return self._events(completed, "refund_payment", "u", at, columns, {**columns, "refund_status": "'1601'"})

    def comment_info_events(self) -> DataFrame:
        """Documents as comments on orders; every fourth ends in a comma and a word, of which most are in the dictionary."""
        columns = {"id": "doc_id", "user_id": "doc_id % 150", "sku_id": "doc_id % 200", "spu_id": "doc_id % 50",
                   "order_id": "doc_id", "appraise": "cast(doc_id % 30 + 1200 as string)",
                   "comment_txt": "if(doc_id % 4 = 0, concat(text, ',badword', doc_id % 40), text)", "nick_name": "source",
                   "create_time": ms("doc_id")}
        return self._events(self.table("documents"), "comment_info", "c",
                            f"{ms('doc_id')} + (doc_id % 5 - 2) * 40000", columns)

    def user_info_events(self) -> DataFrame:
        """Customers as users; every tenth event comes twice."""
        sent = self.table("customer").selectExpr("*", "explode(if(c_custkey % 10 = 0, array(0, 1), array(0))) as i")
        columns = {"id": "c_custkey", "name": "c_name", "birthday": "cast(c_custkey * 137 % 21000 - 3650 as int)",
                   "gender": "case c_custkey % 3 when 1 then 'M' when 2 then 'F' end"}
        return self._events(sent, "user_info", "u", ms("c_custkey * 3"), columns, columns)

    def user_info_sup_msg_events(self) -> DataFrame:
        columns = {"uid": "c_custkey", "height": "cast(c_custkey % 50 + 150 as string)", "unit_height": "'cm'",
                   "weight": "cast(c_custkey % 60 + 40 as string)", "unit_weight": "'kg'"}
        return self._events(self.table("customer"), "user_info_sup_msg", "r",
                            f"{ms('c_custkey * 3')} + (c_custkey % 7 - 3) * 1500000", columns)

    def part_events(self) -> DataFrame:
        """Products: read once, renamed (every third), deleted (every seventh)."""
        p = self.table("part")
        old = {"id": "p_partkey", "name": "p_name", "brand": "p_brand", "size": "p_size", "price": money("p_retailprice")}
        new = {**old, "name": "concat(p_name, ' new')"}
        return union_all([
            self._events(p, "part", "r", f"{DAY0_MS} + p_partkey", old),
            self._events(p.filter("p_partkey % 3 = 0"), "part", "u", f"{DAY0_MS + 1_000_000_000} + p_partkey", new, old),
            self._events(p.filter("p_partkey % 7 = 0"), "part", "d", f"{DAY0_MS + 2_000_000_000} + p_partkey", None, old)])

    def supplier_events(self) -> DataFrame:
        return self._events(self.table("supplier"), "supplier", "r", f"{DAY0_MS} + s_suppkey", {
            "id": "s_suppkey", "name": "s_name", "nation": "s_nationkey"})

    # -- configuration ----------------------------------------------------------------

    def _config(self, table: str, rows: list[tuple[str, dict[str, str]]], times: list[int] | None = None) -> DataFrame:
        one = self.spark.range(1)
        quoted = [(op, {k: f"'{v}'" for k, v in row.items()}) for op, row in rows]
        return union_all([
            as_change_events(one, "config", table, f"'{op}'", str(times[i] if times else i + 1), None if op == "d" else row,
                             row if op in ("d", "u") else None, row=text_map)
            for i, (op, row) in enumerate(quoted)])

    def dim_config_events(self) -> DataFrame:
        """Parts and suppliers are dimensions; users were one and are no longer."""
        def row(table, columns):
            return {"source_table": table, "sink_table": f"dim_{table}", "sink_family": "info",
                    "sink_columns": columns, "sink_row_key": "id"}
        return self._config("table_process_dim", [
            ("r", row("part", "id,name")), ("r", row("user_info", "id,name")), ("r", row("supplier", "id,name,nation")),
            ("u", row("part", "id,name,brand")), ("d", row("user_info", "id,name"))])

    def dim_config_history(self) -> DataFrame:
        """Parts are made anew with more columns after two weeks, suppliers dropped for three milliseconds."""
        def row(table, columns):
            return {"source_table": table, "sink_table": f"dim_{table}", "sink_family": "info",
                    "sink_columns": columns, "sink_row_key": "id"}
        return self._config("table_process_dim", [
            ("r", row("part", "id,name")), ("r", row("supplier", "id,name,nation")), ("u", row("part", "id,name,brand")),
            ("d", row("supplier", "id,name,nation")), ("c", row("supplier", "id,name"))],
            [1, 2, DAY0_MS + 1_000_000_100, DAY0_MS + 3, DAY0_MS + 6])

    def fact_config_events(self) -> DataFrame:
        def row(table, kind, columns):
            return {"source_table": table, "source_type": kind, "sink_table": f"dwd_{table}_{kind}",
                    "sink_columns": columns}
        return self._config("table_process_dwd", [
            ("r", row("part", "u", "id,name")), ("r", row("part", "r", "id,brand,size")),
            ("r", row("cart_info", "c", "id,user_id,sku_id,sku_num")), ("d", row("part", "u", "id,name"))])

    def fact_config_history(self) -> DataFrame:
        """Changes of parts move to another table among them, cart rows pause for a week and come back with fewer columns."""
        def row(table, kind, sink, columns):
            return {"source_table": table, "source_type": kind, "sink_table": sink, "sink_columns": columns}
        return self._config("table_process_dwd", [
            ("r", row("part", "u", "dwd_part_u", "id,name")), ("r", row("cart_info", "c", "dwd_cart", "id,user_id,sku_num")),
            ("u", row("part", "u", "dwd_part_later", "id,brand")), ("d", row("cart_info", "c", "dwd_cart", "id,user_id,sku_num")),
            ("c", row("cart_info", "c", "dwd_cart_again", "id,user_id"))],
            [1, 2, DAY0_MS + 1_000_000_100, DAY0_MS + 700_000_000, DAY0_MS + 1_304_800_000])

    def part_versions(self) -> DataFrame:
        """Products as they were: every event of a part with its name."""
        row = F.coalesce("after", "before")
        return Testbed(self.spark, self.dir, text_map).part_events().select(row["id"].cast("bigint").alias("part_id"), row["name"].alias("name"), "op", "ts_ms")

    def customer_chunks(self, chunk_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Customers as a table read by chunks while it changed: (rows read, changes at log positions 1 to 1520, fences).

        Every third is changed, then every fifth deleted, then every fifteenth comes back; every seventh has a new row
        behind all chunks.  A chunk is read 50 positions after its low mark, 50 before its high one.
        """
        c = self.table("customer").selectExpr(
            "c_custkey as id", "cast(c_acctbal as double) as balance", "c_custkey * 37 % 1000 + 1 as at",
            f"cast(floor(c_custkey / {chunk_rows}) as bigint) as chunk").selectExpr("*", "200 + chunk * 29 % 500 as low")
        row = "named_struct('id', cast({} as bigint), 'balance', {})"
        none = "cast(null as struct<id: bigint, balance: double>)"

        def events(condition: str, op: str, at: str, after: str | None, before: str | None) -> DataFrame:
            return c.filter(condition).selectExpr(f"{before or none} as before", f"{after or none} as after", f"'{op}' as op",
                                                  f"{DAY0_MS} + {at} as ts_ms", f"cast({at} as bigint) as pos")

        new = row.format("id", "balance + 1")
        changes = union_all([
            events("id % 3 = 0", "u", "at", new, row.format("id", "balance")), events("id % 5 = 0", "d", "at + 500", None, new),
            events("id % 15 = 0", "c", "at + 520", row.format("id", "0D"), None),
            events("id % 7 = 0", "c", "at", row.format("id + 10000000", "balance"), None)])
        read = c.filter("id % 5 <> 0 or at + 500 > low + 50 or (id % 15 = 0 and at + 520 <= low + 50)").selectExpr(
            "id", "case when id % 15 = 0 and at + 520 <= low + 50 then 0D when id % 3 = 0 and at <= low + 50 then balance + 1 else balance end as balance")
        fences = c.select("chunk", "low").distinct().selectExpr("chunk", "low", "low + 100 as high", f"{DAY0_MS} + low as ts_ms")
        return read, changes, fences

    # -- dimensions -------------------------------------------------------------------

    def dictionary(self) -> DataFrame:
        """25 codes each for payment (11xx), appraisal (12xx), reason (13xx) and refund type (15xx)."""
        codes = self.table("nation").selectExpr("explode(transform(array(1100, 1200, 1300, 1500), b -> b + n_nationkey)) as code")
        return codes.selectExpr("cast(code as string) as dic_code", "concat('name ', code) as dic_name")

    def provinces(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey as id", "n_name as name")

    def sku_info(self) -> DataFrame:
        return self.table("part").selectExpr("p_partkey as id", "p_name as sku_name", "p_partkey % 100 as spu_id",
                                             "cast(p_partkey % 12 as int) as tm_id", "p_size % 25 as category3_id")

    def product_dims(self) -> dict[str, DataFrame]:
        nation = self.table("nation")
        return {
            "sku": self.sku_info(),
            "spu": self.table("supplier").selectExpr("s_suppkey as id", "s_name as spu_name"),
            "trademark": nation.selectExpr("n_nationkey as id", f"{pick(BRANDS, 'n_nationkey')} as tm_name"),
            "category3": nation.selectExpr("n_nationkey as id", "n_name as name", "n_nationkey % 30 as category2_id"),
            "category2": nation.selectExpr("n_nationkey as id", "concat('sub ', n_name) as name",
                                           "n_nationkey % 18 as category1_id"),
            "category1": nation.selectExpr("n_nationkey as id", f"{pick(CATEGORIES, 'n_nationkey')} as name"),
        }

    def keyword_types(self) -> DataFrame:
        """k0..k99 followed by each event type, mapped to a search category."""
        return self.table("nation").selectExpr("explode(sequence(n_nationkey * 4, n_nationkey * 4 + 3)) as n").selectExpr(
            "n", "explode(array('signup', 'error', 'click', 'view', 'purchase')) as kind").selectExpr(
            "concat('k', n, ' ', kind) as category_name", f"{pick(KEYWORD_TYPES, 'n % 7')} as search_category")

    def raw_words(self) -> DataFrame:
        """Words of at least nine letters in the benchmark texts and some made ones, with blanks and repeats."""
        long = self.table("benchmark").selectExpr("explode(regexp_extract_all(lower(text), '(\\\\p{L}{9,})', 1)) as word")
        made = self.table("nation").selectExpr("concat('badword', n_nationkey) as word")
        return long.unionByName(made).selectExpr("explode(array(word, concat('  ', word, ' '), '  ')) as word")

    def words(self) -> DataFrame:
        return clean_words(self.raw_words())

    def han_words(self) -> DataFrame:
        """Dictionary of the segmenter; one word begins another."""
        return self.table("region").selectExpr(f"{pick(HAN_WORDS, 'r_regionkey')} as word")
