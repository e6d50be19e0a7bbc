"""The registered queries: each operator and plan over whole test tables.

Every result is flat: integers as bigint, amounts as double, dates and times as text.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemart.functions import dates, people
from tidemart.functions.score import with_age_scores
from tidemart.operators import asof, changes, etl, firsttime, joins, logs as log_ops, text
from tidemart.plans import applogs, comments, dims, serving, tags, trade, traffic
from tidemart.session import shared_dir
from tidemart.sources import feeds, handover
from tidemart.streaming import sinks
from tidemart.testbed import BRANDS, CATEGORIES, DB, KEYWORD_TYPES, Testbed, han_phrase, order_ms, pick

AS_OF = "2024-02-01"
REPORT_DAY = "2024-01-10"
HOUR_MS = 3_600_000
_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def flat(df: DataFrame) -> DataFrame:
    out = []
    for field in df.schema.fields:
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType)):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(fn(Testbed(spark, sf_dir)))

    run.__doc__ = fn.__doc__
    _REGISTRY[fn.__name__] = run
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def _event_text(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))


def _row_id(df: DataFrame) -> DataFrame:
    return df.select("op", F.coalesce(F.col("after")["id"], F.col("before")["id"]).cast("bigint").alias("id"), "ts_ms")


# -- sources ----------------------------------------------------------------------------

@query
def src_change_feed(t: Testbed):
    """JSON messages, tombstones among them, parsed strictly into change events."""
    messages = _event_text(t.mixed_feed("part")).withColumn(
        "value", F.when(~F.get_json_object("value", "$.ts_ms").endswith("77"), F.col("value")))
    events = feeds.change_events(feeds.decode_messages(messages))
    return events.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms",
                         F.date_format("et", dates.DATE_TIME).alias("et"),
                         F.col("before")["name"].alias("old_name"), F.col("after")["name"].alias("new_name"))


@query
def src_snapshot_events(t: Testbed):
    events = feeds.snapshot_events(t.table("customer"), DB, "customer", "1704067200000")
    return events.select("op", "ts_ms", *etl.after({"c_custkey": "bigint", "c_name": "string",
                                                     "c_acctbal": "double", "c_mktsegment": "string"}))


@query
def src_snapshot_then_changes(t: Testbed):
    """Customers read in chunks while they change, then the changes that the chunks do not hold."""
    read, log, fences = t.customer_chunks(100)
    events = handover.snapshot_then_changes(read, log, fences, "id", 100, start=200)
    return events.select("op", F.coalesce("after.id", "before.id").alias("id"), F.col("after.balance").alias("balance"), "pos")


@query
def src_page_log_maps(t: Testbed):
    lines = t.logs().select(F.to_json(F.struct("common", "page", "ts")).alias("value"))
    return feeds.page_log(lines).select(F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"),
                                        F.col("page")["during_time"].cast("bigint").alias("during_time"), "ts",
                                        F.date_format("et", dates.DATE_TIME).alias("et"))


def _folder(t: Testbed, name: str) -> str:
    """A new shared folder; on one machine without one a temporary folder."""
    fallback = tempfile.mkdtemp(prefix="tidemart-") if t.spark.sparkContext.master.startswith("local[") else None
    return shared_dir(t.spark, f"{name}-{uuid.uuid4().hex}", fallback)


@query
def src_text_messages(t: Testbed):
    """Lines written as text files and read again."""
    path = _folder(t, "lines")
    t.table("events").selectExpr("concat(event_id, ' ', event_type) as value").write.text(path)
    return feeds.text_messages(t.spark, path)


@query
def src_stored_table(t: Testbed):
    """A fact written and read again by its schema."""
    path, fact = _folder(t, "carts"), trade.cart_add_fact(t.feed("cart_info"))
    fact.write.parquet(path)
    return feeds.stored_table(t.spark, path, fact.schema)


@query
def src_dictionary(t: Testbed):
    """The code dictionary as a stored table with further columns."""
    path = _folder(t, "dictionary")
    t.dictionary().withColumn("parent_code", F.lit("0")).write.parquet(path)
    return feeds.dictionary(t.spark, path)


@query
def src_word_list_file(t: Testbed):
    """Words read from a text file, cleaned, saved and read again."""
    lines, path = _folder(t, "lines"), _folder(t, "words")
    t.raw_words().write.text(lines)
    feeds.save_words(feeds.word_list(t.spark, lines), path)
    return t.spark.read.parquet(path)


@query
def src_word_list(t: Testbed):
    """Words with blanks around them, repeats and blank rows."""
    return feeds.clean_words(t.raw_words())


# -- event filters and projections ------------------------------------------------------

@query
def etl_valid_events(t: Testbed):
    return _row_id(etl.valid_events(t.mixed_feed("part", "supplier"), DB))


@query
def etl_drop_bootstrap(t: Testbed):
    events = t.mixed_feed("part").withColumn(
        "op", F.when(F.col("ts_ms") % 2 == 1, F.concat(F.lit("bootstrap-"), "op")).otherwise(F.col("op")))
    return _row_id(etl.drop_bootstrap(events))


@query
def etl_drop_deletes(t: Testbed):
    return _row_id(etl.drop_deletes(etl.of_table(t.mixed_feed("part", "supplier"), "part")))


@query
def etl_transitions(t: Testbed):
    """All state changes the facts start from."""
    events = t.feed("order_info", "payment_info", "order_refund_info", "refund_payment")
    wanted = {"cancelled": ("order_info", "order_status", "1003", "1001"),
              "paid": ("payment_info", "payment_status", "1602", None),
              "refunding": ("order_info", "order_status", "1005", None),
              "refunded": ("order_info", "order_status", "1006", None),
              "returned": ("order_refund_info", "refund_status", "0705", None),
              "paid_back": ("refund_payment", "refund_status", "1602", None)}
    return changes.union_all([
        etl.transition(events, *args).select(
            F.lit(kind).alias("kind"), F.col("after")["id" if args[0] == "order_info" else "order_id"].alias("order_id"),
            "ts_ms")
        for kind, args in wanted.items()])


@query
def etl_logins(t: Testbed):
    return etl.logins(t.logs()).select("event_id", F.col("common.uid").alias("uid"), "ts")


@query
def etl_searches(t: Testbed):
    return etl.searches(t.logs()).select("event_id", F.col("page.item").alias("full_word"), "ts")


@query
def etl_page_views(t: Testbed):
    return etl.page_views(t.logs())


@query
def etl_log_profile(t: Testbed):
    return etl.log_profile(t.logs())


@query
def etl_keyword_profile(t: Testbed):
    return etl.only_keywords(etl.log_profile(t.logs()))


@query
def etl_flat_comments(t: Testbed):
    return etl.flat_comments(t.feed("comment_info")).withColumn("comment_txt", F.md5("comment_txt"))


ORDER_COLUMNS = {"id": "bigint", "user_id": "bigint", "province_id": "int", "order_status": "string",
                 "original_total_amount": "decimal(16,2)", "consignee": "string", "trade_body": "string"}


@query
def etl_flat_orders(t: Testbed):
    return etl.with_day_key(etl.flat_orders(t.feed("order_info"), ORDER_COLUMNS), "tm_ms")


# -- logs -------------------------------------------------------------------------------

def _common(df: DataFrame, *more) -> DataFrame:
    return df.select(F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), *more)


@query
def log_errors(t: Testbed):
    return _common(applogs.split_messages(t.messages())["err"], F.col("err")["error_code"].alias("error_code"), "ts")


@query
def log_starts(t: Testbed):
    return _common(applogs.split_messages(t.messages())["start"], F.col("start")["entry"].alias("entry"), "ts")


@query
def log_displays(t: Testbed):
    return _common(applogs.split_messages(t.messages())["display"], F.col("page.page_id").alias("page_id"),
                   F.col("display.pos_seq").alias("pos_seq"), F.col("display.item").alias("item"), "ts")


@query
def log_actions(t: Testbed):
    return _common(applogs.split_messages(t.messages())["action"], F.col("page.page_id").alias("page_id"),
                   F.col("action")["action_id"].alias("action_id"), F.col("action")["item"].alias("item"))


@query
def log_pages(t: Testbed):
    return _common(applogs.split_messages(t.messages())["page"], "page.page_id", "page.last_page_id",
                   "page.item", "page.during_time", "ts")


@query
def log_records(t: Testbed):
    """All split outputs written as one table: records per kind, with a value read back from the JSON."""
    logs, _ = feeds.app_log(t.messages())
    records = log_ops.split_records(log_ops.repair_new_visitors(logs, "page", visits=feeds.visit_log(t.messages())))
    return records.select("kind", F.get_json_object("value", "$.common.mid").alias("mid"),
                          F.get_json_object("value", "$.common.is_new").alias("is_new"),
                          F.coalesce(F.get_json_object("value", "$.display.item"),
                                     F.get_json_object("value", "$.action.item"),
                                     F.get_json_object("value", "$.page.item")).alias("item"))


@query
def log_dirty(t: Testbed):
    return applogs.split_messages(t.messages())["dirty"]


@query
def visitor_repair(t: Testbed):
    return _common(log_ops.repair_new_visitors(t.logs(), "event_id"), "event_id")


def hot_share(t: Testbed) -> float:
    return 1.1 / t.logs().select("common.mid").distinct().count()


@query
def visitor_repair_hot_devices(t: Testbed):
    """The same with every device that has a tenth more rows than the mean spread over many partitions."""
    return _common(log_ops.repair_new_visitors(t.logs(), "event_id", hot_share=hot_share(t)), "event_id")


# -- configuration-driven routing -------------------------------------------------------

def _sorted_entries(data: str) -> F.Column:
    pairs = F.transform(F.map_entries(data), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(F.array_sort(pairs), ",").alias(data)


@query
def dim_changes(t: Testbed):
    rows = dims.dimension_rows(t.mixed_feed("part", "supplier", "user_info"), t.dim_config_events(), DB)
    return rows.select("sink_table", "sink_family", "row_key", "op", "ts_ms", _sorted_entries("data"))


@query
def dim_current_rows(t: Testbed):
    rows = dims.current_dimensions(t.mixed_feed("part", "supplier", "user_info"), t.dim_config_events(), DB)
    return rows.select("sink_table", "row_key", _sorted_entries("data"), "ts_ms")


@query
def fact_routed_rows(t: Testbed):
    rows = dims.fact_rows(t.mixed_feed("part", "cart_info"), t.fact_config_events())
    return rows.select("sink_table", _sorted_entries("data"), "ts_ms")


@query
def fact_routed_as_of(t: Testbed):
    """Events before and after a change of the configuration take the sinks of their time."""
    rows = dims.fact_rows_as_of(t.mixed_feed("part", "cart_info"), t.fact_config_history())
    return rows.select("sink_table", _sorted_entries("data"), "ts_ms")


# -- facts ------------------------------------------------------------------------------

ORDER_FEED = ["order_info", "order_detail", "order_detail_activity", "order_detail_coupon"]


def _order_details(t: Testbed, met=None) -> DataFrame:
    return trade.order_detail_fact(t.feed(*ORDER_FEED), met)


@query
def fact_cart_add(t: Testbed):
    return trade.cart_add_fact(t.feed("cart_info"))


@query
def fact_order_detail(t: Testbed):
    return _order_details(t)


@query
def fact_order_detail_of_mixed_feed(t: Testbed):
    """The same from one feed of all tables with rows as text maps."""
    return trade.order_detail_fact(t.mixed_feed(*ORDER_FEED))


@query
def fact_order_cancel(t: Testbed):
    return trade.order_cancel_fact(lambda met: _order_details(t, met), t.feed("order_info"))


@query
def fact_order_cancel_recent(t: Testbed):
    """Only lines within 30 minutes and 5 seconds of the cancel."""
    return trade.order_cancel_fact(lambda met: _order_details(t, met), t.feed("order_info"), within_ms=1_805_000)


@query
def fact_payment(t: Testbed):
    return trade.payment_fact(_order_details(t), t.feed("payment_info"), t.dictionary())


@query
def fact_refund(t: Testbed):
    return trade.refund_fact(t.feed("order_refund_info", "order_info"), t.dictionary())


@query
def fact_refund_payment(t: Testbed):
    return trade.refund_payment_fact(t.feed("refund_payment", "order_refund_info", "order_info"), t.dictionary())


@query
def fact_comment(t: Testbed):
    return comments.comment_fact(t.feed("comment_info"), t.dictionary()).withColumn("comment_txt", F.md5("comment_txt"))


def _comment_orders(t: Testbed) -> DataFrame:
    return comments.comment_order_fact(t.feed("comment_info", "order_info"), t.dictionary(), ORDER_COLUMNS)


@query
def fact_comment_order(t: Testbed):
    return _comment_orders(t).withColumn("comment_txt", F.md5("comment_txt"))


# -- dimension lookups --------------------------------------------------------------------

@query
def join_lookup_sku(t: Testbed):
    return joins.lookup(t.lines().select("id", "sku_id", "seq"), t.sku_info(), {"sku_id": "id"},
                        {"category3_id": "category3_id", "tm_id": "tm_id"})


@query
def join_lookup_as_of(t: Testbed):
    """Order lines with the product's name at their time; products are renamed and deleted meanwhile."""
    rows = t.lines().select("id", "sku_id", "seq", "ts_ms")
    return asof.lookup_as_of(rows, t.part_versions(), {"sku_id": "part_id"}, "ts_ms", {"name": "part_name"},
                             deleted=F.col("op") == "d")


@query
def join_lookup_two_roles(t: Testbed):
    """One dictionary under two roles; a missing code drops the row."""
    rows = t.table("customer").select("c_custkey", (F.col("c_custkey") % 27 + 1500).cast("string").alias("type_code"),
                                      (F.col("c_custkey") % 26 + 1300).cast("string").alias("reason_code"))
    named = joins.dictionary_name(rows, t.dictionary(), "type_code", "type_name")
    return joins.dictionary_name(named, t.dictionary(), "reason_code", "reason_name")


@query
def join_lookup_default(t: Testbed):
    rows = t.table("customer").select("c_custkey", (F.col("c_custkey") % 30 + 1200).cast("string").alias("appraise"))
    return joins.dictionary_name_or(rows, t.dictionary(), "appraise", "dic_name")


@query
def join_product_chain(t: Testbed):
    return joins.flat_products(**t.product_dims())


@query
def join_interval_changes(t: Testbed):
    """Order lines with the order's status change up to 10 minutes later or 1 minute before."""
    lines = t.lines().select("id", "order_id", "seq", "ts_ms")
    updates = etl.of_table(t.feed("order_info"), "order_info", "u").select(
        F.col("after")["id"].cast("bigint").alias("oid"), F.col("after")["order_status"].alias("order_status"),
        F.col("ts_ms").alias("changed_ms"))
    return joins.interval_join(lines, updates, {"order_id": "oid"}, "ts_ms", "changed_ms", -60_000, 600_000).drop("oid")


@query
def join_interval_left(t: Testbed):
    lines = t.lines().select("id", "order_id", "seq", "ts_ms")
    paid = t.payment_info_events().select(F.col("after")["order_id"].cast("bigint").alias("oid"),
                                          F.col("ts_ms").alias("paid_ms"))
    return joins.interval_join(lines, paid, {"order_id": "oid"}, "ts_ms", "paid_ms", 0, 1_200_000,
                               how="left").drop("oid")


# -- deduplication and re-sent rows -------------------------------------------------------

@query
def ded_repeats(t: Testbed):
    rows = t.user_info_events().select(*etl.after({"id": "bigint", "name": "string"}), "ts_ms")
    return changes.drop_repeats(rows, ["id", "ts_ms"])


@query
def ded_equal_rows(t: Testbed):
    rows = t.table("documents").select(F.md5("text").alias("text"), "lang")
    return changes.drop_equal_rows(rows)


@query
def ded_retracted_lines(t: Testbed):
    rows = t.lines().select("id", "ts_ms", "seq", "province_id", F.col("split_total_amount").alias("amount"))
    return changes.retract_by_negation(rows, ["id"], ["ts_ms", "seq"], ["amount"])


@query
def ded_latest_lines(t: Testbed):
    rows = t.lines().select("id", "ts_ms", "seq", "sku_id", F.col("split_total_amount").alias("amount"))
    return changes.latest_per_key(rows, ["id"], ["ts_ms", "seq"])


@query
def ded_latest_records(t: Testbed):
    """Rows newer than all earlier arrivals; every third row arrives an hour late."""
    late = F.when(F.col("event_id") % 3 == 0, F.col("ts") - HOUR_MS * 12).otherwise(F.col("ts"))
    rows = t.logs().select("event_id", F.col("common.uid").alias("uid"), late.alias("ts"))
    return changes.latest_records(rows, "uid", "ts", "event_id", block=1000)


@query
def ded_first_per_customer(t: Testbed):
    rows = t.table("orders").select("o_custkey", "o_orderkey", order_ms("o_orderkey").alias("ts_ms"),
                                    "o_orderstatus")
    return changes.first_per_key(rows, ["o_custkey"], ["ts_ms", "o_orderkey"])


@query
def ded_last_per_window(t: Testbed):
    rows = t.logs().select(F.col("common.uid").alias("uid"), F.timestamp_millis("ts").alias("et"), "ts", "event_id")
    return changes.last_per_window(rows, ["uid"], "et", "2 hours", ["ts", "event_id"]).drop("et")


@query
def running_profile(t: Testbed):
    return changes.running_profile(etl.log_profile(t.logs(), ["event_id"]), "uid", "event_id", ["os", "keyword"], block=500)


# -- first time today ---------------------------------------------------------------------

@query
def uv_daily_flag(t: Testbed):
    rows = t.logs().select(F.col("common.mid").alias("mid"), "ts", "event_id")
    return firsttime.flag_first_of_day(rows, ["mid"], "ts", "event_id")


@query
def uv_home_detail(t: Testbed):
    pages = etl.of_pages(t.logs(), ["home", "good_detail"]).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")
    return firsttime.first_of_day(pages, ["mid", "page_id"], "ts")


@query
def uv_cart_users(t: Testbed):
    return firsttime.first_of_day(trade.cart_add_fact(t.feed("cart_info")), ["user_id"], "ts_ms")


@query
def uv_returning_users(t: Testbed):
    rows = etl.logins(t.logs()).select(F.col("common.uid").alias("uid"), "ts")
    return firsttime.daily_logins(rows, "uid", "ts", gap_days=2)


# -- windows ------------------------------------------------------------------------------

@query
def dws_traffic(t: Testbed):
    return traffic.traffic_window(t.logs())


@query
def dws_traffic_daily(t: Testbed):
    return traffic.traffic_window(t.logs(), "1 day")


@query
def dws_home_detail(t: Testbed):
    return traffic.home_detail_window(t.logs())


@query
def dws_keywords(t: Testbed):
    return traffic.keyword_window(t.logs())


@query
def dws_keywords_daily(t: Testbed):
    return traffic.keyword_window(t.logs(), "1 day")


@query
def dws_keywords_segmented(t: Testbed):
    """Search phrases without spaces, cut by a dictionary."""
    logs = t.logs().withColumn("page", F.col("page").withField("item", F.expr(han_phrase("event_id"))))
    return traffic.keyword_window(logs, "1 hour", t.han_words())


@query
def dws_logins(t: Testbed):
    return traffic.login_window(t.logs())


@query
def dws_logins_daily(t: Testbed):
    return traffic.login_window(t.logs(), "1 day")


@query
def dws_cart_users(t: Testbed):
    return traffic.cart_user_window(trade.cart_add_fact(t.feed("cart_info")))


@query
def dws_cart_users_of_day(t: Testbed):
    return traffic.cart_user_window(trade.cart_add_fact(t.feed("cart_info")), "1 hour", REPORT_DAY)


RESENT = ["ts_ms", "seq"]


def _province_windows(t: Testbed, size: str) -> DataFrame:
    return trade.province_window(t.line_changelog(), t.provinces(), size, RESENT)


@query
def dws_province_orders(t: Testbed):
    return _province_windows(t, "1 second")


@query
def dws_province_orders_hourly(t: Testbed):
    return _province_windows(t, "1 hour")


def _sku_windows(t: Testbed, size: str) -> DataFrame:
    return trade.sku_window(t.line_changelog(), joins.flat_products(**t.product_dims()), size, RESENT)


@query
def dws_sku_orders(t: Testbed):
    return _sku_windows(t, "10 seconds")


@query
def dws_sku_orders_daily(t: Testbed):
    return _sku_windows(t, "1 day")


# -- serving ------------------------------------------------------------------------------

@query
def ads_gmv(t: Testbed):
    return serving.gmv(_province_windows(t, "1 hour"), REPORT_DAY)


@query
def ads_province_amounts(t: Testbed):
    return serving.province_amounts(_province_windows(t, "1 hour"), REPORT_DAY)


@query
def ads_top_channels(t: Testbed):
    return serving.top_channels(traffic.traffic_window(t.logs()), REPORT_DAY, 3)


# -- scalar functions -----------------------------------------------------------------------

@query
def fn_dates(t: Testbed):
    ms, zone = order_ms("o_orderkey"), "Asia/Shanghai"
    return t.table("orders").select(
        "o_orderkey", dates.to_date_text(ms).alias("day"), dates.to_datetime_text(ms).alias("at"),
        dates.to_date_text(ms, zone).alias("local_day"), dates.format_millis(ms, dates.DAY_KEY, zone).alias("day_key"),
        dates.parse_date(dates.to_date_text(ms, zone), zone).alias("local_midnight"),
        dates.parse_datetime(dates.to_datetime_text(ms)).alias("back"),
        F.date_format(dates.at_seconds(ms / 1000), dates.DATE_TIME).alias("from_seconds"))


@query
def fn_people(t: Testbed):
    key = F.col("c_custkey")
    birthday = dates.from_epoch_days(key * 137 % 21_000 - 3650)
    age = people.age_years(birthday, F.lit(AS_OF).cast("date"))
    return t.table("customer").select(
        "c_custkey", birthday.cast("string").alias("birthday"), age.alias("age"), people.age_band(age).alias("age_band"),
        people.era(birthday).alias("era"), people.star_sign(birthday).alias("sign"),
        people.gender_or_home(F.when(key % 3 == 1, "M").when(key % 3 == 2, "F")).alias("gender"))


@query
def fn_day_part_and_price_band(t: Testbed):
    return t.table("orders").select("o_orderkey", people.day_part(order_ms("o_orderkey")).alias("day_part"),
                                    people.price_band(F.col("o_totalprice") / 50).alias("price_band"))


@query
def fn_age_scores(t: Testbed):
    """All six factors on every order; levels picked from the order key."""
    bands = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+", "0-17"]
    rows = t.table("orders").select(
        "o_orderkey", F.expr(pick(bands, "o_orderkey % 7")).alias("band"),
        F.expr(pick(CATEGORIES, "o_orderkey % 18")).alias("category"),
        F.expr(pick(BRANDS, "o_orderkey % 12")).alias("brand"),
        people.price_band(F.col("o_totalprice") / 50).alias("price"),
        people.day_part(order_ms("o_orderkey")).alias("part"),
        F.expr(pick(KEYWORD_TYPES, "o_orderkey % 5")).alias("keyword_type"),
        F.expr(pick(["Android", "iOS", "other"], "o_orderkey % 3")).alias("os"))
    return with_age_scores(rows, "band", "category", "brand", "price", "part", "keyword_type", "os")


# -- text -----------------------------------------------------------------------------------

@query
def txt_keywords(t: Testbed):
    words = text.explode_keywords(t.table("documents").select("lang", "text"), "text")
    return words.groupBy("lang", "keyword").agg(F.count("*").alias("texts"))


@query
def txt_segments(t: Testbed):
    """Every second text with a Han phrase at its end."""
    rows = t.table("documents").selectExpr("lang", f"if(doc_id % 2 = 0, concat(text, {han_phrase('doc_id')}), text) as text")
    words = text.explode_segments(rows, t.han_words(), "text", "word")
    return words.groupBy("lang", "word").agg(F.count("*").alias("texts"))


def _comment_texts(t: Testbed) -> DataFrame:
    return t.comment_info_events().select(F.col("after")["id"].cast("bigint").alias("id"),
                                          F.col("after")["comment_txt"].alias("msg"))


@query
def txt_last_piece_in_dictionary(t: Testbed):
    rows = _comment_texts(t).select("id", text.last_piece(F.col("msg")).alias("piece"))
    return text.with_membership(rows, t.words(), "piece").withColumn("piece", F.md5("piece"))


@query
def txt_membership_map(t: Testbed):
    rows = t.table("documents").select("doc_id", text.words_of(F.col("text")).alias("pieces"))
    found = text.membership_map(rows, t.words(), "doc_id", "pieces")
    hits = F.map_keys(F.map_filter("membership", lambda k, v: v))
    return found.select("doc_id", F.size("membership").alias("pieces"),
                        F.array_join(F.array_sort(hits), ",").alias("hits"))


@query
def txt_words_inside(t: Testbed):
    rows = t.table("documents").select("doc_id", "text")
    found = text.with_words_inside(rows, t.words(), "text", "found")
    return found.select("doc_id", F.array_join("found", ",").alias("found"))


@query
def txt_grade_last_piece(t: Testbed):
    return text.grade_by_last_piece(_comment_texts(t), t.words()).drop("msg")


@query
def comment_moderation(t: Testbed):
    return comments.moderation(_comment_orders(t), t.words()).withColumn("msg", F.md5("msg"))


# -- tags -----------------------------------------------------------------------------------

def _users(t: Testbed) -> DataFrame:
    return tags.user_attributes(t.feed("user_info", "user_info_sup_msg"), F.lit(AS_OF).cast("date"))


@query
def tag_user_attributes(t: Testbed):
    return _users(t)


@query
def tag_order_rows(t: Testbed):
    return tags.order_age_rows(t.feed("order_detail", "order_info"), joins.flat_products(**t.product_dims()))


TAG_COLUMNS = """user_id name age_group id te ts category_name tm_name price_sensitive time_period keyword
keyword_type os category_type tm_type category_score tm_score price_sensitive_score time_period_score
keyword_type_score os_score total_score new_age_group""".split()


@query
def tag_age(t: Testbed):
    rows = tags.age_tags(t.feed("order_detail", "order_info"), _users(t), etl.log_profile(t.logs(), ["event_id"]),
                         joins.flat_products(**t.product_dims()), t.keyword_types(), "event_id",
                         user_ms=120 * HOUR_MS, log_ms=48 * HOUR_MS)
    return rows.select(*TAG_COLUMNS)



@query
def tag_age_default_bounds(t: Testbed):
    """The tag at its own bounds: users a minute and searches an hour around the order, both derived from the orders."""
    orders = t.table("orders").select("o_orderkey", "o_custkey", order_ms("o_orderkey").alias("ms"))
    users = tags.user_rows(orders.selectExpr(
        "o_custkey as id", "concat('user ', o_custkey) as name", "cast(o_custkey * 137 % 21000 - 3650 as int) as birthday",
        "case o_custkey % 3 when 1 then 'M' when 2 then 'F' end as gender", "ms + o_orderkey % 5 * 20000 as ts_ms"),
        F.lit(AS_OF).cast("date"))
    searches = orders.selectExpr(
        "cast(o_custkey as string) as uid", "ms + o_orderkey % 3 * 2400000 as ts", "if(o_custkey % 2 = 0, 'Android', 'iOS') as os",
        "concat('k', o_orderkey % 100, ' view') as keyword", "o_orderkey as event_id")
    rows = tags.age_tags(t.feed("order_detail", "order_info"), users, searches, joins.flat_products(**t.product_dims()),
                         t.keyword_types(), "event_id")
    return rows.select(*TAG_COLUMNS)


# -- records for sinks ------------------------------------------------------------------------

@query
def sink_json_records(t: Testbed):
    """Cart facts as (topic, key, value) records with snake_case JSON."""
    return sinks.json_records(trade.cart_add_fact(t.feed("cart_info")), F.lit("dwd_trade_cart_add"), ["id"])


@query
def sink_topics_per_record(t: Testbed):
    """Routed facts as records whose topic varies, written by topic and read again."""
    path = _folder(t, "topics")
    routed = dims.fact_rows(t.mixed_feed("part", "cart_info"), t.fact_config_events())
    sinks.append_table(path, ["topic"])(sinks.json_records(routed, F.col("sink_table"), ["ts_ms"]), 0)
    return t.spark.read.parquet(path).select("topic", "key").groupBy("topic", "key").agg(F.count("*").alias("n"))


@query
def sink_appended_windows(t: Testbed):
    """Window rows appended by date in two batches, of which one came twice."""
    path, rows = _folder(t, "windows"), _province_windows(t, "1 day")
    write = sinks.append_table(path, ["cur_date"])
    for batch in (0, 1, 1):
        write(rows.filter(F.col("province_id") % 2 == batch), batch)
    return t.spark.read.parquet(path).drop("batch_id", "cur_date")


@query
def sink_upserted(t: Testbed):
    """The newest row per order line of three batches, of which two were compacted."""
    path, rows = _folder(t, "lines"), t.lines().select("id", "ts_ms", "seq", "sku_id")
    write = sinks.append_table(path)
    for batch in range(3):
        write(rows.filter(F.col("sku_id") % 3 == batch), batch)
        if batch == 1:
            sinks.compact(t.spark, path, ["id"], ["ts_ms", "seq"])
    return sinks.upserted(t.spark, path, ["id"], ["ts_ms", "seq"])


@query
def sink_dimension_view(t: Testbed):
    """Rows of one dimension in force, from routed changes written by table and compacted."""
    path = _folder(t, "dimensions")
    changes_of = sinks.route_dimension_changes(lambda df: dims.dimension_rows(df, t.dim_config_events(), DB), path)
    changes_of(t.mixed_feed("part", "supplier"), 0)
    sinks.compact(t.spark, path, ["sink_table", "row_key"], ["ts_ms"])
    return sinks.dimension_view(t.spark, path, "dim_part").select("sink_table", "row_key", _sorted_entries("data"), "ts_ms")


@query
def sink_table_lives(t: Testbed):
    """Dimension tables created, made anew and dropped with rows between, written in two batches of which one came twice."""
    path = _folder(t, "lives")
    write = sinks.route_dimension_changes(lambda df: dims.dimension_rows_by_life(df, t.dim_config_history(), DB), path)
    for batch, table in enumerate(("part", "supplier", "supplier")):
        write(t.mixed_feed(table), min(batch, 1))
    actions = dims.table_life(t.dim_config_history())
    views = [sinks.dimension_view(t.spark, path, f"dim_{table}", actions) for table in ("part", "supplier")]
    return changes.union_all(views).select("sink_table", "row_key", _sorted_entries("data"), "ts_ms")


@query
def sink_split_outputs(t: Testbed):
    """The five outputs of one micro-batch of logs, written side by side and counted."""
    path = _folder(t, "logs")
    logs, _ = feeds.app_log(t.messages())
    sinks.append_tables(log_ops.split_logs, path)(logs, 0)
    counts = [t.spark.read.parquet(f"{path}/{kind}").agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
              for kind in ("err", "start", "display", "action", "page")]
    return changes.union_all(counts)


@query
def ads_reports_of_today(t: Testbed):
    """The reports at their defaults: today, ten channels; all windows are dated today for it."""
    today = F.date_format(F.current_date(), dates.DATE)
    orders = _province_windows(t, "1 hour").withColumn("cur_date", today)
    channels = serving.top_channels(traffic.traffic_window(t.logs()).withColumn("cur_date", today))
    return changes.union_all([
        serving.gmv(orders).select(F.lit("gmv").alias("report"), F.lit("").alias("name"), F.col("order_amount").cast("double").alias("v")),
        serving.province_amounts(orders).select(F.lit("province"), "province_name", F.col("order_amount").cast("double"))
        .toDF("report", "name", "v"),
        channels.select(F.lit("channel"), "ch", F.col("uv_ct").cast("double")).toDF("report", "name", "v")])
