"""Streaming forms of the summaries and facts.

Every input carries the watermarked event time ``et`` (see ``sources.feeds``).  Results are
appended when the watermark passes the end of a window or an interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators import etl
from tidemart.operators.joins import dictionary_name, lookup, stream_interval_join
from tidemart.operators.routing import prune_columns
from tidemart.operators.text import explode_keywords, explode_segments
from tidemart.operators.windows import total, tumble, tumble_distinct
from tidemart.operators.logs import split_records
from tidemart.plans import comments as comment_plans, tags, trade
from tidemart.plans.traffic import VIEW_KEYS
from tidemart.sources.feeds import app_log, with_event_time
from tidemart.streaming.processors import (daily_logins_stream, early_left_join_stream, first_ever_stream, first_of_day_stream,
                                           lookup_as_of_stream, repair_new_visitors_stream, retract_stream)


def traffic_stream(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    views = logs.select(
        F.col("common.mid").alias("mid"), *[F.col(f"common.{k}").alias(k) for k in VIEW_KEYS],
        etl.session_flag(F.col("page.last_page_id")).alias("sv"), F.col("page.during_time").alias("during_time"),
        "ts", "et")
    flagged = first_of_day_stream(views, ["mid"], "ts", "uv", tz)
    return tumble(flagged, size, VIEW_KEYS, [total("uv", "uv_ct"), total("sv", "sv_ct"),
                                             F.count("*").alias("pv_ct"), total("during_time", "dur_sum")])


def home_detail_stream(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    pages = etl.of_pages(logs, ["home", "good_detail"]).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "et")
    firsts = first_of_day_stream(pages, ["mid", "page_id"], "ts", "uv", tz).filter("uv = 1")
    return tumble(firsts, size, [], [F.count_if(F.col("page_id") == "home").alias("home_uv_ct"),
                                     F.count_if(F.col("page_id") != "home").alias("good_detail_uv_ct")])


def keyword_stream(logs: DataFrame, size: str = "1 second", words: DataFrame | None = None) -> DataFrame:
    phrases = etl.searches(logs).select(F.col("page.item").alias("full_word"), "et")
    found = explode_keywords(phrases, "full_word") if words is None else explode_segments(phrases, words, "full_word")
    return tumble(found, size, ["keyword"], [F.count("*").alias("keyword_count")])


def login_stream(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    rows = etl.logins(logs).select(F.col("common.uid").alias("uid"), "ts", "et")
    return tumble(daily_logins_stream(rows, tz), size, [], [total("back_ct"), total("uu_ct")])


def cart_user_stream(cart_adds: DataFrame, size: str = "1 second", tz: str | None = None) -> DataFrame:
    firsts = first_of_day_stream(cart_adds.select("user_id", "ts_ms", "et"), ["user_id"], "ts_ms", "uv", tz)
    return tumble(firsts.filter("uv = 1"), size, [], [F.count("*").alias("cart_add_uu_ct")])


def province_stream(order_details: DataFrame, provinces: DataFrame, size: str = "1 second",
                    ttl_ms: int = 10_000) -> DataFrame:
    lines = order_details.select("id", "order_id", "province_id", F.col("split_total_amount").alias("order_amount"), "et")
    signed = retract_stream(lines, ["id"], ["order_amount"], ttl_ms)
    summed = tumble_distinct(signed, size, ["province_id"], "order_id", "order_count", ["order_amount"])
    return lookup(summed, provinces, {"province_id": "id"}, {"name": "province_name"})


def sku_stream(order_details: DataFrame, products: DataFrame, size: str = "10 seconds",
               ttl_ms: int = 10_000) -> DataFrame:
    names = {"split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
             "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount"}
    lines = order_details.select("id", "sku_id", *[F.col(a).alias(n) for a, n in names.items()], "et")
    signed = retract_stream(lines, ["id"], list(names.values()), ttl_ms)
    summed = tumble(signed, size, ["sku_id"], [total(n) for n in names.values()])
    return lookup(summed, products, {"sku_id": "sku_id"}, {c: c for c in products.columns if c != "sku_id"})


def payment_stream(order_details: DataFrame, payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid lines; ``payments`` has paid_order, payment_type_code, callback_time and its event time ``paid_et``."""
    named = dictionary_name(payments, dictionary, "payment_type_code", "payment_type_name")
    return stream_interval_join(named, order_details, {"paid_order": "order_id"}, "paid_et", "et",
                                "'-30' minute", "'5' second")


def order_lines_stream(lines: DataFrame, orders: DataFrame, extras: DataFrame, extra_key: str, within: str = "10 seconds") \
        -> DataFrame:
    """Lines with their order (inner) and an optional partner (left), which come within the bound.

    ``orders`` has oid and ``order_et``, ``extras`` its key and ``extra_et``.  A line without partner is given once,
    when the watermark shows that none can come any more.
    """
    bound = f"interval {within}"
    joined = lines.join(orders, F.expr(f"order_id = oid and order_et between et - {bound} and et + {bound}")) \
        .drop("order_et")
    return joined.join(extras, F.expr(f"id = {extra_key} and extra_et between et - {bound} and et + {bound}"), "left")


def early_order_lines_stream(lines: DataFrame, extras: DataFrame, extra_key: str, within_ms: int = 10_000) -> DataFrame:
    """Order lines with an optional partner, at once: with nulls first, then taken back and given again with the partner.

    ``sinks.upserted`` by line and ``version`` over the result holds each line as it is in the end.
    """
    return early_left_join_stream(lines, extras, "id", extra_key, within_ms)


def fact_rows_stream(events: DataFrame, config: DataFrame, salts: int = 32) -> DataFrame:
    """Events routed by the configuration in force when they happened: streaming form of ``dims.fact_rows_as_of``.

    ``config`` is the configuration's own change feed (``feeds.config_rows`` with ``et``), read from its start.
    """
    keyed = etl.drop_bootstrap(events).select(
        F.col("source")["table"].alias("source_table"), F.col("op").alias("source_type"),
        F.to_json("after", {"ignoreNullFields": "false"}).alias("after"), "ts_ms", "et")  # state holds no maps
    routed = lookup_as_of_stream(keyed, config, {"source_table": "source_table", "source_type": "source_type"},
                                 {"sink_table": "sink_table", "sink_columns": "sink_columns"}, F.col("op") == "d", salts)
    return routed.filter("sink_table is not null").select(
        "sink_table", prune_columns(F.from_json("after", "map<string,string>"), F.col("sink_columns")).alias("data"), "ts_ms")


# -- facts and tags from feeds of change events -------------------------------------------------
#
# These take feeds without a watermark and set one on every side of a join, so state ends with the interval.

def _timed(df: DataFrame, ts_ms: str, et: str) -> DataFrame:
    return with_event_time(df, ts_ms).withColumnRenamed("et", et)


def cancel_stream(order_details: DataFrame, events: etl.Feed, within_s: int = 1805) -> DataFrame:
    """Streaming form of ``order_cancel_fact``; ``order_details`` carries its watermarked ``et``."""
    side = _timed(trade.cancels(events), "cancel_ts", "cancel_et")
    return trade.cancel_columns(stream_interval_join(
        order_details, side, {"order_id": "cancel_id"}, "et", "cancel_et", f"'-{within_s}' second", f"'{within_s}' second"))


def refund_stream(events: etl.Feed, dictionary: DataFrame, within_s: int = 7200) -> DataFrame:
    """Streaming form of ``refund_fact`` for requests and orders set to refunding within the bound of each other."""
    requests = _timed(trade.refund_requests(events, dictionary), "ts_ms", "et")
    orders = _timed(trade.orders_set_to(events, "1005"), "set_ts", "set_et")
    return trade.refund_columns(stream_interval_join(
        requests, orders, {"order_id": "set_id"}, "et", "set_et", f"'-{within_s}' second", f"'{within_s}' second"))


def refund_payment_stream(events: etl.Feed, dictionary: DataFrame, within_s: int = 7200) -> DataFrame:
    """Streaming form of ``refund_payment_fact``, the three final states within the bound of the payment."""
    paid = _timed(trade.refunds_paid(events, dictionary), "ts_ms", "et")
    done = _timed(trade.requests_completed(events), "done_ts", "done_et")
    orders = _timed(trade.orders_set_to(events, "1006"), "set_ts", "set_et")
    low, high = f"'-{within_s}' second", f"'{within_s}' second"
    joined = stream_interval_join(paid, done, {"order_id": "done_order", "sku_id": "done_sku"}, "et", "done_et", low, high)
    return trade.refund_payment_columns(stream_interval_join(joined, orders, {"order_id": "set_id"}, "et", "set_et", low, high))


def comment_order_stream(events: etl.Feed, dictionary: DataFrame, order_columns: dict[str, str], within_s: int = 60,
                         tz: str | None = None) -> DataFrame:
    """Streaming form of ``comment_order_fact``.

    Moderation follows per micro-batch: ``sinks.append_result(lambda df: comments.moderation(df, words), path)``.
    """
    comments, orders = comment_plans.comment_sides(events, dictionary, order_columns)
    joined = stream_interval_join(_timed(comments, "ts_ms", "et"), _timed(orders, "info_tm_ms", "info_et"),
                                  {"order_id": "info_id"}, "et", "info_et", f"'-{within_s}' second", f"'{within_s}' second")
    return etl.with_day_key(joined.drop("et", "info_et"), "ts_ms", tz)


def user_attributes_stream(events: etl.Feed, as_of: Column, within_s: int = 3600) -> DataFrame:
    """Streaming form of ``user_attributes``; a repeated (id, time) is forgotten with the watermark."""
    users = tags.user_rows(tags.unique_rows(events, "user_info", tags.USER_COLUMNS), as_of)
    joined = stream_interval_join(users, _timed(tags.body_rows(events), "_body_ts", "_body_et"), {"id": "_uid"}, "et",
                                  "_body_et", f"'-{within_s}' second", f"'{within_s}' second")
    return joined.drop("_uid", "_body_ts", "_body_et", "et")


def age_tag_stream(events: etl.Feed, users: DataFrame, logs: DataFrame, products: DataFrame, keyword_types: DataFrame,
                   line_s: int = 60, user_s: int = 60, log_s: int = 3600, seen: DataFrame | None = None) -> DataFrame:
    """Streaming form of ``age_tags``: a user's first tag to arrive, and no other one; ``seen`` (user_id, name) holds those tagged
    before a start without a checkpoint.

    ``users`` (see ``tags.user_rows``) and ``logs`` (``log_profile``, only newest records) carry their watermarked
    ``et``.  Every join is bounded on the line's event time, so state ends, and then exactly on the time ``te`` so far.
    """
    def between(et: str, ts: str, before_s: int, after_s: int, within_s: int) -> Column:
        return F.expr(f"{et} >= et - interval '{before_s}' second and {et} <= et + interval '{after_s}' second and "
                      f"{ts} between te - {within_s * 1000} and te + {within_s * 1000}")

    lines, orders = tags.order_sides(events)
    rows = stream_interval_join(lines, orders, {"order_id": "_order"}, "et", "_order_et", f"'-{line_s}' second", f"'{line_s}' second")
    rows = rows.withColumn("te", F.greatest("ts_ms", "_order_ts")).drop("_order", "_order_ts", "_order_et", "ts_ms")
    rows = tags.with_products(rows.dropDuplicatesWithinWatermark(["id", "create_time"]), products)
    rows = rows.join(tags.user_side(users), (F.col("user_id") == F.col("_uid"))
                     & between("user_et", "user_ts_ms", user_s, line_s + user_s, user_s))
    rows = rows.withColumn("te", F.greatest("te", "user_ts_ms")).drop("_uid", "user_et")
    rows = rows.join(tags.search_side(logs), (F.col("user_id") == F.col("_log_uid"))
                     & between("log_et", "ts", log_s, line_s + user_s + log_s, log_s))
    rows = rows.withColumn("te", F.greatest("te", "ts")).drop("_log_uid", "log_et")
    return first_ever_stream(tags.scored_rows(rows, keyword_types), ["user_id", "name"], seen)


def log_records_stream(messages: DataFrame, tz: str | None = None) -> DataFrame:
    """Raw log lines to (kind, value) records of all five outputs, the visitor flag repaired, in one job."""
    logs, _ = app_log(messages)
    flat = logs.select(F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts",
                       F.to_json(F.struct(*logs.columns)).alias("line"))
    fixed = repair_new_visitors_stream(with_event_time(flat, "ts"), tz)
    fields = F.from_json("line", logs.schema)
    rows = fixed.select("is_new", fields.alias("r")).select(
        *[F.col("r.common").withField("is_new", F.col("is_new")).alias(c) if c == "common" else F.col(f"r.{c}") for c in logs.columns])
    return split_records(rows)
