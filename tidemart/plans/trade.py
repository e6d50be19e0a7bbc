"""Trade facts from change events, and order summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemart import schemas
from tidemart.functions.dates import to_date_text
from tidemart.operators import etl
from tidemart.operators.changes import net_of_resends
from tidemart.operators.joins import dictionary_name, interval_join, lookup
from tidemart.operators.windows import total, tumble

MONEY = "decimal(16,2)"
AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
PAYMENT_LOWER_MS, PAYMENT_UPPER_MS = -30 * 60_000, 5_000


def cart_add_fact(events: etl.Feed) -> DataFrame:
    return etl.cart_additions(events)


def order_lines(events: etl.Feed) -> DataFrame:
    lines = etl.of_table(events, "order_detail", "c").select(
        *etl.after({"id": "bigint", "order_id": "bigint", "sku_id": "bigint", "sku_name": "string",
                    "create_time": "bigint", "sku_num": "bigint", "order_price": MONEY,
                    "split_activity_amount": MONEY, "split_coupon_amount": MONEY, "split_total_amount": MONEY}),
        "ts_ms")
    original = (F.col("sku_num").cast(MONEY) * F.col("order_price")).cast(MONEY)
    return lines.withColumn("split_original_amount", original).drop("order_price")


def order_detail_fact(events: etl.Feed, met: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Order lines with their order's user and province, and activity and coupon if any.

    ``met`` joins the lines with something inner before they meet the rest, so that fewer wide rows are shuffled; the
    columns it adds follow the fact's.
    """
    orders = etl.of_table(events, "order_info", "c").select(
        *etl.after({"id": "bigint", "user_id": "bigint", "province_id": "int"}))
    activities = etl.of_table(events, "order_detail_activity", "c").select(
        *etl.after({"order_detail_id": "bigint", "activity_id": "bigint", "activity_rule_id": "bigint"}))
    coupons = etl.of_table(events, "order_detail_coupon", "c").select(
        *etl.after({"order_detail_id": "bigint", "coupon_id": "bigint"}))
    lines = order_lines(events)
    more = []
    if met:
        bare, lines = lines.columns, met(lines)
        more = [c for c in lines.columns if c not in bare]
    fact = lookup(lines, orders, {"order_id": "id"},
                  {"user_id": "user_id", "province_id": "province_id"}, "inner")
    fact = lookup(fact, activities, {"id": "order_detail_id"},
                  {"activity_id": "activity_id", "activity_rule_id": "activity_rule_id"})
    fact = lookup(fact, coupons, {"id": "order_detail_id"}, {"coupon_id": "coupon_id"})
    return fact.withColumn("date_id", to_date_text(F.col("create_time"))).select(
        *schemas.ORDER_DETAIL_FACT.names, *more)


def cancels(events: etl.Feed) -> DataFrame:
    """Orders that go from unpaid to cancelled: cancel_id, cancel_time, cancel_ts."""
    return etl.transition(events, "order_info", "order_status", "1003", "1001").select(
        F.col("after")["id"].cast("bigint").alias("cancel_id"),
        F.col("after")["operate_time"].cast("bigint").alias("cancel_time"), F.col("ts_ms").alias("cancel_ts"))


def cancel_columns(joined: DataFrame) -> DataFrame:
    kept = [c for c in schemas.ORDER_DETAIL_FACT.names if c not in ("date_id", "create_time", "ts_ms")]
    return joined.select(*kept[:9], to_date_text(F.col("cancel_time")).alias("date_id"), "cancel_time", *kept[9:],
                         F.col("cancel_ts").alias("ts_ms"))


def order_cancel_fact(order_details: DataFrame | Callable[[Callable], DataFrame], events: etl.Feed,
                      within_ms: int | None = None) -> DataFrame:
    """Lines of orders that go from unpaid to cancelled.

    ``within_ms`` keeps the lines that are at most so much older or newer than the cancel.  ``order_details`` is the
    fact, or a function that makes it of the join with the cancels (``met`` of ``order_detail_fact``): the joins are
    the same, in an order that shuffles lines of other orders once instead of three times.
    """
    side = cancels(events)

    def met(lines: DataFrame) -> DataFrame:
        if within_ms is None:
            return lines.join(side, F.col("order_id") == F.col("cancel_id"))
        return interval_join(lines, side, {"order_id": "cancel_id"}, "ts_ms", "cancel_ts", -within_ms, within_ms, spread="right")

    return cancel_columns(order_details(met) if callable(order_details) else met(order_details))


def payment_fact(order_details: DataFrame, events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Paid lines: the payment comes at most 30 minutes after the line, or 5 seconds before it."""
    payments = etl.transition(events, "payment_info", "payment_status", "1602").select(
        F.col("after")["order_id"].cast("bigint").alias("paid_order"),
        F.col("after")["payment_type"].alias("payment_type_code"),
        F.col("after")["callback_time"].cast("bigint").alias("callback_time"), F.col("ts_ms").alias("paid_ts"))
    named = dictionary_name(payments, dictionary, "payment_type_code", "payment_type_name")
    joined = interval_join(named, order_details, {"paid_order": "order_id"}, "paid_ts", "ts_ms",
                           PAYMENT_LOWER_MS, PAYMENT_UPPER_MS, spread="left")
    return joined.select(F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name",
                         "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
                         "payment_type_name", "callback_time", "sku_num", *AMOUNTS[:3],
                         F.col("split_total_amount").alias("split_payment_amount"), F.col("paid_ts").alias("ts_ms"))


def refund_requests(events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Refund requests, type and reason named from one dictionary."""
    refunds = etl.of_table(events, "order_refund_info", "c").select(
        *etl.after({"id": "bigint", "user_id": "bigint", "order_id": "bigint", "sku_id": "bigint"}),
        F.col("after")["create_time"].cast("bigint").alias("create_time"),
        F.col("after")["refund_type"].alias("refund_type_code"),
        F.col("after")["refund_reason_type"].alias("refund_reason_type_code"),
        *etl.after({"refund_reason_txt": "string", "refund_num": "bigint", "refund_amount": MONEY}), "ts_ms")
    named = dictionary_name(refunds, dictionary, "refund_type_code", "refund_type_name")
    return dictionary_name(named, dictionary, "refund_reason_type_code", "refund_reason_type_name")


def orders_set_to(events: etl.Feed, status: str) -> DataFrame:
    """Orders that reach a status: set_id, set_user, set_province, set_ts."""
    return etl.transition(events, "order_info", "order_status", status).select(
        F.col("after")["id"].cast("bigint").alias("set_id"), F.col("after")["user_id"].cast("bigint").alias("set_user"),
        F.col("after")["province_id"].cast("int").alias("set_province"), F.col("ts_ms").alias("set_ts"))


def refund_columns(joined: DataFrame) -> DataFrame:
    return joined.select("id", "user_id", "order_id", "sku_id", F.col("set_province").alias("province_id"),
                         to_date_text(F.col("create_time")).alias("date_id"), "create_time", "refund_type_code",
                         "refund_type_name", "refund_reason_type_code", "refund_reason_type_name",
                         "refund_reason_txt", "refund_num", "refund_amount", "ts_ms")


def refund_fact(events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Refund requests of orders set to refunding; type and reason named from one dictionary."""
    orders = orders_set_to(events, "1005")
    return refund_columns(refund_requests(events, dictionary).join(orders, F.col("order_id") == F.col("set_id")))


def refunds_paid(events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Refund payments that succeed, with the name of their payment type."""
    paid = etl.transition(events, "refund_payment", "refund_status", "1602").select(
        *etl.after({"id": "bigint", "order_id": "bigint", "sku_id": "bigint"}),
        F.col("after")["payment_type"].alias("payment_type_code"), *etl.after({"callback_time": "bigint"}),
        F.col("after")["total_amount"].cast(MONEY).alias("refund_amount"), "ts_ms")
    return dictionary_name(paid, dictionary, "payment_type_code", "payment_type_name")


def requests_completed(events: etl.Feed) -> DataFrame:
    """Refund requests that are completed: done_order, done_sku, refund_num, done_ts."""
    return etl.transition(events, "order_refund_info", "refund_status", "0705").select(
        F.col("after")["order_id"].cast("bigint").alias("done_order"), F.col("after")["sku_id"].cast("bigint").alias("done_sku"),
        *etl.after({"refund_num": "bigint"}), F.col("ts_ms").alias("done_ts"))


def refund_payment_columns(joined: DataFrame) -> DataFrame:
    return joined.select("id", F.col("set_user").alias("user_id"), "order_id", "sku_id",
                         F.col("set_province").alias("province_id"), "payment_type_code", "payment_type_name",
                         to_date_text(F.col("callback_time")).alias("date_id"), "callback_time", "refund_num",
                         "refund_amount", "ts_ms")


def refund_payment_fact(events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Refunds paid out: payment, request and order all reached their final state."""
    joined = refunds_paid(events, dictionary).join(
        requests_completed(events), (F.col("order_id") == F.col("done_order")) & (F.col("sku_id") == F.col("done_sku")))
    return refund_payment_columns(joined.join(orders_set_to(events, "1006"), F.col("order_id") == F.col("set_id")))


# -- order summaries -------------------------------------------------------------------

def province_window(order_details: DataFrame, provinces: DataFrame, size: str = "1 second",
                    order: list[str] | None = None) -> DataFrame:
    """Order count and amount per window and province; re-sent lines count once.

    Names are looked up after the aggregation, on one row per window and province.
    """
    order = order or ["ts_ms"]
    lines = order_details.select("id", "order_id", "province_id", F.col("split_total_amount").alias("order_amount"),
                                 *order)
    net = net_of_resends(lines, ["id"], order, ["order_amount"])
    summed = tumble(net, size, ["province_id"], [F.count_distinct("order_id").alias("order_count"),
                                                 total("order_amount")], ts="ts_ms")
    return lookup(summed, provinces, {"province_id": "id"}, {"name": "province_name"}).select(
        "stt", "edt", "cur_date", "province_id", "province_name", "order_count", "order_amount")


def sku_window(order_details: DataFrame, products: DataFrame, size: str = "10 seconds",
               order: list[str] | None = None) -> DataFrame:
    """Amounts per window and sku with the sku's brand and category chain (see ``flat_products``)."""
    order = order or ["ts_ms"]
    names = {"split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
             "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount"}
    lines = order_details.select("id", "sku_id", *[F.col(a).alias(n) for a, n in names.items()], *order)
    net = net_of_resends(lines, ["id"], order, list(names.values()))
    summed = tumble(net, size, ["sku_id"], [total(n) for n in names.values()], ts="ts_ms")
    chain = ["tm_id", "tm_name", "category1_id", "category1_name", "category2_id", "category2_name",
             "category3_id", "category3_name", "sku_name", "spu_id", "spu_name"]
    full = lookup(summed, products, {"sku_id": "sku_id"}, {c: c for c in chain})
    return full.select("stt", "edt", "cur_date", F.col("tm_id").alias("trademark_id"),
                       F.col("tm_name").alias("trademark_name"), *chain[2:8], "sku_id", *chain[8:], *names.values())
