"""Joins that drop lines come before those that make them wide, with the same rows."""

from pyspark.sql import functions as F

from checks.queries import registry
from tests.conftest import SF_DIR
from tidemart.plans import tags, trade
from tidemart.sources.feeds import as_change_events


def joins_of(df):
    """Join conditions of the optimized plan, the last join first."""
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]


def first_with(conditions, name):
    return next(k for k, c in enumerate(conditions) if name in c)


def feed(spark):
    """Lines of a cancelled, a repeated, an unknown and a null order; line 11 comes twice, as does the cancel of order 2."""
    lines = spark.createDataFrame(
        [(11, 1, 100), (11, 1, 100), (12, 1, 10_000_000), (21, 2, 0), (31, 3, 0), (41, None, 0), (None, 1, 100), (91, 9, 0)],
        "id long, order_id long, t long").selectExpr(
        "*", "7L as sku_id", "'sku' as sku_name", "t as create_time", "2L as sku_num", "cast(3 as decimal(16,2)) as price",
        "cast(0 as decimal(16,2)) as off", "cast(6 as decimal(16,2)) as total")
    orders = spark.createDataFrame([(1, "c", "1001", None), (1, "u", "1003", "1001"), (2, "c", "1001", None), (2, "u", "1003", "1001"),
                                    (2, "u", "1003", "1001"), (3, "c", "1001", None), (3, "u", "1002", "1001"), (9, "u", "1003", "1001")],
                                   "id long, op string, now string, old string").selectExpr("*", "5000L as t")
    row = {"id": "id", "user_id": "id * 10", "province_id": "cast(id as int)", "operate_time": "t", "order_status": "now"}
    parts = {"order_detail_id": "id", "activity_id": "id", "activity_rule_id": "id", "coupon_id": "id"}
    some = spark.createDataFrame([(11,), (21,), (21,)], "id long").withColumn("t", F.lit(0))
    return {"order_info": as_change_events(orders, "shop", "order_info", "op", "t", row, {**row, "order_status": "old"}),
            "order_detail": as_change_events(lines, "shop", "order_detail", "'c'", "t", {
                "id": "id", "order_id": "order_id", "sku_id": "sku_id", "sku_name": "sku_name", "create_time": "create_time", "sku_num": "sku_num",
                "order_price": "price", "split_activity_amount": "off", "split_coupon_amount": "off", "split_total_amount": "total"}),
            "order_detail_activity": as_change_events(some, "shop", "order_detail_activity", "'c'", "t", parts),
            "order_detail_coupon": as_change_events(some.limit(1), "shop", "order_detail_coupon", "'c'", "t", parts)}


def test_cancels_meet_the_lines_first(spark):
    for name in ("fact_order_cancel", "fact_order_cancel_recent"):
        conditions = joins_of(registry()[name](spark, SF_DIR))
        assert len(conditions) == 4 and first_with(conditions, "cancel_id") == 3


def test_cancels_of_a_fact_and_of_its_lines_agree(spark):
    events = feed(spark)
    for within in (None, 6_000):
        whole = trade.order_cancel_fact(trade.order_detail_fact(events), events, within)
        early = trade.order_cancel_fact(lambda met: trade.order_detail_fact(events, met), events, within)
        assert early.schema == whole.schema
        found = sorted(map(repr, early.collect()))
        assert found == sorted(map(repr, whole.collect()))
        # Order 1 was created once, order 9 never; order 2's one line has two activities and two cancels.
        assert len(found) == (8 if within is None else 7)


def test_products_are_looked_up_after_the_other_joins(spark):
    conditions = joins_of(registry()["tag_age_default_bounds"](spark, SF_DIR))
    assert first_with(conditions, "sku_id") < first_with(conditions, "_log_uid")


def test_rows_of_orders_keep_their_products(spark):
    events = feed(spark)
    orders = events["order_info"].withColumn("after", F.expr("named_struct('id', after.id, 'user_id', after.user_id, 'original_total_amount', 1)"))
    events = {**events, "order_info": orders}
    products = spark.sql("select 7L as sku_id, 1L as category3_id, 2L as category2_id, 3L as category1_id, 4 as tm_id, 'b' as tm_name, 'c' as category1_name")
    bare, named = tags.order_age_lines(events), tags.order_age_rows(events, products)
    assert bare.count() == named.count() > 0 and {r.category_name for r in named.collect()} == {"c"}
