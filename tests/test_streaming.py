"""Streams against the batch forms of the same rows.

Input files are read one per micro-batch.  A last row far in the future moves the watermark
past every window, as append mode gives a window out only then.
"""

import time

import pytest
from pyspark.sql import functions as F

from tidemart.operators import changes, joins
from tidemart.operators.windows import total, tumble
from tidemart.operators import logs as log_operators
from tidemart.plans import comments, tags, trade, traffic
from tidemart.sources.feeds import app_log, with_event_time
from tidemart.streaming import plans, processors, sinks
from tidemart.testbed import Testbed, ms as order_time
from tests.conftest import SF_DIR

DAY0 = 1_704_067_200_000
HOUR = 3_600_000
FLUSH = DAY0 + 90 * 24 * HOUR


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every partition of a stateful stream starts a Python worker, so two will do."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def stream_of(spark, folder, schema, batches):
    """Batches of tuples as a stream, one per trigger, with event time ``et`` from ``ts``."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1 if i + 1 < len(batches) else 0)
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return df.withColumn("et", F.timestamp_millis("ts")).withWatermark("et", "3 seconds")


def collect(spark, df, folder):
    sinks.run(df, sinks.append_table(f"{folder}/out"), f"{folder}/checkpoint", available_now=True).awaitTermination()
    return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").drop("batch_id").collect())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


LOGS = "mid string, vc string, page_id string, last_page_id string, item string, item_type string, ts long"


def nested(df):
    return df.select(F.struct("mid", F.col("mid").alias("uid"), "vc", F.lit("c").alias("ch"), F.lit("a").alias("ar"),
                              F.lit("1").alias("is_new")).alias("common"),
                     F.struct("page_id", "last_page_id", "item", "item_type",
                              F.lit(10).cast("long").alias("during_time")).alias("page"),
                     *[c for c in ("ts", "et") if c in df.columns])


def log(mid, hour, page="home", last=None, item=None):
    return (mid, "v1", page, last, item, "keyword" if item else None, DAY0 + int(hour * HOUR))


LOG_BATCHES = [
    [log("a", 0), log("a", 1), log("b", 1, "good_detail"), log("a", 2, "good_detail", "search", "red shoe red")],
    [log("a", 25), log("b", 3), log("b", 26, "home", "search", "shoe")],
    [log("a", 24 * 12), log("b", 24 * 3)],
    [("flush", "v1", "home", None, None, None, FLUSH), ("flush", "v1", "home", "search", "x", "keyword", FLUSH)],
]


@pytest.fixture(scope="module")
def batch_logs(spark):
    return nested(spark.createDataFrame([r for b in LOG_BATCHES[:-1] for r in b], LOGS))


def test_traffic_stream_equals_batch(spark, tmp_path, batch_logs):
    stream = nested(stream_of(spark, tmp_path / "in", LOGS, LOG_BATCHES))
    assert collect(spark, plans.traffic_stream(stream), tmp_path) == rows(traffic.traffic_window(batch_logs))


def test_home_detail_stream_equals_batch(spark, tmp_path, batch_logs):
    stream = nested(stream_of(spark, tmp_path / "in", LOGS, LOG_BATCHES))
    assert collect(spark, plans.home_detail_stream(stream), tmp_path) == rows(traffic.home_detail_window(batch_logs))


def test_login_stream_equals_batch(spark, tmp_path, batch_logs):
    stream = nested(stream_of(spark, tmp_path / "in", LOGS, LOG_BATCHES))
    result = collect(spark, plans.login_stream(stream), tmp_path)
    assert result == rows(traffic.login_window(batch_logs))
    assert sum(r[3] for r in result) == 1  # only the user away for eleven days returns


def test_keyword_stream_equals_batch(spark, tmp_path, batch_logs):
    stream = nested(stream_of(spark, tmp_path / "in", LOGS, LOG_BATCHES))
    assert collect(spark, plans.keyword_stream(stream), tmp_path) == rows(traffic.keyword_window(batch_logs))


def test_cart_stream_equals_batch(spark, tmp_path):
    schema = "user_id long, ts_ms long, ts long"
    batches = [[(1, DAY0, DAY0), (1, DAY0 + 5, DAY0 + 5), (2, DAY0, DAY0)],
               [(1, DAY0 + 25 * HOUR, DAY0 + 25 * HOUR), (2, DAY0 + HOUR, DAY0 + HOUR)], [(9, FLUSH, FLUSH)]]
    stream = stream_of(spark, tmp_path / "in", schema, batches)
    batch = spark.createDataFrame([r for b in batches[:-1] for r in b], schema)
    assert collect(spark, plans.cart_user_stream(stream), tmp_path) == rows(traffic.cart_user_window(batch))


def test_retracted_province_stream_equals_batch_sum(spark, tmp_path):
    schema = "id long, order_id long, province_id int, split_total_amount decimal(16,2), ts long, seq long"
    batches = [[(1, 10, 5, 100, DAY0, 1), (2, 10, 5, 50, DAY0, 1)], [(1, 10, 5, 80, DAY0 + 500, 2)],
               [(9, 9, 9, 0, FLUSH, 1)]]
    from decimal import Decimal
    batches = [[(*r[:3], Decimal(r[3]), *r[4:]) for r in b] for b in batches]
    provinces = spark.createDataFrame([(5, "P5")], "id int, name string")
    stream = stream_of(spark, tmp_path / "in", schema, batches)
    result = collect(spark, plans.province_stream(stream, provinces), tmp_path)
    assert result == [("2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-01", 5, 1, Decimal("130.00"), "P5")]
    batch = spark.createDataFrame([r for b in batches[:-1] for r in b], schema)
    signed = changes.retract_by_negation(batch, ["id"], ["ts", "seq"], ["split_total_amount"])
    assert [r[-1] for r in rows(tumble(signed, "1 second", [], [total("split_total_amount")], ts="ts"))] == [Decimal("130.00")]


def test_row_processors_equal_batch(spark, tmp_path):
    schema = "mid string, is_new string, ts long, event_id long"
    data = [("a", "1", DAY0, 1), ("a", "1", DAY0 + 30 * HOUR, 2), ("a", "0", DAY0 + 31 * HOUR, 3),
            ("b", "0", DAY0 + HOUR, 4), ("b", "1", DAY0 + 2 * HOUR, 5), ("a", "1", DAY0 + 29 * HOUR, 6)]
    batch = spark.createDataFrame(data, schema)
    stream = stream_of(spark, tmp_path / "in", schema, [data[:2], data[2:]])
    fixed = processors.repair_new_visitors_stream(stream).select("event_id", "is_new")
    assert collect(spark, fixed, tmp_path / "x") == [(1, "1"), (2, "0"), (3, "0"), (4, "0"), (5, "0"), (6, "0")]
    latest = processors.latest_records_stream(stream, "mid").select("event_id")
    expected = rows(changes.latest_records(batch, "mid", "ts", "event_id", block=2).select("event_id"))
    assert collect(spark, latest, tmp_path / "y") == expected == [(1,), (2,), (3,), (4,), (5,)]


def test_profile_stream_equals_batch(spark, tmp_path):
    schema = "uid string, os string, keyword string, ts long, event_id long"
    data = [("1", "iOS", None, DAY0, 1), ("1", "Android", "tea", DAY0 + 1, 2), ("2", "iOS", "cup", DAY0 + 2, 3),
            ("1", "iOS", "cup", DAY0 + 3, 4)]
    stream = stream_of(spark, tmp_path / "in", schema, [data[:2], data[2:]])
    batch = changes.running_profile(spark.createDataFrame(data, schema), "uid", "event_id", ["os", "keyword"], block=2)
    assert collect(spark, processors.profile_stream(stream), tmp_path) == rows(batch.drop("event_id"))


def test_interval_join_streams(spark, tmp_path):
    lines = stream_of(spark, tmp_path / "l", "id long, order_id long, ts long",
                      [[(1, 10, DAY0), (2, 11, DAY0)], [(9, 9, FLUSH)]])
    paid = stream_of(spark, tmp_path / "p", "paid_order long, payment_type_code string, ts long",
                     [[(10, "1101", DAY0 + 29 * 60_000), (11, "1101", DAY0 + 31 * 60_000)], [(8, "x", FLUSH)]])
    codes = spark.createDataFrame([("1101", "card")], "dic_code string, dic_name string")
    joined = plans.payment_stream(lines, paid.withColumnsRenamed({"et": "paid_et", "ts": "paid_ts"}), codes)
    assert collect(spark, joined.select("id", "payment_type_name"), tmp_path) == [(1, "card")]


def test_left_join_stream_gives_unmatched_line_once(spark, tmp_path):
    lines = stream_of(spark, tmp_path / "l", "id long, order_id long, ts long",
                      [[(1, 10, DAY0), (2, 10, DAY0)], [(9, 9, FLUSH)]])
    orders = stream_of(spark, tmp_path / "o", "oid long, user_id long, ts long", [[(10, 7, DAY0 + 1000)], [(8, 8, FLUSH)]])
    extras = stream_of(spark, tmp_path / "e", "detail_id long, coupon_id long, ts long", [[(1, 3, DAY0)], [(7, 7, FLUSH)]])
    joined = plans.order_lines_stream(
        lines.drop("ts"), orders.withColumnRenamed("et", "order_et").drop("ts"),
        extras.withColumnRenamed("et", "extra_et").drop("ts"), "detail_id")
    result = collect(spark, joined.select("id", "user_id", F.coalesce("coupon_id", F.lit(-1))), tmp_path)
    assert result == [(1, 7, 3), (2, 7, -1)]


def test_newest_row_is_given_out_once_after_the_delay(spark, tmp_path):
    schema = "id long, amount long, ts long"
    batches = [[(1, 10, DAY0), (1, 20, DAY0 + 1000), (2, 5, DAY0)], [(1, 7, DAY0 + 500)], [(9, 0, FLUSH)]]
    stream = stream_of(spark, tmp_path / "in", schema, batches)
    result = collect(spark, processors.newest_after_stream(stream, ["id"]).select("id", "amount"), tmp_path)
    batch = spark.createDataFrame([r for b in batches[:-1] for r in b], schema)
    assert result == rows(changes.latest_per_key(batch, ["id"], ["ts"]).select("id", "amount"))


def seconds(*points):
    return [DAY0 + int(p * 1000) for p in points]


def test_late_resend_neither_stops_the_stream_nor_changes_totals(spark, tmp_path):
    """The watermark moves in small steps and has passed the first row when it is sent again after 8 seconds."""
    from decimal import Decimal

    schema = "id long, order_id long, province_id int, split_total_amount decimal(16,2), ts long, seq long"
    at = seconds(0, 7.5, 7.6, 7.7, 8)
    batches = [[(1 if k in (0, 4) else 10 + k, 5, 5, Decimal(100 if k == 0 else 30), t, k)] for k, t in enumerate(at)]
    provinces = spark.createDataFrame([(5, "P5")], "id int, name string")
    stream = stream_of(spark, tmp_path / "in", schema, [*batches, [(9, 9, 9, Decimal(0), FLUSH, 1)]])
    result = collect(spark, plans.province_stream(stream, provinces), tmp_path)
    batch = spark.createDataFrame([r for b in batches for r in b], schema)
    newest = changes.latest_per_key(batch, ["id"], ["ts", "seq"]).agg(F.sum("split_total_amount")).first()[0]
    assert sum(r[5] for r in result) == newest == Decimal(120)


def test_newest_row_under_steady_traffic(spark, tmp_path):
    schema = "id long, amount long, ts long"
    batches = [[(1, 10, t0), (2, 5, t0)] if k == 0 else [(100 + k, 1, t0)] if k != 1 else [(1, 20, t0)]
               for k, t0 in enumerate(seconds(0, 4, 6, 7, 9, 12))]
    stream = stream_of(spark, tmp_path / "in", schema, [*batches, [(9, 0, FLUSH)], [(8, 0, FLUSH + HOUR)]])
    summed = tumble(processors.newest_after_stream(stream, ["id"]), "1 second", [], [total("amount")])
    batch = spark.createDataFrame([r for b in batches for r in b], schema)
    expected = changes.latest_per_key(batch, ["id"], ["ts"]).agg(F.sum("amount")).first()[0]
    assert sum(r[-1] for r in collect(spark, summed, tmp_path)) == expected == 29


def test_segmented_keyword_stream_equals_batch(spark, tmp_path):
    logs = [log("a", 1, item="智能手机轻薄"), log("b", 1, item="红手机 red shoe")]
    logs = [(m, v, p, "search", *rest) for m, v, p, _, *rest in logs]
    words = spark.createDataFrame([("智能手机",), ("手机",), ("智能",)], "word string")
    stream = nested(stream_of(spark, tmp_path / "in", LOGS, [logs, [("f", "v1", "home", "search", "x", "keyword", FLUSH)]]))
    batch = rows(traffic.keyword_window(nested(spark.createDataFrame(logs, LOGS)), words=words))
    assert collect(spark, plans.keyword_stream(stream, words=words), tmp_path) == batch
    assert {r[3] for r in batch} == {"智能手机", "轻", "薄", "红", "手机", "red", "shoe"}


def feed_streams(spark, folder, t, *tables):
    """A feed of the test tables, each as one written file and as a stream of it."""
    batch, streams = {}, {}
    for name, df in t.feed(*tables).items():
        df.limit(400).coalesce(1).write.parquet(str(folder / name))
        batch[name] = spark.read.parquet(str(folder / name))
        streams[name] = spark.readStream.schema(batch[name].schema).parquet(str(folder / name))
    return batch, streams


@pytest.fixture(scope="module")
def testbed(spark):
    return Testbed(spark, SF_DIR)


def test_cancel_stream_equals_batch(spark, tmp_path, testbed):
    batch, streams = feed_streams(spark, tmp_path / "in", testbed, "order_info", "order_detail", "order_detail_activity",
                                  "order_detail_coupon")
    details = trade.order_detail_fact(batch)
    details.write.parquet(str(tmp_path / "details"))
    lines = spark.readStream.schema(details.schema).parquet(str(tmp_path / "details"))
    expected = rows(trade.order_cancel_fact(details, batch, within_ms=1_805_000))
    assert collect(spark, plans.cancel_stream(with_event_time(lines), streams), tmp_path) == expected and expected


def test_refund_streams_equal_batch(spark, tmp_path, testbed):
    batch, streams = feed_streams(spark, tmp_path / "in", testbed, "order_refund_info", "order_info", "refund_payment")
    names = testbed.dictionary()
    expected = rows(trade.refund_fact(batch, names))
    assert collect(spark, plans.refund_stream(streams, names, 90 * 24 * 3600), tmp_path / "r") == expected and expected
    expected = rows(trade.refund_payment_fact(batch, names))
    assert collect(spark, plans.refund_payment_stream(streams, names, 90 * 24 * 3600), tmp_path / "p") == expected


def test_comment_order_stream_and_its_moderation_equal_batch(spark, tmp_path, testbed):
    batch, streams = feed_streams(spark, tmp_path / "in", testbed, "comment_info", "order_info")
    columns = {"id": "bigint", "user_id": "bigint", "consignee": "string"}
    joined = comments.comment_order_fact(batch, testbed.dictionary(), columns)
    stream = plans.comment_order_stream(streams, testbed.dictionary(), columns)
    write = sinks.append_result(lambda df: comments.moderation(df, testbed.words()), f"{tmp_path}/out")
    sinks.run(stream, write, f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    graded = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    expected = rows(comments.moderation(joined, testbed.words()))
    assert rows(graded) == expected and {r[-2] for r in expected} >= {"", "P0"}


def test_user_attributes_stream_equals_batch(spark, tmp_path, testbed):
    batch, streams = feed_streams(spark, tmp_path / "in", testbed, "user_info", "user_info_sup_msg")
    as_of = F.lit("2024-02-01").cast("date")
    expected = rows(tags.user_attributes(batch, as_of))
    assert collect(spark, plans.user_attributes_stream(streams, as_of), tmp_path) == expected and expected


def test_log_records_stream_equals_batch(spark, tmp_path, testbed):
    testbed.messages().limit(300).coalesce(1).write.parquet(str(tmp_path / "in"))
    messages = spark.read.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "in"))
    logs, _ = app_log(messages)
    got = collect(spark, plans.log_records_stream(stream), tmp_path)
    expected = rows(log_operators.split_records(logs))
    assert len(got) == len(expected) and sorted(r[0] for r in got) == sorted(r[0] for r in expected)


def test_age_tag_stream_tags_the_users_of_the_batch(spark, tmp_path, testbed):
    batch, streams = feed_streams(spark, tmp_path / "in", testbed, "order_info", "order_detail")
    orders = testbed.table("orders").filter("o_orderstatus is not null")
    at = order_time("o_orderkey")
    people = orders.selectExpr("o_custkey as id", "concat('u', o_custkey) as name", "cast(9000 + o_custkey as int) as birthday",
                               "'M' as gender", f"{at} as ts_ms").dropDuplicates(["id"])
    found = orders.selectExpr("cast(o_custkey as string) as uid", f"{at} + 60000 as ts", "'iOS' as os",
                              "concat('k', o_orderkey % 100, ' view') as keyword").dropDuplicates(["uid"])
    paths = {}
    for name, df in (("people", tags.user_rows(people, F.lit("2024-02-01").cast("date"))), ("found", found)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
        stored = spark.read.parquet(str(tmp_path / name))
        paths[name] = stored, spark.readStream.schema(stored.schema).parquet(str(tmp_path / name))
    products = joins.flat_products(**testbed.product_dims())
    expected = tags.age_tags(batch, paths["people"][0], paths["found"][0].withColumn("event_id", F.col("ts")), products,
                             testbed.keyword_types(), "event_id")
    stream = plans.age_tag_stream(streams, with_event_time(paths["people"][1]), with_event_time(paths["found"][1], "ts"),
                                  products, testbed.keyword_types())
    columns = ["user_id", "name", "age_group", "keyword"]
    wanted = rows(expected.select(columns))
    assert collect(spark, stream.select(columns), tmp_path) == wanted and wanted


def test_distinct_orders_of_a_window_under_resends(spark, tmp_path):
    """Many orders of one province, some lines sent again with other amounts: counts and sums equal the batch, no set is kept."""
    from decimal import Decimal
    schema = "id long, order_id long, province_id int, split_total_amount decimal(16,2), ts long, seq long"
    first = [(i, i // 3, 5 + i % 2, Decimal(i), DAY0 + i * 20, 1) for i in range(300)] + [(900, None, 5, Decimal(1), DAY0, 1)]
    again = [(i, i // 3, 5 + i % 2, Decimal(2 * i), DAY0 + i * 20, 2) for i in range(0, 300, 7)]
    stream = stream_of(spark, tmp_path / "in", schema, [first, again, [(9999, 9999, 9, Decimal(0), FLUSH, 1)]])
    provinces = spark.createDataFrame([(5, "P5"), (6, "P6"), (9, "P9")], "int_id int, name string").withColumnRenamed("int_id", "id")
    result = collect(spark, plans.province_stream(stream, provinces), tmp_path)
    batch = spark.createDataFrame(first + again, schema).withColumnRenamed("ts", "ts_ms")
    expected = trade.province_window(batch, provinces, order=["ts_ms", "seq"])
    assert sorted((r[0], r[3], r[4], r[5]) for r in result) == sorted(
        (r.stt, r.province_id, r.order_count, r.order_amount) for r in expected.collect())
    assert "collect_set" not in plans.province_stream(stream, provinces)._jdf.queryExecution().logical().toString()
