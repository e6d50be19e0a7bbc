"""Input and output schemas, all snake_case."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# A row change: before/after hold whatever columns the source table has.
CHANGE_EVENT = T.StructType([
    T.StructField("before", _TEXT_MAP),
    T.StructField("after", _TEXT_MAP),
    T.StructField("source", _TEXT_MAP),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

_COMMON = T.StructType([T.StructField(n, T.StringType()) for n in
                        ("ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc")])
_PAGE = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("last_page_id", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("during_time", T.LongType()),
])
_DISPLAY = T.StructType([
    T.StructField("pos_seq", T.IntegerType()),
    T.StructField("pos_id", T.IntegerType()),
    T.StructField("item", T.StringType()),
    T.StructField("item_type", T.StringType()),
])

# Actions, start and err carry free fields that are only passed through.
APP_LOG = T.StructType([
    T.StructField("common", _COMMON),
    T.StructField("page", _PAGE),
    T.StructField("displays", T.ArrayType(_DISPLAY)),
    T.StructField("actions", T.ArrayType(_TEXT_MAP)),
    T.StructField("start", _TEXT_MAP),
    T.StructField("err", _TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

# What the first visits need of a log line.
VISIT_LOG = T.StructType([
    T.StructField("common", T.StructType([f for f in _COMMON.fields if f.name in ("mid", "is_new")])),
    T.StructField("ts", T.LongType()),
])

# The page log read as a table of maps.
PAGE_LOG_MAPS = T.StructType([
    T.StructField("common", _TEXT_MAP),
    T.StructField("page", _TEXT_MAP),
    T.StructField("ts", T.LongType()),
])

DIM_CONFIG_COLUMNS = ["source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key"]
FACT_CONFIG_COLUMNS = ["source_table", "source_type", "sink_table", "sink_columns"]

MONEY = T.DecimalType(16, 2)

ORDER_DETAIL_FACT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("id", "order_id", "user_id", "sku_id")]
    + [T.StructField("sku_name", T.StringType()),
       T.StructField("province_id", T.IntegerType()),
       T.StructField("activity_id", T.LongType()),
       T.StructField("activity_rule_id", T.LongType()),
       T.StructField("coupon_id", T.LongType()),
       T.StructField("date_id", T.StringType()),
       T.StructField("create_time", T.LongType()),
       T.StructField("sku_num", T.LongType())]
    + [T.StructField(n, MONEY) for n in ("split_original_amount", "split_activity_amount",
                                         "split_coupon_amount", "split_total_amount")]
    + [T.StructField("ts_ms", T.LongType())])
