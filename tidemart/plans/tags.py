"""User attributes and the age tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions import people
from tidemart.functions.dates import from_epoch_days
from tidemart.functions.score import with_age_scores
from tidemart.operators import etl
from tidemart.operators.changes import drop_repeats, first_per_key, latest_records
from tidemart.operators.joins import interval_join, lookup
from tidemart.sources.feeds import with_event_time

MINUTE_MS = 60_000
HOUR_MS = 60 * MINUTE_MS


def unique_rows(events: etl.Feed, table: str, columns: dict[str, str]) -> DataFrame:
    """Typed columns of a table's live rows, each (id, time) once; a stream's also carry their event time ``et``."""
    rows = etl.drop_deletes(etl.of_table(events, table)).select(*etl.after({"id": "bigint", **columns}), "ts_ms")
    return drop_repeats(with_event_time(rows) if rows.isStreaming else rows, ["id", "ts_ms"])


def user_rows(rows: DataFrame, as_of: Column) -> DataFrame:
    """Age, age band, era and star sign of users given as id, name, birthday, gender, ts_ms; further columns stay."""
    birthday, more = F.col("birthday"), [c for c in rows.columns if c not in ("id", "name", "birthday", "gender", "ts_ms")]
    users = rows.withColumns({"birthday": from_epoch_days(birthday), "gender": people.gender_or_home(F.col("gender"))})
    return users.withColumn("age", people.age_years(birthday, as_of)).select(
        "id", "ts_ms", "name", birthday.cast("string").alias("birthday"), "gender", "age",
        people.age_band(F.col("age")).alias("age_group"), people.era(birthday).alias("era"),
        people.star_sign(birthday).alias("constellation"), *more)


def body_rows(events: etl.Feed) -> DataFrame:
    return etl.drop_deletes(etl.of_table(events, "user_info_sup_msg")).select(
        F.col("after")["uid"].cast("bigint").alias("_uid"), F.col("ts_ms").alias("_body_ts"),
        *etl.after({"height": "string", "unit_height": "string", "weight": "string", "unit_weight": "string"}))


USER_COLUMNS = {"name": "string", "birthday": "int", "gender": "string"}


def user_attributes(events: etl.Feed, as_of: Column, within_ms: int = HOUR_MS) -> DataFrame:
    """Users with age, age band, era, star sign, and body measures that came within the hour."""
    users = user_rows(unique_rows(events, "user_info", USER_COLUMNS), as_of)
    return interval_join(users, body_rows(events), {"id": "_uid"}, "ts_ms", "_body_ts", -within_ms, within_ms).drop(
        "_uid", "_body_ts")


def order_sides(events: etl.Feed) -> tuple[DataFrame, DataFrame]:
    """Order lines, and orders with ``_order``, ``_order_ts`` and on a stream ``_order_et``."""
    lines = unique_rows(events, "order_detail", {"sku_id": "bigint", "order_id": "bigint", "create_time": "bigint"})
    orders = unique_rows(events, "order_info", {"user_id": "bigint", "original_total_amount": "decimal(16,2)"})
    return lines, orders.withColumnsRenamed({"id": "_order", "ts_ms": "_order_ts", "et": "_order_et"})


def with_products(rows: DataFrame, products: DataFrame) -> DataFrame:
    chain = {c: c for c in ("category3_id", "category2_id", "category1_id", "tm_id", "tm_name")}
    return lookup(rows, products, {"sku_id": "sku_id"}, {**chain, "category1_name": "category_name"})


def order_age_lines(events: etl.Feed, within_ms: int = MINUTE_MS) -> DataFrame:
    """Order lines with user and order amount; ``te`` is the joined time."""
    lines, orders = order_sides(events)
    rows = interval_join(lines, orders, {"order_id": "_order"}, "ts_ms", "_order_ts", -within_ms, within_ms)
    rows = rows.withColumn("te", F.greatest("ts_ms", "_order_ts")).drop("_order", "_order_ts", "ts_ms")
    # One row per line and creation time: an order's later changes repeat the line.
    return first_per_key(rows, ["id", "create_time"], ["te", "sku_id"])


def order_age_rows(events: etl.Feed, products: DataFrame, within_ms: int = MINUTE_MS) -> DataFrame:
    """As ``order_age_lines``, with brand and category."""
    return with_products(order_age_lines(events, within_ms), products)


def user_side(users: DataFrame) -> DataFrame:
    return users.select(*[F.col(c).alias("user_" + c) if c in ("id", "ts_ms", "et") else F.col(c)
                          for c in users.columns]).withColumnRenamed("user_id", "_uid")


def search_side(logs: DataFrame) -> DataFrame:
    return etl.only_keywords(logs).select(F.col("uid").cast("bigint").alias("_log_uid"), "ts", "os", "keyword",
                                          *[F.col(c).alias("log_et") for c in logs.columns if c == "et"])


def scored_rows(rows: DataFrame, keyword_types: DataFrame) -> DataFrame:
    rows = rows.withColumns({"time_period": people.day_part(F.col("create_time")),
                             "price_sensitive": people.price_band(F.col("original_total_amount"))})
    rows = lookup(rows, keyword_types, {"keyword": "category_name"}, {"search_category": "keyword_type"}, "inner")
    return with_age_scores(rows, "age_group", "category_name", "tm_name", "price_sensitive", "time_period",
                           "keyword_type", "os")


def age_tags(events: etl.Feed, users: DataFrame, logs: DataFrame, products: DataFrame, keyword_types: DataFrame,
             arrival: str, line_ms: int = MINUTE_MS, user_ms: int = MINUTE_MS, log_ms: int = HOUR_MS) -> DataFrame:
    """One age tag per user (id, name): their first order that meets a recent search.

    ``logs`` is ``log_profile`` plus the column ``arrival``; ``keyword_types`` maps
    ``category_name`` to ``search_category``.  Each join's time is the later of its two sides.
    """
    rows = order_age_lines(events, line_ms)
    rows = interval_join(rows, user_side(users), {"user_id": "_uid"}, "te", "user_ts_ms", -user_ms, user_ms)
    rows = rows.withColumn("te", F.greatest("te", "user_ts_ms")).drop("_uid")

    searches = search_side(latest_records(logs, "uid", "ts", arrival))
    rows = interval_join(rows, searches, {"user_id": "_log_uid"}, "te", "ts", -log_ms, log_ms)
    rows = rows.withColumn("te", F.greatest("te", "ts")).drop("_log_uid")
    # Brand and category are wide: they are looked up for the lines that met a user and a search.
    rows = with_products(rows, products)
    return first_per_key(scored_rows(rows, keyword_types), ["user_id", "name"], ["te", "id", "ts"])


def nested_tag(tags: DataFrame) -> DataFrame:
    """The tag as the three documents it is published as: user, Age, ageScore."""
    user = F.struct("birthday", "gender", "weight", F.col("age_group").alias("ageGroup"), "constellation",
                    "unit_height", F.col("era").alias("Era"), "name", F.col("user_id").alias("id"), "unit_weight",
                    F.col("new_age_group").alias("new_ageGroup"), F.col("user_ts_ms").alias("ts_ms"), "age", "height")
    age = F.struct("category_name", "create_time", "os", "sku_id", "price_sensitive", "original_total_amount",
                   "keyword_type", "tm_name", "category_type", "tm_type", "category1_id", "tm_id", "user_id", "id", "keyword", "order_id",
                   "category3_id", "category2_id", "time_period", "ts")
    score = F.struct("tm_score", "price_sensitive_score", "time_period_score", "category_score", "os_score",
                     F.col("total_score").alias("TotalScore"), "keyword_type_score")
    return tags.select(user.alias("user"), age.alias("Age"), score.alias("ageScore"))
