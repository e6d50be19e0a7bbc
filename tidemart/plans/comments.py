"""Comment facts and their moderation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import etl
from tidemart.operators.changes import drop_repeats
from tidemart.operators.joins import dictionary_name, dictionary_name_or, interval_join, prefixed
from tidemart.operators.text import grade_by_last_piece, grade_by_words_inside

MINUTE_MS = 60_000


def comment_fact(events: etl.Feed, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal; an unknown appraisal drops the row."""
    comments = etl.of_table(events, "comment_info").select(
        *etl.after({"id": "bigint", "user_id": "bigint", "sku_id": "bigint", "appraise": "string",
                    "comment_txt": "string"}), "ts_ms")
    return dictionary_name(comments, dictionary, "appraise", "appraise_name").select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms")


def comment_sides(events: etl.Feed, dictionary: DataFrame, order_columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Comments with the name of their appraisal, and orders with all columns as ``info_*``."""
    comments = dictionary_name_or(etl.flat_comments(events), dictionary, "appraise", "dic_name")
    return comments, prefixed(etl.flat_orders(events, order_columns))


def comment_order_fact(events: etl.Feed, dictionary: DataFrame, order_columns: dict[str, str],
                       within_ms: int = MINUTE_MS, tz: str | None = None) -> DataFrame:
    """Comments with their order's columns as ``info_*``, if both came within a minute."""
    comments, orders = comment_sides(events, dictionary, order_columns)
    joined = interval_join(comments, orders, {"order_id": "info_id"}, "ts_ms", "info_tm_ms",
                           -within_ms, within_ms, spread="left")
    return etl.with_day_key(joined, "ts_ms", tz)


def moderation(comments: DataFrame, words: DataFrame) -> DataFrame:
    """Graded comments: P0 for a dictionary word as last piece, P1 for one inside the text.

    Repeated comments of an order at the same time are dropped first.
    """
    rows = drop_repeats(comments, ["order_id", "ts_ms"]).select(
        "order_id", "user_id", F.col("info_consignee").alias("consignee"), "ts_ms", "ds",
        F.col("comment_txt").alias("msg"))
    graded = grade_by_words_inside(grade_by_last_piece(rows, words), words)
    return graded.drop("order_id")
