"""Filters, projections and reshaping of change events and logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import DAY_KEY, format_millis


def valid_events(events: DataFrame, db: str) -> DataFrame:
    """Known kinds of one database with a non-empty row; a delete needs its old row."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return events.filter((F.col("source")["db"] == db) & F.col("op").isin("c", "u", "d", "r")
                         & row.isNotNull() & (F.size(row) > 0))


def drop_bootstrap(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("op").startswith("bootstrap-"))


def drop_deletes(events: DataFrame) -> DataFrame:
    return events.filter(F.col("op") != "d")


# A change feed: either one DataFrame of all tables, rows held as text maps, or one DataFrame
# per table, rows held as typed structs.  Both are read by column name.
Feed = DataFrame | Mapping[str, DataFrame]


def of_table(events: Feed, table: str, op: str | None = None) -> DataFrame:
    if isinstance(events, Mapping):
        rows = events[table]
    else:
        rows = events.filter(F.col("source")["table"] == table)
    return rows.filter(F.col("op") == op) if op else rows


def transition(events: Feed, table: str, column: str, to: str, from_: str | None = None) -> DataFrame:
    """Updates that bring ``column`` to ``to``, from a given value or from any known one."""
    old = F.col("before")[column]
    was = old == from_ if from_ is not None else old.isNotNull()
    return of_table(events, table, "u").filter(was & (F.col("after")[column] == to))


def after(columns: dict[str, str]) -> list[Column]:
    """Named, typed columns of the new row: {name: type}."""
    return [F.col("after")[name].cast(kind).alias(name) for name, kind in columns.items()]


def cart_additions(events: Feed) -> DataFrame:
    """Quantity put into the cart: the row's for a new row, the increase for an update."""
    new = F.col("after")["sku_num"].cast("int")
    old = F.col("before")["sku_num"].cast("int")
    added = F.col("op").isin("c", "r") | ((F.col("op") == "u") & (new > old))
    return (of_table(events, "cart_info").filter(added)
            .select(*after({"id": "bigint", "user_id": "bigint", "sku_id": "bigint"}),
                    F.when(F.col("op") == "u", new - old).otherwise(new).alias("sku_num"), "ts_ms"))


# -- logs -----------------------------------------------------------------------------

def log_profile(logs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """User, time, operating system without its version, and the keyword searched for."""
    keyword = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return logs.select(F.col("common.uid").alias("uid"), "ts", F.split("common.os", " ")[0].alias("os"),
                       keyword.alias("keyword"), *keep or [])


def only_keywords(df: DataFrame) -> DataFrame:
    return df.filter(F.col("keyword").isNotNull())


def of_pages(logs: DataFrame, pages: list[str], column: str = "page.page_id") -> DataFrame:
    return logs.filter(F.col(column).isin(pages))


def _blank(col: Column) -> Column:
    return F.coalesce(col, F.lit("")) == ""


def logins(logs: DataFrame) -> DataFrame:
    """A signed-in user on the first page of a visit, or coming from the login page."""
    last = F.col("page.last_page_id")
    return logs.filter(~_blank(F.col("common.uid")) & ((last == "login") | _blank(last)))


def searches(logs: DataFrame) -> DataFrame:
    return logs.filter((F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword")
                       & F.col("page.item").isNotNull())


def session_flag(last_page: Column) -> Column:
    """1 on the first page of a session."""
    return F.when(_blank(last_page), 1).otherwise(0).cast("bigint")


def page_views(logs: DataFrame) -> DataFrame:
    """The flat row the traffic summary adds up."""
    return logs.select(F.col("common.mid").alias("mid"), F.col("common.vc").alias("vc"),
                       F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
                       F.col("common.is_new").alias("is_new"),
                       session_flag(F.col("page.last_page_id")).alias("sv"),
                       F.lit(1).cast("bigint").alias("pv"),
                       F.col("page.during_time").alias("during_time"), "ts")


# -- comments and orders --------------------------------------------------------------

def flat_comments(events: Feed) -> DataFrame:
    """One flat row per comment event that has an appraisal."""
    source = F.col("source")
    return (of_table(events, "comment_info")
            .filter(F.col("after").isNotNull() & F.col("after")["appraise"].isNotNull())
            .select("ts_ms", source["db"].alias("db"), source["table"].alias("table"),
                    source["server_id"].alias("server_id"), "op",
                    *after({"appraise": "string", "nick_name": "string", "create_time": "bigint",
                            "user_id": "bigint", "sku_id": "bigint", "id": "bigint", "spu_id": "bigint",
                            "order_id": "bigint"}),
                    F.col("after")["comment_txt"].alias("comment_txt")))


def flat_orders(events: Feed, columns: dict[str, str]) -> DataFrame:
    """Order columns from the new row, or from the old one when there is no new row."""
    rows = of_table(events, "order_info")
    new, old = F.col("after"), F.col("before")
    present = new.isNotNull()
    if isinstance(rows.schema["after"].dataType, T.MapType):
        present = present & (F.size(new) > 0)
    row = F.when(present, new).otherwise(old)
    return rows.select(
        "op", F.col("ts_ms").alias("tm_ms"), *[row[c].cast(t).alias(c) for c, t in columns.items()])


def with_day_key(df: DataFrame, ts_ms: str = "ts_ms", tz: str | None = None) -> DataFrame:
    return df.withColumn("ds", format_millis(F.col(ts_ms), DAY_KEY, tz))
