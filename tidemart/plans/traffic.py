"""Traffic summaries: visitors, page views, searches, logins, carts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import etl
from tidemart.operators.firsttime import daily_logins, first_of_day
from tidemart.operators.text import explode_keywords, explode_segments
from tidemart.operators.windows import of_date, total, tumble

VIEW_KEYS = ["vc", "ch", "ar", "is_new"]


def traffic_window(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    """Unique visitors, sessions, page views and stay per window, version, channel, area, newness.

    A device's unique visit counts where its earliest view of the day falls.  Those views are
    added to the plain views as rows that only count one visitor, so every view is summed on
    the map side and only (device, day) pairs and window sums are shuffled.
    """
    views = etl.page_views(logs)
    visits = _earliest_views(views, tz)
    zero = F.lit(0).cast("bigint")
    rows = views.select("ts", *VIEW_KEYS, zero.alias("uv"), "sv", "pv", "during_time").unionByName(
        visits.select("ts", *VIEW_KEYS, F.lit(1).cast("bigint").alias("uv"), zero.alias("sv"), zero.alias("pv"),
                      zero.alias("during_time")))
    return tumble(rows, size, VIEW_KEYS, [total("uv", "uv_ct"), total("sv", "sv_ct"), total("pv", "pv_ct"),
                                          total("during_time", "dur_sum")], ts="ts")


def _earliest_views(views: DataFrame, tz: str | None) -> DataFrame:
    """Equal times are ordered by the dimensions, so the choice does not depend on row order."""
    ordered = views.withColumn("_dims", F.struct(*VIEW_KEYS))
    firsts = first_of_day(ordered, ["mid"], "ts", tz, carry=["_dims"], tie="_dims")
    return firsts.select("ts", "_dims.*")


def home_detail_window(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    """Unique visitors of the home page and of product pages per window."""
    pages = etl.of_pages(logs, ["home", "good_detail"]).select(
        F.col("common.mid").alias("mid"), (F.col("page.page_id") == "home").alias("home"), "ts")
    firsts = first_of_day(pages, ["mid", "home"], "ts", tz)
    return tumble(firsts, size, [], [F.count_if("home").alias("home_uv_ct"),
                                     F.count_if(~F.col("home")).alias("good_detail_uv_ct")], ts="ts")


def keyword_window(logs: DataFrame, size: str = "1 second", words: DataFrame | None = None) -> DataFrame:
    """How often each word was searched for per window; phrases without spaces are cut by the dictionary ``words``."""
    phrases = etl.searches(logs).select(F.col("page.item").alias("full_word"), "ts")
    found = explode_keywords(phrases, "full_word") if words is None else explode_segments(phrases, words, "full_word")
    return tumble(found, size, ["keyword"], [F.count("*").alias("keyword_count")], ts="ts")


def login_window(logs: DataFrame, size: str = "10 seconds", tz: str | None = None) -> DataFrame:
    """Users on their first login of the day, and those among them who return after a long absence."""
    rows = etl.logins(logs).select(F.col("common.uid").alias("uid"), "ts")
    return tumble(daily_logins(rows, "uid", "ts", tz), size, [],
                  [total("back_ct"), total("uu_ct")], ts="ts")


def cart_user_window(cart_adds: DataFrame, size: str = "1 second", cur_date: str | None = None,
                     tz: str | None = None) -> DataFrame:
    """Users adding to the cart for the first time that day, per window."""
    firsts = first_of_day(cart_adds.select("user_id", "ts_ms"), ["user_id"], "ts_ms", tz)
    return of_date(tumble(firsts, size, [], [F.count("*").alias("cart_add_uu_ct")], ts="ts_ms"), cur_date)
