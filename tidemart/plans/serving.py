"""Report queries over the stored summaries, partitioned by ``cur_date``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.dates import DATE


def _day(date: str | None) -> Column:
    return F.lit(date) if date else F.date_format(F.current_date(), DATE)


def gmv(province_windows: DataFrame, date: str | None = None) -> DataFrame:
    """Total order amount of a date (today by default)."""
    return province_windows.filter(F.col("cur_date") == _day(date)).agg(F.sum("order_amount").alias("order_amount"))


def province_amounts(province_windows: DataFrame, date: str | None = None) -> DataFrame:
    return (province_windows.filter(F.col("cur_date") == _day(date)).groupBy("province_name")
            .agg(F.sum("order_amount").alias("order_amount")))


def top_channels(traffic_windows: DataFrame, date: str | None = None, limit: int = 10) -> DataFrame:
    """Channels with the most unique visitors of a date; equal counts in channel order."""
    return (traffic_windows.filter(F.col("cur_date") == _day(date)).groupBy("ch")
            .agg(F.sum("uv_ct").alias("uv_ct")).orderBy(F.desc("uv_ct"), "ch").limit(limit))
