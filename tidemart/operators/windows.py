"""Tumbling event-time windows and their label columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.dates import DATE, DATE_TIME, at_millis


def event_window(df: DataFrame, size: str, ts: str | None = None, et: str = "et") -> Column:
    """The tumbling window of epoch-millisecond column ``ts``, or of timestamp ``et``."""
    return F.window(at_millis(F.col(ts)) if ts else F.col(et), size)


def tumble(df: DataFrame, size: str, keys: list[str], measures: list[Column], ts: str | None = None,
           et: str = "et") -> DataFrame:
    """Group by window and keys; label rows with ``stt``, ``edt``, ``cur_date``.

    Without keys this is the global window: partial sums per task, then one row per window.
    A streaming input must carry its watermark on ``et``.
    """
    grouped = df.groupBy(event_window(df, size, ts, et).alias("window"), *keys).agg(*measures)
    return labelled(grouped)


def labelled(grouped: DataFrame, window: str = "window") -> DataFrame:
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    return grouped.select(F.date_format(start, DATE_TIME).alias("stt"), F.date_format(end, DATE_TIME).alias("edt"),
                          F.date_format(start, DATE).alias("cur_date"),
                          *[c for c in grouped.columns if c != window])


def total(column: str, alias: str | None = None) -> Column:
    """Sum in which a missing measure counts as zero."""
    return F.coalesce(F.sum(column), F.lit(0)).alias(alias or column)


def tumble_distinct(df: DataFrame, size: str, keys: list[str], column: str, out: str, sums: list[str], et: str = "et") -> DataFrame:
    """As ``tumble`` on a stream, with the exact number of distinct values of ``column`` and sums.

    The state holds one row per window, key and value, which sums the value's rows; when the watermark passes the window
    these rows are counted and summed once more, so no set of values is kept in one row.  Null values do not count.
    """
    values = df.groupBy(event_window(df, size, et=et).alias("_window"), *keys, column).agg(*[total(c) for c in sums])
    counted = [F.count(column).alias(out), *[total(c).cast(values.schema[c].dataType).alias(c) for c in sums]]
    return labelled(values.groupBy(F.window(F.window_time("_window"), size).alias("window"), *keys).agg(*counted))


def of_date(df: DataFrame, cur_date: str | None) -> DataFrame:
    return df if cur_date is None else df.filter(F.col("cur_date") == cur_date)
