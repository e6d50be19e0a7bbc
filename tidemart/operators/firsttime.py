"""First-time-today operators: unique visitors, unique carts, returning users.

State in arrival order becomes "the earliest row of the key on that day" by event time.
It is found with a partial aggregate per (key, day), never by sorting a key's rows, so a
single device or user may hold any share of the traffic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.functions.dates import DAY_MS, day_start_millis, local_day


def first_of_day(df: DataFrame, keys: list[str], ts: str, tz: str | None = None,
                 carry: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """The earliest row per key and day: keys, ``day``, ``ts`` and the ``carry`` columns."""
    aggs = [F.min(ts).alias(ts)]
    if carry:
        order = F.struct(ts, tie) if tie else F.col(ts)
        aggs.append(F.min_by(F.struct(*carry), order).alias("_carry"))
    firsts = df.groupBy(*keys, local_day(F.col(ts), tz).alias("day")).agg(*aggs)
    return firsts.select(*keys, "day", ts, *[F.col(f"_carry.{c}").alias(c) for c in carry or []])


def flag_first_of_day(df: DataFrame, keys: list[str], ts: str, tie: str, flag: str = "uv",
                      tz: str | None = None) -> DataFrame:
    """Every row, with ``flag`` 1 on the earliest row of its key and day, else 0.

    The rows are matched on (keys, ts, tie), which is unique per row and so evenly spread.
    """
    firsts = df.groupBy(*keys, local_day(F.col(ts), tz).alias("_day")) \
        .agg(F.min(F.struct(ts, tie)).alias("_f")) \
        .select(*keys, F.col(f"_f.{ts}").alias(ts), F.col(f"_f.{tie}").alias(tie), F.lit(1).alias("_hit"))
    return (df.join(firsts, [*keys, ts, tie], "left")
            .select(*df.columns, F.coalesce("_hit", F.lit(0)).cast("bigint").alias(flag)))


def days_since(ts: Column, day: Column, tz: str | None = None) -> Column:
    """Whole days from the start of ``day`` to ``ts``."""
    return F.floor((ts - day_start_millis(day, tz)) / DAY_MS)


def daily_logins(df: DataFrame, uid: str, ts: str, tz: str | None = None, gap_days: int = 8) -> DataFrame:
    """One row per user and login day: ``uu_ct`` 1, and ``back_ct`` 1 after a long absence.

    The window below runs over login days, of which a user has at most one per day.
    """
    firsts = first_of_day(df, [uid], ts, tz)
    last_day = F.lag("day").over(Window.partitionBy(uid).orderBy("day"))
    back = days_since(F.col(ts), last_day, tz) >= gap_days
    return firsts.select(uid, ts, F.lit(1).cast("bigint").alias("uu_ct"),
                         F.when(back, 1).otherwise(0).cast("bigint").alias("back_ct"))
