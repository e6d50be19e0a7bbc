"""Deduplication and handling of rows that are sent again.

No operator here gathers all rows of a key: they aggregate with a map-side combine, or join
on a key that is unique per row, so one key may hold any share of the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key.

    Rows that share a key are copies; should they differ, a batch keeps the smallest, so a
    rerun gives the same row.  A stream keeps the first and forgets keys the watermark passed.
    """
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_equal_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _pick(df: DataFrame, keys: list[str], order: list[str], by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], deleted: Column | None = None) -> DataFrame:
    """Newest row per key; keys whose newest row is a delete are left out."""
    newest = _pick(df, keys, order, F.max_by)
    return newest.filter(~deleted) if deleted is not None else newest


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def retract_by_negation(df: DataFrame, keys: list[str], order: list[str], measures: list[str]) -> DataFrame:
    """Every row, plus each superseded row once more with its measures negated.

    Sums over the result count only the newest row per key.  ``order`` must be unique per
    row within a key; ``keys + order`` is then an evenly spread join key.
    """
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_o")) \
        .select(*keys, *[F.col(f"_o.{c}").alias(c) for c in order])
    superseded = df.join(newest, keys + order, "left_anti").select(
        *[(-F.coalesce(F.col(c), F.lit(0))).cast(df.schema[c].dataType).alias(c) if c in measures else F.col(c)
          for c in df.columns])
    return df.unionByName(superseded)


def last_per_window(df: DataFrame, keys: list[str], et: str, size: str, order: list[str]) -> DataFrame:
    """Newest row per key and tumbling window."""
    windowed = df.withColumn("_window", F.window(et, size).getField("start"))
    return latest_per_key(windowed, keys + ["_window"], order).drop("_window")


# -- running state --------------------------------------------------------------------

def _blocks(df: DataFrame, arrival: str, block: int) -> DataFrame:
    """Cut the arrival order into blocks so that a key's history spreads over tasks."""
    return df.withColumn("_block", F.floor(F.col(arrival) / F.lit(block)).cast("bigint"))


def latest_records(df: DataFrame, key: str, ts: str, arrival: str, block: int = 100_000) -> DataFrame:
    """Rows whose time exceeds that of every earlier arrival of their key.

    ``arrival`` is a unique integer position (such as a log offset).  A block holds at most
    ``block`` rows of a key; only one running maximum per block is carried between blocks.
    """
    rows = _blocks(df, arrival, block)
    per_block = rows.groupBy(key, "_block").agg(F.max(ts).alias("_top"))
    earlier_blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(key, "_block", F.max("_top").over(earlier_blocks).alias("_carried"))
    earlier_rows = Window.partitionBy(key, "_block").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.col("_carried"), F.max(ts).over(earlier_rows))
    return (rows.join(carried, [key, "_block"]).withColumn("_seen", seen)
            .filter(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen")))
            .select(*df.columns))


def running_profile(df: DataFrame, key: str, arrival: str, sets: list[str], block: int = 10_000) -> DataFrame:
    """Per row: how many rows its key has so far, and the distinct values seen, comma-joined.

    Values are joined in sorted order.  A value is carried from the one block in which it first
    appears, so what the blocks of a key carry adds up to its distinct values.
    """
    rows = _blocks(df, arrival, block)
    per_block = rows.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    for c in sets:
        firsts = rows.filter(F.col(c).isNotNull()).groupBy(key, c).agg(F.min("_block").alias("_block"))
        new = firsts.groupBy(key, "_block").agg(F.collect_list(c).alias(f"_new_{c}"))
        per_block = per_block.join(new, [key, "_block"], "left")
    earlier_blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        key, "_block", F.coalesce(F.sum("_n").over(earlier_blocks), F.lit(0)).alias("_before"),
        *[F.flatten(F.collect_list(f"_new_{c}").over(earlier_blocks)).alias(f"_old_{c}") for c in sets])
    so_far = Window.partitionBy(key, "_block").orderBy(arrival).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(carried, [key, "_block"])
    seen = [F.array_join(F.array_sort(F.array_union(f"_old_{c}", F.collect_set(c).over(so_far))), ",").alias(c)
            for c in sets]
    return joined.select(key, arrival, (F.col("_before") + F.count("*").over(so_far)).alias("pv"), *seen)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def net_of_resends(df: DataFrame, keys: list[str], order: list[str], measures: list[str]) -> DataFrame:
    """Rows whose measures add up like ``retract_by_negation``, without matching rows.

    All rows with measures 0 (they still count towards distinct values and open their
    windows) plus the newest row per key with its measures.
    """
    zeroed = df.select(*[F.lit(0).cast(df.schema[c].dataType).alias(c) if c in measures else F.col(c)
                         for c in df.columns])
    return zeroed.unionByName(latest_per_key(df, keys, order))
