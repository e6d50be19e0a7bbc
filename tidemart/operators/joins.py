"""Lookups, interval joins and joins with hot keys.

Dimensions carry no broadcast hint: their size is not known when the plan is written.  Spark
broadcasts a side whose size is below the configured threshold, measured again at run time,
and otherwise shuffles it.  Sides with a checked bound are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot when it holds at least this share of all rows, so there are at most 1,000 by arithmetic.
HOT_SHARE = 1 / 1_000
# Rows that a configuration may have to be sent to every task.
SMALL_ROWS = 100_000


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, str], add: dict[str, str], how: str = "left") -> DataFrame:
    """Add dimension columns: ``on`` maps row column to dimension key, ``add`` dimension column to name.

    With ``how="left"`` a missing dimension row leaves the added columns null; "inner" drops it.
    """
    side = dim.select(*[F.col(d).alias(f"_k{i}") for i, d in enumerate(on.values())],
                      *[F.col(c).alias(name) for c, name in add.items()])
    condition = None
    for i, key in enumerate(on):
        part = F.col(key) == F.col(f"_k{i}")
        condition = part if condition is None else condition & part
    return df.join(side, condition, how).drop(*[f"_k{i}" for i in range(len(on))])


def dictionary_name(df: DataFrame, dictionary: DataFrame, code: str, name: str, how: str = "inner") -> DataFrame:
    return lookup(df, dictionary, {code: "dic_code"}, {"dic_name": name}, how)


def dictionary_name_or(df: DataFrame, dictionary: DataFrame, code: str, name: str, default: str = "N/A") -> DataFrame:
    named = dictionary_name(df, dictionary, code, name, "left")
    return named.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def flat_products(sku: DataFrame, spu: DataFrame, trademark: DataFrame, category3: DataFrame,
                  category2: DataFrame, category1: DataFrame) -> DataFrame:
    """The product snowflake as one row per sku, joined once and looked up once."""
    flat = sku.select(F.col("id").alias("sku_id"), "sku_name", "spu_id", "tm_id", "category3_id")
    flat = lookup(flat, spu, {"spu_id": "id"}, {"spu_name": "spu_name"})
    flat = lookup(flat, trademark, {"tm_id": "id"}, {"tm_name": "tm_name"})
    flat = lookup(flat, category3, {"category3_id": "id"}, {"name": "category3_name", "category2_id": "category2_id"})
    flat = lookup(flat, category2, {"category2_id": "id"}, {"name": "category2_name", "category1_id": "category1_id"})
    return lookup(flat, category1, {"category1_id": "id"}, {"name": "category1_name"})


def prefixed(df: DataFrame, prefix: str = "info_") -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def interval_join(left: DataFrame, right: DataFrame, on: dict[str, str], left_ts: str, right_ts: str,
                  lower_ms: int, upper_ms: int, spread: str = "right", how: str = "inner") -> DataFrame:
    """Rows with equal keys and ``left_ts + lower_ms <= right_ts <= left_ts + upper_ms``.

    Times are epoch milliseconds; column names of the two sides must differ.  In a batch the
    equi-key gets a time bucket, four intervals long, so a hot key is cut along time and
    no partition compares rows that are far apart.  The rows of ``spread`` (give the
    smaller side; for "left" joins it must be the right one) go to the one or two buckets their
    interval touches, the other side's rows to exactly one, so every pair meets once.
    """
    width = max(4 * (upper_ms - lower_ms), 1)
    low, high = F.lit(lower_ms), F.lit(upper_ms)
    if spread == "right":
        first, last, exact = F.col(right_ts) - high, F.col(right_ts) - low, F.col(left_ts)
    else:
        first, last, exact = F.col(left_ts) + low, F.col(left_ts) + high, F.col(right_ts)

    def bucket(c: Column) -> Column:
        return F.floor(c / F.lit(width)).cast("bigint")

    both = F.when(bucket(first) == bucket(last), F.array(bucket(first))).otherwise(F.array(bucket(first), bucket(last)))
    if spread == "right":
        left, right = left.withColumn("_lb", bucket(exact)), right.withColumn("_rb", F.explode(both))
    else:
        left, right = left.withColumn("_lb", F.explode(both)), right.withColumn("_rb", bucket(exact))
    condition = (F.col("_lb") == F.col("_rb")) & F.col(right_ts).between(F.col(left_ts) + low, F.col(left_ts) + high)
    for l, r in on.items():
        condition = condition & (F.col(l) == F.col(r))
    return left.join(right, condition, how).drop("_lb", "_rb")


def stream_interval_join(left: DataFrame, right: DataFrame, on: dict[str, str], left_et: str, right_et: str,
                         lower: str, upper: str, how: str = "inner") -> DataFrame:
    """The streaming form: both sides watermarked, bounds as interval text such as "-30 minutes"."""
    condition = F.expr(f"{right_et} >= {left_et} + interval {lower} and {right_et} <= {left_et} + interval {upper}")
    for l, r in on.items():
        condition = condition & (F.col(l) == F.col(r))
    return left.join(right, condition, how)


def hot_keys(counts: DataFrame, keys: list[str], n: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys that hold at least ``share`` of all rows, at most 1 / share of them."""
    least = share * counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) >= least).select(*keys, F.lit(True).alias("_hot"))


def salted_left_join(rows: DataFrame, side: DataFrame, hot: DataFrame, keys: list[str], spread_by: list[str] | list[Column],
                     salts: int = 64) -> DataFrame:
    """Left join in which the rows of hot keys are spread over ``salts`` partitions.

    ``side`` has one row per key; those of hot keys are copied once per salt.  ``hot`` (see ``hot_keys``) is bounded
    by its share and therefore broadcast.
    """
    hot = F.broadcast(hot)
    marked = rows.join(hot, keys, "left")
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = side.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return marked.withColumn("_salt", salt).drop("_hot").join(copied, [*keys, "_salt"], "left").drop("_salt")


def join_config(rows: DataFrame, config: DataFrame, keys: list[str], spread_by: list[Column]) -> DataFrame:
    """Inner join with a configuration of any size, whose keys in ``rows`` may be few and hot.

    Up to SMALL_ROWS rows, counted first, the configuration goes to all tasks.  A larger one is shuffled by its keys;
    rows of hot keys are then dealt by ``spread_by`` (a stream shuffles by the keys alone).
    """
    if config.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return rows.join(F.broadcast(config), keys)
    if rows.isStreaming:
        return rows.join(config, keys)
    hot = hot_keys(rows.groupBy(*keys).agg(F.count("*").alias("_n")), keys, "_n")
    joined = salted_left_join(rows, config.withColumn("_known", F.lit(True)), hot, keys, spread_by)
    return joined.filter("_known").drop("_known")
