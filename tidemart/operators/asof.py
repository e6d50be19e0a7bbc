"""Lookups in a dimension or configuration as it was at the time of a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.operators.joins import join_config

BLOCK_MS = 3_600_000


def _all_known(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def lookup_as_of(df: DataFrame, versions: DataFrame, on: dict[str, str], ts: str, add: dict[str, str], version_ts: str = "ts_ms",
                 order: list[str] | None = None, deleted: Column | None = None, how: str = "left", block_ms: int = BLOCK_MS) -> DataFrame:
    """Add columns of the version in force at ``ts``: the newest of its key that is not later.

    ``on`` maps row column to version key, ``add`` version column to name; ``order`` decides between versions of one
    time.  Before its first version, after one that is ``deleted`` and for null keys or times the columns are null, or with
    ``how="inner"`` the row goes.  Time is cut into blocks: only the last version of a block is carried on, so a key's
    rows are never together in one task.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    alive = ~F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(True)
    side = versions.select(
        *[F.col(d).alias(k) for k, d in zip(keys, on.values(), strict=True)], F.col(version_ts).cast("long").alias("_at"),
        F.struct(*[F.col(c) for c in order or [version_ts]]).alias("_order"),
        F.struct(alive.alias("_alive"), *[F.col(c).alias(name) for c, name in add.items()]).alias("_version"))
    side = side.filter(_all_known([*keys, "_at"])).withColumn("_block", F.floor(F.col("_at") / block_ms))
    rows = df.select(*[F.col(c).alias(k) for k, c in zip(keys, on, strict=True)], F.col(ts).cast("long").alias("_at"),
                     F.struct(*df.columns).alias("_row")).withColumn("_block", F.floor(F.col("_at") / block_ms))
    known = _all_known([*keys, "_at"])
    asked, lost = rows.filter(known), rows.filter(~known)

    def empty(df_: DataFrame, column: str) -> Column:
        return F.lit(None).cast(df_.schema[column].dataType).alias(column)

    last = side.groupBy(*keys, "_block").agg(F.max_by("_version", F.struct("_at", "_order")).alias("_version"))
    steps = last.unionByName(asked.select(*keys, "_block").distinct().select(*keys, "_block", empty(last, "_version")))
    steps = steps.groupBy(*keys, "_block").agg(F.first("_version", True).alias("_version"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select(*keys, "_block", F.last("_version", True).over(before).alias("_carried"))
    both = asked.select(*keys, "_block", "_at", F.lit(1).alias("_kind"), empty(side, "_order"), empty(side, "_version"), "_row") \
        .unionByName(side.select(*keys, "_block", "_at", F.lit(0).alias("_kind"), "_order", "_version", empty(rows, "_row")))
    inside = Window.partitionBy(*keys, "_block").orderBy("_at", "_kind", "_order").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_version", F.last("_version", True).over(inside)).filter("_kind = 1")
    found = found.join(carried, [*keys, "_block"]).withColumn("_version", F.coalesce("_version", "_carried"))
    found = found.select("_row", F.when(F.col("_version._alive"), F.col("_version")).alias("_version"))
    found = found.unionByName(lost.select("_row", empty(found, "_version")))
    if how == "inner":
        found = found.filter(F.col("_version").isNotNull())
    return found.select("_row.*", *[F.col(f"_version.{name}").alias(name) for name in add.values()])


def in_force(rows: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """Configuration rows with the time from which (``_from``) and before which (``_to``) they hold; deletes end the one before.

    A configuration's history is short; of several rows of a key and time a delete comes first, else the larger row counts.
    """
    rest = [c for c in rows.columns if c not in (*keys, ts)]
    one = rows.groupBy(*keys, ts).agg(F.max(F.struct((F.col("op") != "d").alias("_alive"), *rest)).alias("_row"))
    later = Window.partitionBy(*keys).orderBy(ts)
    spans = one.select(*keys, F.col(ts).alias("_from"), F.lead(ts).over(later).alias("_to"), "_row.*")
    return spans.filter("_alive").drop("_alive")


def event_spread(ts: str = "ts_ms") -> list[Column]:
    """What tells change events of one table apart, for dealing them out."""
    return [F.col(ts), F.map_entries("before"), F.map_entries("after")]


def route_as_of(events: DataFrame, config: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """``events``, which have ``keys``, with the other columns of the configuration in force at their time, whose size
    decides how it is joined; events of what is not configured then go."""
    spans = in_force(config, keys).drop("op")
    known = (F.col(ts) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    return join_config(events, spans, keys, event_spread(ts)).filter(known).drop("_from", "_to")
