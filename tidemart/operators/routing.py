"""Routing of change events by a configuration table.

Events hold their rows as text maps here, since the columns wanted are known only from the configuration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.asof import event_spread, lookup_as_of, route_as_of
from tidemart.operators.changes import latest_per_key
from tidemart.operators.joins import join_config


def current_config(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The configuration in force: newest row per key, deleted keys left out."""
    return latest_per_key(rows, keys, order or ["ts_ms"], deleted=F.col("op") == "d")


def prune_columns(data: Column, columns: Column) -> Column:
    """Only the entries whose name is in the comma list ``columns``."""
    wanted = F.transform(F.split(columns, ","), lambda c: F.trim(c))
    return F.map_filter(data, lambda k, v: F.array_contains(wanted, k))


def route_dimensions(events: DataFrame, config: DataFrame) -> DataFrame:
    """Each event of a configured table with its sink, row key, kind and wanted columns.

    A delete takes its row from ``before``.  Events of other tables are dropped.
    """
    side = config.select("source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key")
    keyed = events.withColumn("source_table", F.col("source")["table"])
    routed = join_config(keyed, side, ["source_table"], event_spread())
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return routed.select("sink_table", "sink_family", row[F.col("sink_row_key")].alias("row_key"), "op", "ts_ms",
                         prune_columns(row, F.col("sink_columns")).alias("data"))


def route_facts(events: DataFrame, config: DataFrame) -> DataFrame:
    """Each event configured by (table, kind) with its sink and wanted columns plus ``ts_ms``."""
    side = config.select("source_table", "source_type", "sink_table", "sink_columns")
    keyed = events.withColumn("source_table", F.col("source")["table"]).withColumn("source_type", F.col("op"))
    return join_config(keyed, side, ["source_table", "source_type"], event_spread()).select(
        "sink_table", prune_columns(F.col("after"), F.col("sink_columns")).alias("data"), "ts_ms")


def route_facts_as_of(events: DataFrame, config: DataFrame) -> DataFrame:
    """As ``route_facts``, by the configuration that was in force when each event happened; ``config`` holds all changes."""
    keyed = events.withColumn("source_table", F.col("source")["table"]).withColumn("source_type", F.col("op")).drop("op")
    rows = config.select("source_table", "source_type", "sink_table", "sink_columns", "op", "ts_ms")
    return route_as_of(keyed, rows, ["source_table", "source_type"]).select(
        "sink_table", prune_columns(F.col("after"), F.col("sink_columns")).alias("data"), "ts_ms")


def route_dimensions_as_of(events: DataFrame, config: DataFrame) -> DataFrame:
    """As ``route_dimensions``, by the configuration that was in force when each event happened."""
    keyed = events.withColumn("source_table", F.col("source")["table"]).withColumnRenamed("op", "_kind")
    rows = config.select("source_table", "sink_table", "sink_family", "sink_columns", "sink_row_key", "op", "ts_ms")
    routed = route_as_of(keyed, rows, ["source_table"]).withColumnRenamed("_kind", "op")
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return routed.select("sink_table", "sink_family", row[F.col("sink_row_key")].alias("row_key"), "op", "ts_ms",
                         prune_columns(row, F.col("sink_columns")).alias("data"))


def current_dimension(routed: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The dimension rows in force after all events; null columns are not stored."""
    newest = latest_per_key(routed, ["sink_table", "row_key"], order or ["ts_ms"], deleted=F.col("op") == "d")
    return newest.withColumn("data", F.map_filter("data", lambda k, v: v.isNotNull()))


def table_actions(rows: DataFrame) -> DataFrame:
    """What each configuration row asks for: drop, create, or drop and create the sink table."""
    action = F.when(F.col("op") == "d", "drop").when(F.col("op") == "u", "recreate").otherwise("create")
    return rows.select("sink_table", "sink_columns", "ts_ms", action.alias("action"))


def with_generation(routed: DataFrame, actions: DataFrame) -> DataFrame:
    """Routed rows with ``generation``, the time at which the table that they go to was created, by ``table_actions`` of all
    configuration changes; rows of a time without the table go."""
    alive = actions.withColumn("_alive", F.col("action") != "drop")  # of one time, a drop comes first
    return lookup_as_of(routed, alive, {"sink_table": "sink_table"}, "ts_ms", {"ts_ms": "generation"}, order=["ts_ms", "_alive"],
                        deleted=~F.col("_alive"), how="inner")


def rows_in_force(rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Rows, which have ``generation``, of the tables that exist after all ``actions``; one newest action per table is joined."""
    alive = (F.col("action") != "drop").alias("_alive")
    newest = actions.groupBy("sink_table").agg(F.max(F.struct(F.col("ts_ms").alias("generation"), alive)).alias("_last"))
    existing = newest.filter("_last._alive").select("sink_table", "_last.generation")
    return rows.join(existing, ["sink_table", "generation"], "left_semi")
