"""From a table read in chunks of its keys to the changes that follow it.

A chunk holds the keys of ``chunk_rows`` neighbouring numbers.  Before and after it is read the position of the change log is
noted: its *fence* (chunk, low, high, ts_ms).  What was read may show any state between the two, so the chunk's rows are
brought to the state at ``high`` by the changes inside the fence; from then on only later changes count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FENCE = "chunk long, low long, high long, ts_ms long"


def chunk_of(key: Column, chunk_rows: int) -> Column:
    return F.floor(key.cast("long") / chunk_rows).cast("long")


def _fenced(changes: DataFrame, fences: DataFrame, key: str, chunk_rows: int) -> DataFrame:
    """Changes with ``_key`` and the fence of its chunk, null where no chunk holds the key; an equality join, so Spark splits a hot chunk."""
    keyed = changes.withColumn("_key", F.coalesce(F.col("after")[key], F.col("before")[key]).cast("long"))
    side = fences.select(F.col("chunk").alias("_chunk"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    return keyed.withColumn("_chunk", chunk_of(F.col("_key"), chunk_rows)).join(side, "_chunk", "left")


def changes_after(changes: DataFrame, fences: DataFrame, key: str, chunk_rows: int, start: int, position: str = "pos") -> DataFrame:
    """Changes, of a batch or a stream, that the chunks do not hold: those after the fence of their key.

    Keys of no chunk, such as rows added behind the last one, and null keys count from ``start``, where the first chunk began.
    """
    later = F.col(position) > F.coalesce("_high", F.lit(start))
    return _fenced(changes, fences, key, chunk_rows).filter(later).select(changes.columns)


def changes_from(changes: DataFrame, start: int, position: str = "pos") -> DataFrame:
    """No snapshot: the changes after ``start``, the log's end when the job began."""
    return changes.filter(F.col(position) > start)


def chunk_events(snapshot: DataFrame, changes: DataFrame, fences: DataFrame, key: str, chunk_rows: int, position: str = "pos") -> DataFrame:
    """One event of kind ``r`` per key that existed at the end of its chunk's fence, in the columns of ``changes`` (``after``,
    ``before``, ``op``, ``ts_ms``, ``position`` and others, which are null).

    ``snapshot`` has one row per key; a null key is an event as it was read if it has no fence.  Of the changes of a key inside the fence
    the newest replaces the row that was read, adds one that was not there yet, or removes it.
    """
    kind = changes.schema["after"].dataType
    inside = _fenced(changes, fences, key, chunk_rows).filter((F.col(position) > F.col("_low")) & (F.col(position) <= F.col("_high")))
    newest = inside.groupBy("_key").agg(F.max_by(F.struct("op", "after", "ts_ms"), position).alias("_change"))
    read = snapshot.select(F.col(key).cast("long").alias("_key"), F.struct(*kind.names).cast(kind).alias("_read"))
    rows = read.join(newest, "_key", "full").withColumn("chunk", chunk_of(F.col("_key"), chunk_rows))
    rows = rows.join(fences, "chunk", "left").filter(F.coalesce(F.col("_change.op") != "d", F.lit(True)))
    made = {"after": F.when(F.col("_change").isNull(), F.col("_read")).otherwise(F.col("_change.after")), "op": F.lit("r"),
            "ts_ms": F.coalesce("_change.ts_ms", "ts_ms"), position: F.col("high")}
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in changes.schema.fields])


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, fences: DataFrame, key: str, chunk_rows: int, start: int,
                          position: str = "pos") -> DataFrame:
    """The rows of the chunks as events and every change they do not hold, each once."""
    rows = chunk_events(snapshot, changes, fences, key, chunk_rows, position)
    return rows.unionByName(changes_after(changes, fences, key, chunk_rows, start, position))
