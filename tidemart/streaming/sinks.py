"""Sinks for batches and micro-batches.

A micro-batch may be written twice after a failure.  A writer puts the rows of batch N below ``batch_id=N`` and then, last, a
mark beside the table (``<path>.commits``).  ``stored_rows``, ``upserted``, ``dimension_view`` and ``compact`` read marked batches only.
A batch that has no mark yet is overwritten in place; one that is marked already is written to a new folder below ``<path>.redo``,
which counts once its own mark is there, so no folder changes that a reader may have open.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.changes import latest_per_key, union_all
from tidemart.operators.routing import current_dimension, rows_in_force


def json_records(df: DataFrame, topic: Column, key: list[str]) -> DataFrame:
    """Rows as (topic, key, value): the shape a Kafka write needs; the topic may vary by row."""
    return df.select(topic.alias("topic"), F.concat_ws("|", *key).alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))


def write_kafka(records: DataFrame, servers: str) -> None:
    """Needs the Spark Kafka package on the class path."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


# -- batch writers, each usable as a foreachBatch function ----------------------------------

def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder, none if it is absent, with the times they were written."""
    where, files = _folder(spark, path)
    return {f.getPath().getName(): f.getModificationTime() for f in files.listStatus(where)} if files.exists(where) else {}


def _mark(spark: SparkSession, path: str, batch_id: int, attempt: int) -> None:
    where, files = _folder(spark, f"{path}.commits/{batch_id}.{attempt}")
    files.create(where, True).close()


def _commits(spark: SparkSession, path: str) -> dict[int, dict[int, int]]:
    """Per batch its marked attempts with their times; the largest attempt counts, 0 stands in the table's own folder."""
    found: dict[int, dict[int, int]] = {}
    for name, written in _listed(spark, f"{path}.commits").items():
        batch_id, _, attempt = name.partition(".")
        found.setdefault(int(batch_id), {})[int(attempt)] = written
    return found


def _attempt_folder(path: str, batch_id: int, attempt: int) -> str:
    return f"{path}.redo/attempt={attempt}/batch_id={batch_id}" if attempt else f"{path}/batch_id={batch_id}"


def _write_batch(df: DataFrame, batch_id: int, path: str, partitions: list[str]) -> None:
    """Write a batch as an attempt of its own and mark it when it is whole."""
    spark = df.sparkSession
    earlier = any(name.startswith(f"{batch_id}.") for name in _listed(spark, f"{path}.commits"))
    attempt = time.time_ns() if earlier else 0
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(_attempt_folder(path, batch_id, attempt))
    _mark(spark, path, batch_id, attempt)


def append_table(path: str, partitions: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Append facts or window rows, e.g. partitioned by ``cur_date`` or ``sink_table``."""
    return lambda df, batch_id: _write_batch(df, batch_id, path, partitions or [])


def append_tables(outputs: Callable[[DataFrame], dict[str, DataFrame]], path: str) \
        -> Callable[[DataFrame, int], None]:
    """Several outputs from one micro-batch, which is read and computed once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for name, rows in outputs(df).items():
                _write_batch(rows, batch_id, f"{path}/{name}", [])
        finally:
            df.unpersist()

    return write


def append_result(result: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """Append what a batch operator makes of each micro-batch."""
    return lambda df, batch_id: _write_batch(result(df), batch_id, path, [])


def route_dimension_changes(route: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """Dimension changes by sink table; ``route`` reads the configuration anew for each batch."""
    return lambda df, batch_id: _write_batch(route(df), batch_id, path, ["sink_table"])


# -- readers of the tables above ------------------------------------------------------------

def _bases(spark: SparkSession, path: str) -> dict[int, int]:
    """The complete compactions by the last batch in them, with the times they were finished."""
    done = {}
    for name in _listed(spark, f"{path}.base"):
        finished = _listed(spark, f"{path}.base/{name}").get("_SUCCESS")
        if finished is not None:
            done[int(name.split("=")[1])] = finished
    return done


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of an appended table with ``batch_id``: its last compaction and the marked batches after it."""
    bases = _bases(spark, path)
    upto = max(bases, default=-1)
    parts = [spark.read.parquet(f"{path}.base/upto={upto}")] if bases else []
    later = {n: max(attempts) for n, attempts in sorted(_commits(spark, path).items()) if n > upto}
    for root, again in ((path, False), (f"{path}.redo", True)):
        folders = [_attempt_folder(path, n, attempt) for n, attempt in later.items() if bool(attempt) == again]
        if folders:
            parts.append(spark.read.option("basePath", root).parquet(*folders).drop("attempt"))
    if not parts:
        raise ValueError(f"no batch of {path} is complete")
    return union_all(parts)


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> int:
    """Write the newest row per key of all marked batches beside the table and return the last batch in it.

    Readers then skip the batches it covers; ``remove_superseded`` takes their folders away.  Rows of deletes stay, so an
    older row that comes late does not return.  A run that fails leaves no ``_SUCCESS`` and is not read; without newer
    batches nothing is written.  Run one at a time, on batches that are over.
    """
    done, marked = max(_bases(spark, path), default=-1), max(_commits(spark, path), default=-1)
    if 0 <= done >= marked:
        return done
    newest = latest_per_key(stored_rows(spark, path), keys, [*order, "batch_id"])
    newest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}.base/upto={marked}")
    return marked


def remove_superseded(spark: SparkSession, path: str, grace_ms: int) -> list[str]:
    """Remove what a compaction or a repeated batch replaced at least ``grace_ms`` ago, and return those folders.

    A reader keeps the list of folders it was planned with, so the grace must exceed the longest read.  What counts now is never
    removed, nor the marks of batches that no old enough compaction covers.
    """
    limit = int(time.time() * 1000) - grace_ms
    bases, commits = _bases(spark, path), _commits(spark, path)
    covered = max((n for n, finished in bases.items() if finished <= limit), default=-1)
    gone = [f"{path}.base/upto={n}" for n in bases if n < covered]
    marks = []
    for batch_id, attempts in commits.items():
        valid = max((a for a, written in attempts.items() if written <= limit), default=-1)
        old = [a for a in attempts if batch_id <= covered or a < valid]
        gone += [_attempt_folder(path, batch_id, a) for a in old]
        # The newest mark of a covered batch stays, so that a repeat of the batch does not take it for new.
        marks += [f"{path}.commits/{batch_id}.{a}" for a in old if a < max(attempts)]
    for name in [*marks, *gone]:
        where, files = _folder(spark, name)
        files.delete(where, True)
    return gone


def upserted(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key of an appended table (the upsert view)."""
    return latest_per_key(stored_rows(spark, path), keys, [*order, "batch_id"]).drop("batch_id")


def dimension_view(spark: SparkSession, path: str, sink_table: str, actions: DataFrame | None = None) -> DataFrame:
    """The rows of one dimension in force; only that dimension's folders are read.

    With ``actions`` (``routing.table_actions`` of all configuration changes) the rows carry ``generation``, and those
    of tables dropped or created anew since do not count.
    """
    changes = stored_rows(spark, path).filter(F.col("sink_table") == sink_table)
    if actions is not None:
        changes = rows_in_force(changes, actions.filter(F.col("sink_table") == sink_table))
    return current_dimension(changes, ["ts_ms", "batch_id"])


def apply_table_actions(spark: SparkSession, actions: list[tuple[str, str, str]], database: str = "default") -> None:
    """Create, drop or recreate dimension tables; ``actions`` are (sink table, columns, action) of a
    configuration change, so a handful of rows."""
    for table, columns, action in actions:
        name = f"{database}.{table}"
        if action in ("drop", "recreate"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if action in ("create", "recreate"):
            fields = ", ".join(f"`{c.strip()}` STRING" for c in columns.split(","))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING PARQUET")


# -- running a stream -----------------------------------------------------------------------

def run(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
        available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Start a stream into a batch writer.  ``checkpoint`` must be a shared folder (``session.shared_dir``)."""
    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
