"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# RocksDB keeps operator state on disk, so it may outgrow executor memory; it is
# also what transformWithState requires.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidemart", master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution, runtime skew splitting and RocksDB state.

    ``shuffle_partitions`` is the *initial* count: adaptive execution merges small
    partitions, so on a cluster give 2-3 times the core count.  ``master`` stays unset
    on a cluster (spark-submit supplies it).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Keep generated classes of many plans, so a repeated plan finds its compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # The JVM does not compile methods above 8000 bytes of bytecode; let such stages run uncombined.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Merge only what is tiny; the upper size stays Spark's, so this acts on small inputs alone.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Keep splitting hot join partitions even if that costs one more exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A folder for ``name`` below the cluster's ``spark.checkpoint.dir``.

    Streaming progress must live where every executor can reach it, so there is no
    machine-local default; ``fallback`` is for tests on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{name}"
