"""Log splitting and repair of the new-visitor flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.dates import local_day
from tidemart.operators.joins import HOT_SHARE, hot_keys, salted_left_join


def split_logs(logs: DataFrame) -> dict[str, DataFrame]:
    """One log stream as five: err, start, display, action, page.

    A start row is only a start (and an error, if it has one); every other row gives its
    page, one row per display and one per action.
    """
    browsing = logs.filter(F.col("start").isNull())
    return {
        "err": logs.filter(F.col("err").isNotNull()),
        "start": logs.filter(F.col("start").isNotNull()),
        "display": browsing.select("common", "page", F.explode("displays").alias("display"), "ts"),
        "action": browsing.select("common", "page", F.explode("actions").alias("action")),
        "page": browsing.drop("displays", "actions", "err", "start"),
    }


def split_records(logs: DataFrame) -> DataFrame:
    """All outputs of ``split_logs`` as (kind, value JSON) rows in a single pass.

    For writing: one scan feeds one sink partitioned by ``kind``, or a topic per kind.
    """
    def record(kind, *columns):
        return F.struct(F.lit(kind).alias("kind"), F.to_json(F.struct(*columns)).alias("value"))

    def when(condition, kind, *columns):
        return F.when(condition, F.array(record(kind, *columns))).otherwise(F.array().cast(kinds))

    def each(column, kind, name, *columns):
        records = F.transform(F.col(column), lambda e: record(kind, *columns, e.alias(name)))
        return F.when(browsing & F.col(column).isNotNull(), records).otherwise(F.array().cast(kinds))

    kinds, browsing = "array<struct<kind:string,value:string>>", F.col("start").isNull()
    rest = [c for c in logs.columns if c not in ("displays", "actions", "err", "start")]
    records = F.concat(
        when(F.col("err").isNotNull(), "err", *logs.columns), when(~browsing, "start", *logs.columns),
        each("displays", "display", "display", "common", "page", "ts"),
        each("actions", "action", "action", "common", "page"), when(browsing, "page", *rest))
    return logs.select(F.explode(records).alias("_r")).select("_r.kind", "_r.value")


def first_visits(logs: DataFrame, mid: str = "common.mid", is_new: str = "common.is_new", ts: str = "ts",
                 tz: str | None = None) -> DataFrame:
    """First known visit date per device, decided by its earliest row, and its row count.

    A row that says "new" dates the first visit to its own day, one that says "old" to the
    day before; of rows at the same time an old one decides.  One partial aggregate, so a hot
    device never meets in one task.
    """
    day = local_day(F.col(ts), tz)
    known = F.when(F.col(is_new) == "1", day).otherwise(F.date_sub(day, 1))
    return logs.groupBy(F.col(mid).alias("_mid")).agg(
        F.min_by(known, F.struct(F.col(ts), F.col(is_new))).alias("_first_visit"), F.count("*").alias("_rows"))


def repair_new_visitors(logs: DataFrame, spread_by: str, tz: str | None = None, hot_share: float = HOT_SHARE,
                        visits: DataFrame | None = None) -> DataFrame:
    """Set ``common.is_new`` to 0 where a row says 1 but the device was seen on another day.

    The logs are read twice: once for the first visits, once for the rows.  ``visits`` may give the same rows with
    ``common.mid``, ``common.is_new`` and ``ts`` alone, where they are cheaper to read.  Rows of devices that hold at
    least ``hot_share`` of all rows are spread over many partitions by ``spread_by``.
    """
    firsts = first_visits(logs if visits is None else visits, tz=tz)
    # All uses of ``firsts`` read the same columns, so its aggregation runs once.
    hot = hot_keys(firsts, ["_mid"], "_rows", hot_share)
    joined = salted_left_join(logs.withColumn("_mid", F.col("common.mid")), firsts, hot, ["_mid"], ["ts", spread_by])
    stale = (F.col("common.is_new") == "1") & (F.col("_first_visit") != local_day(F.col("ts"), tz))
    fixed = F.when(stale, F.lit("0")).otherwise(F.col("common.is_new"))
    return joined.withColumn("common", F.col("common").withField("is_new", fixed)).select(*logs.columns)
