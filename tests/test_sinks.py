"""Writers repeat safely, and their readers give the newest rows."""

import pytest
from pyspark.sql import functions as F

from tidemart.operators import logs
from tidemart.plans import applogs, dims, serving
from tidemart.session import shared_dir
from tidemart.sources.feeds import app_log
from tidemart.streaming import sinks
from tidemart.testbed import DB, Testbed
from tests.conftest import SF_DIR


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_repeated_batch_changes_nothing(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "cur_date string, order_amount int")
    write = sinks.append_table(f"{tmp_path}/t", ["cur_date"])
    for batch_id in (0, 1, 1):
        write(df, batch_id)
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.count() == 4
    report = serving.gmv(stored.withColumn("cur_date", F.col("cur_date").cast("string")), "2024-01-02")
    assert rows(report) == [(4,)]


def test_upsert_view_takes_the_newest(spark, tmp_path):
    write = sinks.append_table(f"{tmp_path}/t")
    write(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, ts_ms long"), 0)
    write(spark.createDataFrame([(1, "c", 2)], "id int, v string, ts_ms long"), 1)
    assert rows(sinks.upserted(spark, f"{tmp_path}/t", ["id"], ["ts_ms"])) == [(1, "c", 2), (2, "b", 1)]


def test_log_outputs_of_one_batch(spark, tmp_path):
    t = Testbed(spark, SF_DIR)
    clean, _ = app_log(t.messages())
    sinks.append_tables(logs.split_logs, f"{tmp_path}/logs")(clean, 7)
    expected = applogs.split_messages(t.messages())
    for kind in ("err", "start", "display", "action", "page"):
        assert spark.read.parquet(f"{tmp_path}/logs/{kind}").count() == expected[kind].count()


def test_topic_per_record(spark, tmp_path):
    t = Testbed(spark, SF_DIR)
    routed = dims.fact_rows(t.mixed_feed("part", "cart_info"), t.fact_config_events())
    records = sinks.json_records(routed, F.col("sink_table"), ["ts_ms"])
    sinks.append_table(f"{tmp_path}/topics", ["topic"])(records, 0)
    stored = spark.read.parquet(f"{tmp_path}/topics")
    assert {r.topic for r in stored.select("topic").distinct().collect()} == {"dwd_part_r", "dwd_cart_info_c"}
    assert stored.count() == routed.count()


def test_dimension_stream_reads_configuration_per_batch(spark, tmp_path):
    t = Testbed(spark, SF_DIR)
    t.mixed_feed("part", "supplier").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    route = sinks.route_dimension_changes(lambda b: dims.dimension_rows(b, t.dim_config_events(), DB), f"{tmp_path}/dim")
    sinks.run(stream, route, f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    expected = dims.current_dimensions(t.mixed_feed("part"), t.dim_config_events(), DB)
    got = sinks.dimension_view(spark, f"{tmp_path}/dim", "dim_part")
    assert {r.row_key: r["data"] for r in got.collect()} == {r.row_key: r["data"] for r in expected.collect()}


def test_dimension_tables_follow_configuration(spark):
    sinks.apply_table_actions(spark, [("dim_x", "id,name", "create")])
    assert spark.table("dim_x").columns == ["id", "name"]
    sinks.apply_table_actions(spark, [("dim_x", "id", "recreate")])
    assert spark.table("dim_x").columns == ["id"]
    sinks.apply_table_actions(spark, [("dim_x", "id", "drop")])
    assert not spark.catalog.tableExists("dim_x")


def test_shared_dir_comes_from_the_session(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_dir(spark, "q", str(tmp_path)) == f"{root.rstrip('/')}/q"
    else:
        assert shared_dir(spark, "q", str(tmp_path)) == f"{tmp_path}/q"
        with pytest.raises(ValueError):
            shared_dir(spark, "q")


def test_compaction_keeps_the_view_and_is_safe_to_repeat(spark, tmp_path):
    schema, path = "id int, v string, op string, ts_ms long", f"{tmp_path}/t"
    write = sinks.append_table(path)
    write(spark.createDataFrame([(1, "a", "c", 1), (2, "b", "c", 1), (3, "x", "d", 9)], schema), 0)
    write(spark.createDataFrame([(1, "c", "u", 2)], schema), 1)
    before = rows(sinks.upserted(spark, path, ["id"], ["ts_ms"]))
    assert sinks.compact(spark, path, ["id"], ["ts_ms"]) == sinks.compact(spark, path, ["id"], ["ts_ms"]) == 1
    assert rows(sinks.upserted(spark, path, ["id"], ["ts_ms"])) == before
    assert sinks.stored_rows(spark, path).count() == 3
    write(spark.createDataFrame([(2, "d", "u", 5), (3, "late", "c", 4)], schema), 2)
    after = [(1, "c", "u", 2), (2, "d", "u", 5), (3, "x", "d", 9)]
    assert rows(sinks.upserted(spark, path, ["id"], ["ts_ms"])) == after
    assert sinks.compact(spark, path, ["id"], ["ts_ms"]) == 2
    spark.createDataFrame([(7, "half", "c", 1, 3)], schema + ", batch_id int").write.parquet(f"{path}.base/upto=5")
    import os
    os.remove(f"{path}.base/upto=5/_SUCCESS")  # a compaction that broke off
    assert rows(sinks.upserted(spark, path, ["id"], ["ts_ms"])) == after


def test_readers_see_committed_batches_only(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/t", "id int, v string, ts_ms long"
    write = sinks.append_table(path)
    write(spark.createDataFrame([(1, "a", 1)], schema), 0)
    write(spark.createDataFrame([(2, "b", 1)], schema), 1)
    open_reader = sinks.stored_rows(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_mark", lambda *a: None)  # an attempt that breaks off before its commit
        write(spark.createDataFrame([(2, "half", 1)], schema), 1)
        write(spark.createDataFrame([(3, "half", 1)], schema), 2)
    whole = [(1, "a", 1, 0), (2, "b", 1, 1)]
    assert rows(sinks.stored_rows(spark, path)) == rows(open_reader) == whole
    write(spark.createDataFrame([(2, "c", 1)], schema), 1)
    write(spark.createDataFrame([(3, "d", 1)], schema), 2)
    assert rows(sinks.stored_rows(spark, path)) == [(1, "a", 1, 0), (2, "c", 1, 1), (3, "d", 1, 2)]
    assert rows(open_reader) == whole
    with pytest.raises(ValueError, match="complete"):
        sinks.stored_rows(spark, f"{tmp_path}/none")


def test_replaced_folders_go_after_their_grace(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id int, v string, ts_ms long"
    write = sinks.append_table(path)
    write(spark.createDataFrame([(1, "a", 1)], schema), 0)
    write(spark.createDataFrame([(1, "b", 2), (2, "b", 2)], schema), 1)
    write(spark.createDataFrame([(1, "c", 2), (2, "b", 2)], schema), 1)
    reader = sinks.upserted(spark, path, ["id"], ["ts_ms"])
    assert sinks.compact(spark, path, ["id"], ["ts_ms"]) == 1
    write(spark.createDataFrame([(3, "d", 3)], schema), 2)
    assert sinks.remove_superseded(spark, path, 3_600_000) == []
    assert rows(reader) == [(1, "c", 2), (2, "b", 2)]  # planned before the compaction
    assert len(sinks.remove_superseded(spark, path, 0)) == 3
    assert rows(sinks.upserted(spark, path, ["id"], ["ts_ms"])) == [(1, "c", 2), (2, "b", 2), (3, "d", 3)]
    write(spark.createDataFrame([(1, "c", 2), (2, "b", 2)], schema), 1)  # a covered batch once more
    assert sinks.compact(spark, path, ["id"], ["ts_ms"]) == 2
    assert rows(sinks.upserted(spark, path, ["id"], ["ts_ms"])) == [(1, "c", 2), (2, "b", 2), (3, "d", 3)]


def test_generations_of_a_table(spark):
    from tidemart.operators import routing
    actions = spark.createDataFrame([("t", "id", 10, "create"), ("t", "id", 20, "recreate"), ("t", "id", 30, "drop"), ("t", "id", 30, "create"),
                                     ("s", "id", 10, "create"), ("s", "id", 25, "drop")], "sink_table string, sink_columns string, ts_ms long, action string")
    routed = spark.createDataFrame([(n, at) for n in ("t", "s") for at in (5, 15, 25, 35)], "sink_table string, ts_ms long")
    lived = routing.with_generation(routed, actions)
    assert rows(lived) == [("s", 15, 10), ("t", 15, 10), ("t", 25, 20), ("t", 35, 30)]
    assert rows(routing.rows_in_force(lived, actions).select("sink_table", "ts_ms")) == [("t", 35)]


def test_hand_over_of_a_stream(spark, tmp_path):
    from tidemart.sources import handover
    read, log, fences = Testbed(spark, SF_DIR).customer_chunks(50)
    log.write.parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
    write = sinks.append_table(f"{tmp_path}/out")
    sinks.run(handover.changes_after(stream, fences, "id", 50, 200), write, f"{tmp_path}/c", available_now=True).awaitTermination()
    later = sinks.stored_rows(spark, f"{tmp_path}/out").drop("batch_id")
    assert later.count() == handover.changes_after(log, fences, "id", 50, 200).count() > 0
    # Snapshot rows and later changes replayed give the table's end state.
    events = handover.chunk_events(read, log, fences, "id", 50).unionByName(later)
    order = F.struct("pos", F.col("op") != "r")
    end = events.groupBy(F.coalesce("after.id", "before.id").alias("id")).agg(F.max_by("after", order).alias("row")).filter("row is not null")
    c = spark.read.parquet(f"{SF_DIR}/customer.parquet").selectExpr("c_custkey as id", "cast(c_acctbal as double) as b")
    wanted = c.filter("id % 5 <> 0 or id % 15 = 0").selectExpr("id", "case when id % 15 = 0 then 0D when id % 3 = 0 then b + 1 else b end")
    assert rows(end.filter("id < 10000000").select("id", "row.balance")) == rows(wanted)
    assert handover.changes_from(log, 1000).filter("pos <= 1000").isEmpty()
