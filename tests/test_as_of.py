"""Versions in force, live configuration, early joins, first rows for ever, and growing files: batch and stream."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators import asof, changes, joins
from tidemart.operators.routing import route_facts_as_of
from tidemart.plans import dims
from tidemart.sources import feeds, tail
from tidemart.streaming import plans, processors, sinks
from tidemart.testbed import DB, Testbed
from tests.conftest import SF_DIR
from tests.test_streaming import DAY0, FLUSH, HOUR, collect, stream_of

ROWS = "id long, k long, ts long, name string"
VERSIONS = "key long, name string, op string, ts long, seq long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def of_time(found, key, ts):
    """The name in force by looking through all versions."""
    held = max((v for v in found if v[0] == key and v[3] <= ts), key=lambda v: (v[3], v[4]), default=None)
    return held[1] if held and held[2] != "d" else None


def test_lookup_as_of_equals_brute_force(spark):
    rng = random.Random(1)
    versions = [(rng.randint(0, 5), f"n{k}", rng.choice("uuud"), rng.randint(0, 400) * 100_000, k) for k in range(120)]
    data = [(k, rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6]), rng.randint(-5, 450) * 100_000, "own") for k in range(600)]
    data += [(1000, None, 5, "own"), (1001, 1, None, "own"), (1, data[1][1], data[1][2], "own")]
    df = spark.createDataFrame(data, ROWS)
    dim = spark.createDataFrame([*versions, (None, "x", "u", 1, 0), (1, "x", "u", None, 0)], VERSIONS)
    found = asof.lookup_as_of(df, dim, {"k": "key"}, "ts", {"name": "version_name"}, "ts", ["seq"], F.col("op") == "d")
    expected = sorted(((*r, of_time(versions, r[1], r[2]) if None not in r[:3] else None) for r in data), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    inner = asof.lookup_as_of(df, dim, {"k": "key"}, "ts", {"name": "version_name"}, "ts", ["seq"], F.col("op") == "d", "inner")
    assert inner.count() == sum(r[4] is not None for r in expected)
    none = asof.lookup_as_of(df, dim.limit(0), {"k": "key"}, "ts", {"name": "version_name"}, "ts")
    assert none.count() == len(data) and none.filter("version_name is not null").count() == 0
    assert asof.lookup_as_of(df.limit(0), dim, {"k": "key"}, "ts", {"name": "version_name"}, "ts").count() == 0


def test_lookup_as_of_stream_equals_batch(spark, tmp_path):
    at = lambda h: DAY0 + int(h * HOUR)
    versions = [[(1, "a", "c", at(0), 0), (2, "b", "c", at(0), 0)], [(1, "a2", "u", at(3), 0), (2, "b", "d", at(4), 0)], [(9, "end", "c", FLUSH, 0)]]
    data = [[(1, 1, at(1), "x"), (2, 2, at(1.5), "x"), (3, 3, at(1), "x")], [(4, 1, at(3), "x"), (5, 2, at(4.5), "x")], [(6, 1, at(2.9999), "x")],
            [(99, 9, FLUSH, "x")]]
    left = stream_of(spark, tmp_path / "rows", ROWS, data)
    right = stream_of(spark, tmp_path / "versions", VERSIONS, versions)
    found = processors.lookup_as_of_stream(left, right, {"k": "key"}, {"name": "version_name"}, F.col("op") == "d", salts=3)
    batch = asof.lookup_as_of(spark.createDataFrame([r for b in data[:-1] for r in b], ROWS),
                              spark.createDataFrame([r for b in versions for r in b], VERSIONS),
                              {"k": "key"}, "ts", {"name": "version_name"}, "ts", ["seq"], F.col("op") == "d")
    result = collect(spark, found.filter("id < 99"), tmp_path)
    assert sorted(result, key=repr) == sorted(rows_of(batch), key=repr) and len(result) == 6


def rows_of(df):
    return [tuple(r) for r in df.collect()]


CONFIG = "source_table string, source_type string, sink_table string, sink_columns string, op string, ts_ms long, ts long"
EVENTS = "after map<string,string>, source map<string,string>, op string, ts_ms long, ts long"


def test_configuration_changes_while_the_stream_runs(spark, tmp_path):
    at = lambda h: DAY0 + int(h * HOUR)
    config = [("part", "u", "first", "id,name", "c", at(0)), ("part", "u", "second", "id", "u", at(2)),
              ("cart", "c", "carts", "id", "c", at(0)), ("cart", "c", "carts", "id", "d", at(2))]
    config = [(*c, c[-1]) for c in config]
    events = [({"id": str(k), "name": f"n{k}"}, {"table": table}, op, at(h), at(h))
              for k, (table, op, h) in enumerate([("part", "u", 1), ("part", "u", 2), ("part", "u", 3), ("cart", "c", 1), ("cart", "c", 3),
                                                  ("part", "c", 1), ("other", "u", 1), ("part", "u", 1.9)])]
    expected = route_facts_as_of(spark.createDataFrame(events, EVENTS), spark.createDataFrame(config, CONFIG))
    flat = lambda df: sorted((r["sink_table"], tuple(sorted(r["data"].items())), r["ts_ms"]) for r in df.collect())
    assert [r[0] for r in flat(expected)] == ["carts", "first", "first", "second", "second"]
    end_event = ({"id": "end"}, {"table": "part"}, "u", FLUSH, FLUSH)
    end_config = ("end", "u", "end", "id", "c", FLUSH, FLUSH)
    live = plans.fact_rows_stream(stream_of(spark, tmp_path / "events", EVENTS, [events[:3], events[3:], [end_event]]),
                                  stream_of(spark, tmp_path / "config", CONFIG, [config[::2], config[1::2], [end_config]]), salts=2)
    sinks.run(live, sinks.append_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    assert flat(spark.read.parquet(f"{tmp_path}/out").filter(f"ts_ms < {FLUSH}")) == flat(expected)


def test_early_rows_are_taken_back(spark, tmp_path):
    lines = "id long, amount long, ts long"
    extras = "line long, coupon long, ts long"
    left = [[(1, 10, DAY0), (2, 20, DAY0)], [(3, 30, DAY0 + 1000)], [(4, 40, DAY0 + 1500)], [(99, 0, FLUSH)], [(3, 30, FLUSH + 1)]]
    right = [[(1, 7, DAY0)], [(2, 8, DAY0 + 900)], [(3, 9, DAY0 + 2000)], [(98, 0, FLUSH)], [(97, 0, FLUSH + 1)]]
    stream = plans.early_order_lines_stream(stream_of(spark, tmp_path / "l", lines, left).withColumnRenamed("ts", "line_ts"),
                                            stream_of(spark, tmp_path / "r", extras, right).withColumnRenamed("ts", "extra_ts"), "line", 10_000)
    sinks.run(stream, sinks.append_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    early = {(r["id"], r["coupon"], r["change"]) for r in out.filter(f"line_ts < {FLUSH}").collect()}
    assert {(2, None, "+"), (2, None, "-"), (2, 8, "+"), (3, None, "-"), (3, 9, "+"), (4, None, "+")} <= early
    latest = sinks.upserted(spark, f"{tmp_path}/out", ["id"], ["batch_id", "version"]).filter("change = '+'")
    held = {r["id"]: r["coupon"] for r in latest.filter(f"line_ts < {FLUSH}").collect()}
    assert {k: held[k] for k in (1, 2, 4)} == {1: 7, 2: 8, 4: None}
    signed = out.filter("id in (1, 2, 3, 4)").filter(f"line_ts < {FLUSH}").selectExpr("id", "if(change = '+', amount, -amount) as amount")
    assert {r["id"]: r["s"] for r in signed.groupBy("id").agg(F.sum("amount").alias("s")).collect()} == {1: 10, 2: 20, 3: 30, 4: 40}
    # The state of line 3 has ended: the same id long after finds no partner.
    assert [r["coupon"] for r in out.filter(f"id = 3 and line_ts > {FLUSH}").collect()] == [None]


def test_first_rows_are_remembered_for_ever(spark, tmp_path):
    schema = "user_id long, name string, n long, ts long"
    batches = [[(1, "a", 1, DAY0), (2, "b", 2, DAY0)], [(3, "c", 3, DAY0 + 50 * 24 * HOUR)], [(1, "a", 4, DAY0 + 80 * 24 * HOUR)], [(4, "d", 5, FLUSH)]]
    seen = spark.createDataFrame([(2, "b"), (2, "b"), (7, "x")], "user_id long, name string")
    stream = processors.first_ever_stream(stream_of(spark, tmp_path / "in", schema, batches), ["user_id", "name"], seen)
    assert [r[2] for r in collect(spark, stream.drop("et"), tmp_path)] == [1, 3, 5]


def test_growing_files_are_read_once(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()

    def add(name, text):
        with open(logs / name, "a") as file:
            file.write(text)

    def run():
        stream = tail.tailed_messages(spark, str(logs), "app.log*", part_bytes=7)
        sinks.run(stream, sinks.append_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
        return sorted(r["value"] for r in spark.read.parquet(f"{tmp_path}/out").select("value").collect())

    add("app.log", "a1\na2 é\nhal")
    add("other.txt", "not this\n")
    assert run() == ["a1", "a2 é"]
    add("app.log", "f 3\n\na5 is a longer line than a part\n")
    os.rename(logs / "app.log", logs / "app.log.1")  # rotated, then more is written to both
    add("app.log.1", "a6\n")
    add("app.log", "b1\nb2")
    assert run() == sorted(["a1", "a2 é", "half 3", "", "a5 is a longer line than a part", "a6", "b1"])
    add("app.log", "\n")
    (logs / "app.log.1").write_text("c1\n")  # written anew: another first line, so another file
    expected = sorted(["a1", "a2 é", "half 3", "", "a5 is a longer line than a part", "a6", "b1", "b2", "c1"])
    assert run() == expected and run() == expected
    batch = feeds.text_messages(spark, str(logs / "app.log")).collect()
    assert sorted(r["value"] for r in batch) == ["b1", "b2"]


def test_configuration_spans(spark):
    config = [("t", "one", "c", 1), ("t", "two", "u", 5), ("t", "two", "d", 9), ("t", "three", "c", 9)]
    spans = asof.in_force(spark.createDataFrame(config, "k string, sink string, op string, ts_ms long"), ["k"])
    assert sorted((r["sink"], r["_from"], r["_to"]) for r in spans.collect()) == [("one", 1, 5), ("three", 9, None), ("two", 5, 9)]
    assert changes.union_all([spans]).count() == 3


def test_a_large_configuration_routes_alike(spark, monkeypatch):
    t = Testbed(spark, SF_DIR)
    routes = [lambda: dims.fact_rows(t.mixed_feed("part", "cart_info"), t.fact_config_events()),
              lambda: dims.fact_rows_as_of(t.mixed_feed("part", "cart_info"), t.fact_config_history()),
              lambda: dims.dimension_rows(t.mixed_feed("part", "supplier", "user_info"), t.dim_config_events(), DB)]

    def counted(route):
        rows = route().withColumn("data", F.array_sort(F.map_entries("data")).cast("string"))
        return Counter(map(tuple, rows.collect()))

    small = [counted(route) for route in routes]
    monkeypatch.setattr(joins, "SMALL_ROWS", 0)
    assert all(small) and [counted(route) for route in routes] == small
    plan = routes[0]()._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
