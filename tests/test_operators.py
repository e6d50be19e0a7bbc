"""Operators on hand-made rows; the quirk a deviation answers to is named by its Q number."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators import changes, etl, firsttime, joins, logs, routing, text
from tidemart.operators.windows import total, tumble
from tidemart.plans import dims, tags, trade
from tidemart.sources import feeds
from tidemart.testbed import Testbed
from tests.conftest import SF_DIR

DAY0 = 1_704_067_200_000
DAY = 86_400_000


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def event(spark, items):
    return spark.createDataFrame(items, schemas.CHANGE_EVENT)


def src(table):
    return {"db": "shop", "table": table}


# -- sources ----------------------------------------------------------------------------

def test_strict_parse_fails_and_lenient_parse_splits(spark):
    lines = spark.createDataFrame([('{"common":{"mid":"m"},"ts":5}',), ("{broken",), (None,)], "value string")
    clean, dirty = feeds.app_log(lines)
    assert [r.common.mid for r in clean.collect()] == ["m"]
    assert rows(dirty) == [("{broken",)]
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.change_events(lines).collect()


def test_change_event_sample(spark):
    line = ('{"before":{"id":1,"tm_name":"Redmi2"},"after":{"id":1,"tm_name":"Redmi","operate_time":null},'
            '"source":{"db":"shop","table":"base_trademark","server_id":1},"op":"u","ts_ms":1747019648229}')
    got = feeds.change_events(spark.createDataFrame([(line,)], "value string")).first()
    assert (got.after["tm_name"], got.before["id"], got.source["table"], got.op) == ("Redmi", "1", "base_trademark", "u")
    assert got.et == datetime(2025, 5, 12, 3, 14, 8, 229000)  # Q4: ts_ms is milliseconds
    typed = feeds.by_table(spark.createDataFrame([(line,)], "value string"), {
        "base_trademark": spark.createDataFrame([], "id long, tm_name string").schema})
    assert typed["base_trademark"].select(*etl.after({"id": "bigint"})).collect()[0][0] == 1


def test_mixed_and_typed_feeds_agree(spark):
    t = Testbed(spark, SF_DIR)
    mixed = t.mixed_feed("order_refund_info", "order_info")
    typed = t.feed("order_refund_info", "order_info")
    assert rows(trade.refund_fact(mixed, t.dictionary())) == rows(trade.refund_fact(typed, t.dictionary()))


def test_text_folder_and_words(spark, tmp_path):
    (tmp_path / "words.txt").write_text("tea\n\ncup\ntea \n")
    assert rows(feeds.word_list(spark, str(tmp_path / "words.txt"))) == [("cup",), ("tea",)]
    feeds.save_words(feeds.word_list(spark, str(tmp_path / "words.txt")), str(tmp_path / "saved"))
    assert rows(feeds.stored_table(spark, str(tmp_path / "saved"))) == [("cup",), ("tea",)]
    assert feeds.text_messages(spark, str(tmp_path / "words.txt")).count() == 4


# -- filters ----------------------------------------------------------------------------

def test_cart_quantity(spark):
    """Q5: snapshot rows keep their quantity; only increases count for updates."""
    def cart(op, new, old=None):
        return ({"sku_num": str(old)} if old is not None else None,
                {"id": "1", "user_id": "2", "sku_id": "3", "sku_num": str(new)}, src("cart_info"), op, 7)
    got = etl.cart_additions(event(spark, [cart("c", 2), cart("r", 4), cart("u", 5, 2), cart("u", 1, 2), cart("d", 1)]))
    assert sorted(r.sku_num for r in got.collect()) == [2, 3, 4]


def test_valid_events_keep_deletes(spark):
    """Q2: a delete has no new row; its old row must be there."""
    items = [(None, {"id": "1"}, src("a"), "c", 1), ({"id": "1"}, None, src("a"), "d", 2), (None, None, src("a"), "d", 3),
             (None, {}, src("a"), "u", 4), (None, {"id": "1"}, {"db": "x", "table": "a"}, "c", 5),
             (None, {"id": "1"}, src("a"), "bootstrap-start", 6)]
    assert sorted(r.ts_ms for r in etl.valid_events(event(spark, items), "shop").collect()) == [1, 2]


def test_config_change_and_delete(spark):
    """Deleted dimension rows leave the table, pruned columns stay out, nulls are not stored."""
    def cfg(op, columns, ts):
        row = {"source_table": "p", "sink_table": "dim_p", "sink_family": "info", "sink_columns": columns,
               "sink_row_key": "id"}
        return (row if op == "d" else None, None if op == "d" else row, src("table_process_dim"), op, ts)
    data = event(spark, [(None, {"id": "1", "n": "a", "x": "y"}, src("p"), "c", 1),
                         ({"id": "1"}, {"id": "1", "n": "b", "x": "y"}, src("p"), "u", 2),
                         (None, {"id": "2", "n": None, "x": "y"}, src("p"), "r", 1),
                         (None, {"id": "3", "n": "c", "x": "y"}, src("p"), "r", 1),
                         ({"id": "3", "n": "c"}, None, src("p"), "d", 5), (None, {"id": "9"}, src("q"), "c", 1)])
    config = event(spark, [cfg("r", "id,n,x", 1), cfg("u", "id, n", 2)])
    got = {r.row_key: r["data"] for r in dims.current_dimensions(data, config, "shop").collect()}
    assert got == {"1": {"id": "1", "n": "b"}, "2": {"id": "2"}}
    gone = event(spark, [cfg("r", "id,n,x", 1), cfg("d", "id,n", 2)])
    assert dims.current_dimensions(data, gone, "shop").count() == 0
    actions = routing.table_actions(feeds.config_rows(gone, schemas.DIM_CONFIG_COLUMNS))
    assert sorted((r.ts_ms, r.action) for r in actions.collect()) == [(1, "create"), (2, "drop")]


# -- logs -------------------------------------------------------------------------------

def line(mid="m", new="1", ts=DAY0, displays=None, actions=None, start=None, err=None):
    common = (None, None, None, new, None, mid, "iOS 1", None, "u", "v")
    return (common, ("home", None, "i", None, 3), displays, actions, start, err, ts)


def test_split_outputs(spark):
    """Q8: page rows hold no error; a start with an error is both, and never a page."""
    df = spark.createDataFrame([line(err={"c": "1"}, displays=[(1, 2, "a", "s"), (2, 2, "b", "s")]),
                                line(start={"e": "icon"}, err={"c": "2"}), line(actions=[{"a": "x"}])], schemas.APP_LOG)
    out = logs.split_logs(df)
    assert {k: v.count() for k, v in out.items()} == {"err": 2, "start": 1, "display": 2, "action": 1, "page": 2}
    assert out["page"].columns == ["common", "page", "ts"] and out["action"].columns == ["common", "page", "action"]
    kinds = logs.split_records(df).groupBy("kind").count()
    assert {r.kind: r["count"] for r in kinds.collect()} == {"err": 2, "start": 1, "display": 2, "action": 1, "page": 2}


def test_visitor_repair(spark):
    """Q1: a row that says new on a later day than the first visit becomes old."""
    df = spark.createDataFrame([line("a", "1", DAY0), line("a", "1", DAY0 + DAY), line("b", "0", DAY0),
                                line("b", "1", DAY0 + 5), line("c", "1", DAY0 + 9)], schemas.APP_LOG)
    for hot in (0.9, 0.1):
        got = logs.repair_new_visitors(df, "page", hot_share=hot)
        assert sorted((r.common.mid, r.ts - DAY0, r.common.is_new) for r in got.collect()) == [
            ("a", 0, "1"), ("a", DAY, "0"), ("b", 0, "0"), ("b", 5, "0"), ("c", 9, "1")]


# -- deduplication and first-time -------------------------------------------------------

def test_retraction_sums_to_the_newest(spark):
    """Q11: measures are negated as numbers, a missing one as 0."""
    df = spark.createDataFrame([(1, 1, 10), (1, 2, None), (1, 3, 7), (2, 1, 5)], "id int, ts int, amount int")
    signed = changes.retract_by_negation(df, ["id"], ["ts"], ["amount"])
    assert rows(signed.groupBy("id").agg(F.sum("amount"))) == [(1, 7), (2, 5)]
    assert signed.count() == 6
    net = changes.net_of_resends(df, ["id"], ["ts"], ["amount"])
    assert rows(net.groupBy("id").agg(F.sum("amount"))) == [(1, 7), (2, 5)]


def test_latest_records_and_profile_against_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice("aab"), rng.randrange(50), i, rng.choice(["iOS", "Android"]), rng.choice([None, "x", "y"]))
            for i in range(300)]
    df = spark.createDataFrame(data, "uid string, ts int, seq long, os string, keyword string")
    top, expected = {}, []
    for uid, ts, seq, *_ in data:
        if ts > top.get(uid, -1):
            top[uid] = ts
            expected.append((uid, ts, seq))
    assert rows(changes.latest_records(df.select("uid", "ts", "seq"), "uid", "ts", "seq", block=7)) == sorted(expected)
    seen, profile = {}, []
    for uid, _, seq, os, keyword in data:
        n, oss, kws = seen.get(uid, (0, set(), set()))
        seen[uid] = n + 1, oss | {os}, kws | ({keyword} if keyword else set())
        profile.append((uid, seq, seen[uid][0], ",".join(sorted(seen[uid][1])), ",".join(sorted(seen[uid][2]))))
    assert rows(changes.running_profile(df, "uid", "seq", ["os", "keyword"], block=7)) == sorted(profile)


def test_daily_flags_follow_event_time(spark):
    """Q10: days A, B, A in arrival order are two days, not three."""
    df = spark.createDataFrame([("m", DAY0, 1), ("m", DAY0 + DAY, 2), ("m", DAY0 + 5, 3)], "mid string, ts long, id long")
    assert rows(firsttime.flag_first_of_day(df, ["mid"], "ts", "id").select("id", "uv")) == [(1, 1), (2, 1), (3, 0)]


def test_returning_user_after_eight_days(spark):
    df = spark.createDataFrame([("u", DAY0 + 5), ("u", DAY0 + 8 * DAY), ("u", DAY0 + 15 * DAY + 9)], "uid string, ts long")
    assert [r[3] for r in rows(firsttime.daily_logins(df, "uid", "ts"))] == [0, 1, 0]


def test_window_labels_and_null_measures(spark):
    """Q12: a missing measure adds nothing."""
    df = spark.createDataFrame([(DAY0 + 11_000, None), (DAY0 + 19_999, 4)], "ts long, n int")
    assert rows(tumble(df, "10 seconds", [], [total("n")], ts="ts")) == [
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "2024-01-01", 4)]


# -- joins ------------------------------------------------------------------------------

@pytest.mark.parametrize("spread,how", [("left", "inner"), ("right", "inner"), ("right", "left")])
def test_interval_join_against_brute_force(spark, spread, how):
    rng = random.Random(5)
    left = [(i, rng.choice([1, 1, 1, 2, 3]), rng.randrange(-500, 500)) for i in range(120)]
    right = [(i, rng.choice([1, 1, 2, 4]), rng.randrange(-500, 500)) for i in range(120)]
    got = joins.interval_join(spark.createDataFrame(left, "l int, k int, lt long"),
                              spark.createDataFrame(right, "r int, j int, rt long"), {"k": "j"}, "lt", "rt", -7, 20,
                              spread, how).select("l", "r")
    pairs = [(a, b) for a, k, s in left for b, j, t in right if k == j and s - 7 <= t <= s + 20]
    if how == "left":
        met = {a for a, _ in pairs}
        pairs += [(a, -1) for a, _, _ in left if a not in met]
    assert rows(got.fillna(-1)) == sorted(pairs)


def test_salted_join_equals_plain_join(spark):
    data = [("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, 900)]
    df = spark.createDataFrame(data, "k string, id int")
    side = spark.createDataFrame([("hot", "x"), ("k3", "y")], "k string, v string")
    hot = joins.hot_keys(df.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", 0.1)
    salted = joins.salted_left_join(df, side, hot, ["k"], ["id"], salts=8)
    assert rows(salted.select("id", F.coalesce("v", F.lit("-")))) == rows(
        df.join(side, "k", "left").select("id", F.coalesce("v", F.lit("-"))))


def test_dictionary_names(spark):
    """Q6: the name is looked up, the code stays beside it, an unknown code gives N/A or drops the row."""
    df = spark.createDataFrame([("1201",), ("9",)], "appraise string")
    dic = spark.createDataFrame([("1201", "好评")], "dic_code string, dic_name string")
    assert rows(joins.dictionary_name_or(df, dic, "appraise", "name")) == [("1201", "好评"), ("9", "N/A")]
    assert rows(joins.dictionary_name(df, dic, "appraise", "name")) == [("1201", "好评")]


# -- text -------------------------------------------------------------------------------

def test_words_inside_against_brute_force(spark):
    rng = random.Random(11)
    words = list({"".join(rng.choices("abc手", k=rng.randint(1, 4))) for _ in range(40)})
    texts = [(i, "".join(rng.choices("abcd手 机", k=rng.randint(0, 60)))) for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(texts, "id int, t string")
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    expected = sorted((i, None if t is None else sorted(w for w in words if w in t)) for i, t in texts)
    assert rows(text.with_words_inside(df, dictionary, "t", "found").select("id", "found")) == expected


def test_words_inside_with_repeated_and_null_keys(spark):
    """Rows are told apart by their text alone, so repeated and null keys neither double nor lose anything."""
    df = spark.createDataFrame([(1, "so bad"), (1, "so bad"), (None, "worse 🙂 bad"), (None, None), (2, "")], "id int, msg string")
    words = spark.createDataFrame([("bad",), ("bad",), ("worse 🙂 b",), ("🙂",), ("",), (None,)], "word string")
    got = text.with_words_inside(df, words, "msg", "found").collect()
    assert sorted((str(r.id), str(r.msg), r.found) for r in got if r.msg) == [
        ("1", "so bad", ["bad"]), ("1", "so bad", ["bad"]), ("None", "worse 🙂 bad", ["bad", "worse 🙂 b", "🙂"])]
    assert [r.found for r in got if not r.msg and r.msg is not None] == [[]] and [r.found for r in got if r.msg is None] == [None]


def test_words_inside_sends_no_text_through_a_shuffle(spark):
    """Of a large text only what may be words leaves its row, and the dictionary meets it at any place and length."""
    from tidemart.operators import substrings

    rng = random.Random(5)
    long = "".join(rng.choices("abcdefg é🙂手\n", k=2 * substrings.PLACES_AT_ONCE))
    words = [long[a:a + n] for n in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 40, 3000) for a in (0, 65_530, len(long) - n)] + ["é🙂é🙂é🙂nowhere"]
    df = spark.createDataFrame([(1, long), (2, long[:-1]), (3, long[70_000:]), (4, None)], "id int, t string")
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    found = text.with_words_inside(df, dictionary, "t", "found")
    assert {r.id: r.found for r in found.collect()} == {
        r.id: None if r.t is None else sorted({w for w in words if w in r.t}) for r in df.collect()}
    plan = text.with_words_inside(df, dictionary, "t", "found").select("id", "found")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and plan.count("MapInArrow") == 1


def test_segmenter_explodes_runs_alone(spark):
    """Other words stay with their row, in order with the runs; equal texts and repeated runs keep all their rows."""
    words = spark.createDataFrame([("手机",)], "word string")
    df = spark.createDataFrame([(1, "b手机a 人 b 手机 人手机c"), (1, "b手机a 人 b 手机 人手机c"), (None, "ꀀ㐀手机")], "i int, t string")
    found = text.with_segments(df, words, "t", "cut")
    assert sorted((str(r.i), r.cut) for r in found.collect()) == [
        *[("1", ["b", "手机", "a", "人", "c"])] * 2, ("None", ["ꀀ㐀", "手机"])]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "first(" not in plan  # no table of whole texts


def test_last_piece_follows_trailing_comma_rule(spark):
    df = spark.createDataFrame([("a,b",), ("a,b,,",), (",,",), ("",), ("a",)], "t string")
    assert [r[0] for r in df.select(text.last_piece(F.col("t"))).collect()] == ["b", "b", "", "", "a"]


def test_grades(spark):
    df = spark.createDataFrame([(1, "fine,bad"), (2, "so bad and worse"), (3, "fine")], "id int, msg string")
    words = spark.createDataFrame([("bad",), ("worse",)], "word string")
    graded = text.grade_by_words_inside(text.grade_by_last_piece(df, words), words)
    assert [(r.id, r.is_violation, r.violation_grade, r.violation_msg) for r in graded.orderBy("id").collect()] == [
        (1, 1, "P0", "bad"), (2, 0, "P1", "bad, worse"), (3, 0, "", "")]


def test_segmenter_takes_longest_words(spark):
    words = spark.createDataFrame([(w,) for w in ("智能", "智能手机", "手机", "轻薄", "")], "word string")
    df = spark.createDataFrame([("智能手机Redmi 轻薄手机 手机",), (None,), ("Plain words, plain",)], "t string")
    assert {r.t: r.cut for r in text.with_segments(df, words, "t", "cut").collect()} == {
        "智能手机Redmi 轻薄手机 手机": ["智能手机", "redmi", "轻薄", "手机"], None: None, "Plain words, plain": ["plain", "words"]}


def _longest_words(run, words):
    out, at = [], 0
    while at < len(run):
        size = next((n for n in range(len(run) - at, 1, -1) if run[at:at + n] in words), 1)
        out.append(run[at:at + size])
        at += size
    return out


def test_segmenter_equals_a_scan_from_the_left(spark):
    import random
    dice = random.Random(7)
    letters = "天地人山水火"
    known = {"".join(dice.choices(letters, k=dice.randint(1, 5))) for _ in range(60)}
    runs = ["".join(dice.choices(letters, k=dice.randint(1, 40))) for _ in range(200)] + ["天" * 3000]
    words = spark.createDataFrame([(w,) for w in known] + [("天a",), (None,)], "word string")
    df = spark.createDataFrame([(i, r + (" Ab1 " + r[::-1] if i % 3 else "")) for i, r in enumerate(runs)] + [(-1, ""), (-1, "")],
                               "i int, t string")
    got = {r.i: r.cut for r in text.with_segments(df, words, "t", "cut").collect()}
    for i, run in enumerate(runs):
        parts = _longest_words(run, known) + (["ab1", *_longest_words(run[::-1], known)] if i % 3 else [])
        assert got[i] == list(dict.fromkeys(parts))
    assert got[-1] == []
    assert text.with_segments(df, words.limit(0), "t", "cut").count() == len(runs) + 2


def test_segmenter_takes_a_large_dictionary(spark):
    """Of 600,000 words; nothing of it passes the driver."""
    words = spark.range(600_000).selectExpr("translate(lpad(id, 6, '0'), '0123456789', '零一二三四五六七八九') as word")
    df = words.filter("word = '五零零零零七'").selectExpr("concat('火火', word, '人') as t")
    row = text.with_segments(df, words, "t", "cut").first()
    assert row.cut == ["火", "五零零零零七", "人"]


def test_keyword_function_in_sql(spark):
    text.register_keyword_function(spark)
    spark.createDataFrame([(1, "Red shoe red"), (2, None)], "id int, t string").createOrReplaceTempView("searches")
    got = spark.sql("select id, k.keyword from searches s, lateral keywords_of(s.t) k")
    assert rows(got) == [(1, "red"), (1, "shoe")]


def test_nested_tag_shape(spark):
    t = Testbed(spark, SF_DIR)
    users = tags.user_attributes(t.feed("user_info", "user_info_sup_msg"), F.lit("2024-02-01").cast("date"))
    flat = tags.age_tags(t.feed("order_detail", "order_info"), users, etl.log_profile(t.logs(), ["event_id"]),
                         joins.flat_products(**t.product_dims()), t.keyword_types(), "event_id",
                         user_ms=5 * DAY, log_ms=2 * DAY)
    assert tags.nested_tag(flat).columns == ["user", "Age", "ageScore"]


def test_search_needs_no_package_on_workers():
    """Its functions travel whole: a process without this package on its path can load them."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from tidemart.operators import substrings

    sent = cloudpickle.dumps([substrings.marks, substrings.candidates])
    load = "import pickle, sys; assert len(pickle.loads(sys.stdin.buffer.read())) == 2"
    subprocess.run([sys.executable, "-I", "-c", load], input=sent, check=True, cwd="/")
