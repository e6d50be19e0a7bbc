"""Every registered query against its SQL on the smallest test tables."""

import pytest

from __spark_entry__ import entry
from checks.compare import connect, differences
from checks.oracle import statements
from checks.queries import hot_share, registry
from tests.conftest import SF_DIR
from tidemart.operators import joins, logs
from tidemart.testbed import Testbed


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry()) == set(statements())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, SF_DIR, registry()[name], statements()[name], con) is None


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:3] == ["stt", "edt", "cur_date"] and df.count() > 0


BRANCHES = {  # query: column and the values that must all occur
    "txt_grade_last_piece": ("violation_grade", {"", "P0"}), "comment_moderation": ("violation_grade", {"", "P0", "P1"}),
    "txt_last_piece_in_dictionary": ("in_dictionary", {0, 1}), "fn_people": ("age_band", {"0-17", "18-24", "25-29", "30-34",
                                                                                        "35-39", "40-49", "50+"})}


@pytest.mark.parametrize("name", sorted(BRANCHES))
def test_every_branch_has_rows(spark, name):
    column, values = BRANCHES[name]
    assert {r[0] for r in registry()[name](spark, SF_DIR).select(column).distinct().collect()} == values


def test_hot_devices_and_han_phrases_occur(spark):
    t = Testbed(spark, SF_DIR)
    firsts = logs.first_visits(t.logs())
    hot, devices = joins.hot_keys(firsts, ["_mid"], "_rows", hot_share(t)).count(), firsts.count()
    assert 0 < hot < devices
    assert registry()["txt_segments"](spark, SF_DIR).filter("word in ('的', '健康食品')").count() > 1


def test_default_bounds_find_tags(spark):
    assert not registry()["tag_age_default_bounds"](spark, SF_DIR.replace("0.001", "0.01")).isEmpty()
