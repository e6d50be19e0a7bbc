"""Scalar functions at their edges, and the published sample of an age tag."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.functions import dates, people
from tidemart.functions.score import with_age_scores


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_age_counts_whole_years(spark):
    """Q3: nothing is taken off twice before the birthday; 29 February ages on 1 March."""
    def age(born, on):
        return people.age_years(F.lit(born), F.lit(on))
    got = one(spark, age(date(2001, 7, 15), date(2025, 5, 14)), age(date(2001, 7, 15), date(2025, 7, 15)),
              age(date(2004, 2, 29), date(2025, 2, 28)), age(date(2004, 2, 29), date(2025, 3, 1)))
    assert tuple(got) == (23, 24, 20, 21)


def test_bands_at_their_limits(spark):
    ages = [17, 18, 24, 25, 29, 30, 34, 35, 39, 40, 49, 50]
    got = one(spark, *[people.age_band(F.lit(a)) for a in ages])
    assert list(got) == ["0-17", "18-24", "18-24", "25-29", "25-29", "30-34", "30-34", "35-39", "35-39", "40-49", "40-49",
                         "50+"]


def test_sign_and_era_of_the_sample_user(spark):
    born = F.lit(date(1983, 3, 9))
    assert tuple(one(spark, people.star_sign(born), people.era(born))) == ("双鱼座", "1980年代")
    cuts = [(date(2000, 1, 19), "摩羯座"), (date(2000, 1, 20), "水瓶座"), (date(2000, 12, 21), "射手座"),
            (date(2000, 12, 22), "摩羯座"), (date(2000, 7, 22), "巨蟹座"), (date(2000, 7, 23), "狮子座")]
    assert list(one(spark, *[people.star_sign(F.lit(d)) for d, _ in cuts])) == [s for _, s in cuts]


def test_day_parts_are_local(spark):
    """Hour 0 in Shanghai is 16:00 UTC of the day before."""
    hours = {0: "凌晨", 5: "凌晨", 6: "早晨", 9: "上午", 12: "中午", 14: "下午", 18: "晚上", 22: "夜间", 23: "夜间"}
    got = one(spark, *[people.day_part(F.lit(1_704_038_400_000 + h * 3_600_000)) for h in hours])
    assert list(got) == list(hours.values())


def test_negative_inputs_fail_or_are_null(spark):
    with pytest.raises(Exception, match="negative amount"):
        one(spark, people.price_band(F.lit(-1.0)))
    with pytest.raises(Exception, match="negative timestamp"):
        one(spark, people.day_part(F.lit(-1)))
    assert one(spark, people.price_band(F.lit(-1.0), strict=False))[0] is None


def test_price_limits(spark):
    got = one(spark, *[people.price_band(F.lit(a)) for a in (999.99, 1000.0, 4000.0, 4000.01)])
    assert list(got) == ["低价商品", "中价商品", "中价商品", "高价商品"]


def test_dates_in_a_zone(spark):
    ms, zone = F.lit(1_745_852_856_000), "Asia/Shanghai"
    got = one(spark, dates.to_datetime_text(ms), dates.to_datetime_text(ms, zone),
              dates.parse_datetime(F.lit("2025-04-28 23:07:36"), zone), dates.parse_date(F.lit("2025-04-28"), zone),
              dates.from_epoch_days(F.lit("7380")).cast("string"))
    assert tuple(got) == ("2025-04-28 15:07:36", "2025-04-28 23:07:36", 1_745_852_856_000, 1_745_769_600_000,
                          "1990-03-17")


def test_sample_tag_scores(spark):
    """The sample user's total 0.440 moves them from 18-24 to 40-49."""
    rows = spark.createDataFrame([("18-24", "电脑办公", "联想", "高价商品", "夜间", " 健康与养生 ", "Android"),
                                  ("0-17", "电脑办公", "联想", "高价商品", "夜间", "健康与养生", "Android"),
                                  ("18-24", "none", "none", "none", "none", None, "none")],
                                 "b string, c string, t string, p string, d string, k string, o string")
    got = with_age_scores(rows, "b", "c", "t", "p", "d", "k", "o").collect()
    sample = got[0]
    assert [sample[n] for n in ("tm_score", "price_sensitive_score", "time_period_score", "category_score", "os_score",
                                "keyword_type_score")] == [Decimal(x) for x in
                                                           (".180", ".015", ".090", ".060", ".080", ".015")]
    assert (sample["total_score"], sample["new_age_group"]) == (Decimal("0.440"), "40-49")
    assert (got[1]["total_score"], got[1]["os_score"], got[1]["new_age_group"]) == (Decimal("-1.000"), None, None)
    assert (got[2]["total_score"], got[2]["new_age_group"]) == (Decimal("0.000"), None)
