"""Attributes read off a birthday, a time of day or an amount."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemart.functions.dates import at_millis

# Star signs in calendar order, and the last day of the month that still
# belongs to the earlier of the month's two signs.
SIGNS = ["摩羯座", "水瓶座", "双鱼座", "白羊座", "金牛座", "双子座", "巨蟹座",
         "狮子座", "处女座", "天秤座", "天蝎座", "射手座", "摩羯座"]
LAST_DAYS = [19, 18, 20, 19, 20, 20, 22, 22, 22, 22, 21, 21]

# First hour of each part of the day.
DAY_PARTS = [(22, "夜间"), (18, "晚上"), (14, "下午"), (12, "中午"), (9, "上午"), (6, "早晨"), (0, "凌晨")]

# Lowest age of each band.
AGE_BANDS = [(50, "50+"), (40, "40-49"), (35, "35-39"), (30, "30-34"), (25, "25-29"), (18, "18-24")]
YOUNGEST = "0-17"

# Price bands.
LOW_PRICE, MID_PRICE, HIGH_PRICE = "低价商品", "中价商品", "高价商品"


def at_least(value: Column, steps: list[tuple], below: Column) -> Column:
    """The label of the first (threshold, label) step that ``value`` reaches."""
    out = None
    for threshold, label in steps:
        reached = value >= F.lit(threshold)
        out = F.when(reached, F.lit(label)) if out is None else out.when(reached, F.lit(label))
    return F.when(value.isNotNull(), out.otherwise(below))


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years lived at ``as_of``; someone born on 29 February turns on 1 March."""
    def month_day(d):
        return F.month(d) * 100 + F.dayofmonth(d)
    before_birthday = month_day(as_of) < month_day(birthday)
    return F.year(as_of) - F.year(birthday) - before_birthday.cast("int")


def age_band(age: Column) -> Column:
    return at_least(age, AGE_BANDS, F.lit(YOUNGEST))


def era(birthday: Column) -> Column:
    return F.concat((F.floor(F.year(birthday) / 10) * 10).cast("string"), F.lit("年代"))


def star_sign(birthday: Column) -> Column:
    signs = F.array(*[F.lit(s) for s in SIGNS])
    last = F.get(F.array(*[F.lit(d) for d in LAST_DAYS]), F.month(birthday) - 1)
    later_sign = (F.dayofmonth(birthday) > last).cast("int")
    return F.get(signs, F.month(birthday) - 1 + later_sign)


def day_part(ms: Column, tz: str = "Asia/Shanghai") -> Column:
    hour = F.hour(F.from_utc_timestamp(at_millis(ms), tz))
    checked = F.when(ms < 0, F.raise_error(F.lit("negative timestamp")).cast("int")).otherwise(hour)
    return at_least(checked, DAY_PARTS, F.lit(None).cast("string"))


def price_band(amount: Column, strict: bool = True) -> Column:
    """Low below 1000, middle up to 4000, high above; a negative amount fails, or is null."""
    bad = F.raise_error(F.lit("negative amount")).cast("string") if strict else F.lit(None).cast("string")
    return (F.when(amount < 0, bad).when(amount < 1000, F.lit(LOW_PRICE))
            .when(amount <= 4000, F.lit(MID_PRICE)).when(amount > 4000, F.lit(HIGH_PRICE)))


def gender_or_home(gender: Column) -> Column:
    return F.coalesce(gender, F.lit("home"))
