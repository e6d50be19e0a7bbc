"""Weighted age score: six factors looked up by level and age band."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.people import at_least

BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
SCORE = "decimal(4,3)"

# Share of each factor, and its weight per level for the bands above.
FACTOR_SHARE = {"category": "0.30", "brand": "0.20", "price": "0.15", "day_part": "0.10",
                "keyword": "0.15", "os": "0.10"}
FACTOR_WEIGHTS = {
    "category": {"潮流服饰": [.9, .8, .6, .4, .2, .1],
                 "家具用品": [.2, .4, .6, .8, .9, .7],
                 "健康食品": [.1, .2, .4, .6, .8, .9]},
    "brand": {"设备类": [.9, .7, .5, .3, .2, .1],
              "服饰类": [.1, .3, .5, .7, .8, .9]},
    "price": {"高价商品": [.1, .2, .3, .4, .5, .6],
              "中价商品": [.2, .4, .6, .7, .8, .7],
              "低价商品": [.8, .6, .4, .3, .2, .1]},
    "day_part": {"凌晨": [.2, .1, .1, .1, .1, .1],
                 "早晨": [.1, .1, .1, .1, .2, .3],
                 "上午": [.2, .2, .2, .2, .3, .4],
                 "中午": [.4, .4, .4, .4, .4, .3],
                 "下午": [.4, .5, .5, .5, .5, .4],
                 "晚上": [.8, .7, .6, .5, .4, .3],
                 "夜间": [.9, .7, .5, .3, .2, .1]},
    "keyword": {"时尚与潮流": [.9, .7, .5, .3, .2, .1],
                "性价比": [.2, .4, .6, .7, .8, .8],
                "健康与养生": [.1, .2, .4, .6, .8, .9],
                "家庭与育儿": [.1, .2, .4, .6, .8, .7],
                "科技与数码": [.8, .6, .4, .3, .2, .1],
                "学习与发展": [.4, .5, .6, .7, .8, .7]},
    "os": {"Android": [.8, .7, .6, .5, .4, .3],
           "iOS": [.7, .6, .5, .4, .3, .2]},
}

# The types of categories and brands, and which belong to which.
CATEGORY_LEVELS = {
    "潮流服饰": ["珠宝", "礼品箱包", "鞋靴", "服饰内衣", "个护化妆"],
    "家具用品": ["母婴", "钟表", "厨具", "电脑办公", "家居家装", "家用电器", "图书、音像、电子书刊", "手机", "汽车用品", "数码"],
    "健康食品": ["运动健康", "食品饮料、保健食品"],
}
BRAND_LEVELS = {
    "设备类": ["Redmi", "苹果", "联想", "TCL", "小米"],
    "服饰类": ["长粒香", "金沙河", "索芙特", "CAREMiLLE", "欧莱雅", "香奈儿"],
}

# Lowest total of each re-assigned band.
TOTAL_STEPS = [(Decimal(".75"), "18-24"), (Decimal(".69"), "25-29"), (Decimal(".585"), "30-34"),
               (Decimal(".47"), "35-39"), (Decimal(".365"), "40-49"), (Decimal(".26"), "50+")]


def _level(name: Column, levels: dict[str, list[str]]) -> Column:
    out = F.lit(None).cast("string")
    for level, names in levels.items():
        out = F.when(name.isin(names), F.lit(level)).otherwise(out)
    return out


def category_level(name: Column) -> Column:
    return _level(name, CATEGORY_LEVELS)


def brand_level(name: Column) -> Column:
    return _level(name, BRAND_LEVELS)


def band_index(band: Column) -> Column:
    """Position in ``BANDS`` from 0; null for any other band."""
    position = F.array_position(F.array(*[F.lit(b) for b in BANDS]), band)
    return F.when(position > 0, (position - 1).cast("int"))


def factor_score(factor: str, level: Column, index: Column) -> Column:
    """Weight times share at three places; null when the level or the band is unknown."""
    share = Decimal(FACTOR_SHARE[factor])
    levels = [f"'{name}', array({', '.join(f'cast({Decimal(str(w)) * share} as {SCORE})' for w in weights)})"
              for name, weights in FACTOR_WEIGHTS[factor].items()]
    return F.get(F.try_element_at(F.expr(f"map({', '.join(levels)})"), level), index)


def with_age_scores(df: DataFrame, band: str, category: str, brand: str, price: str, day_part: str,
                    keyword_type: str, os: str) -> DataFrame:
    """Add the types of category and brand, the six factor scores, their total and the band the total stands for.

    A user outside the six bands gets -1 as the only score, hence no new band.
    """
    index = F.col("_band")
    typed = df.withColumns({"_band": band_index(F.col(band)), "category_type": category_level(F.col(category)),
                            "tm_type": brand_level(F.col(brand))})
    category_score = F.when(index.isNull(), F.lit("-1").cast(SCORE)).otherwise(
        factor_score("category", F.col("category_type"), index))
    scored = typed.withColumns({
        "category_score": category_score,
        "tm_score": factor_score("brand", F.col("tm_type"), index),
        "price_sensitive_score": factor_score("price", F.col(price), index),
        "time_period_score": factor_score("day_part", F.col(day_part), index),
        "keyword_type_score": factor_score("keyword", F.trim(F.col(keyword_type)), index),
        "os_score": factor_score("os", F.col(os), index),
    }).drop("_band")
    return with_total_score(scored, ["category_score", "tm_score", "price_sensitive_score",
                                     "time_period_score", "keyword_type_score", "os_score"])


def with_total_score(df: DataFrame, parts: list[str]) -> DataFrame:
    total = sum((F.coalesce(F.col(p), F.lit(0).cast(SCORE)) for p in parts), F.lit(0).cast(SCORE))
    total = F.round(total, 3).cast("decimal(6,3)")
    band = at_least(F.col("total_score"), TOTAL_STEPS, F.lit(None).cast("string"))
    return df.withColumn("total_score", total).withColumn("new_age_group", band)
