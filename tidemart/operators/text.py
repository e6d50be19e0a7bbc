"""Keywords, dictionary membership and grading of comments."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import AtomicType

from tidemart.operators import substrings

# Its functions go to the tasks whole, so workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(substrings)

_WORD, _NO_WORD = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"
_HAN, _NOT_HAN = "[一-鿿]", r"[\p{L}\p{N}&&[^一-鿿]]"


def words_of(text: Column) -> Column:
    """Distinct words of a text, lower-cased, in order of appearance."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _NO_WORD)), "")


def explode_keywords(df: DataFrame, text: str, keyword: str = "keyword") -> DataFrame:
    """One row per distinct word of ``text``; a null text gives no row."""
    return df.withColumn(keyword, F.explode(words_of(F.col(text))))


def register_keyword_function(spark: SparkSession, name: str = "keywords_of") -> None:
    """Table function for SQL: ``from t, lateral keywords_of(t.text)`` gives column ``keyword``."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (keyword STRING)
        RETURN SELECT explode(array_distinct(regexp_extract_all(lower({name}.text), r'({_WORD})', 1)))""")


FILTER_BITS = 24  # whatever the dictionary; a fuller filter lets more rows pass, which costs time but changes nothing


def maybe_among(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``df`` without rows whose ``column`` is surely not in ``values[column]``, by a filter of fixed size that every task gets."""
    def marked(rows: DataFrame) -> DataFrame:
        spot = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
        return rows.withColumn("_spot", spot).withColumn("_place", F.shiftright("_spot", 6).cast("int"))

    bit = F.expr("shiftleft(1L, cast(_spot & 63 as int))")
    marks = marked(values.select(column)).groupBy("_place").agg(F.bit_or(bit).alias("_bits"))
    return marked(df).join(F.broadcast(marks), "_place").filter(F.col("_bits").bitwiseAND(bit) != 0).select(df.columns)


# -- segmentation of text written without spaces -----------------------------------------

def _pieces(text: Column) -> Column:
    """Distinct Han runs and other words of a text, lower-cased, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({_HAN}+|{_NOT_HAN}+)"), F.lit(1)))


def _cut_run(run: Column, matches: Column) -> Column:
    """A run as the longest dictionary words, left to right, else single characters; ``matches`` are structs (at, n) by at."""
    def step(done: Column, m: Column) -> Column:
        # Of the words at one place the longest comes first; later ones lie before the end of what was taken.
        taken = F.named_struct(F.lit("next"), m["at"] + m["n"], F.lit("cuts"), F.concat(done["cuts"], F.array(m)))
        return F.when(m["at"] >= done["next"], taken).otherwise(done)

    none = F.array().cast("array<struct<at:int,n:int>>")
    cuts = F.aggregate(F.array_sort(matches, lambda x, y: F.when(x["at"] != y["at"], x["at"] - y["at"]).otherwise(y["n"] - x["n"])),
                       F.named_struct(F.lit("next"), F.lit(0), F.lit("cuts"), none), step, lambda done: done["cuts"])

    def pieces(cuts: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda m: m["at"] + m["n"]))
        starts = F.concat(F.transform(cuts, lambda m: m["at"]), F.array(F.length(run)))
        words = F.concat(F.transform(cuts, lambda m: F.substring(run, m["at"] + 1, m["n"])), F.array(F.lit("")))
        return F.flatten(F.zip_with(F.zip_with(ends, starts, lambda end, start: F.split(F.substring(run, end + 1, start - end), "")),
                                    words, lambda single, word: F.concat(single, F.array(word))))

    return F.filter(F.flatten(F.transform(F.array(cuts), pieces)), lambda piece: piece != "")


def _dictionary_matches(pieces: DataFrame, words: DataFrame) -> DataFrame:
    """``pieces`` (one row per ``_piece``) with places ``_at`` and lengths ``_n`` of dictionary words in Han runs, and one
    row per piece with ``_n`` 0, so that none is lost."""
    known = words.select(F.col("word").alias("_gram")).filter(F.col("_gram").rlike(f"^{_HAN}{{2,}}$")).distinct()
    lengths = [r[0] for r in known.select(F.length("_gram")).distinct().collect()]  # at most as many as the longest word has letters
    none = F.array().cast("array<struct<_at:int,_n:int,_gram:string>>")

    def grams(n: int) -> Column:
        found = F.regexp_extract_all("_piece", F.lit(f"(?=({_HAN}{{{n}}}))"), F.lit(1))
        return F.transform(found, lambda gram, at: F.struct(at.alias("_at"), F.lit(n).alias("_n"), gram.alias("_gram")))

    cut = pieces.select("*", F.inline(F.concat(none, *[grams(n) for n in sorted(lengths)])))
    met = maybe_among(cut, "_gram", known).join(known, "_gram").drop("_gram")
    return met.unionByName(pieces.select("*", F.lit(0).alias("_at"), F.lit(0).alias("_n")))


def _real(matches: Column) -> Column:
    return F.filter(matches, lambda m: m["n"] > 0)


def with_segments(df: DataFrame, words: DataFrame, text: str, out: str) -> DataFrame:
    """Distinct words of ``text``, Han runs cut by the dictionary's ``word`` of any number; null for a null text.

    The places of grams of distinct Han runs that are dictionary words come from a join, behind a filter of fixed size; a
    text gets its cut runs back by its hash, its other words stay with its row.  Texts without Han are not shuffled.
    """
    rest = [c for c in df.columns if c != out]
    han = F.coalesce(F.col(text).rlike(_HAN), F.lit(False))
    plain = df.filter(~han).withColumn(out, words_of(F.col(text))).select(*rest, out)
    keyed = df.filter(han).withColumn("_text", F.unhex(F.sha2(text, 256)))
    found_runs = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({_HAN}+)"), F.lit(1)))
    runs = keyed.select("_text", F.posexplode(found_runs).alias("_place", "_piece")).distinct()
    matches = _dictionary_matches(runs.select("_piece").distinct(), words).groupBy("_piece").agg(
        F.collect_list(F.struct(F.col("_at").alias("at"), F.col("_n").alias("n"))).alias("_matches"))
    cut = matches.select("_piece", _cut_run(F.col("_piece"), _real(F.col("_matches"))).alias("_words"))
    cuts = runs.join(cut, "_piece").groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("_place", "_words"))).alias("_cuts"))

    def is_run(piece: Column) -> Column:
        return (piece["piece"] >= "一") & (piece["piece"] < "ꀀ")  # a piece is Han as a whole or not at all; ꀀ follows 鿿

    def joined(pieces: Column) -> Column:
        """The words at each piece's place: a run's are those of the cut of the same rank, as both are in order of appearance."""
        cut = F.zip_with(F.filter(pieces, is_run), F.col("_cuts._words"), lambda piece, words: F.struct(piece["at"].alias("at"), words.alias("words")))
        others = F.transform(F.filter(pieces, lambda piece: ~is_run(piece)), lambda piece: F.struct(piece["at"].alias("at"), F.array(piece["piece"]).alias("words")))
        return F.flatten(F.transform(F.array_sort(F.concat(others, cut)), lambda piece: piece["words"]))

    placed = F.transform(_pieces(F.col(text)), lambda piece, at: F.struct(at.alias("at"), piece.alias("piece")))
    cut_rows = keyed.join(cuts, "_text").withColumn(out, F.array_distinct(F.get(F.transform(F.array(placed), joined), F.lit(0))))
    return plain.unionByName(cut_rows.select(*rest, out))


def _segments_of_stream(df: DataFrame, words: DataFrame, text: str, keyword: str) -> DataFrame:
    """Equal rows of one event time, which come back as many; a row leaves once the watermark has passed it."""
    pieces = df.select("*", F.explode(_pieces(F.col(text))).alias("_piece"))
    met = _dictionary_matches(pieces, words).groupBy(*df.columns, "_piece").agg(
        F.collect_set(F.struct(F.col("_at").alias("at"), F.col("_n").alias("n"))).alias("_matches"),
        F.count_if(F.col("_n") == 0).cast("int").alias("_rows"))
    cut = met.select(*df.columns, "_rows", F.when(F.col("_piece").rlike(f"^{_HAN}"), _cut_run(F.col("_piece"), _real(F.col("_matches"))))
                     .otherwise(F.array("_piece")).alias("_words"))
    found = cut.select(*df.columns, "_rows", F.explode("_words").alias(keyword)).dropDuplicates([*df.columns, keyword])
    return found.select(*df.columns, keyword, F.explode(F.sequence(F.lit(1), "_rows"))).drop("col")


def explode_segments(df: DataFrame, words: DataFrame, text: str, keyword: str = "keyword") -> DataFrame:
    """As ``explode_keywords``, with Han runs cut by the dictionary; a stream needs ``et`` and columns that can be grouped by."""
    if df.isStreaming:
        return _segments_of_stream(df, words, text, keyword)
    return with_segments(df, words, text, "_words").withColumn(keyword, F.explode("_words")).drop("_words")


# -- membership -------------------------------------------------------------------------

def last_piece(text: Column) -> Column:
    """The last comma-separated piece; trailing commas do not open an empty one."""
    return F.substring_index(F.regexp_replace(text, ",+$", ""), ",", -1)


def with_membership(df: DataFrame, words: DataFrame, column: str, flag: str = "in_dictionary") -> DataFrame:
    """Whether ``column`` is one of the dictionary's (distinct) words."""
    side = words.select(F.col("word").alias("_word"), F.lit(True).alias("_known"))
    return (df.join(side, F.col(column) == F.col("_word"), "left")
            .withColumn(flag, F.coalesce("_known", F.lit(False))).drop("_word", "_known"))


def membership_map(df: DataFrame, words: DataFrame, key: str, pieces: str) -> DataFrame:
    """Per ``key`` (one row each) a map from every distinct piece to its membership."""
    exploded = df.select(key, F.explode(F.array_distinct(pieces)).alias("piece"))
    flagged = with_membership(exploded, words, "piece")
    return flagged.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("piece", "in_dictionary"))).alias("membership"))


def with_words_inside(df: DataFrame, words: DataFrame, text: str, out: str) -> DataFrame:
    """All dictionary words that occur anywhere in ``text``, as a sorted array; null for a null text.

    Tasks search whole batches of texts for what may be words, by a filter of fixed size (see ``substrings``); a join with
    the dictionary, of any size, keeps what is one.  Rows meet their words by the text's hash.  Empty words do not count.
    """
    known = words.select("word").filter("word != ''").distinct().withColumn("_found", F.col("word").cast("binary"))
    marked = known.select("_found").mapInArrow(substrings.marks, "length long, spot long")
    bits = np.zeros((1 << substrings.FILTER_BITS) // 64, dtype=np.uint64)
    places = marked.groupBy(F.shiftright("spot", 6).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"), F.collect_set("length").alias("lengths")).toArrow()
    bits[places.column("place").to_numpy()] = places.column("bits").to_numpy().view(np.uint64)
    lengths = sorted({n for found in places.column("lengths").to_pylist() for n in found})  # at most as many as the longest word has bytes

    keyed = df.withColumn("_text", F.unhex(F.sha2(text, 256)))
    texts = keyed.select("_text", F.col(text).alias("_whole")).filter("_text is not null")
    met = texts.mapInArrow(partial(substrings.candidates, bits=bits, lengths=lengths), "_text binary, _found binary")
    found = met.join(known, "_found").groupBy("_text").agg(F.array_sort(F.collect_set("word")).alias(out))
    # Rows without a text meet nothing; their keys, which no hash of a text equals, only deal them to all tasks.
    dealt = F.xxhash64(*[f.name for f in df.schema if isinstance(f.dataType, AtomicType)])
    spread = keyed.withColumn("_none", F.col("_text").isNull()).withColumn("_text", F.coalesce("_text", F.encode(dealt.cast("string"), "utf-8")))
    filled = F.when(~F.col("_none"), F.coalesce(f"_words.{out}", F.array().cast("array<string>")))
    joined = spread.join(found.alias("_words"), "_text", "left")
    return joined.select(*[c for c in df.columns if c != out], filled.alias(out))


# -- grading ----------------------------------------------------------------------------

def grade_by_last_piece(df: DataFrame, words: DataFrame, text: str = "msg") -> DataFrame:
    """Grade P0 when the last piece of the text is a dictionary word."""
    pieces = with_membership(df.withColumn("_last", last_piece(F.col(text))), words, "_last", "_hit")
    return pieces.select(*df.columns, F.col("_hit").cast("int").alias("is_violation"),
                         F.when(F.col("_hit"), "P0").otherwise("").alias("violation_grade"),
                         F.when(F.col("_hit"), F.col("_last")).otherwise("").alias("violation_msg"))


def grade_by_words_inside(df: DataFrame, words: DataFrame, text: str = "msg") -> DataFrame:
    """Grade P1, naming the words, when an ungraded text has dictionary words inside."""
    unseen = df.withColumn("_unseen", F.when(F.col("is_violation") == 0, F.col(text)))
    found = with_words_inside(unseen, words, "_unseen", "_found")
    hit = F.coalesce(F.size("_found") > 0, F.lit(False))
    return found.select(*[c for c in df.columns if c not in ("violation_grade", "violation_msg")],
                        F.when(hit, "P1").otherwise(F.col("violation_grade")).alias("violation_grade"),
                        F.when(hit, F.array_join("_found", ", ")).otherwise(F.col("violation_msg"))
                        .alias("violation_msg"))
