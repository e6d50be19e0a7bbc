"""Document fingerprints of spot signatures, with built-in functions only.

After every common word (the anchor) the next two content words, common ones skipped, form a signature; the
set of a document's signatures is its fingerprint.  Fingerprints are compared by Jaccard.  For near
duplicates equal fingerprints are one class, classes are partitioned by set length so that only neighbouring
partitions can hold similar sets, and compared where the rarest signatures of both, of which similar sets
share one, meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import let, next_lower, saved

THRESHOLD = 0.8
# Common words of English, German, French and Spanish.
COMMON = """a an and are as at be but by for from had has have he her his in is it not of on or she that the they this to was
were which will with you der die das den dem des ein eine einen und oder ist sind war im zu zum zur von mit auf nicht sich für
auch es dass als le la les un une et ou est sont de du au aux dans en par pour que qui sur pas ce se el los las uno y o
del al con no lo como su sus más""".split()


def _short_hash(*values: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*values), 32).cast("long")


def _chains(words: Column) -> Column:
    """A signature for every common word and the two content words next after it."""
    def before(places: Column, j: Column) -> Column:
        # The common words between a content word and the one before it begin chains with it and its successor.
        first, place = F.coalesce(F.get(places, j - 1) + 1, F.lit(0)), F.get(places, j)
        return F.transform(F.slice(words, first + 1, place - first),
                           lambda common: _short_hash(common, F.get(words, place), F.get(words, F.get(places, j + 1))))

    def of(places: Column) -> Column:
        numbers = F.when(F.size(places) > 1, F.sequence(F.lit(0), F.size(places) - 2)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(numbers, lambda j: before(places, j)))

    numbers = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    return let(F.filter(numbers, lambda k: ~F.get(words, k).isin(COMMON)), of)


def signatures(text: Column) -> Column:
    """The sorted distinct signatures, as numbers below 2**32.

    A text without a whole chain has one signature, of its words or, where it has none, of all its characters;
    null and empty texts have none.
    """
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        return let(_chains(words), lambda found: F.when(
            F.size(found) > 0, F.array_sort(F.array_distinct(found))).otherwise(
            F.when(F.size(words) > 0, F.array(_short_hash(F.array_join(words, " "))))
            .when(text != "", F.array(_short_hash(text))).otherwise(F.array().cast("array<bigint>"))))

    return let(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), of)


def as_text(found: Column) -> Column:
    """A fingerprint written out: signatures in hexadecimal, in order."""
    return F.array_join(F.transform(found, lambda s: F.lower(F.hex(s))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two fingerprints; 1 for two empty ones."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def length_part(n: Column, threshold: float = THRESHOLD) -> Column:
    """The number of the set length's partition: sets at least as similar as the threshold lie at most one apart."""
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / -math.log(threshold))).otherwise(-1).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, signatures, part) per row; other columns are ignored."""
    return docs.select("doc_id", signatures(F.col("text")).alias("signatures")).withColumn("part", length_part(F.size("signatures")))


def near_duplicates(prints: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links): (doc_id, class) of all documents, and (a, b, likeness) between classes, the smallest
    doc_id of equal fingerprints naming each; links are those of at least ``threshold`` between different texts.

    Documents without signatures and null ids are in no class.
    """
    held = prints.filter("size(signatures) > 0 and doc_id is not null")
    named = saved(held.groupBy("signatures").agg(F.min("doc_id").alias("class")))
    members = held.join(named, "signatures").select("doc_id", "class")
    n = F.size("signatures")
    entries = named.select("class", n.alias("n"), F.explode("signatures").alias("s"))
    counts = entries.groupBy("s").agg(F.count("*").alias("df"))
    shared = entries.join(counts.filter("df > 1"), "s")
    # Rarest first; what no other class has needs no entry, but takes its place in the prefix.
    ordered = shared.groupBy("class", "n").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("common"))
    least = F.ceil(F.lit(threshold) * F.col("n") - 1e-9)
    prefix = F.col("n") - least + 1 - (F.col("n") - F.size("common"))
    kept = ordered.filter(prefix > 0).select("class", "n", F.explode(F.slice("common", 1, prefix.cast("int"))).alias("c"))
    kept = kept.select("class", "n", F.col("c.s").alias("s"), length_part(F.col("n"), threshold).alias("part"))
    left = kept.withColumn("part", F.explode(F.array("part", F.col("part") + 1))).alias("x")
    fits = (F.col("x.n") <= F.col("y.n")) & (F.col("x.n") >= threshold * F.col("y.n") - 1e-9)
    other = (F.col("x.n") < F.col("y.n")) | (F.col("x.class") < F.col("y.class"))
    pairs = left.join(kept.alias("y"), ["s", "part"]).filter(fits & other).select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(named.select(F.col("class").alias(side), F.col("signatures").alias(f"of_{side}")), side)
    links = pairs.select("a", "b", likeness(F.col("of_a"), F.col("of_b")).alias("likeness"))
    return members, links.filter(F.col("likeness") >= threshold - 1e-12)


# -- comparison with an edited text and the next document ---------------------------------------

def edited_text(text: Column, head: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``head``, or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(head, F.lit(1), half))


def compared_with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited, signatures, edited_signatures, near_edited, near_next) per row.

    The next document is that of the next smaller doc_id, after the smallest the largest; of several texts of
    one doc_id it is the one with the smallest hash.  Null texts are empty.  A row without a doc_id has no
    next document: its text is cut, and near_next is null.  Other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter("doc_id is not null")
    sizes = saved(known.groupBy("doc_id").agg(F.max(F.length("text")).alias("longest"), F.min(F.xxhash64("text")).alias("which")))
    pairs = sizes.join(next_lower(sizes, "doc_id"), "doc_id")
    donors = pairs.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("target"), "longest").join(
        sizes.select("doc_id", "which"), "doc_id")
    # Not a plain equality: as a further join key it would deal the texts out anew, instead of by doc_id alone as below.
    given = known.join(saved(donors), "doc_id").filter(F.xxhash64("text").bitwiseXOR(F.col("which")) == 0)
    given = given.select(F.col("target").alias("doc_id"), signatures(F.col("text")).alias("next_signatures"),
                         F.substring("text", F.lit(1), F.floor(F.col("longest") / 2).cast("int")).alias("head"))
    with_next = known.join(given.dropDuplicates(["doc_id"]), "doc_id")
    alone = rows.filter("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<bigint>").alias("next_signatures"),
                                                 F.lit("").alias("head"))
    both = with_next.select(alone.columns).unionByName(alone)
    both = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), "next_signatures",
                       edited_text(F.col("text"), F.col("head")).alias("edited"), signatures(F.col("text")).alias("signatures"))
    both = both.withColumn("edited_signatures", signatures(F.col("edited")))
    return both.select("doc_id", "n_chars", "edited", "signatures", "edited_signatures",
                       likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
                       F.when(F.col("next_signatures").isNotNull(),
                              likeness(F.col("signatures"), F.col("next_signatures"))).alias("near_next"))
