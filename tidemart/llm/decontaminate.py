"""Benchmark decontamination by greedy string tiling.

Word runs that a document shares with a benchmark item are the seeds.  They are joined by their hashes; a filter of
fixed size over the items' runs keeps all other documents out of the join.  For each pair whose seeds can cover enough
of the item the longest common run of unmarked words is marked as a tile, again and again until none of LEAST_RUN words
is left; runs of a length are found by Karp-Rabin sums, the longest length by bisection.  Tiles may lie in any order, so
reordered passages are caught by the share of the item that they cover.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import (FILTER_BITS, give_back, has_unnamed, hashed_words, letters_table, mix64, powers, rows_at_once, saved, shingle_hashes,
                                 text_key, without_ids, without_unnamed)

LEAST_RUN = 5
COVERAGE = 0.5
TEXTS_AT_ONCE = 500   # documents that a worker is sent at once
PAIRS_AT_ONCE = 50    # pairs with both texts


# -- tiles ------------------------------------------------------------------------------------

class Covered:
    """The words of one side that some seed covers, with sums that give the hash of any run."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, width: int):
        reach = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(reach, starts, 1)
        np.add.at(reach, starts + width, -1)
        self.places = np.flatnonzero(np.cumsum(reach)[:-1])
        self.words, self.free = words[self.places], np.ones(len(self.places), dtype=bool)
        up, self.down = powers(len(self.places) + 1)
        self.sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.words * up[:-1], dtype=np.uint64)))

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the unmarked runs of ``size`` adjacent words."""
        last = len(self.places) - size + 1
        if last <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        marked = np.concatenate(([0], np.cumsum(~self.free)))
        whole = (self.places[size - 1:] - self.places[:last] == size - 1) & (marked[size:] == marked[:last])
        starts = np.flatnonzero(whole)
        return starts, mix64((self.sums[starts + size] - self.sums[starts]) * self.down[starts])


def tiles_between(item: np.ndarray, doc: np.ndarray, width: int, need: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in document, words) of two rows of word hashes, longest first.

    Nothing is listed pair by pair, so equal runs may come any number of times on both sides.  An empty list comes
    at once where even overlapping tiles would cover fewer than ``need`` words of the item.
    """
    of_item, of_doc = shingle_hashes(item, width), shingle_hashes(doc, width)
    a = Covered(item, np.flatnonzero(np.isin(of_item, of_doc)), width)
    if len(a.places) < need:
        return []
    b = Covered(doc, np.flatnonzero(np.isin(of_doc, of_item)), width)
    found, most = [], min(len(a.places), len(b.places))
    while most >= width:
        low, high = width - 1, most  # the longest common run is at least low and at most high
        while low < high:
            size = (low + high + 1) // 2
            low, high = (size, high) if np.isin(a.runs(size)[1], b.runs(size)[1]).any() else (low, size - 1)
        if low < width:
            break
        _mark(a, b, low, found)
        most = low - 1
    return found


def _mark(a: Covered, b: Covered, size: int, found: list[tuple[int, int, int]]) -> None:
    """Marks equal runs of ``size`` words, which lie in the order of the item's places and then of the document's."""
    (a_starts, a_hashes), (b_starts, b_hashes) = a.runs(size), b.runs(size)
    order = np.argsort(b_hashes, kind="stable")
    b_starts, b_hashes = b_starts[order], b_hashes[order]
    begin, end = np.searchsorted(b_hashes, a_hashes, "left"), np.searchsorted(b_hashes, a_hashes, "right")
    upto: dict[int, int] = {}  # how far the document's runs of a hash are used up
    for k in np.flatnonzero(end > begin).tolist():
        i = int(a_starts[k])
        if not a.free[i:i + size].all():
            continue
        at = upto.get(int(begin[k]), int(begin[k]))
        while at < end[k]:
            j = int(b_starts[at])
            at += 1
            if b.free[j:j + size].all() and np.array_equal(a.words[i:i + size], b.words[j:j + size]):
                a.free[i:i + size] = b.free[j:j + size] = False
                found.append((int(a.places[i]), int(b.places[j]), size))
                break
        upto[int(begin[k])] = at


# -- seeds ------------------------------------------------------------------------------------

def _grams(words: np.ndarray, width: int) -> np.ndarray:
    return mix64(shingle_hashes(words, width) + np.uint64(width))


def _item_seeds(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(item, gram, times, width, words): an item's distinct runs; one shorter than ``least`` words is one run."""
    for batch in batches:
        rows = batch.column(0).to_pylist()
        for first, n, words, owner in hashed_words([t.as_py() for t in batch.column(1)], letters_table()):
            bounds = np.searchsorted(owner, np.arange(n + 1))
            for k in range(n):
                own = words[bounds[k]:bounds[k + 1]]
                width = min(least, len(own))
                if width:
                    grams, times = np.unique(_grams(own, width), return_counts=True)
                    same = [np.full(len(grams), x) for x in (rows[first + k], width, len(own))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (same[0], grams.view(np.int64), times, *same[1:])],
                                                     ["item", "gram", "times", "width", "words"])


def _bits(seeds: DataFrame) -> np.ndarray:
    """A filter of 2**FILTER_BITS bits, all that reaches the driver, in which the items' runs are marked."""
    spot = F.col("gram").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    marks = seeds.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for r in marks.collect():
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def _doc_seeds(batches: Iterator[pa.RecordBatch], bits: np.ndarray, widths: list[int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, grams) of documents with runs that may be an item's."""
    for batch in batches:
        texts = [t.as_py() for t in batch.column(1)]
        rows, grams = [], []
        for first, n, words, owner in hashed_words(texts, letters_table()):
            hits, owners = [], []
            for width in widths:
                found = _grams(words, width)
                inside = owner[:len(found)] == owner[width - 1:] if len(found) else np.zeros(0, dtype=bool)
                spot = found & np.uint64((1 << FILTER_BITS) - 1)
                marked = (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1)
                hit = inside & (marked == 1)
                hits.append(found[hit])
                owners.append(owner[:len(found)][hit])
            hits, owners = np.concatenate(hits), np.concatenate(owners)
            for k in np.unique(owners).tolist():
                rows.append(first + k)
                grams.append(np.unique(hits[owners == k]).view(np.int64))
        if rows:
            part = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(grams, pa.list_(pa.int64()))],
                                             ["doc_id", "text", "grams"])


def _words(text: bytes) -> np.ndarray:
    parts = [words for _, _, words, _ in hashed_words([text], letters_table())]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _tiled(batches: Iterator[pd.DataFrame], least: int, coverage: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row in batch.itertuples():
            item, doc = _words(row.item_text), _words(row.text)
            need = max(1, math.ceil(coverage * len(item)))
            tiles = tiles_between(item, doc, min(least, len(item)), need)
            covered = sum(n for _, _, n in tiles)
            if covered >= need:
                out.append((row.doc_id, row.item_id, len(item), covered, covered / len(item),
                            [{"item_at": i, "doc_at": d, "words": n} for i, d, n in sorted(tiles)]))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "item_words", "covered", "coverage", "tiles"])
    give_back()


def contaminated(docs: DataFrame, benchmark: DataFrame, least_run: int = LEAST_RUN, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_words, covered, coverage, tiles) of every pair covered to at least ``coverage``.

    Words are runs of letters and digits, case ignored; ``tiles`` counts in words.  Null and empty texts pair
    with nothing, an item of fewer than ``least_run`` words has to occur whole, repeated rows give repeated
    pairs, other columns are ignored.  Memory grows with the length of the two texts, however often their words repeat.
    """
    spark = docs.sparkSession
    rows = docs.filter("text is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    items = benchmark.filter("text is not null").select("item_id", F.col("text").cast("binary").alias("item_text"))
    items = saved(items.withColumn("item", F.monotonically_increasing_id()))
    seeds = saved(items.select("item", "item_text").mapInArrow(
        lambda it: _item_seeds(it, least_run), "item long, gram long, times long, width long, words long"))
    widths = sorted(r["width"] for r in seeds.select("width").distinct().collect())  # at most least_run of them
    held = spark.sparkContext.broadcast(_bits(seeds))
    kind = dict(docs.dtypes)["doc_id"]
    with rows_at_once(spark, TEXTS_AT_ONCE):
        hits = rows.mapInArrow(lambda it: _doc_seeds(it, held.value, widths), f"doc_id {kind}, text binary, grams array<long>") if widths \
            else rows.limit(0).withColumn("grams", F.array().cast("array<long>"))
        hits = saved(hits.withColumn("row", F.monotonically_increasing_id()))
    shared = hits.select("row", F.explode("grams").alias("gram")).join(seeds, "gram")
    # Every place of a shared run covers at most its width.
    pairs = shared.groupBy("row", "item").agg((F.sum("times") * F.max("width")).alias("reach"), F.max("words").alias("words"))
    pairs = pairs.filter(F.col("reach") >= F.ceil(F.lit(coverage) * F.col("words"))).select("row", "item")
    both = pairs.join(hits.drop("grams"), "row").join(items, "item").select("doc_id", "item_id", "text", "item_text")
    schema = (f"doc_id {kind}, item_id {dict(benchmark.dtypes)['item_id']}, item_words long, covered long, coverage double, "
              "tiles array<struct<item_at:long,doc_at:long,words:long>>")
    with rows_at_once(spark, PAIRS_AT_ONCE):
        return saved(both.mapInPandas(lambda it: _tiled(it, least_run, coverage), schema))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that hold an item; rows without a doc_id go each by its own text."""
    left = without_ids(docs, contaminated(docs.filter("doc_id is not null"), benchmark).select("doc_id"))
    if not has_unnamed(docs):
        return left
    unnamed = docs.filter("doc_id is null").select(text_key(F.col("text")).alias("doc_id"), "text").distinct()
    return without_unnamed(left, contaminated(unnamed, benchmark).select("doc_id"), "text")
