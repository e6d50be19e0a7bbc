"""Importance resampling of documents towards a target text collection.

Words (and runs of words) are hashed into buckets; a bucket's gain is the logarithm of its share in the target over
its share in the documents.  A document's weight is the mean gain of its features, looked up in an array; noise from
its id turns weights into scores whose largest are a draw without replacement.  The cut is found by bisection: exact
counts over the saved scores, then over what ties at the cut.  The drawn rows alone are put in order, by ranges.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import saved

BUCKETS = 10_000
RUN = 1             # features are runs of 1 to RUN words
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
BLOCK_BYTES = 1 << 20
# The 128 ASCII characters: letters in lower case, digits as they are, all others to a blank.
ASCII = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about BLOCK_BYTES, cut between words."""
    text, at = text.translate(ASCII), 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def feature_buckets(text: bytes, run: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per block of words: how many, and the bucket of each run of 1 to ``run`` words that ends among them."""
    before: list[bytes] = []
    for words in word_blocks(text):
        found = []
        for width in range(1, run + 1):
            seen = [*before[len(before) - min(width - 1, len(before)):], *words]
            features = seen if width == 1 else map(b" ".join, zip(*[seen[k:] for k in range(width)], strict=False))
            found.append(np.fromiter(map(zlib.crc32, features), dtype=np.int64) % buckets)
        yield len(words), np.concatenate(found)
        before = [*before, *words][-(run - 1):] if run > 1 else []


def _counted(batches: Iterator[pa.RecordBatch], run: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, n) once per task."""
    counts = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0):
            for _, found in feature_buckets(text.as_py(), run, buckets):
                counts += np.bincount(found, minlength=buckets)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, column: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; one number per bucket reaches the driver."""
    raw = texts.filter(F.col(column).isNotNull()).select(F.col(column).cast("binary").alias("text"))
    found = raw.mapInArrow(lambda it: _counted(it, run, buckets), "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of its smoothed share in the target over that in the source)."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    ratios = ((t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln u)) for a u between 0 and 1 from the id; no id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(batches: Iterator[pa.RecordBatch], gain: np.ndarray, run: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for doc_id, text in zip(ids, batch.column(1), strict=True):
            words = features = total = 0
            for n, found in feature_buckets(text.as_py() or b"", run, len(gain)):
                words, features, total = words + n, features + len(found), total + int(gain[found].sum())
            weight = total // features if features else 0
            out.append((words, features, weight, weight + noise(doc_id, seed)))
        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight", "score"])


def first_rows(rows: DataFrame, keys: list[str], wanted: int) -> Column:
    """The condition that picks the ``wanted`` smallest rows by ``keys``, whole numbers without nulls, unique together.

    Each key in turn is bisected among the rows that tie on those before: one exact count a step.
    """
    picked, tied = F.lit(False), F.lit(True)
    for key in keys:
        here = rows.filter(tied)
        ends = here.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n")).first()
        if ends["n"] <= wanted or wanted <= 0:
            break
        lo, hi = ends["lo"], ends["hi"]
        while lo < hi:
            middle = (lo + hi) // 2
            if here.filter(F.col(key) <= middle).count() >= wanted:
                hi = middle
            else:
                lo = middle + 1
        wanted -= here.filter(F.col(key) < lo).count()
        picked, tied = picked | (tied & (F.col(key) < lo)), tied & (F.col(key) == lo)
    return picked | tied if wanted > 0 else picked


def ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` from 1 by ``keys``, unique together: sorted ranges, and the sizes of those before."""
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = saved(dealt.withColumn("at", F.monotonically_increasing_id()))  # the range's number, then the place in it
    part = F.shiftright("at", 33).alias("part")
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect()}  # one row per range
    before, offsets = 0, []
    for number in sorted(sizes):
        offsets.append((number, before))
        before += sizes[number]
    if not offsets:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    first = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    numbered = placed.withColumn("part", part).join(F.broadcast(first), "part")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*rows.columns, (F.col("before") + place + 1).alias("rank"))


def _over(rows: Callable, *given) -> Callable:
    return lambda batches: rows(batches, *given)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, run: int = RUN,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs``; ``target`` has a column text as well.

    Of the N rows with at least ``least_words`` words the floor(percent * N / 100) highest scores are drawn and ranked
    1, 2, ...; ties go to the smaller doc_id, then to the row with fewer features, then in the order of saving (such rows
    are equal in all that is returned).  Null, empty and wordless texts have no features and weight 0.  A null doc_id
    counts as an empty string in the noise and comes last among ties.  Rows that repeat a doc_id are drawn each for itself.  An empty
    ``target`` or ``docs`` works as counts of 0.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    gain = gains(bucket_counts(docs, "text", run, buckets), bucket_counts(target, "text", run, buckets))
    scored = rows.mapInArrow(_over(_scored, gain, run, seed), "doc_id long, n_words long, n_features long, weight long, score long")
    scored = scored.withColumn("row", F.monotonically_increasing_id()).withColumn("down", -F.col("score"))
    scored = saved(scored.withColumn("of", F.coalesce("doc_id", F.lit((1 << 63) - 1))))
    keys = ["down", "of", "n_features", "row"]
    able = F.col("n_words") >= least_words
    wanted = percent * scored.filter(able).count() // 100
    drawn = able & first_rows(scored.filter(able), keys, wanted)
    taken = ranked(scored.filter(drawn), keys)
    others = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return taken.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
