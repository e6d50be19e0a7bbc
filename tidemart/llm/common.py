"""What several of the text operators share: saved tables, hashing of words, next documents."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemart.session import shared_dir

# Bytes of text hashed at once: the working arrays are about forty times as large.
BLOCK_BYTES = 1 << 19
WHITE = bytes([32, *range(9, 14)])


def work_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only for a one-machine session without it."""
    own = None
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        own = tempfile.mkdtemp(prefix="tidemart-")
    return shared_dir(spark, f"llm-{uuid.uuid4().hex}", own)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to a shared Parquet table and read again: lineage ends there and nothing is computed twice."""
    spark, path = df.sparkSession, work_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs within send at most so many rows to Python at once, for rows that hold whole sets or texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Hands memory that a worker has freed but still holds to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FILTER_BITS = 24  # whatever the input; a fuller filter lets more rows pass, which costs time but changes nothing


def split_by_filter(rows: DataFrame, ids: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``column`` may be among ``ids`` (one column) and rows whose is not, without a shuffle of the rows.

    The ids are marked in a filter of fixed size, 2**FILTER_BITS bits in all, which is sent to every task.
    """
    def spot(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << FILTER_BITS))

    bit = F.expr("shiftleft(1L, cast(pmod(_spot, 64) as int))")
    word = F.floor(F.col("_spot") / 64).cast("int")
    marks = ids.select(spot(ids.columns[0]).alias("_spot")).groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = rows.withColumn("_spot", spot(column)).withColumn("_word", word)
    marked = marked.join(F.broadcast(saved(marks)), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return marked.filter(maybe).select(rows.columns), marked.filter(~maybe).select(rows.columns)


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without those whose doc_id is in the one column of ``ids``; only rows that may be are shuffled."""
    ids = saved(ids.distinct().toDF("doc_id"))
    some, others = split_by_filter(docs, ids, "doc_id")
    return some.join(ids, "doc_id", "left_anti").select(docs.columns).unionByName(others)


def text_key(*values: Column) -> Column:
    """One key for equal values, nulls as empty strings."""
    return F.sha2(F.concat(*[F.sha2(F.coalesce(v.cast("string"), F.lit("")), 256) for v in values]), 256)


def has_unnamed(docs: DataFrame) -> bool:
    return docs.filter("doc_id is null").limit(1).count() > 0


def without_unnamed(docs: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """``docs`` without rows that have no doc_id and whose ``text_key`` of ``columns`` is in the one column of ``keys``."""
    keys = saved(keys.distinct().toDF("_key"))
    unnamed = docs.filter("doc_id is null").withColumn("_key", text_key(*[F.col(c) for c in columns]))
    unnamed = unnamed.join(keys, "_key", "left_anti").select(docs.columns)
    return docs.filter("doc_id is not null").unionByName(unnamed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` computed once; a column named instead may be computed again at every step of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- hashing --------------------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD6E8FEB86659FD93)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hasher:
    """64-bit hashes of byte ranges of ``data``, equal for equal bytes wherever they lie."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def lower_table() -> np.ndarray:
    """A-Z to a-z, white space to a blank."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[list(WHITE)] = 32
    return out


def letters_table() -> np.ndarray:
    """As ``lower_table``, and every other ASCII character that is no letter or digit to a blank."""
    out = lower_table()
    for c in range(128):
        if not chr(c).isalnum():
            out[c] = 32
    return out


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(first text, its number of texts, joined bytes) of at most BLOCK_BYTES, a longer text on its own."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) + 1 > BLOCK_BYTES:
            yield first, k - first, b" ".join(texts[first:k])
            first, size = k, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts) - first, b" ".join(texts[first:])


def runs_where(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    inside = np.concatenate(([False], mask, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hashed_words(texts: list[bytes], table: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block of texts: (number of the first, how many, hash of each word, number of its text in the block)."""
    for first, n, joined in _blocks(texts):
        data = table[np.frombuffer(joined, dtype=np.uint8)]
        if len(data) > 4 * BLOCK_BYTES:  # one very long text: cut between words, so memory stays bounded
            parts, at = [], 0
            while at < len(data):
                end = min(len(data), at + BLOCK_BYTES)
                while end < len(data) and data[end] != 32:
                    end += 1
                part = data[at:end]
                parts.append(Hasher(part).of(*runs_where(part != 32)))
                at = end
            hashes = np.concatenate(parts)
            yield first, 1, hashes, np.zeros(len(hashes), dtype=np.int64)
            continue
        starts, ends = runs_where(data != 32)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[first:first + n]])[:-1]
        yield first, n, Hasher(data).of(starts, ends), np.searchsorted(begins, starts, "right") - 1


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = (out + words[k:k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return mix64(out)


# -- connected components -------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of (a, b) links, for nodes that have one.

    Alternating large-star and small-star steps; each is an aggregate and a join on the node, so a node with
    very many links is combined before the shuffle and split by the adaptive join.  Every round is written out.
    """
    def stars(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = saved(large.filter("a != b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        return saved(small.distinct())

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = saved(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, now = None, mark(edges)
    while now != before:
        edges = stars(edges)
        before, now = now, mark(edges)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select("b", "b")).distinct()


# -- next documents -------------------------------------------------------------------------

FANOUT_BITS = 12


def next_lower(ids: DataFrame, column: str) -> DataFrame:
    """(column, next_id): the next smaller distinct value, for the smallest the largest; null values are left out.

    No task sees more than 2**12 values at once: values are ordered inside buckets that share their upper
    bits, then the buckets' largest values inside buckets of those, and so on up to one bucket.
    """
    ids = ids.select(F.col(column).cast("long").alias("id")).filter("id is not null").distinct()
    ends = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if ends["lo"] is None:
        return ids.select(F.col("id").alias(column), F.col("id").alias("next_id"))
    lo, hi = ends["lo"], ends["hi"]
    levels = max(1, math.ceil((hi - lo + 1).bit_length() / FANOUT_BITS))

    def below(values: DataFrame, level: int) -> DataFrame:
        """(id, under): the largest value below ``id`` among ``values``, which hold one per bucket of ``level``."""
        bits = FANOUT_BITS * (level + 1)
        bucket = F.shiftright(F.col("id") - F.lit(lo), bits) if bits < 63 else F.lit(0)
        keyed = values.withColumn("bucket", bucket)
        inside = keyed.withColumn("under", F.lag("id").over(Window.partitionBy("bucket").orderBy("id")))
        if level + 1 >= levels:
            return inside.select("id", "under")
        tops = keyed.groupBy("bucket").agg(F.max("id").alias("id"))
        outer = below(tops.select("id"), level + 1)
        carried = tops.join(outer, "id").select("bucket", F.col("under").alias("carried"))
        return inside.join(carried, "bucket").select("id", F.coalesce("under", "carried").alias("under"))

    return below(ids, 0).select(F.col("id").alias(column), F.coalesce("under", F.lit(hi)).alias("next_id"))
