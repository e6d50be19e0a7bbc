"""Similarity join of word shingle sets by Jaccard, size-aware: light sets by subsets, heavy ones by lists.

Equal sets are one class.  Two sets of sizes a and b link when they share at least need(a, b) shingles.

* Light sets (up to a size chosen by cost) enumerate their subsets of every size that a partner can need; sets
  that share such a subset link without further work, each with the smallest of them.
* Heavy sets put their smallest hashes into inverted lists: as many as a partner cannot miss all of, but no more
  than PREFIX.  Of the PREFIX smallest hashes of two linked sets' union each is shared with probability 0.8 or more,
  so fewer than ``shared_at_least`` shared ones have a probability below 10**-19, as little as equal 64-bit hashes of
  different shingles.  Sets that meet others in fewer lists are done.  Each other set is compared with one leader of its lists, and in lists of
  FEW sets with all that are not in its component yet.  Sets with many fuller lists are joined among themselves with all
  their shingles, rarest first, where shingles that no other of these sets has bound the possible overlap.  Every
  comparison looks at parity sketches first, which bound the difference from below, and then at the whole sets.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import components, give_back, hashed_words, lower_table, mix64, rows_at_once, saved, shingle_hashes, split_by_filter, without_ids

WIDTH = 5
SMALL = 24        # largest size that can be light
ROWS_AT_ONCE = 500  # documents or pairs with their sets that a worker holds
FOLD = 8          # numbers of 64 bits of the parity that entries of lists carry
PREFIX = 64       # hashes of a set in lists at most
FEW = 16          # sets of a list whose pairs are compared directly
KEY_STEPS, LIST_STEPS = 2, 3  # shuffles that a subset key and a list entry go through


def need(a: int, b: int) -> int:
    """Shingles that sets of these sizes must share: 100 * shared >= 80 * (a + b - shared)."""
    return -(-4 * (a + b) // 9)


def full_prefix(n: int) -> int:
    """Elements in any common order of which a set shares one with every partner."""
    return n - -(-4 * n // 5) + 1


def prefix(n: int) -> int:
    return min(full_prefix(n), PREFIX)


def shared_at_least(size: int) -> int:
    """What linked sets share of their ``size`` smallest hashes, but for a probability of 10**-19; at least 1."""
    below, k = 0.0, 0
    while True:
        below += math.comb(size, k) * 0.8 ** k * 0.2 ** (size - k)
        if below >= 1e-19:
            return max(1, k)
        k += 1


def _need(a: Column, b: Column) -> Column:
    return F.floor((4 * (a + b) + 8) / 9)


def _full_prefix(n: Column) -> Column:
    return n - F.floor((4 * n + 4) / 5) + 1


def _prefix(n: Column) -> Column:
    return F.least(_full_prefix(n), F.lit(PREFIX))


# -- sets -----------------------------------------------------------------------------------

def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    for _, n, words, owner in hashed_words([t.encode() for t in texts], lower_table()):
        runs = shingle_hashes(words, width)
        inside = owner[:len(runs)] == owner[width - 1:] if len(runs) else np.zeros(0, dtype=bool)
        runs, run_owner = runs[inside], owner[:len(inside)][inside]
        run_at, word_at = np.searchsorted(run_owner, np.arange(n + 1)), np.searchsorted(owner, np.arange(n + 1))
        for k in range(n):
            found = np.unique(runs[run_at[k]:run_at[k + 1]])
            short = word_at[k + 1] - word_at[k]
            if not len(found) and short:
                found = mix64(shingle_hashes(words[word_at[k]:word_at[k + 1]], short) + np.uint64(short))
            yield found


def sketch(found: np.ndarray) -> bytes:
    """Parity of the hashes per bit; the number of bits is a power of two, about one per shingle."""
    bits = 64
    while bits < len(found):
        bits *= 2
    counts = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(found: np.ndarray) -> np.ndarray:
    """The same over FOLD * 64 bits for every size, as numbers that a join condition can compare."""
    counts = np.bincount((found & np.uint64(64 * FOLD - 1)).astype(np.int64), minlength=64 * FOLD)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def least_difference(a: bytes, b: bytes) -> int:
    """At most the number of shingles that only one of two sets has."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _describe(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, found in zip(batch["doc_id"], shingle_sets(batch["text"].tolist(), width), strict=True):
            n = len(found)
            heads = found[:n if n <= SMALL else prefix(n)].view(np.int64)
            out.append((doc_id, n, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), heads, sketch(found), folded(found)))
        yield pd.DataFrame(out, columns=["doc_id", "n", "set_id", "heads", "sketch", "fold"])
    give_back()


def _whole_sets(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [s.view(np.int64) for s in shingle_sets(batch["text"].tolist(), width)]
        yield pd.DataFrame({"node": batch["doc_id"], "held": sets})
    give_back()


# -- light sets -----------------------------------------------------------------------------

def subset_sizes(n: int) -> list[int]:
    """The sizes of subsets that a set of ``n`` shares with a partner of some size."""
    partners = range(-(-4 * n // 5), n * 5 // 4 + 1)
    return sorted({need(n, b) for b in partners if need(n, b) <= min(n, b)})


def light_limit(counts: dict[int, int], load: float) -> int:
    """The size up to which enumerating subsets costs no more rows than list entries do."""
    limit = 0
    for n in range(1, SMALL + 1):
        keys = sum(math.comb(n, c) for c in subset_sizes(n))
        if KEY_STEPS * keys > LIST_STEPS * prefix(n) * max(1.0, load) and counts.get(n, 0):
            break
        limit = n
    return limit


def _subset_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for node, n, heads in zip(batch["node"], batch["n"], batch["heads"], strict=True):
            for size in subset_sizes(n):
                for chosen in itertools.combinations(np.asarray(heads).tolist(), size):
                    key = hashlib.blake2b(np.array(chosen, dtype=np.int64).tobytes(), digest_size=16).digest()
                    out.append((size, key, node, n))
        yield pd.DataFrame(out, columns=["size", "key", "node", "n"])


def light_links(small: DataFrame) -> DataFrame:
    """(a, b) links among sets that share a subset of the size they need, each with the smallest set that has it.

    need() grows with both sizes: where two sets of a subset's owners link, the smallest owner links with both.
    """
    keys = small.select("node", "n", "heads").mapInPandas(_subset_keys, "size long, key binary, node long, n long")
    first = keys.groupBy("size", "key").agg(F.min(F.struct("n", "node")).alias("first"), F.max("node").alias("last"),
                                            F.min("node").alias("least")).filter("last != least")
    pairs = keys.join(first, ["size", "key"])
    fits = (F.col("node") != F.col("first.node")) & (_need(F.col("n"), F.col("first.n")) <= F.col("size"))
    return pairs.filter(fits).select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()


# -- comparing ------------------------------------------------------------------------------

def _near_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [least_difference(x, y) <= a + b - 2 * need(a, b)
                for a, b, x, y in zip(batch["n_a"], batch["n_b"], batch["held_a"], batch["held_b"], strict=True)]
        yield batch.loc[keep, ["a", "b"]]


def _near_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [len(np.intersect1d(x, y, assume_unique=True)) >= need(len(x), len(y))
                for x, y in zip(batch["held_a"], batch["held_b"], strict=True)]
        yield batch.loc[keep, ["a", "b"]]


def _beside(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """``pairs`` with the columns of both nodes, ending in _a and _b."""
    for side in ("a", "b"):
        own = held.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in held.columns if c != "node"])
        pairs = pairs.join(own, side)
    return pairs


def whole_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, held): the shingle hashes of some documents, from their texts."""
    some, _ = split_by_filter(docs, nodes, "doc_id")
    sets = some.mapInPandas(lambda it: _whole_sets(it, width), "node long, held array<long>")
    with rows_at_once(docs.sparkSession, ROWS_AT_ONCE):
        return saved(sets.join(nodes.select(F.col(nodes.columns[0]).alias("node")), "node", "left_semi"))


def near_by_sketch(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    return saved(_beside(pairs, sketches.drop("fold")).mapInPandas(_near_sketches, "a long, b long"))


def near_by_set(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    with rows_at_once(pairs.sparkSession, ROWS_AT_ONCE):
        return saved(_beside(pairs, sets).mapInPandas(_near_sets, "a long, b long"))


# -- heavy sets -----------------------------------------------------------------------------

def _led(entries: DataFrame, rank: Column) -> DataFrame:
    """(a, b): every set with the commonest leader of its lists; ``rank`` chooses a list's leader."""
    leaders = entries.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), F.xxhash64("node").alias("turn"), "node", "n")).alias("lead"))
    fits = _need(F.col("n"), F.col("lead.n")) <= F.least(F.col("n"), F.col("lead.n"))
    led = entries.join(leaders, "token").filter(F.col("node") != F.col("lead.node")).filter(fits)
    led = led.groupBy("node", F.col("lead.node").alias("leader")).agg(F.count("*").alias("times"))
    led = led.groupBy("node").agg(F.max(F.struct("times", "leader")).alias("best"))
    return led.select(F.col("node").alias("a"), F.col("best.leader").alias("b"))


def _rooted(entries: DataFrame, links: DataFrame) -> DataFrame:
    """Entries (node, token, ...) with their component, of lists that hold several components."""
    found = entries.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = found.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("token")
    return saved(found.join(mixed, "token", "left_semi"))


def _pairs(entries: DataFrame, fits: Column) -> DataFrame:
    """Pairs of different components in a list, sizes and ``fits`` (of x and y) permitting, the smaller set first."""
    # A set meets partners of its own step of sizes and of the next.
    stepped = entries.withColumn("step", F.floor(F.log(F.col("n").cast("double")) / math.log(1.25)))
    left = stepped.withColumn("step", F.explode(F.array("step", F.col("step") + 1))).alias("x")
    a, b = F.col("x.n"), F.col("y.n")
    ordered = (a < b) | ((a == b) & (F.col("x.node") < F.col("y.node")))
    pairs = left.join(stepped.alias("y"), ["token", "step"]).filter(
        ordered & (_need(a, b) <= a) & fits & (F.col("x.root") != F.col("y.root")))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    near = near_by_sketch(pairs, sketches)
    return near_by_set(near, whole_sets(docs, near.select("a").union(near.select("b")).distinct(), width))


def crowd_links(crowd: DataFrame, first: DataFrame, sketches: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(a, b) links among the sets ``crowd`` (node) that meet many others, beyond the links ``first``.

    A join of these sets alone: shingles are ordered by the number of sets that have them, those of one set first, and
    a set enters the lists of what is left of its full prefix.  ``cap``, its shingles that others have, bounds its overlaps.
    In each list the set with the fewest shingles of its own leads; what is not linked with it is compared in pairs.
    """
    sets = whole_sets(docs, crowd, width)
    entries = sets.select("node", F.size("held").alias("n"), F.explode("held").alias("token"))
    counts = entries.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    common = entries.join(counts, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common"))
    room = _full_prefix(F.col("n")) - (F.col("n") - F.size("common"))
    lists = common.filter(room > 0).join(sketches.select("node", "fold"), "node").select(
        "node", "n", "fold", F.size("common").alias("cap"), F.explode(F.slice("common", 1, room.cast("int"))).alias("c"))
    lists = saved(lists.select("node", "n", "fold", "cap", F.col("c.token").alias("token")))
    second = near_by_set(near_by_sketch(_led(lists, F.col("n") - F.col("cap")), sketches), sets)
    rest = _rooted(lists, first.unionByName(second))
    shared = _need(F.col("x.n"), F.col("y.n"))
    apart = sum((F.bit_count(F.get("x.fold", F.lit(k)).bitwiseXOR(F.get("y.fold", F.lit(k)))) for k in range(FOLD)), F.lit(0))
    pairs = _pairs(rest, (shared <= F.least("x.cap", "y.cap")) & (apart <= F.col("x.n") + F.col("y.n") - 2 * shared))
    return second.unionByName(near_by_set(near_by_sketch(pairs, sketches), sets))


def heavy_links(large: DataFrame, sketches: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(a, b) links of sets given as (node, n, heads), enough of them to connect all that link."""
    entries = large.select("node", "n", F.explode(F.slice("heads", 1, _prefix(F.col("n")).cast("int"))).alias("token"))
    lists = entries.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = entries.join(lists, "token").groupBy("node", "n").agg(F.collect_list(F.struct("token", "df")).alias("tokens"))
    # The smallest partner has 0.8 of the size; with it the fewest hashes are compared.
    fewest = _prefix(F.floor((4 * F.col("n") + 4) / 5)).cast("int")
    least = F.get(F.array(*[F.lit(shared_at_least(k)) for k in range(PREFIX + 1)]), fewest)
    full = F.size(F.filter("tokens", lambda t: t["df"] > FEW))
    shared = shared.filter(F.size("tokens") >= least).select("node", "n", (full >= least).alias("crowded"), F.inline("tokens"))
    shared = saved(shared)
    first = verified(_led(shared, F.lit(0)), sketches, docs, width)
    rest = _rooted(shared, first)
    # Pairs that share a hash of few sets meet there; others share frequent ones alone, as many as linked sets do.
    second = verified(_pairs(rest.filter(F.col("df") <= FEW), F.lit(True)), sketches, docs, width)
    crowd = saved(rest.filter("crowded").filter(F.col("df") > FEW).select("node").distinct())
    first = first.unionByName(second)
    return first.unionByName(crowd_links(crowd, first, sketches, docs, width))


def similar_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach.  Null, empty and blank texts have no shingles and
    link with nothing.  A null doc_id takes no part and has a null component.  Rows that repeat a doc_id are one
    document with several sets, linked by it.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    described = rows.mapInPandas(lambda it: _describe(it, width),
                                 "doc_id long, n long, set_id binary, heads array<long>, sketch binary, fold array<long>")
    with rows_at_once(docs.sparkSession, ROWS_AT_ONCE):
        sets = saved(described)
    held = sets.filter("n > 0 and doc_id is not null")
    # The class of equal sets is named by its smallest document, whose row stands for it.
    classes = held.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    members = saved(held.select("doc_id", "set_id").distinct().join(classes, "set_id").select("doc_id", "set_id", "node"))
    own = members.filter("doc_id = node").select("set_id", "node")
    # A document with several sets may stand for several classes: they are one component anyway.
    one = own.groupBy("node").agg(F.min("set_id").alias("set_id"), F.count("*").alias("k"))
    nodes = saved(held.join(one.select("node", "set_id"), [held.doc_id == one.node, held.set_id == one.set_id])
                  .select("node", "n", "heads", "sketch", "fold").dropDuplicates(["node"]))
    sketches = nodes.select("node", "n", F.col("sketch").alias("held"), "fold")

    counts = {r["n"]: r["k"] for r in nodes.filter(F.col("n") <= SMALL).groupBy("n").agg(F.count("*").alias("k")).collect()}
    few = nodes.filter(F.col("n") <= SMALL).select(F.explode(F.slice("heads", 1, _prefix(F.col("n")).cast("int"))).alias("t"))
    load = few.agg(F.count("*") / F.greatest(F.lit(1), F.approx_count_distinct("t"))).first()[0]
    limit = light_limit(counts, load or 1.0)
    light = light_links(nodes.filter(F.col("n") <= limit))
    heavy = heavy_links(nodes.filter(F.col("n") >= math.ceil(0.8 * (limit + 1))).select("node", "n", "heads"), sketches, rows, width)
    same = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a != b").select("a", "b")
    roots = components(light.unionByName(heavy).unionByName(same))
    owner = members.groupBy("doc_id").agg(F.min("node").alias("node")).join(roots, "node", "left")
    owner = owner.select("doc_id", F.coalesce("root", "node").alias("component"))
    return sets.select("doc_id", "n").join(owner, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; rows without a doc_id stay."""
    found = similar_documents(docs, width)
    return without_ids(docs, found.filter("doc_id != component_id").select("doc_id"))
