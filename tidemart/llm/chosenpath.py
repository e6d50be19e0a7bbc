"""Near duplicates by a chosen-path similarity join of word shingle sets.

Equal sets are one class.  TREES independent trees branch the classes: at each level a class goes to the child of the
token that is smallest under that tree's and level's hash, which two sets share with a probability equal to their
Jaccard similarity.  All trees grow level by level as one table of (path, node), from the second level on, where sets
that have little in common are apart already:

* every node takes the leader it meets most often and is compared with it, which joins groups of copies of any size;
* paths whose members are all in one component are done;
* where few members lie outside a path's largest component, they are compared with all members;
* the other paths branch on, and what lies outside is compared with some members of the largest component before; at the
  last level all that is left is compared.

A pair is found in a tree of d levels with a probability of at least 0.8 ** d, so the number of trees follows from the
recall that is asked for.  Comparisons look at parities first, which bound the difference of two sets from below, and
end with the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import components, hashed_words, lower_table, mix64, saved, shingle_hashes, split_by_filter, without_ids
from tidemart.llm.jaccard import FOLD, folded, least_difference, near_by_set, need, sketch

WIDTH = 2
LEVELS = 4
FIRST = 2           # tokens of the paths that are looked at first
PROBES = 3          # members of largest components that a node outside is compared with before its paths branch on
RECALL = 1 - 1e-6   # of a single pair that is found nowhere before the last level
OUTSIDE = 32        # members outside a path's largest component that are compared with all of the path
SLICE_BYTES = 1 << 21
HASHES_AT_ONCE = 1 << 12


def trees_for(recall: float, levels: int) -> int:
    """Independent trees so that a pair of similarity 0.8 ends in one path of some tree with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - 0.8 ** levels))


TREES = trees_for(RECALL, LEVELS)


def _need(a: Column, b: Column) -> Column:
    """Shingles that sets of these sizes must share: 100 * shared >= 80 * (a + b - shared)."""
    return F.floor((4 * (a + b) + 8) / 9)


# -- sets and their tokens --------------------------------------------------------------------

def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    for _, n, words, owner in hashed_words(texts, lower_table()):
        bounds = np.searchsorted(owner, np.arange(n + 1))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= width:
                yield np.unique(shingle_hashes(words[a:b], width))
            elif b > a:
                yield mix64(shingle_hashes(words[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, dtype=np.uint64)


def minwise(found: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed the upper half of the smallest hash of the set."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), HASHES_AT_ONCE):
        mixed = (found[at:at + HASHES_AT_ONCE, None] ^ seeds) * (seeds | np.uint64(1))
        np.minimum(least, mixed.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _seeds() -> np.ndarray:
    return mix64(np.arange(1, TREES * LEVELS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of about SLICE_BYTES: whole sets of a batch are not held at once."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(doc_id.as_py())
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= SLICE_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def set_name(found: np.ndarray) -> int:
    """64 bits for a set, equal for equal sets; 0 for an empty one."""
    if not len(found):
        return 0
    mixed = mix64(found + np.uint64(len(found)))
    return int((mixed.sum(dtype=np.uint64) ^ np.bitwise_xor.reduce(mix64(mixed))).view(np.int64)) or 1


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    seeds = _seeds()
    for batch in batches:
        for ids, texts in _slices(batch):
            rows = [(set_name(s), len(s), minwise(s, seeds), folded(s), sketch(s)) for s in shingle_sets(texts, width)]
            node, n, tokens, fold, parity = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(list(tokens), pa.list_(pa.int32())),
                 pa.array(list(fold), pa.list_(pa.int64())), pa.array(parity, pa.binary())],
                ["doc_id", "node", "n", "tokens", "fold", "held"])


def _whole(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _slices(batch):
            sets = list(shingle_sets(texts, width))
            yield pa.RecordBatch.from_arrays([pa.array([set_name(s) for s in sets], pa.int64()),
                                              pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "held"])


# -- confirming -------------------------------------------------------------------------------

def _near_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = [need(a, b) <= min(a, b) and least_difference(x, y) <= a + b - 2 * need(a, b)
                for a, b, x, y in zip(batch["n_a"], batch["n_b"], batch["held_a"], batch["held_b"], strict=True)]
        yield batch.loc[keep, ["a", "b", "doc_a", "doc_b"]]


def confirmed(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """The (a, b) of ``pairs`` that link by their whole sets, computed again from a text of each class concerned."""
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("held").alias(f"held_{side}"),
                           F.col("doc_id").alias(f"doc_{side}"))
        pairs = pairs.join(own, side)
    near = saved(pairs.mapInPandas(_near_sketches, "a long, b long, doc_a long, doc_b long"))
    some, _ = split_by_filter(rows, near.select(F.explode(F.array("doc_a", "doc_b")).alias("doc_id")), "doc_id")
    # Texts that the filter lets through in vain, and equal sets, find no pair or the same one again.
    sets = saved(some.mapInArrow(lambda it: _whole(it, width), "node long, held array<long>"))
    return near_by_set(near.select("a", "b"), sets)


# -- trees ------------------------------------------------------------------------------------

def _shared(entries: DataFrame) -> DataFrame:
    """Entries (path, tree, node) of paths with several nodes, and the path's leader; names of sets are in random order."""
    paths = entries.groupBy("path").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead != last")
    return saved(entries.join(paths.select("path", "lead"), "path"))


def _led(shared: DataFrame) -> DataFrame:
    """(a, b): each node and the leader that it meets in most paths; b is the smaller."""
    times = shared.filter("node != lead").groupBy("node", "lead").agg(F.count("*").alias("times"))
    best = times.groupBy("node").agg(F.max(F.struct("times", "lead")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.lead").alias("b"))


def _climbed(parents: DataFrame) -> DataFrame:
    """(node, root) of the forest that (a, b) links make, one for each a, by doubling the way upwards."""
    found = saved(parents.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct())
    while True:
        above = found.select(F.col("node").alias("root"), F.col("root").alias("above"))
        found = saved(found.select("node", "root").join(above, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        if found.filter("moved").isEmpty():
            return found.select("node", "root")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further (a, b) links, which are drawn between the roots."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"of_{side}"))
        links = links.join(own, side, "left").withColumn(side, F.coalesce(f"of_{side}", side)).drop(f"of_{side}")
    links = saved(links.filter("a != b").distinct())
    if links.isEmpty():
        return roots
    found = saved(components(links).toDF("root", "upper"))
    moved = roots.join(found, "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
    return saved(moved.unionByName(found.filter("root != upper").select(F.col("root").alias("node"), F.col("upper").alias("root"))))


def _rooted(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with their component (root), of paths that several components share: ``major`` is the one with most
    members there, ``outside`` the number of the others, ``probe`` one of its members, another one in each path."""
    rooted = entries.select("path", "tree", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    some = F.min(F.struct(F.xxhash64("path", "node").alias("turn"), "node")).alias("some")
    sizes = rooted.groupBy("path", "root").agg(F.count("*").alias("k"), some)
    paths = sizes.groupBy("path").agg(F.sum("k").alias("m"), F.max(F.struct("k", "root", "some")).alias("most"))
    paths = paths.select("path", F.col("most.root").alias("major"), F.col("most.some.node").alias("probe"),
                         (F.col("m") - F.col("most.k")).alias("outside"))
    return saved(rooted.join(paths.filter("outside > 0"), "path"))


def _probes(rest: DataFrame) -> DataFrame:
    """(a, b): nodes outside the largest component, each with some members of it."""
    met = rest.filter("root != major").select("node", "probe").distinct()
    chosen = met.groupBy("node").agg(F.slice(F.collect_list("probe"), 1, PROBES).alias("probes"))  # at most TREES in a list
    return chosen.select(F.col("node").alias("a"), F.explode("probes").alias("b"))


def _pairs(rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) of different components in a path: those outside the largest with all, where sizes and parities permit."""
    # Sets that link lie in one step of sizes or in neighbouring ones.
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(1.25)).cast("int")
    whole = saved(rest.join(nodes.select("node", "n", "fold"), "node").withColumn("step", step))
    left = whole.filter("root != major").withColumn("step", F.explode(F.array(F.col("step") - 1, "step", F.col("step") + 1)))
    a, b = F.col("x.n"), F.col("y.n")
    shared = _need(a, b)
    apart = sum((F.bit_count(F.get("x.fold", F.lit(k)).bitwiseXOR(F.get("y.fold", F.lit(k)))) for k in range(FOLD)), F.lit(0))
    once = (F.col("y.root") == F.col("y.major")) | (F.col("x.node") < F.col("y.node"))
    pairs = left.alias("x").join(whole.alias("y"), ["path", "step"]).filter(
        (F.col("x.root") != F.col("y.root")) & once & (shared <= F.least(a, b)) & (apart <= a + b - 2 * shared))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _branched(rest: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """Entries of the next level; the tokens are joined once per node, which has at most TREES paths."""
    held = rest.groupBy("node").agg(F.collect_list(F.struct("path", "tree")).alias("at")).join(nodes.select("node", "tokens"), "node")
    token = F.get("tokens", F.col("tree") * LEVELS + level)
    return held.select("node", "tokens", F.inline("at")).select(F.xxhash64("path", token).alias("path"), "tree", "node")


def path_roots(nodes: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(node, root) of the components of ``nodes`` (node, n, tokens, fold, held, doc_id); a node without a row is its own root."""
    first = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda tree: F.struct(
        F.xxhash64(tree, *[F.get("tokens", tree * LEVELS + k) for k in range(FIRST)]).alias("path"), tree.alias("tree")))
    entries = _shared(nodes.select("node", F.inline(first)).select("path", "tree", "node"))
    roots = _climbed(confirmed(_led(entries), nodes, rows, width))
    for level in range(FIRST, LEVELS + 1):
        rest = _rooted(entries, roots)
        large = rest.filter(F.col("outside") > OUTSIDE)
        last = level == LEVELS or large.isEmpty()
        pairs = _pairs(rest if last else rest.filter(F.col("outside") <= OUTSIDE), nodes)
        pairs = pairs if last else pairs.unionByName(_probes(large)).distinct()
        roots = _merged(roots, confirmed(pairs, nodes, rows, width))
        if last:
            break
        entries = _shared(_branched(large, nodes, level))
    return roots


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, ``kept`` marks the row whose doc_id it is.  Null, empty and blank texts
    have no shingles and link with nothing.  A null doc_id takes no part: its component is null, and it is kept.  Rows that
    repeat a doc_id are one document with several sets, linked by it, and alike in ``component_id``.  An empty table
    gives an empty result, other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id long, node long, n long, tokens array<int>, fold array<long>, held binary"
    sets = saved(rows.mapInArrow(lambda it: _describe(it, width), schema))
    held = sets.filter("n > 0 and doc_id is not null")
    members = saved(held.select("doc_id", "node").distinct())
    nodes = saved(held.dropDuplicates(["node"]))
    # Several sets of one doc_id are one component anyway.
    firsts = members.groupBy("doc_id").agg(F.min("node").alias("a"))
    same = members.join(firsts, "doc_id").filter("node != a").select("a", F.col("node").alias("b"))
    roots = _merged(path_roots(nodes, rows, width), same)
    rooted = members.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component"))
    owner = rooted.distinct().join(least, "root").select("doc_id", "component")
    found = sets.select("doc_id", "n").join(owner, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def first_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; rows without a doc_id stay."""
    return without_ids(docs, near_duplicates(docs, width).filter("not kept").select("doc_id"))
