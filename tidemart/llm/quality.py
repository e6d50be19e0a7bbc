"""Quality classifier: document evidence and site posteriors by hierarchical empirical Bayes.

Evidence is the log likelihood ratio of a logistic regression over the distinct features of a document (words,
word beginnings, runs of marks, shape of the text), learnt from a bounded sample of labelled documents.  The rate of bad documents of a site is estimated from all its
documents, labelled or not, and shrunk: a host's towards the global rate, a path's towards its host's, the
more the fewer documents there are and the less the sites differ.  Evidence and path posterior are added as log odds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import (BLOCK_BYTES, Hasher, give_back, has_unnamed, letters_table, rows_at_once, runs_where, saved, text_key, without_ids,
                                 without_unnamed)

BUCKETS = 1 << 20
TRAIN_ROWS = 12_000     # labelled documents the evidence is learnt from, about
LEAST_DOCS = 5          # documents a feature must occur in
LEAST_Z = 4.5           # standard errors by which its rate must differ between the classes
MOST_FEATURES = 2048    # of those, the ones that differ most are learnt from
PENALTY = 2e-5          # of squared weights in the regression
STEPS = 300
UNKNOWN = -10.0         # prior log odds without any labelled document
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning taken as a feature
CLASSES = ("toxic", "low")
REJECT = 0.5            # posterior from which a document is rejected
ROWS_AT_ONCE = 500      # texts that a worker holds
LETTERS = letters_table()


def _shape(data: np.ndarray, letters: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Numbers of shape features of one text: each a kind and a step of ten of a share."""
    n, size = max(1, len(words)), max(1, len(data))
    ascii_letters = np.count_nonzero((letters >= 97) & (letters <= 122)) or 1
    symbols = np.count_nonzero((data > 32) & (data < 128) & (letters == 32))
    marks = np.count_nonzero((data == 46) | (data == 44) | (data == 10))
    shares = [
        np.count_nonzero(words[1:] == words[:-1]) / n, len(np.unique(words)) / n,
        np.count_nonzero((data >= 65) & (data <= 90)) / ascii_letters, 4 * (symbols - marks) / size,
        10 * np.count_nonzero(data == 124) / size, 10 * np.count_nonzero(data == 33) / size,
        float(np.mean(sizes)) / 12 if len(sizes) else 0.0, math.log2(n) / 16, 10 * np.count_nonzero((data >= 48) & (data <= 57)) / size,
    ]
    return [16 * kind + min(15, max(0, int(share * 10 + 0.5))) for kind, share in enumerate(shares)]


def features(text: bytes) -> np.ndarray:
    """The distinct feature numbers of one text; its shape takes the first few hundred numbers."""
    found, hashes, sizes = [], [], []
    raw = np.frombuffer(text, dtype=np.uint8)
    letters = LETTERS[raw]
    at = 0
    while at < len(letters):
        end = min(len(letters), at + BLOCK_BYTES)
        while end < len(letters) and letters[end] != 32:
            end += 1
        part, marks = letters[at:end], raw[at:end]
        starts, ends = runs_where(part != 32)
        hasher = Hasher(part)
        hashes.append(hasher.of(starts, ends))
        sizes.append(ends - starts)
        for k, n in enumerate(BEGINNINGS):
            long = starts[ends - starts > n]
            found.append(hasher.of(long, long + n) + np.uint64(k + 1))
        first, last = runs_where((part == 32) & (marks > 32))
        last = np.minimum(last, first + 3)
        found.append(Hasher(marks).of(first, last) + np.uint64(16))
        at = end
    words = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    lengths = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
    every = np.concatenate([words, *found])
    buckets = np.unique(every % np.uint64(BUCKETS - 512)).astype(np.int64) + 512
    return np.concatenate([np.array(_shape(raw, letters, words, lengths), dtype=np.int64), buckets])


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(feature, n, toxic, low): documents with each feature, summed within the task."""
    sums = np.zeros((BUCKETS, 1 + len(CLASSES)), dtype=np.int32)
    for batch in batches:
        for text, *marks in zip(batch["text"], *(batch[c] for c in CLASSES), strict=True):
            sums[features(text.encode())] += np.array([1, *marks], dtype=np.int32)
    held = np.flatnonzero(sums[:, 0])
    yield pd.DataFrame({"feature": held} | {c: sums[held, k] for k, c in enumerate(("n", *CLASSES))})


def _bad(c: str) -> Column:
    return F.col("toxic") == 1 if c == "toxic" else F.col("quality") == 0


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict[str, dict[int, float]]:
    """Per class the weights of its features, the prior log odds under -1 and the shift from it under -2."""
    marks = labels.select("doc_id", *[F.coalesce(_bad(c), F.lit(False)).cast("int").alias(c) for c in CLASSES]).dropna()
    marks = marks.dropDuplicates(["doc_id"])
    share = min(1.0, train_rows / max(1, marks.count()))
    # The sample is drawn by the hash of the id on both sides, so that only its texts are shuffled.
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 20)) < int(share * (1 << 20))
    rows = docs.select("doc_id", "text").filter("text is not null").filter(drawn)
    rows = saved(rows.join(marks.filter(drawn), "doc_id").select("text", *CLASSES))
    sums = ", ".join(f"{c} long" for c in ("feature", "n", *CLASSES))
    with rows_at_once(docs.sparkSession, ROWS_AT_ONCE):
        counts = saved(rows.mapInPandas(_count, sums).groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", *CLASSES)]))
    # Every text has exactly one step of each kind of shape, so those of kind 0 count the documents.
    whole = counts.filter("feature < 16").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *CLASSES)]).first()
    out = {}
    for c in CLASSES:
        bad, good = whole[c], whole["n"] - whole[c]
        out[c] = {-1: math.log((bad + 0.5) / (good + 0.5)) if whole["n"] else UNKNOWN}
        if not bad or not good:
            continue
        a, b = F.col(c) / bad, (F.col("n") - F.col(c)) / good
        mean = F.col("n") / whole["n"]
        z = F.abs((a - b) / F.sqrt(mean * (1 - mean) * (1 / bad + 1 / good) + 1e-12))
        told = counts.filter((F.col("n") >= LEAST_DOCS) & (z >= LEAST_Z)).orderBy(z.desc(), "feature").limit(MOST_FEATURES)
        chosen = np.sort(np.array([r["feature"] for r in told.select("feature").collect()], dtype=np.int64))
        if len(chosen):
            held = rows.mapInPandas(lambda it, c=c, chosen=chosen: _chosen(it, c, chosen), "bad int, held binary").collect()
            held.sort(key=lambda r: (r["held"], r["bad"]))  # so that the sums do not depend on who came first
            weights, shift = _fit([np.frombuffer(r["held"], dtype="<u2") for r in held],
                                  np.array([r["bad"] for r in held], dtype=float), len(chosen))
            out[c] |= dict(zip(chosen.tolist(), weights.tolist(), strict=True)) | {-2: shift - out[c][-1]}
    return out


def _chosen(batches: Iterator[pd.DataFrame], c: str, chosen: np.ndarray) -> Iterator[pd.DataFrame]:
    for batch in batches:
        held = []
        for text in batch["text"]:
            own = features(text.encode())
            held.append(np.flatnonzero(np.isin(chosen, own, assume_unique=True)).astype("<u2").tobytes())
        yield pd.DataFrame({"bad": batch[c], "held": held})


def _fit(held: list[np.ndarray], bad: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and shift of a logistic regression over presence, by gradient steps scaled per weight."""
    row = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])
    col = np.concatenate(held).astype(np.int32) if held else np.zeros(0, dtype=np.int32)
    weights, shift = np.zeros(size + 1), math.log((bad.sum() + 0.5) / (len(bad) - bad.sum() + 0.5))
    weights[size] = shift
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        logit = np.bincount(row, weights[col], len(bad)) + weights[size]
        off = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - bad) / len(bad)
        slope = np.append(np.bincount(col, off[row], size), off.sum())
        slope[:size] += PENALTY * weights[:size]
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope ** 2
        rate = 0.1 * (1 - step / (STEPS + 1))
        weights -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
    return weights[:size], float(weights[size])


def _score(batches: Iterator[pd.DataFrame], weights: dict[str, dict[int, float]]) -> Iterator[pd.DataFrame]:
    dense = np.zeros((BUCKETS, len(CLASSES)), dtype=np.float32)
    for k, c in enumerate(CLASSES):
        keys = [f for f in weights[c] if f >= 0]
        dense[keys, k] = [weights[c][f] for f in keys]
    for batch in batches:
        found = np.array([dense[features(t.encode())].sum(axis=0) for t in batch["text"]]).reshape(-1, len(CLASSES))
        found = found + np.array([weights[c].get(-2, 0.0) for c in CLASSES])
        yield batch.drop(columns=["text"]).assign(**{c: found[:, k] for k, c in enumerate(CLASSES)})
    give_back()


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))


def _shrunk(sites: DataFrame, c: str, towards: Column) -> Column:
    """Posterior mean of a site's rate; the prior's strength follows from how much the sites differ."""
    rate = F.col(f"{c}_sum") / F.col("n")
    spread = sites.agg(F.avg(towards * (1 - towards)).alias("pq"), F.count("*").alias("k"),
                       F.avg((rate - towards) ** 2 - towards * (1 - towards) / F.col("n")).alias("between")).first()
    pq, between = spread["pq"] or 0.0, max(spread["between"] or 0.0, 0.0)
    strength = pq / between if between > pq * 1e-4 else 1e4
    return (F.col(f"{c}_sum") + strength * towards) / (F.col("n") + strength)


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: tuple[str, ...] = ("source", "lang"),
          train_rows: int = TRAIN_ROWS, reject: float = REJECT) -> DataFrame:
    """(doc_id, toxic, low, rejected): posteriors of both classes, one row per row of ``docs``.

    A null text is empty, null hosts and paths are sites of their own, a document without a label is judged
    like any other, and a label decides only through the rates: labelled documents are judged by their text,
    too.  Without labels nothing is rejected.  Other columns are ignored.
    """
    return _judged(docs, labels, host, path, train_rows, reject).drop("own")


def _judged(docs: DataFrame, labels: DataFrame, host: str = "source", path: tuple[str, ...] = ("source", "lang"),
            train_rows: int = TRAIN_ROWS, reject: float = REJECT) -> DataFrame:
    """As ``judge``, and ``own``: for a row without a doc_id the key of what it was judged by, else null."""
    weights = learn(docs, labels, train_rows)
    keys = list(dict.fromkeys([host, *path]))
    site = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"site_{k}") for k in keys]
    own_key = F.when(F.col("doc_id").isNull(), text_key(*[F.col(k) for k in keys], F.col("text")))
    rows = docs.select("doc_id", own_key.alias("own"), *site, F.coalesce("text", F.lit("")).alias("text"))
    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text") + ", " + ", ".join(f"{c} double" for c in CLASSES)
    with rows_at_once(docs.sparkSession, ROWS_AT_ONCE):
        scored = saved(rows.mapInPandas(lambda it: _score(it, weights), kinds))
    marks = labels.select("doc_id", *[_bad(c).cast("double").alias(f"{c}_label") for c in CLASSES])
    marks = marks.groupBy("doc_id").agg(*[F.max(f"{c}_label").alias(f"{c}_label") for c in CLASSES])
    known = scored.join(marks, "doc_id", "left")
    own = {c: F.coalesce(f"{c}_label", _sigmoid(F.col(c) + weights[c][-1])) for c in CLASSES}
    path_keys, host_key = [f"site_{k}" for k in dict.fromkeys([host, *path])], f"site_{host}"
    paths = saved(known.groupBy(*path_keys).agg(F.count("*").alias("n"), *[F.sum(own[c]).alias(f"{c}_sum") for c in CLASSES]))
    hosts = paths.groupBy(host_key).agg(F.sum("n").alias("n"), *[F.sum(f"{c}_sum").alias(f"{c}_sum") for c in CLASSES])
    whole = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"{c}_sum").alias(c) for c in CLASSES]).first()
    prior = {c: (whole[c] or 0.0) / (whole["n"] or 1) for c in CLASSES}
    hosts = hosts.select(host_key, *[_shrunk(hosts, c, F.lit(prior[c])).alias(f"{c}_host") for c in CLASSES])
    paths = paths.join(hosts, host_key)
    paths = paths.select(*path_keys, *[_shrunk(paths, c, F.col(f"{c}_host")).alias(f"{c}_path") for c in CLASSES])
    judged = scored.join(paths, path_keys)
    judged = judged.select("doc_id", "own", *[_sigmoid(F.col(c) + _logit(F.col(f"{c}_path"))).alias(c) for c in CLASSES])
    return judged.withColumn("rejected", reduce(lambda a, b: a | b, [F.col(c) >= reject for c in CLASSES]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected; of rows that share a doc_id one rejected takes all, rows without one go each by its own verdict."""
    rejected = _judged(docs, labels).filter("rejected")
    left = without_ids(docs, rejected.select("doc_id"))
    return without_unnamed(left, rejected.filter("own is not null").select("own"), "source", "lang", "text") if has_unnamed(docs) else left
