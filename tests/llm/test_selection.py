"""Centroid clustering, importance resampling and the chosen-path join on small tables, against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ASCII_LOWER, SCHEMA, awkward, documents, linked, shingles
from tidemart.llm import centroids, chosenpath, resampling

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def odd(spark):
    return awkward(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 11 centroids -----------------------------------------------------------------------------

def brute_nearest(vectors, points):
    apart = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in points] for v in vectors])
    return apart.argmin(axis=1), apart.min(axis=1)


def test_transform_keeps_distances_and_orders_by_sign_changes():
    rng = np.random.default_rng(1)
    x = rng.integers(-centroids.LARGEST, centroids.LARGEST, (50, 64))
    y = centroids.hadamard(x)
    assert ((y * y).sum(axis=1) == 64 * (x * x).sum(axis=1)).all()
    signs = centroids.hadamard(np.eye(64, dtype=np.int64))[:, centroids.coarse_to_fine(64)]
    assert np.count_nonzero(np.diff(signs, axis=0), axis=0).tolist() == list(range(64))


def test_progressive_search_equals_brute_force():
    rng = np.random.default_rng(2)
    for reach, k in ((3, 16), (40, 16), (centroids.LARGEST, 7), (1, 2), (60, 1)):
        vectors, points = rng.integers(-reach, reach + 1, (200, 64)), rng.integers(-reach, reach + 1, (k, 64))
        points[-1] = points[0]  # a tie with the first
        vectors[:5] = points[rng.integers(0, k, 5)]
        number, distance = centroids.nearest(vectors, points)
        expected, least = brute_nearest(vectors, points)
        assert number.tolist() == expected.tolist() and distance.tolist() == least.tolist()


def brute_clusters(rows, k, rounds):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    turn = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    points = [v for _, v in sorted(kept, key=turn)[:k]]
    for step in range(rounds + 1):
        number, distance = brute_nearest([v for _, v in kept], points)
        if step < rounds:
            for c in set(number.tolist()):
                own = [v for (_, v), n in zip(kept, number, strict=True) if n == c]
                points[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted(((i if i is not None else -1), int(n), int(d), sum(int(x) for x, m in zip(distance, number, strict=True) if m == n),
                   int(distance.sum()), points[n]) for (i, _), n, d in zip(kept, number, distance, strict=True))


def test_clusters_of_awkward_vectors(spark):
    rng = random.Random(3)
    some = lambda: [rng.gauss(0, 0.3) for _ in range(64)]
    rows = [(k, some()) for k in range(120)] + [(7, some()), (7, some()), (None, some()), (None, None), (200, []), (201, some()[:63]),
                                                (202, some() + [0.0]), (203, [None, *some()[1:]]), (204, [math.nan, *some()[1:]]),
                                                (205, [math.inf, *some()[1:]]), (206, [0.0] * 64), (207, [0.0] * 64)]
    rows += [(k, rows[0][1]) for k in range(300, 400)]  # a very common vector
    df = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS).selectExpr("*", "'x' as cluster", "'x' as id", "'x' as components")
    found = centroids.cluster_vectors(df, rounds=3).collect()
    got = sorted(((r["vec_id"] if r["vec_id"] is not None else -1), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"],
                  r["centroid"]) for r in found)
    assert got == brute_clusters(rows, 16, 3)
    few = centroids.cluster_vectors(df.filter("vec_id in (1, 2, 206, 207)"))
    assert few.count() == 4 and {r["distance"] for r in few.collect()} == {0}
    assert centroids.cluster_vectors(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(1, [3e38] * 64, 0), (2, [-3e38] * 64, 0)], VECTORS)
    assert {r["distance"] for r in centroids.cluster_vectors(huge, k=1, rounds=0).collect()} == {0, 64 * (2 * centroids.LARGEST) ** 2}


# -- 12 resampling ----------------------------------------------------------------------------

def brute_scores(rows, target, run=1):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))
        runs = [" ".join(words[k:k + n]) for n in range(1, run + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(w.encode()) % 10000 for w in runs]

    s, t = np.zeros(10000), np.zeros(10000)
    for counts, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            for bucket in features(text)[1]:
                counts[bucket] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in rows:
        n, found = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        out.append((n, i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[0] >= 20), key=lambda r: (-r[4], 1 << 63 if r[1] is None else r[1], r[2]))
    drawn = able[:len(able) // 10]
    ranks = [(*r[1:], k + 1) for k, r in enumerate(drawn)]
    rest = list(out)
    for r in drawn:
        rest.remove(r)
    return sorted([*ranks, *[(*r[1:], None) for r in rest]], key=repr)


@pytest.mark.parametrize("run", [1, 3])
def test_resampling_equals_brute_force(spark, odd, run, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 64)
    rng = random.Random(4)
    vocabulary = ["Apple", "b2b", "don't", "é", "日本", "x-y", "\x00", "ÀB", "7"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for k in range(150)]
    rows += [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()] + [rows[0]] * 90
    target = spark.createDataFrame([("apple b2b 日本",), (None,), ("",)], "text string")
    docs = documents(spark, rows).selectExpr("*", "'x' as row", "'x' as score", "'x' as down", "'x' as n")
    found = sorted([tuple(r) for r in resampling.resample(docs, target, run=run).collect()], key=repr)
    assert found == brute_scores(rows, ["apple b2b 日本"], run)


def test_resampling_of_empty_tables(spark, none, odd):
    texts = spark.createDataFrame([], "text string")
    assert resampling.resample(none, texts).count() == 0
    assert resampling.resample(odd, texts).filter("rank is not null").count() == 0  # too few documents for one in ten
    assert [r["rank"] for r in resampling.resample(odd, texts, percent=100).filter("rank is not null").collect()]


def test_cut_and_ranks_among_ties(spark):
    rng = random.Random(6)
    rows = [(rng.randint(-3, 3), rng.randint(0, 4), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(7).cache()
    ordered = sorted(rows)
    for wanted in (0, 1, 37, 600, 1999, 2000):
        picked = df.filter(resampling.first_rows(df, ["a", "b", "c"], wanted))
        found = sorted((r["rank"], (r["a"], r["b"], r["c"])) for r in resampling.ranked(picked, ["a", "b", "c"]).collect())
        assert found == [(k + 1, row) for k, row in enumerate(ordered[:wanted])]


# -- 13 chosen paths --------------------------------------------------------------------------

def near_copies(rng, n, size, edits, vocabulary):
    base = rng.choices(vocabulary, k=size)
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(size)] = rng.choice(vocabulary)
        yield " ".join(text)


def test_chosen_paths_find_every_link(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [t for size, edits in ((5, 1), (30, 4), (60, 8), (200, 30), (1500, 160)) for _ in range(3)
             for t in near_copies(rng, 25, size, edits, vocabulary)]
    found = {r["doc_id"]: r for r in chosenpath.near_duplicates(documents(spark, texts)).collect()}
    sets = {k: shingles(t, 2) for k, t in enumerate(texts)}
    roots = linked(sets)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in found.items()} == {
        i: (len(sets[i]), roots[i], roots[i] == i) for i in sets}
    assert 1 < len(set(roots.values())) < len(texts) - 100


def test_large_paths_branch_to_the_last_level(spark, monkeypatch):
    """Texts on one template that are too far apart to link crowd the same paths; the near copies among them are found."""
    rng = random.Random(8)
    template = " ".join(f"t{k}" for k in range(60))
    own = [" ".join(f"o{k}x{j}" for j in range(25)) for k in range(80)]
    texts = [f"{template} {o}" for o in own] + [f"{template} {o} end" for o in own[:20]] + [f"{o} {template}" for o in own[10:15]]
    rng.shuffle(texts)
    levels, branched = [], chosenpath._branched
    monkeypatch.setattr(chosenpath, "OUTSIDE", 4)
    monkeypatch.setattr(chosenpath, "_branched", lambda rest, nodes, level: levels.append(level) or branched(rest, nodes, level))
    found = {r["doc_id"]: r["component_id"] for r in chosenpath.near_duplicates(documents(spark, texts)).collect()}
    assert found == linked({k: shingles(t, 2) for k, t in enumerate(texts)}) and levels == [2, 3]


def test_chosen_paths_on_awkward_and_empty_tables(odd, none):
    rows = chosenpath.near_duplicates(odd).collect()
    assert chosenpath.near_duplicates(none).count() == 0
    assert len(rows) == odd.count()
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)
    assert {r["n_shingles"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert chosenpath.first_of_each(odd).columns == odd.columns


def test_links_of_every_text_of_a_repeated_id(spark):
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = documents(spark, [(5, one), (5, two), (7, two + " more"), (3, one + " more"), (9, two)])
    found = {(r["doc_id"], r["component_id"]) for r in chosenpath.near_duplicates(docs).collect()}
    assert found == {(k, 3) for k in (3, 5, 7, 9)}


def test_minwise_tokens_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(9)
    a = chosenpath.mix64(rng.integers(0, 1 << 62, 400).astype(np.uint64))
    b = np.concatenate((a[:360], chosenpath.mix64(rng.integers(0, 1 << 62, 40).astype(np.uint64))))
    seeds = chosenpath.mix64(np.arange(1, 4001, dtype=np.uint64))
    agree = (chosenpath.minwise(a, seeds) == chosenpath.minwise(b, seeds)).mean()
    assert abs(agree - 360 / 440) < 0.02
    assert 1 - (1 - 0.8 ** chosenpath.LEVELS) ** chosenpath.TREES >= chosenpath.RECALL


def test_no_column_of_a_clashing_name_is_lost(spark):
    df = documents(spark, ["some words that stand alone here", "other words entirely and more of them"])
    df = df.withColumns({c: F.lit("x") for c in ("node", "root", "path", "tree", "kept", "fold", "held", "component_id")})
    assert chosenpath.first_of_each(df).columns == df.columns and chosenpath.first_of_each(df).count() == 2
