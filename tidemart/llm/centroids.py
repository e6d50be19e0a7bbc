"""Centroid clustering of integer vectors; nearest centroids by progressive search in Walsh-Hadamard coefficients.

Vectors and centroids are transformed exactly, in whole numbers: squared differences of all coefficients sum to
the number of components times the squared distance.  Coefficients are ordered by their sign changes, coarse to
fine, and taken in blocks.  After a block a centroid whose sum so far is larger than the most that another one can
reach is strictly worse and leaves; those left are finished over all coefficients.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import saved

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
LARGEST = 1 << 23   # components beyond it count as it: sums over all coefficients then fit 64 bits
PAIRS_AT_ONCE = 1 << 15


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, whose length is a power of two, in butterflies."""
    rows, dims = x.shape
    out, step = x.astype(np.int64), 1
    while step < dims:
        halves = out.reshape(rows, dims // (2 * step), 2, step)
        out = np.concatenate((halves[:, :, :1] + halves[:, :, 1:], halves[:, :, :1] - halves[:, :, 1:]), axis=2).reshape(rows, dims)
        step *= 2
    return out


def coarse_to_fine(dims: int) -> np.ndarray:
    """Coefficients by the number of sign changes of their row of the Hadamard matrix."""
    signs = hadamard(np.eye(dims, dtype=np.int64))
    return np.argsort(np.count_nonzero(np.diff(signs, axis=0), axis=0), kind="stable")


def _blocks(dims: int) -> Iterator[tuple[int, int]]:
    at, width = 0, max(1, dims // 16)
    while at < dims:
        yield at, min(dims, at + width)
        at, width = at + width, at + width


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smallest of several, and the squared distance."""
    n, dims, k = len(vectors), vectors.shape[1], len(centroids)
    order = coarse_to_fine(dims)
    v, c = hadamard(vectors)[:, order], hadamard(centroids)[:, order]
    v_left, c_left = (v * v).sum(axis=1), (c * c).sum(axis=1)
    row, number, total = np.repeat(np.arange(n), k), np.tile(np.arange(k), n), np.zeros(n * k, dtype=np.int64)
    for at, end in _blocks(dims):
        apart = v[row, at:end] - c[number, at:end]
        total += (apart * apart).sum(axis=1)
        v_left -= (v[:, at:end] ** 2).sum(axis=1)
        c_left -= (c[:, at:end] ** 2).sum(axis=1)
        if end < dims:
            # (a - b)^2 <= 2 a^2 + 2 b^2 bounds what is still to come, in whole numbers.
            most = total + 2 * (v_left[row] + c_left[number])
            least_most = np.minimum.reduceat(most, np.searchsorted(row, np.arange(n)))
            stays = total <= least_most[row]
            row, number, total = row[stays], number[stays], total[stays]
    first = np.searchsorted(row, np.arange(n))
    best = np.minimum.reduceat(total, first)
    hits = np.flatnonzero(total == best[row])
    hits = hits[np.searchsorted(row[hits], np.arange(n))]
    return number[hits], best // dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _slices(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = max(1, PAIRS_AT_ONCE // len(centroids))
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(cluster, n, sums), one row per cluster and task."""
    k, dims = centroids.shape
    counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
    for batch in batches:
        for part in _slices(batch, centroids):
            x = _matrix(part.column("components"), dims)
            cluster, _ = nearest(x, centroids)
            counts += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, x)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
                                     ["cluster", "n", "sums"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, centroids):
            cluster, distance = nearest(_matrix(part.column("components"), centroids.shape[1]), centroids)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             ["id", "cluster", "distance"])


def _over(centroids: np.ndarray, rows: Callable) -> Callable:
    return lambda batches: rows(batches, centroids)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, dims: int, scale: int) -> DataFrame:
    """(id, components) of rows with ``dims`` components, none null or not finite: floor(scale * x) as whole numbers."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("x"))
    infinite = float("inf")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long")

    sound = (F.size("x") == dims) & F.forall("x", finite)
    return rows.filter(F.coalesce(sound, F.lit(False))).select("id", F.transform("x", whole).alias("components"))


def cluster_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS,
                    rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) per kept vector.

    Kept are vectors of exactly ``dims`` components (a power of two), none null, infinite or NaN; a null vector is
    left out like an empty one.  Components are floor(scale * x), those beyond 2**23 count as 2**23.  The first
    centroids are the ``k`` vectors with the smallest SHA-256 of "seed:id"; of equal hashes (repeated ids) the
    smaller vector comes first, and a vector without an id only where others are too few.  With fewer than
    ``k`` vectors there are fewer centroids, an empty table gives an empty result.  Repeated rows count each for
    itself, ids are returned as they are, other columns are ignored.  Sums of distances that do not fit 64 bits are null.

    Only the centroids and, per round and cluster, sums and counts reach the driver.
    """
    if dims & (dims - 1):
        raise ValueError("the number of components has to be a power of two")
    spark = vectors.sparkSession
    kept = saved(whole_vectors(vectors, id_column, vector_column, dims, scale))
    schema = f"id {dict(kept.dtypes)['id']}, cluster int, distance long"
    turn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select("components", turn.alias("turn")).orderBy(F.col("turn").asc_nulls_last(), "components").limit(k)
    centroids = np.array([r["components"] for r in first.collect()], dtype=np.int64).reshape(-1, dims)
    if not len(centroids):
        empty = spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid array<long>")
        return empty.withColumnRenamed("id", id_column)
    for _ in range(rounds):
        found = kept.select("components").mapInArrow(_over(centroids, _sums), "cluster int, n long, sums array<long>")
        found = found.select("cluster", "n", F.posexplode("sums").alias("place", "part")).groupBy("cluster", "place")
        centroids = centroids.copy()
        for r in found.agg(F.sum("n").alias("n"), F.sum("part").alias("total")).collect():
            centroids[r["cluster"], r["place"]] = r["total"] // r["n"]
    assigned = saved(kept.mapInArrow(_over(centroids, _assigned), schema))
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.try_sum("distance").alias("total")).collect()}
    inertia = None if None in sums.values() or sum(sums.values()) >= 1 << 63 else sum(sums.values())
    facts = spark.createDataFrame([(number, sums.get(number), inertia, c) for number, c in enumerate(centroids.tolist())],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    out = assigned.join(F.broadcast(facts), "cluster")  # one row per centroid
    return out.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def written(centroid: Column) -> Column:
    """A centroid's components in decimal, joined by commas."""
    return F.array_join(F.transform(centroid, lambda x: x.cast("string")), ",")
