"""Clusters around centroids, the nearest one found by a progressive search on Walsh-Hadamard coefficients."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxtally.llm.common import settle

SIZE = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
#: Coefficients known after each step of the search.
STEPS = (4, 8, 16, 32, 64)
#: Up to this magnitude 64 times a squared distance fits into 64 bits; beyond it Python's integers compute.
NARROW = 1 << 24


def transform(vectors: np.ndarray) -> np.ndarray:
    """Exact integer Walsh-Hadamard transform of each row, coefficients by their number of sign changes."""
    out, half = vectors.reshape(len(vectors), -1), 1
    size = out.shape[1]
    while half < size:
        pair = out.reshape(len(out), size // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(out), size)
        half *= 2
    return out[:, _sequency(size)]


def _sequency(size: int) -> np.ndarray:
    signs = np.ones((1, 1), np.int64)
    while len(signs) < size:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def nearest(coefs: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centre of each vector, both given by their coefficients.

    The squared difference of all coefficients is `size` times that of the vectors. The first few
    coefficients are summed for all pairs, and the sum of the leading centre is completed. A centre
    whose sum so far is strictly above that can't win and is dropped; the others go on with the next
    coefficients and are dropped alike, until all coefficients of the rest are summed. Of equal
    distances the smaller number counts.
    """
    n, size = coefs.shape
    k = len(centers)
    if not n or not k:
        return np.zeros(0, np.int64), np.zeros(0, coefs.dtype)
    if object in (coefs.dtype, centers.dtype):
        coefs, centers = coefs.astype(object), centers.astype(object)

    def part(rows, numbers, first, last):
        gap = coefs[rows, first:last] - centers[numbers, first:last]
        return (gap * gap).sum(axis=1)

    rows, numbers = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    sums = part(rows, numbers, 0, STEPS[0])
    lead = sums.reshape(n, k).argmin(axis=1)
    bound = sums.reshape(n, k)[np.arange(n), lead] + part(np.arange(n), lead, STEPS[0], size)
    for first, last in zip(STEPS, STEPS[1:]):
        open_ = sums <= bound[rows]
        rows, numbers, sums = rows[open_], numbers[open_], sums[open_]
        sums = sums + part(rows, numbers, first, last)
    # The leading centre is never dropped, so every vector has at least one pair left.
    starts = np.searchsorted(rows, np.arange(n))
    least = np.minimum.reduceat(sums, starts)
    best = np.minimum.reduceat(np.where(sums == least[rows], numbers, k), starts)
    return best, least // size


def _integers(batch: pa.RecordBatch, wide: bool) -> np.ndarray:
    scaled = np.floor(SCALE * batch.column("v").flatten().to_numpy(zero_copy_only=False)).reshape(-1, SIZE)
    if wide or (scaled.size and np.abs(scaled).max() > NARROW):
        return np.array([[int(x) for x in row] for row in scaled], object).reshape(-1, SIZE)
    return scaled.astype(np.int64)


def _center_array(centers: list[list[int]]) -> tuple[np.ndarray, bool]:
    wide = any(abs(x) > NARROW for row in centers for x in row)
    return np.array(centers, object if wide else np.int64).reshape(-1, SIZE), wide


def _assigned(vectors: DataFrame, centers: list[list[int]]) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed, wide = _center_array(centers)
        coefs = transform(fixed)
        for batch in batches:
            cluster, distance = nearest(transform(_integers(batch, wide)), coefs)
            yield pa.record_batch(
                [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance.tolist(), pa.int64())], ["id", "cluster", "distance"])

    return vectors.mapInArrow(assign, "id bigint, cluster int, distance bigint")


def _moved(vectors: DataFrame, centers: list[list[int]]) -> list[list[int]]:
    """The next centres: each task sums its vectors per cluster, Spark sums the sums."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed, wide = _center_array(centers)
        coefs, sums, counts = transform(fixed), [[0] * SIZE for _ in centers], [0] * len(centers)
        for batch in batches:
            whole = _integers(batch, wide)
            cluster, _ = nearest(transform(whole), coefs)
            for c in np.unique(cluster):
                mine = whole[cluster == c]
                counts[c] += len(mine)
                sums[c] = [a + int(b) for a, b in zip(sums[c], mine.sum(axis=0))]
        met = [c for c, n in enumerate(counts) if n]
        yield pa.record_batch([
            pa.array(met, pa.int32()), pa.array([counts[c] for c in met], pa.int64()),
            pa.array([[Decimal(x) for x in sums[c]] for c in met], pa.list_(pa.decimal128(38, 0)))], ["cluster", "n", "sums"])

    parts = vectors.mapInArrow(tally, "cluster int, n bigint, sums array<decimal(38,0)>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "x")).groupBy("cluster", "pos").agg(
        F.sum("n").alias("n"), F.sum("x").cast("decimal(38,0)").alias("x"))
    moved = [list(row) for row in centers]
    for row in totals.collect():  # centres times components, however many vectors there are
        moved[row["cluster"]][row["pos"]] = int(row["x"]) // row["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 1,
) -> DataFrame:
    """One row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of 64 components, none of them null or not finite, are taken, each component as the integer floor(64 x);
    all other rows are left out. The `centroids` vectors with the smallest sha256 of
    `seed:id` start as centres, in that order (rows of the same id: by their components; rows without
    an id never start). Each round every vector goes to the nearest centre by squared distance, of
    equal ones that with the smaller number, and each centre with vectors becomes the floor of their
    mean. Repeated rows count as often as they stand. With fewer vectors there are fewer centres; where no row can
    start, and for an empty table, the result is empty. Other columns are not read. Distances that
    exceed 64 bits raise an error.

    Everything is exact: see `nearest`. Vectors stay where they are read; a task hands on a sum per centre, and
    only centres reach the driver.
    """
    plain = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    taken = plain.where((F.size("v") == SIZE) & ~F.exists("v", bad))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = taken.where("id IS NOT NULL").orderBy(order, "v").limit(centroids).select("v").collect()
    centers = [[int(np.floor(SCALE * x)) for x in row["v"]] for row in first]
    if not centers:
        taken = taken.where("false")
    for _ in range(rounds if centers else 0):
        centers = _moved(taken, centers)
    assigned = settle(_assigned(taken, centers), "clusters")
    digests = [sha256(",".join(map(str, row)).encode()).hexdigest() for row in centers]
    sums = {row["cluster"]: row["s"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    stats = vectors.sparkSession.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), d) for c, d in enumerate(digests)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(stats), "cluster").select(
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
