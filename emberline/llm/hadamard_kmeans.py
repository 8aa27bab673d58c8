"""Clustering of integer vectors around centroids, nearest centroids found by Walsh-Hadamard progressive search.

Vectors and centroids are transformed exactly, in whole numbers. Squared distances of transforms are `size` times those of
the vectors, so a search may add up coefficient differences instead, coarse coefficients (sums over halves,
quarters, ...) first. After each step the length of what is left of both sides bounds the rest of a
distance from below and above; a centroid whose lower bound is strictly above another one's upper bound is out. The centroids that
stay are finished over all coefficients, so distances and ties are exact.

The transform is linear: cluster sums are taken over coefficients and turned back on the driver, k rows a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import stored

SIZE = 64
SCALE = 1024
LARGEST = 1 << 24
"""Greatest whole component for which squares of coefficient differences fit 64 bits."""


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, coefficients from coarse to fine (bit-reversed order)."""
    n, size = rows.shape
    out = rows.copy()
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, coarse_first(size)]


def coarse_first(size: int) -> np.ndarray:
    bits = size.bit_length() - 1
    return np.array([int(format(i, f"0{bits}b")[::-1], 2) if bits else 0 for i in range(size)])


def inverse(rows: np.ndarray) -> np.ndarray:
    """The rows that `transform` made, times their size; works on exact Python numbers (dtype object) too."""
    back = np.empty_like(rows)
    back[:, coarse_first(rows.shape[1])] = rows
    return transform(back)[:, np.argsort(coarse_first(rows.shape[1]))]


def _rest(coefficients: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers not above and not below the length of what follows coefficient `at`."""
    length = np.sqrt((coefficients[:, at:] ** 2).sum(1).astype(float)).astype(np.int64)
    return np.maximum(length - 1, 0), length + 1


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """`(centroid, squared distance, coefficient differences taken)` of transformed vectors; ties to the smaller number."""
    n, size = vectors.shape
    k = len(centroids)
    row, centroid = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total = np.zeros(n * k, np.int64)
    steps = [0, *(1 << i for i in range(size.bit_length()))]
    work = 0
    for lo, hi in zip(steps, steps[1:], strict=False):
        gap = vectors[row, lo:hi] - centroids[centroid, lo:hi]
        total += (gap * gap).sum(1)
        work += gap.size
        if hi == size:
            break
        (v_low, v_high), (c_low, c_high) = _rest(vectors, hi), _rest(centroids, hi)
        least = np.maximum(np.maximum(v_low[row] - c_high[centroid], c_low[centroid] - v_high[row]), 0)
        most = v_high[row] + c_high[centroid]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        bound = np.minimum.reduceat(total + most * most, start)
        stays = total + least * least <= bound[row]
        row, centroid, total = row[stays], centroid[stays], total[stays]
    start = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(total, start)
    hit = np.flatnonzero(total == best[row])
    first = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
    return centroid[first], total[first] // size, work


def whole_vectors(embeddings: DataFrame, id_column: str, vector: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """`(id, whole)`: vectors of `size` finite components, each times `scale` and rounded down.

    A component beyond `LARGEST` after scaling stops the query, as its distances would pass 64 bits.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.select(F.col(id_column).alias("id"), x.alias("x")).where(F.col(vector).isNotNull() & (F.size(vector) == size) & ~bad)
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST / scale}")).cast("bigint")
    whole = F.transform("x", lambda v: F.when(F.abs(v * scale) > LARGEST, too_large).otherwise(F.floor(v * scale)))
    return rows.select("id", whole.alias("whole"))


@dataclass
class Clusters:
    rows: DataFrame
    """`(id, cluster, distance)`: one row per kept vector, `distance` squared."""
    centroids: list[list[int]]
    """Whole components of each centroid."""


def cluster(
    embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10,
    size: int = SIZE, scale: int = SCALE, seed: int = 3,
) -> Clusters:
    """Lloyd rounds over whole vectors from the `k` vectors with the least sha256 of `seed:id`.

    Each round assigns all vectors (ties to the smaller centroid) and replaces every centroid that has vectors by the
    componentwise floor of their mean; after the last round the vectors are assigned once more. Vectors that are null, of
    another size, or hold null or non-finite components are left out; a null id counts as empty text in the digest; repeated
    rows are vectors of their own; equal ids start in the order of their components. Fewer vectors than `k` give as many
    centroids, an empty table none. Other columns are not read. `size` must be a power of two.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    kept = whole_vectors(embeddings, id_column, vector, size, scale)
    id_type = dict(kept.dtypes)["id"]

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("whole").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)
            flat = pa.array(transform(whole).astype(np.int32).ravel(), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "waves"])

    waves = stored(kept.mapInArrow(transformed, f"id {id_type}, waves array<int>"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = waves.orderBy(digest, "waves").limit(k).collect()
    centroids = [[int(c) // size for c in row] for row in inverse(np.array([r.waves for r in first], object).reshape(-1, size))]

    def placed(batch: pa.RecordBatch, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = batch.column("waves").flatten().to_numpy().astype(np.int64).reshape(-1, size)
        return rows, *nearest(rows, targets)[:2]

    for _ in range(rounds if centroids else 0):
        targets = transform(np.array(centroids, np.int64))

        def summed(batches: Iterator[pa.RecordBatch], targets=targets) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(targets), size + 1), np.int64)  # behind the coefficients the number of vectors
            for batch in batches:
                if batch.num_rows:
                    rows, at, _ = placed(batch, targets)
                    np.add.at(sums[:, :size], at, rows)
                    sums[:, size] += np.bincount(at, minlength=len(targets))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums.tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])

        parts = waves.select("waves").mapInArrow(summed, "cluster int, sums array<bigint>").select("cluster", F.posexplode("sums").alias("at", "part"))
        table = np.zeros((len(centroids), size + 1), object)
        for r in parts.groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total")).collect():
            table[r.cluster, r.at] = int(r.total)
        means = inverse(table[:, :size])
        centroids = [[int(s) // size // n for s in row] if (n := table[i, size]) else centroids[i] for i, row in enumerate(means)]

    targets = transform(np.array(centroids, np.int64).reshape(-1, size))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, at, far = placed(batch, targets)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(at, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"])

    rows = stored(waves.mapInArrow(assigned, f"id {id_type}, cluster int, distance bigint"))
    return Clusters(rows.withColumnRenamed("id", id_column), centroids)
