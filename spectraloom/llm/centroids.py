"""Centroid clustering in exact integers, with a LAESA pivot table (operator 13).

Vectors become integer vectors. Their distances to a few fixed pivots are computed once and stored beside them. In every
round the centroids' distances to the same pivots are known too, and the largest difference of two such distances is a
lower bound of the distance between vector and centroid. The centroid of the smallest bound gets its exact integer
distance first; after that only centroids whose bound does not exceed the best distance so far get theirs. Bounds
decide what is computed, never the result. Rounds read the stored table, sum up in their tasks and send at most one row
a centroid and task to the shuffle; the centroids, and nothing else, pass the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, staged

#: Pivots, and the vectors of smallest hash that they are chosen from (they set the speed, never the result).
PIVOTS, PIVOT_SAMPLE = 8, 1024
#: Largest integer component: squared distances of 64 such components fit in 63 bits.
LARGEST = 1 << 27
TABLE_SCHEMA = "id long, x binary, far binary"


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one integer vector."""
    d = x - centre
    return np.einsum("ij,ij->i", d, d)


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the one farthest from those before it."""
    chosen = [0]
    gap = squared(sample, sample[0])
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(x, p) for p in pivots], axis=1).astype(np.float64))


def assign(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance to it, exact distances computed); the smaller number wins ties."""
    own = pivot_distances(centroids, pivots)
    bound = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(far[:, p, None] - own[None, :, p]), out=bound)
    # roots are rounded: what the rounding may add is taken off
    slack = 1e-12 * (far.max(axis=1, initial=0.0) + own.max(initial=0.0)) + 1e-9
    bound = np.maximum(bound - slack[:, None], 0.0) ** 2 * (1 - 1e-12)
    label = bound.argmin(axis=1)
    best = squared(x, centroids[label])
    first, computed = label.copy(), len(x)
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= best) & (first != c))
        d = squared(x[rows], centroids[c])
        computed += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < label[rows]))
        label[rows[better]], best[rows[better]] = c, d[better]
    return label, best, computed


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def pivot_table(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, pivots.shape[1])
                far = pivot_distances(x, pivots)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()), pa.array([r.tobytes() for r in far.astype("<f8")], pa.binary())], names=["id", "x", "far"])

    return run


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            x = _rows(part.column("x"), "<i4", centroids.shape[1]).astype(np.int64)
            label, best, computed = assign(x, _rows(part.column("far"), "<f8", len(pivots)), centroids, pivots)
            yield part, x, label, best, computed


def cluster_sums(centroids: np.ndarray, pivots: np.ndarray):
    """One row a centroid and task: its vectors, their componentwise sums, and the exact distances the task computed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, exact = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), 0
        for _, x, label, _, computed in _assigned(batches, centroids, pivots):
            order = np.argsort(label, kind="stable")
            here, starts = np.unique(label[order], return_index=True)
            sums[here] += np.add.reduceat(x[order], starts, axis=0)
            n += np.bincount(label, minlength=len(n))
            exact += computed
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(list(sums[used]), pa.list_(pa.int64())), pa.array([exact, *[0] * (len(used) - 1)], pa.int64())],
                names=["cluster", "n", "sums", "exact"],
            )

    return run


def nearest_rows(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, label, best, _ in _assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(label.astype(np.int32)), pa.array(best)], names=["id", "cluster", "distance"])

    return run


def cluster_vectors(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, pivots: int = PIVOTS, measured: dict | None = None) -> DataFrame:
    """k-means over floor(scale * component), exact in integers.

    Vectors of another length than `dim`, null ones and those with null or non-finite components are left out. Centroids
    start as the k kept vectors of smallest sha256 of `1:<id>` (a null id as `1:`; equal hashes by the vector), fewer if there are
    fewer. `rounds` times each vector goes to its nearest centroid (squared Euclidean distance, ties to the smaller number)
    and each non-empty centroid becomes the componentwise floor of its vectors' mean; then vectors are assigned once more.
    Returns per kept row: the id (null ids and repeated rows each count), cluster, distance, cluster_inertia, inertia,
    centroid_sha256. An empty table gives an empty table. Components beyond LARGEST can't be measured in 64-bit squared
    distances: they are refused with an error. `measured` gets the exact distances each round computed, and the rows.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where((F.size("v") == dim) & finite)
    ints = F.transform(v, lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(F.raise_error(F.lit(f"a component times {scale} reaches {LARGEST}")).cast("long")))
    rows = rows.select("id", ints.alias("v"))
    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    sample = [r["v"] for r in rows.orderBy(drawn, "v").limit(max(PIVOT_SAMPLE, k)).select("v").collect()]
    out = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not sample:
        return spark.createDataFrame([], f"{id_col} long, {out}")
    sample = np.array(sample, np.int64)
    centroids, base = sample[:k].copy(), spread_pivots(sample, pivots)
    table = staged(arrow_map(rows, pivot_table(base), TABLE_SCHEMA), "pivot-table")
    for _ in range(rounds):
        sums = arrow_map(table, cluster_sums(centroids, base), "cluster int, n long, sums array<long>, exact long")
        totals = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("exact").alias("exact"), F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(dim)]).alias("sums")).collect()
        if measured is not None:
            measured.setdefault("exact", []).append(sum(r["exact"] for r in totals))
            measured["rows"] = sum(r["n"] for r in totals)
        for r in totals:
            centroids[r["cluster"]] = [int(s) // r["n"] for s in r["sums"]]
    placed = staged(arrow_map(table, nearest_rows(centroids, base), "id long, cluster int, distance long"), "pivot-placed")
    inertia = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    each = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    prints = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centroids])
    return placed.select(
        F.col("id").alias(id_col), "cluster", "distance", F.get(each, F.col("cluster")).alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(prints, F.col("cluster")).alias("centroid_sha256"),
    )
