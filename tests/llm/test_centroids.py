"""Centroid clustering against a plain loop over all centroids in Python integers."""

import hashlib
import math

import numpy as np
import pytest

from spectraloom.llm.centroids import assign, cluster_vectors, pivot_distances, spread_pivots
from spectraloom.llm.queries import queries


def brute(rows: list[tuple[int | None, list[float]]], k: int, rounds: int, scale: int = 64) -> list[tuple]:
    ints = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    first = sorted(ints, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in first[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for turn in range(rounds + 1):
        own = [min((far(v, c), n) for n, c in enumerate(centres)) for _, v in ints]
        if turn < rounds:
            for n in range(len(centres)):
                members = [v for (_, v), (_, c) in zip(ints, own, strict=True) if c == n]
                if members:
                    centres[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    inertia = [sum(d for d, c in own if c == n) for n in range(len(centres))]
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia), prints[c]) for (i, _), (d, c) in zip(ints, own, strict=True)), key=str)


@pytest.mark.parametrize("n", [5, 700])
def test_equals_plain_k_means(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(9, 64))
    x = centres[rng.integers(0, 9, n)] + rng.normal(size=(n, 64)) * 0.2
    x[n // 2 :] = np.round(x[n // 2 :] * 4) / 4  # many ties
    x[2] = x[3]
    rows = [(i, r.tolist()) for i, r in enumerate(x)] + [(None, x[0].tolist()), (1, x[1].tolist())]
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64), (906, [float("-inf")] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 0, b"c") for i, v in rows + odd], "vec_id long, embedding array<double>, cluster int, x binary").repartition(5)
    measured = {}
    got = sorted(map(tuple, cluster_vectors(df, measured=measured).collect()), key=str)
    assert got == brute(rows, 16, 3)
    assert measured["rows"] == len(rows) and all(e <= len(rows) * 16 for e in measured["exact"])


def test_bounds_discard_and_never_change_the_result():
    rng = np.random.default_rng(1)
    centres = (rng.normal(size=(16, 64)) * 200).astype(np.int64)
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-30, 30, (3000, 64))
    pivots = spread_pivots(x[:200], 8)
    label, best, computed = assign(x, pivot_distances(x, pivots), centres, pivots)
    all_ = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (label == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()
    assert computed < 0.5 * all_.size


def test_equal_rows_empty_table_and_refused_components(spark):
    same = spark.createDataFrame([(i, [0.5] * 64) for i in range(300)], "vec_id long, embedding array<float>")
    got = cluster_vectors(same).collect()
    assert len(got) == 300 and {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)}
    assert cluster_vectors(same.limit(0)).count() == 0
    assert cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).columns[0] == "vec_id"
    with pytest.raises(Exception, match="reaches"):
        cluster_vectors(spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")).collect()


def test_registered_query(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(90, 64)).astype(np.float32)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)] + [(200, None, 1), (201, [1.0] * 3, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries()["op13_centroid_clustering"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in rows[:90]], 16, 3)
