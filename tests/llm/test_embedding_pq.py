"""Embedding links against brute force: none wrong, recall of at least 0.9, components and copies."""

import numpy as np
import pytest

from spectraloom.llm.embedding_pq import near_vectors, nearest


def exact(x: np.ndarray) -> np.ndarray:
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    return near


def test_links_and_components(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 64))
    x = (centres[rng.integers(0, 30, 600)] + rng.normal(size=(600, 64)) * rng.uniform(0.05, 0.4, (600, 1))).astype(np.float32)
    x[100:110] = x[100]
    near = exact(x)
    rows = [(i, [float(v) for v in r], i % 3, "k") for i, r in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 64), (1003, [float("nan")] + [1.0] * 63), (1004, [None] + [1.0] * 63), (1005, [float("inf")] * 64), (1006, [1.0] * 3)]
    rows += [(i, v, 0, "k") for i, v in odd] + [(None, rows[100][1], 0, "k")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, list string")
    got = {r.vec_id: r for r in near_vectors(df, block=64, lists=16, probes=6).collect()}
    assert len(got) == len(rows)
    for i, _ in odd:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id == got[100].component_id and not got[None].kept
    links = near.sum(axis=1)
    links[np.flatnonzero(near[100])] += 1  # the copy without an id
    links[100] += 1
    mine = np.array([got[i].n_links for i in range(600)])
    assert (mine <= links).all() and mine.sum() >= 0.9 * links.sum()
    assert mine[105] >= 10  # nine copies and the one without an id
    for i in range(600):
        c = got[i].component_id
        assert c <= i and got[i].kept == (c == i)
    assert near_vectors(df.limit(0)).count() == 0


def test_every_list_probed_is_exact(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    x = (np.repeat(base, 5, axis=0) + rng.normal(size=(200, 16)) * 0.12).astype(np.float32)
    near = exact(x)
    label = np.arange(200)
    for _ in range(200):
        label = np.minimum(label, np.where(near, label[None, :], 10**6).min(axis=1))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = sorted(near_vectors(df, block=32, lists=8, probes=8).collect())
    assert [r.n_links for r in got] == near.sum(axis=1).tolist()
    assert [r.component_id for r in got] == label.tolist()


@pytest.mark.parametrize(("n", "lists", "kind"), [(1000, None, "float"), (6000, None, "float"), (6000, 180, "double")])
def test_recall_at_sizes(spark, n, lists, kind):
    """Groups of 1 to 40 noisy copies among strangers, with the shipped probes."""
    rng = np.random.default_rng(n)
    parts, left = [], n
    while left:
        k = min(left, int(rng.choice([1, 1, 1, 2, 5, 40])))
        parts.append(rng.normal(size=32) + rng.normal(size=(k, 32)) * rng.choice([0.1, 0.2, 0.25]))
        left -= k
    x = np.concatenate(parts).astype(np.float32 if kind == "float" else np.float64)
    links = exact(x).sum(axis=1)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    mine = np.zeros(n, int)
    for r in near_vectors(df, lists=lists).collect():
        mine[r.vec_id] = r.n_links
    assert (mine <= links).all() and mine.sum() >= 0.9 * links.sum() > n


def test_nearest_in_blocks():
    rng = np.random.default_rng(0)
    x, centres = rng.normal(size=(5000, 8)), rng.normal(size=(3000, 8))
    some = rng.integers(0, 5000, 50)
    assert nearest(x, centres)[some].tolist() == [int(((centres - x[i]) ** 2).sum(axis=1).argmin()) for i in some]
