"""Fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from spectraloom.llm.simhash import fingerprint_links, simhash_components


def slow_fingerprint(text: str | None) -> int:
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids: list[int], fps: list[int], bits: int) -> dict[int, int]:
    label = dict(zip(ids, ids, strict=True))
    while True:
        nxt = {i: min([label[i]] + [label[j] for j, g in zip(ids, fps, strict=True) if (f ^ g).bit_count() <= bits]) for i, f in zip(ids, fps, strict=True)}
        if nxt == label:
            return label
        label = nxt


def test_documents(spark):
    rng = random.Random(1)
    words = [f"w{i}É" for i in range(60)]
    texts: list[str | None] = [None, "", " \t", "One", "one", "a b", "A  b\n", "x\x0by\x1cz"]
    for _ in range(40):
        t = [rng.choice(words) for _ in range(rng.randint(3, 80))]
        texts.append(" ".join(t))
        t[0] = "Q"
        texts.append(" ".join(t))
    texts += ["".join([texts[20] or "", " "]), texts[21]]
    docs = spark.createDataFrame([(i, t, 0, "q") for i, t in enumerate(texts)], "doc_id long, text string, fp int, piece string")
    got = {r.doc_id: r for r in simhash_components(docs).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert {i: r.component_id for i, r in got.items()} == components(list(range(len(texts))), fps, 2)
    assert simhash_components(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "k l"), (7, "k l"), (7, "k l"), (None, "only nulls here")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in simhash_components(odd).collect()) == [(-1, -1), (-1, 7), (7, 7), (7, 7)]


@pytest.mark.parametrize("most", [4096, 4])
def test_links_reach_what_all_pairs_reach(spark, most):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(25)} | {0}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = [(r.u, r.v) for r in fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), most=most).collect()]
    assert all(((u ^ v) & ((1 << 64) - 1)).bit_count() <= 64 for u, v in edges)
    label = {f: f for f in signed}
    for _ in range(60):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    want = components(signed, [f & ((1 << 64) - 1) for f in signed], 2)
    assert label == want


def test_bucket_labels():
    from spectraloom.llm.simhash import linked, pivots

    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 64, 40).astype(np.uint64))
    table = np.bitwise_count(fps[:, None] ^ pivots(8)[None, :]).astype(np.int8)
    label, touched = linked(fps, table, 1)
    assert (label == 0).all() or touched.any()


def test_distance_table(spark):
    from spectraloom.llm.simhash import distance_table, pivots

    fps = [0, -1, 5, -(1 << 63)]
    refs = pivots(6).tolist()
    got = {r.fp: r.table for r in distance_table(spark.createDataFrame([(f,) for f in fps], "fp long"), 6).collect()}
    assert got == {f: [((f & ((1 << 64) - 1)) ^ r).bit_count() for r in refs] for f in fps}


def test_more_shingles_than_a_block():
    from spectraloom.llm.simhash import fingerprint

    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert fingerprint(text.encode(), 3) == slow_fingerprint(text)
