"""Shards, slots and growth against the tree walked row by row."""

import math
import struct
import zlib
from collections import Counter, defaultdict

import xxhash

from spectraloom.llm.sharding import Node, shard_rows, tree


def walk(id_: int | None, node: Node) -> int:
    while node.children:
        seed = 42 if id_ is None else xxhash.xxh64_intdigest(struct.pack("<q", id_), 42)
        best = []
        for i, c in enumerate(node.children):
            if c.total > 0:
                u = ((xxhash.xxh64_intdigest(struct.pack("<q", c.name), seed) >> 11) + 0.5) / (1 << 53)
                best.append((-math.log(u) / c.total, i))
        node = node.children[min(best)[1]]
    return node.name


def test_placement(spark):
    rows = [(i * 7 - 50, f"text é {i % 40}" if i % 9 else None, i) for i in range(3000)] + [(None, "a", 1), (None, "", 2), (6, "again", 3), (6, "again", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = shard_rows(docs, part_rows=10).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == walk(r.doc_id, tree(24)) and r.grown_shard == walk(r.doc_id, tree(25))
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert sum(r.grown_shard == 24 for r in got) > 0
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) < 2 * len(rows) / 24
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert shard_rows(docs.limit(0)).count() == 0


def test_growth_moves_into_the_new_shard_only():
    for n in (24, 25, 26, 40):
        for i in range(400):
            a, b = walk(i, tree(n)), walk(i, tree(n + 1))
            assert b in (a, n)


def test_weights_move_rows_in_their_subtree_only(spark):
    docs = spark.createDataFrame([(i, "") for i in range(4000)], "doc_id long, text string")
    before = {r.doc_id: r.shard for r in shard_rows(docs, 12).collect()}
    after = {r.doc_id: r.shard for r in shard_rows(docs, 12, weights={3: 0.0, 2: 2.0}).collect()}
    assert 3 not in after.values()
    # the rack's weight is as it was, so nothing crosses its border
    assert all(before[i] == after[i] or (before[i] < 4 and after[i] < 4) for i in before)
