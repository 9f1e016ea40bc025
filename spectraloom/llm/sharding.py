"""Sharding by a hierarchical weighted hash tree (operator 9).

A row descends region, rack and shard. At every level each child draws -ln(u) / weight, u hashed from the id and
the child's name, and the least draw wins, so a child gets rows in proportion to its weight, and a change of one
weight moves rows only into or out of that subtree. A grown tree opens new shards in regions of their own: old
subtrees keep their weights, so rows move into the new shard only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PART_ROWS, ranked, staged


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: name (its hash key), weight of a shard, children of the others."""

    name: int
    weight: float = 1.0
    children: tuple[Node, ...] = ()

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


#: Shards of the tree before growth, shards a rack, racks a region.
BASE_SHARDS, PER_RACK, PER_REGION = 24, 4, 3


def tree(shards: int, weights: dict[int, float] | None = None) -> Node:
    """The tree of `shards` shards, set by that count alone: full racks and regions up to BASE_SHARDS, then one region for each more."""
    leaf = lambda i: Node(i, (weights or {}).get(i, 1.0))
    size = PER_RACK * PER_REGION
    regions = []
    for r in range(0, min(shards, BASE_SHARDS), size):
        own = range(r, min(r + size, shards, BASE_SHARDS))
        racks = [Node(2_000_000 + own[k], children=tuple(leaf(i) for i in own[k : k + PER_RACK])) for k in range(0, len(own), PER_RACK)]
        regions.append(Node(1_000_000 + r, children=tuple(racks)))
    for i in range(BASE_SHARDS, shards):
        regions.append(Node(1_000_000 + i, children=(Node(2_000_000 + i, children=(leaf(i),)),)))
    return Node(0, children=tuple(regions))


def draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight with u in (0, 1) from 53 bits of the hash of key and node."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name).cast("long")), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(node.total)


def descend(key: Column, node: Node) -> Column:
    """The shard that key reaches below node."""
    if not node.children:
        return F.lit(node.name)
    live = [c for c in node.children if c.total > 0]
    if len(live) == 1:
        return descend(key, live[0])
    won = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(live)]))["i"]
    if all(not c.children for c in live):
        return F.get(F.array(*[F.lit(c.name) for c in live]), won)
    below = F.transform(F.array(won), lambda w: _chosen(w, key, live))
    return below[0]


def _chosen(won: Column, key: Column, live: list[Node]) -> Column:
    out = F.when(won == 0, descend(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(won == i, descend(key, c))
    return out


def shard_rows(docs: DataFrame, shards: int = BASE_SHARDS, text: str = "text", id_col: str = "doc_id", weights: dict[int, float] | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Places every row by its id and the shard count.

    Returns the id, size (UTF-8 bytes of the text, null as none, plus 8), text_crc32 (of the text's bytes, null
    as none), law `key`, shard, slot (gapless from 0 in a shard, by hashed id) and grown_shard (with one more
    shard). A null id is hashed like a value of its own, so all null ids share one shard; repeated ids share
    theirs; each row has its own slot. `weights` sets shards' weights (default 1; 0 empties a shard). An empty
    table gives an empty table.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(id_col), (F.octet_length(t) + 8).cast("long").alias("size"), F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"),
        descend(F.col(id_col), tree(shards, weights)).cast("int").alias("shard"), descend(F.col(id_col), tree(shards + 1, weights)).cast("int").alias("grown_shard"),
    )
    # repeated rows are dealt by crc too; rows alike in all columns may take each other's slots, which changes nothing
    spread = F.xxhash64(F.col(id_col), F.lit(3), F.col("text_crc32"))
    placed = staged(placed, "sharded")
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # one a shard
    out = ranked(placed, "shard", [id_col, "text_crc32", "size"], "slot", spread, counts, part_rows)
    return out.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
