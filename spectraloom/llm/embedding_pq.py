"""Embedding near-duplicates by product quantisation (operator 2).

Unit vectors fall into coarse inverted lists; what is left after the list's centroid is coded by subspace. A vector
probes the lists nearest to it. In a list's block its inner products with all members come from one lookup
table per query (asymmetric: the query is exact, the members are codes). A member's own coding error bounds how
far its true inner product may lie from the looked-up one, so no pair that meets is lost, and pairs that pass
are compared exactly in double precision. A pair is found when either vector probes the other's list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, connected_components, row_id, staged

#: Lists for small tables; one for every LIST_ROWS vectors of larger ones, up to MOST_LISTS.
LISTS, LIST_ROWS, MOST_LISTS = 256, 1024, 4096
#: Vectors for each list that the index is fitted on, drawn by hash (so 8,192 to 131,072 in all); every vector is indexed.
SAMPLE = 32
#: Vectors in a block of a list; lists a vector probes.
BLOCK, PROBES = 2048, 16
SUBSPACES, CODES = 8, 256

CODED_SCHEMA = "node long, n long, list int, probes array<int>, codes binary, err double, vec binary"
LINK_SCHEMA = "u long, v long, c long"


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of each row's nearest centre, over blocks of rows so that some four million distances are held at once."""
    sizes, rows = (centres**2).sum(axis=1)[None, :], max(1, (1 << 22) // len(centres))
    return np.concatenate([np.zeros(0, np.int64), *[(sizes - 2 * (x[lo : lo + rows] @ centres.T)).argmin(axis=1) for lo in range(0, len(x), rows)]])


def k_means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    centroids: np.ndarray  # list x dimension
    books: np.ndarray  # subspace x code x its dimensions
    probes: int

    def split(self, x: np.ndarray) -> np.ndarray:
        m, _, d = self.books.shape
        out = np.zeros((len(x), m * d))
        out[:, : x.shape[1]] = x
        return out.reshape(len(x), m, d)

    def probe(self, x: np.ndarray) -> np.ndarray:
        far = (self.centroids**2).sum(axis=1)[None, :] - 2 * (x @ self.centroids.T)
        return np.argsort(far, axis=1, kind="stable")[:, : self.probes]

    def code(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the length of what coding loses."""
        parts = self.split(x - self.centroids[lists])
        codes = np.stack([nearest(parts[:, m], self.books[m]) for m in range(len(self.books))], axis=1)
        lost = parts - np.stack([self.books[m][codes[:, m]] for m in range(len(self.books))], axis=1)
        return codes.astype(np.uint8), np.sqrt((lost**2).sum(axis=(1, 2)))

    def looked_up(self, queries: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Approximate inner products of queries with the coded members of one list."""
        parts = self.split(queries)
        out = np.repeat((queries @ self.centroids[which])[:, None], len(codes), axis=1)
        for m in range(len(self.books)):
            out += (parts[:, m] @ self.books[m].T)[:, codes[:, m]]
        return out


def fit(x: np.ndarray, lists: int = LISTS, probes: int = PROBES, subspaces: int = SUBSPACES) -> Index:
    k = max(1, min(lists, len(x) // 16))
    centroids = k_means(x, k, 8, 1)
    residual = x - centroids[nearest(x, centroids)]
    d = -(-x.shape[1] // subspaces)
    wide = np.zeros((len(x), subspaces * d))
    wide[:, : x.shape[1]] = residual
    parts = wide.reshape(len(x), subspaces, d)
    books = np.stack([k_means(parts[:, m], min(CODES, len(x)), 6, 2 + m) for m in range(subspaces)])
    return Index(centroids, books, min(probes, k))


def unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def coder(index: Index, dim: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                raw = _vectors(part.column("embedding"), dim)
                x = unit(raw)
                probes = index.probe(x)
                codes, err = index.code(x, probes[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("n"), pa.array(probes[:, 0].astype(np.int32)), pa.array(list(probes.astype(np.int32)), pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(err), pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary())],
                    names=["node", "n", "list", "probes", "codes", "err", "vec"],
                )

    return run


def spanning(q: np.ndarray, y: np.ndarray, nodes_q: np.ndarray, nodes_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links as (node, smallest node it reaches here): a forest instead of all pairs."""
    nodes, inverse = np.unique(np.r_[nodes_q[q], nodes_y[y]], return_inverse=True)
    a, b = inverse[: len(q)], inverse[len(q) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        nxt = label.copy()
        np.minimum.at(nxt, a, low)
        np.minimum.at(nxt, b, low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            break
        label = nxt
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def block_links(index: Index, dim: int, kind: str, least: float):
    """Rows of (list, block), members before queries, to link counts (u, null, c) and links (u, v, 0).

    Vectors travel as they came, in numbers of `kind`; all is computed in double precision.
    """
    vectors = lambda raw: unit(np.frombuffer(b"".join(raw), kind).reshape(-1, dim))

    class Block:
        def __init__(self) -> None:
            self.rows: list[tuple] = []
            self.ready = None

        def members(self):
            if self.ready is None:
                node, n, probes, codes, err, vec = zip(*self.rows, strict=True)
                probed = np.zeros((len(node), len(index.centroids)), bool)
                for i, p in enumerate(probes):
                    probed[i, p] = True
                self.ready = (np.array(node), np.array(n), probed, np.frombuffer(b"".join(codes), np.uint8).reshape(len(node), -1), np.array(err), vectors(vec))
                self.rows = []
            return self.ready

    def links(which: int, block: Block, queries: list[tuple]) -> Iterator[pa.RecordBatch]:
        node, n, probed, codes, err, x = block.members()
        q_node, q_n, q_list, q_vec = (np.array(c) if i < 3 else c for i, c in enumerate(zip(*queries, strict=True)))
        q_x = vectors(q_vec)
        near = index.looked_up(q_x, which, codes) >= least - err[None, :] - 1e-9
        near &= q_node[:, None] != node[None, :]
        a, b = np.nonzero(near)
        keep = np.concatenate([(q_x[a[i : i + 65536]] * x[b[i : i + 65536]]).sum(axis=1) >= least for i in range(0, len(a), 65536)]) if len(a) else np.zeros(0, bool)
        a, b = a[keep], b[keep]
        if not len(a):
            return
        to_q = np.bincount(a, weights=n[b], minlength=len(q_node)).astype(np.int64)
        back = ~probed[b, q_list[a]]  # the member doesn't probe the query's list, so the pair is found here only
        to_y = np.bincount(b[back], weights=q_n[a[back]], minlength=len(node)).astype(np.int64)
        u, v = spanning(a, b, q_node, node)
        i, j = np.flatnonzero(to_q), np.flatnonzero(to_y)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([q_node[i], node[j], u])), pa.array([*[None] * (len(i) + len(j)), *v.tolist()], pa.int64()), pa.array(np.concatenate([to_q[i], to_y[j], np.zeros(len(u), np.int64)]))],
            names=["u", "v", "c"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, queries = None, Block(), []
        for batch in batches:
            names = ("list", "block", "asks", "node", "n", "own", "probes", "codes", "err", "vec")
            for which, part, asks, node, n, own, probes, codes, err, vec in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (which, part) != at:
                    if queries:
                        yield from links(at[0], block, queries)
                    at, block, queries = (which, part), Block(), []
                if asks == 0:
                    block.rows.append((node, n, probes, codes, err, vec))
                elif block.rows or block.ready is not None:
                    queries.append((node, n, own, vec))
                    if len(queries) == 256:
                        yield from links(which, block, queries)
                        queries = []
        if queries:
            yield from links(at[0], block, queries)

    return run


def near_vectors(vectors: DataFrame, vector: str = "embedding", id_col: str = "vec_id", least: float = 0.95, sample: int = SAMPLE, lists: int | None = None, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """Links between vectors of cosine >= least (double precision), and their components.

    Returns per row: the id, n_links (other rows linked directly), component_id (smallest id reachable, itself
    included) and kept (id = component_id). Vectors that are null, empty, zero, or hold null or non-finite
    components, and those not of the table's most frequent length, link with nothing: n_links 0, their own component,
    kept. Equal vectors are compared as one and link with one another. A row with a null id has a null
    component_id if its component holds no other id, and is kept only then. Without `lists` their number follows
    the table's (LISTS). The index is fitted on about `sample` vectors a list; every vector is indexed. An empty
    table gives an empty table.
    """
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(row_id(id_col).alias("id"), F.col(vector).alias("embedding"))
    good = F.coalesce(F.size(v) > 0, F.lit(False)) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", good)
    lengths = rows.where("good").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    name = lambda c: F.when(c != F.lit(-(1 << 63)), c)
    if not lengths:
        return rows.select(name(F.col("id")).alias(id_col), F.lit(0).cast("long").alias("n_links"), name(F.col("id")).alias("component_id"), F.lit(True).alias("kept"))
    dim = lengths[0]["d"]
    kind = "<f4" if vectors.select(F.get(vector, F.lit(0))).dtypes[0][1] == "float" else "<f8"
    rows = staged(rows.select("id", F.when(F.col("good") & (F.size("embedding") == dim), F.xxhash64("embedding")).alias("node"), "embedding"), "pq-rows")
    usable = rows.where("node is not null")
    # a null id is larger than any other: it never names a component that has one
    large = F.when(F.col("id") == F.lit(-(1 << 63)), F.lit((1 << 63) - 1)).otherwise(F.col("id"))
    distinct = staged(usable.groupBy("node", "embedding").agg(F.count("*").alias("n"), F.min(large).alias("least")), "pq-distinct")
    total = distinct.count()
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(9), F.col("node")), 11).cast("double") / float(1 << 53)
    lists = lists or max(LISTS, min(MOST_LISTS, total // LIST_ROWS))
    fitted = distinct.where(draw < sample * lists / total).select("node", "embedding").toPandas().sort_values("node")
    if fitted.empty:
        fitted = distinct.orderBy("node").limit(1).toPandas()
    index = fit(unit(np.stack(fitted["embedding"].to_list())), lists, probes)
    coded = staged(arrow_map(distinct.select("node", "n", "embedding"), coder(index, dim, kind), CODED_SCHEMA), "pq-coded")
    sizes = {r["list"]: r["count"] for r in coded.groupBy("list").count().collect()}
    blocks = F.array(*[F.lit(max(1, -(-sizes.get(i, 0) // block))) for i in range(len(index.centroids))])
    deal = F.pmod(F.xxhash64(F.lit(4), F.col("node")), F.get(blocks, F.col("list"))).cast("int")
    members = coded.select("list", deal.alias("block"), F.lit(0).alias("asks"), "node", "n", F.col("list").alias("own"), "probes", "codes", "err", "vec")
    none = [F.lit(None).cast("array<int>").alias("probes"), F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("err")]
    asked = coded.select(F.explode("probes").alias("to"), "node", "n", F.col("list").alias("own"), "vec")
    asked = asked.select(F.col("to").alias("list"), F.explode(F.sequence(F.lit(0), F.get(blocks, F.col("to")) - 1)).alias("block"), F.lit(1).alias("asks"), "node", "n", "own", *none, "vec")
    dealt = members.unionByName(asked).repartition("list", "block").sortWithinPartitions("list", "block", "asks")
    links = staged(arrow_map(dealt, block_links(index, dim, kind, least), LINK_SCHEMA), "pq-links")
    counts = links.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("c").alias("c"))
    component = connected_components(links.where("v is not null").select("u", "v"), "pq-cc")
    placed = distinct.select("node", "n", "least").join(component, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left")
    named = placed.join(placed.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    per_node = named.select("node", (F.col("n") - 1 + F.coalesce("c", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("id", "node").join(per_node, "node", "left")
    c = F.coalesce(F.when(F.col("component_id") != F.lit((1 << 63) - 1), F.col("component_id")), F.when(F.col("node").isNull(), name(F.col("id"))))
    own = name(F.col("id"))
    return out.select(own.alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), c.alias("component_id"), own.eqNullSafe(c).alias("kept"))
