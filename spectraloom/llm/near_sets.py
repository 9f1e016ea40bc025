"""Near copies by exact shingle similarity: prefix keys, pivot distances, verification.

A text is the set of its word shingles' hashes. Two sets whose similarity (shared by all) is at least 4/5
share an element among the first n - ceil(4n/5) + 1 of each in any common order, so these prefixes are the
shuffle keys and no pair is lost. The order puts shingles that a sample finds common last, so that boilerplate
seldom keys anything. Inside a bucket lengths and positions discard pairs; then each set's distances to
reference sets (hash classes, one for four to eight elements) do: by the triangle inequality the differences of two sets' counts in those
classes sum up to no more than what the sets differ in. Survivors' sets are intersected.

Only components matter, so each bucket's members are first compared with a few of their bucket alone; pairs that
this has connected already are left out of the comparison of all with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, connected_components, row_id, scratch, staged, text_buffers
from .shingles import by_text, rotated

#: Fewest reference sets; a longer text has twice as many for each doubling.
CLASSES = 16
#: Distinct texts that may be sent to all workers as hashes.
SENT = 500_000
#: Shingles found common in one of SAMPLE texts: at most COMMON of them, each in at least LEAST sampled texts.
SAMPLE, COMMON, LEAST = 16, 50_000, 8
#: Members of a bucket that meet one another in one task.
MOST = 2048
SET_SCHEMA = "id long, h long, k long, n int, classes binary, prefix array<long>"


def shingle_sets_of(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    for h in by_text(*text_buffers(texts), words):
        s = np.sort(h)
        yield s[np.r_[True, s[1:] != s[:-1]]] if len(s) else s


def prefix_of(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 elements of a sorted set. The top bits name the class, so the order is by the lower ones, then by the top ones; common shingles come last."""
    often = np.zeros(len(s), bool)
    if len(common):
        often = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
    turned = rotated(s, 20)
    need = len(s) - -(-4 * len(s) // 5) + 1
    rare = np.sort(turned[~often])[:need]
    first = np.r_[rare, np.sort(turned[often])[: need - len(rare)]] if len(rare) < need else rare
    return rotated(first, 44)


def class_counts(s: np.ndarray) -> bytes:
    """How many elements fall in each of a power of two of hash classes, 255 standing for more."""
    c = max(CLASSES, 1 << min(max(len(s) // 4, 1).bit_length() - 1, 20))
    at = (s >> np.uint64(65 - c.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=c), 255).astype(np.uint8).tobytes()


def class_distance(x: bytes, y: bytes) -> int:
    """At most the number of elements that two sets differ in; 0 where counts are not known."""
    a, b = sorted((np.frombuffer(v, np.uint8) for v in (x, y)), key=len)
    if max(a.max(), b.max()) == 255:
        return 0
    return int(np.abs(b.reshape(len(a), -1).sum(axis=1, dtype=np.int64) - a).sum())


def described(words: int, common: np.ndarray):
    """Rows (id, h, text) to their set's key, size, class counts and prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, classes, prefixes, seen = [], [], [], [], set()
            for s in shingle_sets_of(batch.column("text"), words):
                keys.append(xxhash.xxh64_intdigest(s.tobytes(), 7))
                sizes.append(len(s))
                classes.append(class_counts(s))
                if keys[-1] in seen:  # a copy keys nothing that its first does not
                    prefixes.append(s[:0].view(np.int64))
                    continue
                seen.add(keys[-1])
                prefixes.append((prefix_of(s, common) if len(s) else s).view(np.int64))
            columns = [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(classes, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), *columns], names=["id", "h", "k", "n", "classes", "prefix"])

    return run


def all_shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for s in shingle_sets_of(batch.column("text"), words):
                held.append(s)
                n += len(s)
                if n >= 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], names=["s"])
                    held, n = [], 0
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], names=["s"])

    return run


def shingle_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets_of(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(sets, pa.binary())], names=["k", "shingles"])

    return run


def within_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose class counts differ by no more than similar sets do."""
    for batch in batches:
        total = batch.column("nu").to_numpy().astype(np.int64) + batch.column("nv").to_numpy()
        near = [9 * class_distance(x, y) <= t for x, y, t in zip(batch.column("cu").to_pylist(), batch.column("cv").to_pylist(), total.tolist(), strict=True)]
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets share at least 4/5 of all their shingles."""
    for batch in batches:
        near = []
        for x, y in zip(batch.column("su"), batch.column("sv"), strict=True):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            near.append(5 * both >= 4 * (len(a) + len(b) - both))
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))


def similar_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 5) -> DataFrame:
    """Rows (id, h, component): every row's null-safe id, its text's hash, and the component of texts that links of
    similarity 4/5 or more connect. Texts without a word are one component; a text of fewer words is one shingle."""
    own = docs.select(row_id(id_col).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    sample = arrow_map(own.where(F.pmod("h", F.lit(SAMPLE)) == 0).dropDuplicates(["h"]).select("text"), all_shingles(words), "s long")
    seen = sample.groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST).orderBy(F.desc("n"), "s").limit(COMMON)
    common = np.sort(seen.select("s").toPandas()["s"].to_numpy(np.int64).view(np.uint64))
    rows = staged(arrow_map(own, described(words, common), SET_SCHEMA), "near-sets")
    sets = staged(rows.groupBy("k").agg(F.min("h").alias("h"), F.first("n").alias("n"), F.first("classes").alias("classes")), "near-distinct")
    keyed = rows.select("k", "n", F.posexplode("prefix").alias("pos", "s")).repartition("s").dropDuplicates(["s", "k"]).withColumn("many", F.count("*").over(Window.partitionBy("s"))).where("many > 1")
    keys = staged(keyed, "near-keys")

    def verified(pairs: DataFrame) -> DataFrame:
        side = {c: sets.select(F.col("k").alias(c), F.col("n").alias(f"n{c}"), F.col("classes").alias(f"c{c}")) for c in "uv"}
        met = pairs.distinct().join(side["u"], "u").join(side["v"], "v").where("5L * least(nu, nv) >= 4L * greatest(nu, nv)")
        met = staged(arrow_map(met, within_reach, "u long, v long"), "near-pairs")
        wanted = staged(met.select(F.col("u").alias("k")).union(met.select(F.col("v").alias("k"))).distinct().join(sets.select("k", "h"), "k"), "near-wanted")
        if wanted.count() <= SENT:
            wanted = F.broadcast(wanted)
        texts = own.select("h", "text").join(wanted, "h").dropDuplicates(["k"]).select("k", "text")
        full = staged(arrow_map(texts, shingle_sets(words), "k long, shingles binary"), "near-shingles")
        both = met.join(full.select(F.col("k").alias("u"), F.col("shingles").alias("su")), "u").join(full.select(F.col("k").alias("v"), F.col("shingles").alias("sv")), "v")
        return staged(arrow_map(both, similar, "u long, v long"), "near-links")

    def placed_keys(links: DataFrame) -> DataFrame:
        """Keys with their component so far; a bucket of one component has nothing left to tell."""
        known = connected_components(links, "near-cc").withColumnRenamed("node", "k")
        now = keys.join(known, "k", "left").withColumn("component", F.coalesce("component", "k"))
        own = Window.partitionBy("s")
        now = now.withColumn("least", F.min("component").over(own)).withColumn("most", F.max("component").over(own))
        return staged(now.where("least <> most").drop("least", "most"), "near-open")

    other = F.struct("k", "n", "pos", "component")
    now, links = keys.withColumn("component", F.col("k")), None
    # neighbours by size and the smallest of the bucket; then neighbours in an order of each bucket's own, so that copies of
    # one text meet many others of them and not the same one in every bucket
    for by, centre, reach in ((["n", "k"], True, 1), ([F.xxhash64("s", "k")], False, 6)):
        order = Window.partitionBy("s").orderBy(*by)
        near = [F.lag(other, i).over(order) for i in range(1, reach + 1)]
        met = now.withColumn("o", F.array(*[F.first(other).over(order)] * centre, *near)).select("k", "n", "pos", "component", F.explode("o").alias("o"))
        # what is left of both from the shared element on must hold the share that similar sets have
        met = met.where("component <> o.component and 9L * least(n - pos, o.n - o.pos) >= 4L * (n + o.n)").select("k", F.col("o.k").alias("o"))
        found = verified(met.select(F.least("k", "o").alias("u"), F.greatest("k", "o").alias("v")))
        links = found if links is None else links.union(found)
        now = placed_keys(links)
    now = now.withColumn("lots", (1 + F.floor(F.col("many") / MOST)).cast("int"))
    left = now.select("s", F.pmod(F.xxhash64("k"), F.col("lots")).cast("int").alias("lot"), F.col("k").alias("u"), F.col("n").alias("nu"), F.col("pos").alias("pu"), F.col("component").alias("a"))
    right = now.select("s", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), F.col("k").alias("v"), F.col("n").alias("nv"), F.col("pos").alias("pv"), F.col("component").alias("b"))
    met = left.join(right, ["s", "lot"]).where("u < v and a <> b and 5L * least(nu, nv) >= 4L * greatest(nu, nv) and 9L * least(nu - pu, nv - pv) >= 4L * (nu + nv)")
    links = links.union(verified(met.select("u", "v")))
    placed = connected_components(links, "near-cc").withColumnRenamed("node", "k")
    return rows.select("id", "h", "k").join(placed, "k", "left").select("id", "h", F.coalesce("component", "k").alias("component"))
