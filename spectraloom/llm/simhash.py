"""SimHash near-duplicates through pivot distance tables (operator 10).

Each text gets a 64-bit fingerprint by majority over its word shingles' hashes. One table holds every distinct
fingerprint's Hamming distances to many reference fingerprints, computed once. By the triangle inequality two
fingerprints whose distances to one reference differ by more than two are more than two apart, so the largest
coordinate difference discards pairs before any is compared; survivors are verified bit by bit.

Pairs meet in cells that follow from distances too. With the zero fingerprint and the one-bit fingerprints as
references, a coordinate less the zero's is +1 or -1, so the 16 coordinates of a quarter spell that quarter's
bits (which are read off directly). Two bits of difference leave at least two of four quarters' coordinates
alone, so the six pairs of quarters are the shuffle keys; a random reference's distances take a few dozen values
and would key almost nothing. A bucket gives a spanning forest of its links, not its pairs. A bucket over `most`
fingerprints is dealt again by all but one pair of the eight 4-bit pieces it leaves free, which holds it to 256
distinct fingerprints whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, connected_components, row_id, staged, text_buffers
from .shingles import by_text, xxh64_shingles

QUARTERS = list(combinations(range(4), 2))
FINGERPRINT_SCHEMA = "id long, fp long"
EDGE_SCHEMA = "u long, v long"
#: Fingerprints in a bucket that are compared with one another in one task.
MOST = 4096
PIVOTS = 32


#: The bits of every byte, highest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def majority(h: np.ndarray) -> int:
    """Each bit that is set in over half of the hashes: how often each byte value stands at each of eight places tells how often its bits are set."""
    n = len(h)
    if not n:
        return 0
    count = np.zeros(2048, np.int64)
    for a in range(0, n, 1 << 16):
        # places from the highest byte on
        count += np.bincount((h[a : a + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)).ravel(), minlength=2048)
    ones = (count.reshape(8, 256) @ BITS).ravel()
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprint(text: bytes, words: int) -> int:
    return majority(xxh64_shingles(np.frombuffer(text, np.uint8), np.array([0, len(text)]), words)[0])


def fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = by_text(*text_buffers(batch.column("text")), words, xxh64_shingles)
            fps = np.fromiter((majority(h) for h in hashes), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return run


def pivots(n: int) -> np.ndarray:
    """n reference fingerprints, fixed by rule: hashes of 0..n-1."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 1) for i in range(n)], np.uint64)


def distance_table(fps: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """fp with `table`: its Hamming distances to the references."""
    signed = pivots(n_pivots).view(np.int64).tolist()
    return fps.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(r).cast("long"))).cast("byte") for r in signed]).alias("table"))


def linked(fps: np.ndarray, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct fingerprints of one bucket and their rows of the table: each with the smallest index it reaches over links of at most `bits` bits."""
    n = len(fps)
    label = np.arange(n)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0]
    a, b = [], []
    for i in range(n):
        # the first coordinate bounds the run of partners, the others thin it
        stop = int(np.searchsorted(first, first[i] + bits, "right"))
        rest = order[i + 1 : stop]
        if len(rest):
            rest = rest[np.abs(table[rest] - table[order[i]]).max(axis=1) <= bits]
            rest = rest[np.bitwise_count(fps[rest] ^ fps[order[i]]) <= bits]
            a += [order[i]] * len(rest)
            b += rest.tolist()
    if not a:
        return label, np.zeros(n, bool)
    x, y = np.array(a), np.array(b)
    while True:
        low = np.minimum(label[x], label[y])
        nxt = label.copy()
        np.minimum.at(nxt, x, low)
        np.minimum.at(nxt, y, low)
        nxt = nxt[nxt]
        if (nxt == label).all():
            break
        label = nxt
    touched = np.zeros(n, bool)
    touched[x] = touched[y] = True
    return label, touched


def bucket_links(bits: int):
    """Rows (piece, key, fp, table) sorted by bucket to links."""

    def of_pairs(fps: np.ndarray, table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All buckets of two at once: discarded by the largest coordinate difference, then verified."""
        at = at[np.abs(table[at] - table[at + 1]).max(axis=1) <= bits] if len(at) else at
        at = at[np.bitwise_count(fps[at] ^ fps[at + 1]) <= bits]
        return fps[at + 1], fps[at]

    def of_bucket(fps: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(fps.view(np.int64))
        fps, table = fps[order], table[order]
        label, touched = linked(fps, table, bits)
        some = np.flatnonzero(touched & (label != np.arange(len(fps))))
        return fps[some], fps[label[some]]

    def emit(fps: np.ndarray, table: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(cuts)
        found = [of_pairs(fps, table, cuts[:-1][sizes == 2])]
        found += [of_bucket(fps[a : a + n], table[a : a + n]) for a, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True)]
        u, v = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("piece", "key", "fp")]
            held.append((*own, batch.column("table").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)))
            piece, key, fp, table = (np.concatenate(x) for x in zip(*held, strict=True))
            cuts = np.flatnonzero((piece[1:] != piece[:-1]) | (key[1:] != key[:-1])) + 1
            if len(cuts):
                last = cuts[-1]
                yield emit(fp[:last].view(np.uint64), table[:last], np.r_[0, cuts])
                held = [(piece[last:], key[last:], fp[last:], table[last:])]
            else:
                held = [(piece, key, fp, table)]
        if held:
            yield emit(held[0][2].view(np.uint64), held[0][3], np.array([0, len(held[0][2])]))

    return run


def fingerprint_links(fps: DataFrame, bits: int = 2, most: int = MOST, n_pivots: int = PIVOTS) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints `fp` of at most two differing bits; a spanning forest in each bucket."""
    if not 0 <= bits <= 2:
        raise ValueError("two of four quarters are untouched by at most two bits")

    def quarter(i: int):
        return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))

    keys = F.array(*[F.struct(F.lit(n).alias("piece"), F.shiftleft(quarter(a), 16).bitwiseOR(quarter(b)).alias("key")) for n, (a, b) in enumerate(QUARTERS)])
    tables = staged(distance_table(fps, n_pivots), "simhash-table")
    rows = tables.select("fp", F.explode(keys).alias("k")).select(F.col("k.piece").alias("piece"), F.col("k.key").alias("key"), "fp")
    # counts hold one row for each key that two fingerprints share, and so do the rows that are kept
    sizes = staged(rows.groupBy("piece", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
    shared = staged(rows.join(sizes, ["piece", "key"]), "simhash-keys")
    parts = shared.where(F.col("n") <= most).select("piece", "key", "fp")
    large = shared.where(F.col("n") > most).select("piece", "fp")
    if not large.isEmpty():
        # the two quarters that the bucket leaves free, as eight pieces of four bits; all but two of them key anew
        masks = []
        for n, (a, b) in enumerate(QUARTERS):
            free = [16 * q + 4 * i for q in range(4) if q not in (a, b) for i in range(4)]
            for m, (x, y) in enumerate(combinations(free, 2)):
                mask = ((1 << 64) - 1) ^ (0xF << x) ^ (0xF << y)
                masks.append((n, 6 + 28 * n + m, mask - (1 << 64) if mask >> 63 else mask))
        finer = fps.sparkSession.createDataFrame(masks, "piece int, fine int, mask long")
        parts = parts.union(large.join(F.broadcast(finer), "piece").select(F.col("fine").alias("piece"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    dealt = parts.join(tables, "fp").select("piece", "key", "fp", "table").repartition("piece", "key").sortWithinPartitions("piece", "key")
    return arrow_map(dealt, bucket_links(bits), EDGE_SCHEMA)


def simhash_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 3, bits: int = 2, most: int = MOST, n_pivots: int = PIVOTS) -> DataFrame:
    """Fingerprint and near-duplicate component of every row.

    Returns the id column, `fingerprint` (16 lowercase hex digits) and `component_id` (smallest id reachable
    over links of at most `bits` bits). Null and empty texts, and texts of white space, have fingerprint zero
    and are linked like any other. A null id never is a component's id: a component of null ids only has a
    null component_id. Repeated ids keep one row each. An empty table gives an empty table.
    """
    ids = arrow_map(docs.select(row_id(id_col).alias("id"), F.col(text).alias("text")), fingerprints(words), FINGERPRINT_SCHEMA)
    rows = staged(ids.withColumn("id", F.when(F.col("id") != F.lit(-(1 << 63)), F.col("id"))), "simhash-fps")
    fps = rows.groupBy("fp").agg(F.min("id").alias("least"))
    component = connected_components(fingerprint_links(fps.select("fp"), bits, most, n_pivots), "simhash-cc")
    placed = fps.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = placed.join(placed.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
