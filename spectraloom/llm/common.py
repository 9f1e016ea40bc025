"""Helpers shared by the text-pipeline operators: staged tables, Arrow text access, components, ranks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.staging import delete, scratch, ship_package, staged  # noqa: F401

#: Stands for a null id in join keys.
NULL_ID = -(1 << 63)


def row_id(column: str = "doc_id") -> Column:
    """Null-safe long id."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column in one array, with len+1 offsets; a null text is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


_kept: dict[tuple, object] = {}


def worker_cache(key: tuple, make):
    """What a Python worker keeps between tasks, made once; it keeps one operator's at a time."""
    if key not in _kept:
        drop_worker_caches()
        _kept[key] = make()
    return _kept[key]


def drop_worker_caches() -> None:
    if _kept:
        _kept.clear()
        release_memory()


def release_memory() -> None:
    """Gives back to the system what Python, Arrow and the C library hold but don't use: workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library may have no such call
        ctypes.CDLL(None).malloc_trim(0)


Batches = Iterator[pa.RecordBatch]
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 8 << 20


def tidy(run: Callable[[Batches], Batches], cached: bool = False) -> Callable[[Batches], Batches]:
    """run for mapInArrow, with memory given back at the end of each task; unless it uses worker caches, those of others go first."""

    @functools.wraps(run)
    def task(batches: Batches) -> Batches:
        if not cached:
            drop_worker_caches()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def arrow_map(df: DataFrame, run: Callable[[Batches], Batches], schema: str, cached: bool = False) -> DataFrame:
    """df through run, tidied. Unless the session sets a size of its own, batches are of about 8 MB: those of 64 MB fill executors and workers."""
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    return df.mapInArrow(tidy(run, cached), schema)


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def record_batches(schema: pa.Schema, rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    for columns in rows:
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest node reachable from each node of `edges` (u long, v long): columns node, component.

    Alternates large-star and small-star steps; every step is a min-aggregate and a join, and ends in a
    staged table. Nodes without an edge to another node do not appear. Loops and repeated edges are allowed.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, name)
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("a"), "u", "m")
        nxt = small.select(F.col("u").alias("u"), F.col("m").alias("v")).union(small.select(F.col("a").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        nxt = staged(nxt, name)
        # a forest of stars has settled when a step leaves its digest as it was
        digest = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = nxt
        if digest == before:
            break
        before = digest
    flat = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return flat.union(flat.select(F.col("component").alias("node"), "component").distinct())


#: Rows that one task numbers, about; groups of more than FEW rows are dealt to LEAST_PARTS parts at least.
PART_ROWS, FEW, LEAST_PARTS = 1 << 18, 1024, 64


def ranked(df: DataFrame, group: str, order: list[str], out: str, spread: Column, counts: dict[int, int], rows: int = PART_ROWS) -> DataFrame:
    """Adds `out`: a gapless rank from 0 within each whole number of `group`, without one task per group.

    `counts` has the rows of every group, of which there are few. Each is dealt by `spread` to as many parts as it has times
    `rows` (a group of many rows to LEAST_PARTS at least); rows are numbered inside a part, and the parts' sizes are summed up to
    offsets that are joined back.
    """
    from pyspark.sql import Window

    split = {g: max(LEAST_PARTS, -(-n // rows)) for g, n in counts.items() if n > min(FEW, rows)}
    parts = F.lit(1)
    if split:
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for pair in split.items() for v in pair]), F.col(group)), parts)
    dealt = df.withColumn("_part", F.pmod(spread, parts).cast("int"))
    sizes = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    numbered = dealt.withColumn("_rn", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [group, "_part"]).withColumn(out, (F.col("_before") + F.col("_rn")).cast("long")).drop("_part", "_rn", "_before")
