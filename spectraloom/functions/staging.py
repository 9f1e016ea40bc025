"""Tables kept in the folder that driver and executors share, and the package on workers that don't have it."""

from __future__ import annotations

import os
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_open: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or on one machine a folder of our own where it is unset; a cluster without one is refused."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-staged-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """df written to a shared table and read back: its lineage ends there, and lost executors cost no rework."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes on leaving what was staged inside, but for what the yielded function stages."""
    own: list[str] = []
    _open.append(own)

    def keep(df: DataFrame, name: str = "stage") -> DataFrame:
        out_of = _open.pop()
        try:
            return staged(df, name)
        finally:
            _open.append(out_of)

    try:
        yield keep
    finally:
        _open.pop()
        for path in own:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Gives every worker of this session the package, whether or not it can see the driver's folders."""
    context = spark.sparkContext
    if getattr(context, "_spectraloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):  # else it came from an archive that was shipped already
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spectraloom-"), "spectraloom"), "zip", os.path.dirname(root), "spectraloom")
        context.addPyFile(os.path.realpath(archive))
    context._spectraloom_shipped = True


def small_batches(spark: SparkSession) -> None:
    """For functions on Arrow batches: workers have the package, and batches end at about 8 MB unless the session sets a size of its own."""
    ship_package(spark)
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, f"{8 << 20}b")


#: Bytes that a named object may have.
MOST_OBJECT = 64 << 20


def share(spark: SparkSession, name: str, value: object, most: int = MOST_OBJECT):
    """Sends a small object to all workers under a name; a later one of that name takes its place. Objects over `most` bytes are refused."""
    n = len(pickle.dumps(value, pickle.HIGHEST_PROTOCOL))
    if n > most:
        raise ValueError(f"{name} has {n} bytes, more than {most}")
    held = spark.sparkContext.__dict__.setdefault("_spectraloom_objects", {})
    if name in held:
        held[name].unpersist()
    held[name] = spark.sparkContext.broadcast(value)
    return held[name]


def share_map(spark: SparkSession, name: str, df: DataFrame, key: str, value: str, most_rows: int = 1_000_000):
    """A table's key to value map under a name: its rows are counted before any is fetched, and over `most_rows` are refused. The largest value of equal keys counts."""
    small = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))
    n = small.count()
    if n > most_rows:
        raise ValueError(f"{name} has {n} rows, more than {most_rows}")
    return share(spark, name, {r[0]: r[1] for r in small.collect()})


def shared_object(spark: SparkSession, name: str):
    """The broadcast handle of a named object; tasks take .value of it."""
    held = spark.sparkContext.__dict__.get("_spectraloom_objects", {})
    if name not in held:
        raise KeyError(f"no object is shared as {name}")
    return held[name]


def looked_up(df: DataFrame, name: str, key: str, out: str, kind: str) -> DataFrame:
    """Adds out: what the shared map `name` has for each key, null without an entry."""
    handle = shared_object(df.sparkSession, name)

    @F.pandas_udf(kind)
    def look(k: pd.Series) -> pd.Series:
        return k.map(handle.value.get)

    return df.withColumn(out, look(F.col(key)))
