"""A peptide table that follows its proteins: folders by mass bin, and a manifest of where each bin's rows are.

A store at `path` has three parts. `path/rows/v=N/bin=B` holds peptides as (sequence, protein_id, start, matching_mass), written once and never changed. `path/proteins/v=N` holds
the hash of every protein the store was built from. `path/manifest/v=N` says for every bin in which version's folder its rows are, how many they
are, and between which masses. An update digests only proteins that are new or changed, writes the bins that these, changed or removed proteins
have peptides in, and then the manifest: a reader sees the state before or after it. Nothing is written over what is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.masses import matching_mass, sequence_mass
from spectraloom.functions.staging import staged
from spectraloom.operators.digest import digest

from .reports import children, exists

ROWS = "sequence string, protein_id string, start int, matching_mass double"
MANIFEST = "bin long, v int, n long, least double, most double"


@dataclass(frozen=True)
class Update:
    version: int
    changed_proteins: int
    bins: int
    rewritten_bins: int


def latest(spark: SparkSession, path: str) -> int:
    """Number of the newest manifest, 0 without one."""
    names = children(spark, f"{path}/manifest") if exists(spark, f"{path}/manifest") else []
    return max((int(n.removeprefix("v=")) for n in names if n.startswith("v=") and exists(spark, f"{path}/manifest/{n}/_SUCCESS")), default=0)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row a bin: at most as many as there are mass bins."""
    version = latest(spark, path) if version is None else version
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/v={version}") if version else spark.createDataFrame([], MANIFEST)


def update_store(proteins: DataFrame, path: str, width: float = 20.0, missed: int = 0) -> Update:
    """Brings the store at path to the state of proteins (protein_id, sequence); builds it if there is none.

    A null sequence has no peptides; of rows with one id all count. Bins are `width` wide in mass.
    """
    spark = proteins.sparkSession
    before = latest(spark, path)
    version = before + 1
    own = proteins.select(F.col("protein_id").cast("string").alias("protein_id"), F.coalesce("sequence", F.lit("")).alias("sequence"))
    hashes = own.groupBy("protein_id").agg(F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list("sequence"))), 256).alias("hash"))
    hashes.write.mode("overwrite").parquet(f"{path}/proteins/v={version}")
    now = spark.read.schema("protein_id string, hash string").parquet(f"{path}/proteins/v={version}")
    was = spark.read.schema("protein_id string, hash string").parquet(f"{path}/proteins/v={before}") if before else now.limit(0)
    changed = now.join(was.withColumnRenamed("hash", "old"), "protein_id", "full_outer").where(~F.col("hash").eqNullSafe(F.col("old"))).select("protein_id")
    changed = staged(changed, "changed-proteins")
    binned = F.floor(F.col("matching_mass") / width)
    fresh = digest(own.join(changed, "protein_id", "left_semi"), missed=missed, starts=True)
    fresh = fresh.select("sequence", "protein_id", F.col("start").cast("int").alias("start"), matching_mass(sequence_mass(F.col("sequence"))).alias("matching_mass"))
    fresh = staged(fresh.withColumn("bin", binned), "fresh-peptides")
    known = manifest(spark, path, before)
    old = read_rows(spark, path, known)
    gone = old.join(changed, "protein_id", "left_semi").select("bin")
    touched = staged(fresh.select("bin").union(gone).distinct(), "touched-bins")
    # rows of touched bins that stay, and what is new; the old folders of these bins are not read any more
    bins = [r["bin"] for r in touched.collect()]  # bounded by the number of mass bins
    kept = read_rows(spark, path, known.where(F.col("bin").isin(bins))) if bins else old.limit(0)
    rows = kept.join(changed, "protein_id", "left_anti").unionByName(fresh)
    rows.repartition("bin").sortWithinPartitions("bin", "matching_mass").write.mode("overwrite").partitionBy("bin").parquet(f"{path}/rows/v={version}")
    written = spark.read.schema(f"{ROWS}, bin long").parquet(f"{path}/rows/v={version}")
    entries = written.groupBy("bin").agg(F.count("*").alias("n"), F.min("matching_mass").alias("least"), F.max("matching_mass").alias("most"))
    entries = entries.select("bin", F.lit(version).alias("v"), "n", "least", "most").unionByName(known.join(touched, "bin", "left_anti"))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v={version}")
    return Update(version, changed.count(), manifest(spark, path, version).count(), len(bins))


def read_rows(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """Rows (sequence, protein_id, start, matching_mass, bin) of the bins of a manifest, each from the folder of its version."""
    by_version: dict[int, list[int]] = {}
    for r in entries.select("bin", "v").collect():
        by_version.setdefault(r["v"], []).append(r["bin"])
    if not by_version:
        return spark.createDataFrame([], f"{ROWS}, bin long")
    parts = [spark.read.schema(f"{ROWS}, bin long").parquet(f"{path}/rows/v={v}").where(F.col("bin").isin(bins)) for v, bins in by_version.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_store(spark: SparkSession, path: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Peptides with low <= matching_mass <= high: the manifest's bounds choose the folders, no other is listed or read."""
    entries, mass = manifest(spark, path), F.col("matching_mass")
    rows = read_rows(spark, path, entries.where((F.col("most") >= (float("-inf") if low is None else low)) & (F.col("least") <= (float("inf") if high is None else high))))
    return rows.where((mass >= (float("-inf") if low is None else low)) & (mass <= (float("inf") if high is None else high)))
