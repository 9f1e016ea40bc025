"""Spectra that arrive as files: windowed counts per mass bin, and matches against a stored peptide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spectraloom.operators.joins import ppm_join


def arriving(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def windowed_bin_counts(stream: DataFrame, time: str, mass: str, width: float, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per time window and mass bin; rows later than the watermark are left out."""
    bins = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.floor(F.col(mass) / width).alias("bin"))
    return bins.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "bin", "n")


def candidates(stream: DataFrame, peptides: DataFrame, mass: str, precursor: str, ppm: float) -> DataFrame:
    """Arriving spectra with the stored peptides inside their tolerance (a stream-static join on mass bins)."""
    return ppm_join(peptides, stream, mass, precursor, ppm)
