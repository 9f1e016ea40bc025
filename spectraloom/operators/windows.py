"""Ranks, cumulative counts and sliding sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hit_ranks(df: DataFrame, key: str, score: str, item: str) -> DataFrame:
    """rank, delta_cn = 1 - next / this and delta_cn_star = 1 - this / top; both 0 without a next hit."""
    order = Window.partitionBy(key).orderBy(F.desc(score), item)
    nxt, top = F.lead(score).over(order), F.first(score).over(order)
    this = F.col(score)
    return df.select(
        "*", F.row_number().over(order).alias("rank"),
        F.when(nxt.isNull() | (this == 0), 0.0).otherwise(1 - nxt / this).alias("delta_cn"),
        F.when(nxt.isNull() | (top == 0), 0.0).otherwise(1 - this / top).alias("delta_cn_star"),
    )


def background(df: DataFrame, key: str, bin_col: str, value: str, reach: int = 75) -> DataFrame:
    """value less the mean of the bins within reach (own bin left out, divided by 2 * reach), at bins that have a value."""
    near = Window.partitionBy(key).orderBy(bin_col).rangeBetween(-reach, reach)
    return df.withColumn("corrected", F.col(value) - (F.sum(value).over(near) - F.col(value)) / (2 * reach))


def window_mean(df: DataFrame, key: str, bin_col: str, value: str, reach: int = 50, floor: bool = False) -> DataFrame:
    """value less the window's sum over its width (2 * reach + 1); cut at 0 with floor."""
    near = Window.partitionBy(key).orderBy(bin_col).rangeBetween(-reach, reach)
    out = F.col(value) - F.sum(value).over(near) / (2 * reach + 1)
    return df.withColumn("corrected", F.greatest(out, F.lit(0.0)) if floor else out)


def window_normalised(df: DataFrame, key: str, bin_col: str, value: str, windows: int = 10, most: float = 50.0, cut: float = 5.0) -> DataFrame:
    """Peaks' square roots scaled to 100 by key; those over `cut` scaled so that each of the equal windows' largest is `most`."""
    whole = Window.partitionBy(key)
    binned = df.where(F.col(value) > 0).groupBy(key, bin_col).agg(F.max(F.sqrt(value)).alias("_v"))
    scaled = binned.select(key, bin_col, (F.col("_v") * 100 / F.max("_v").over(whole)).alias("_v"), F.floor(F.col(bin_col) / (F.floor(F.max(bin_col).over(whole) / windows) + 1)).alias("_w"))
    part = Window.partitionBy(key, "_w")
    return scaled.withColumn("normalised", F.col("_v") * most / F.max("_v").over(part)).where(F.col("_v") > cut).select(key, bin_col, "normalised")


def neutral_loss(df: DataFrame, key: str, bin_col: str, value: str, water: int, ammonia: int, share: float = 0.2) -> DataFrame:
    """value plus a share of the values that lie a water and an ammonia loss lower."""
    base = df.select(key, bin_col, value)
    shift = lambda d, n: base.select(key, (F.col(bin_col) + d).alias(bin_col), F.col(value).alias(n))
    out = base.join(shift(water, "_w"), [key, bin_col], "left").join(shift(ammonia, "_a"), [key, bin_col], "left")
    return out.select(key, bin_col, (F.col(value) + share * (F.coalesce("_w", F.lit(0.0)) + F.coalesce("_a", F.lit(0.0)))).alias("with_loss"))


def survival(df: DataFrame, key: str, bin_col: str) -> DataFrame:
    """Rows per bin, and rows in this bin or a higher one."""
    n = df.groupBy(key, bin_col).agg(F.count("*").alias("n"))
    above = Window.partitionBy(key).orderBy(F.desc(bin_col)).rowsBetween(Window.unboundedPreceding, 0)
    return n.withColumn("at_least", F.sum("n").over(above))


def top_peaks(df: DataFrame, key: str, position: str, value: str, n: int) -> DataFrame:
    """The n largest peaks per key, ties by position."""
    order = Window.partitionBy(key).orderBy(F.desc(value), position)
    return df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def centroids(df: DataFrame, key: str, position: str, value: str, least: float | None = None, most: int | None = None) -> DataFrame:
    """Runs of neighbouring positions with a value above 0 as one peak each: value-weighted position (centre), summed value (total) and width.

    With `least`, only peaks centred there or above; with `most`, only the `most` of a key with the largest total (ties by position).
    """
    order = Window.partitionBy(key).orderBy(position)
    starts = df.where(F.col(value) > 0).withColumn("_s", (F.col(position) - F.lag(position).over(order) == 1).cast("int"))
    runs = starts.withColumn("_run", F.sum(1 - F.coalesce("_s", F.lit(0))).over(order))
    out = runs.groupBy(key, "_run").agg((F.sum(F.col(position) * F.col(value)) / F.sum(value)).alias("centre"), F.sum(value).alias("total"), F.count("*").alias("width"))
    if least is not None:
        out = out.where(F.col("centre") >= least)
    if most is not None:
        best = Window.partitionBy(key).orderBy(F.desc("total"), "centre")
        out = out.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= most).drop("_r")
    return out
