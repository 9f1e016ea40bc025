"""Expectation values from score histograms, and false-discovery curves."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the score fit.
SCALE, ENOUGH, LEAST, SLOPE, INTERCEPT = 0.05, 200, 10, -0.18, 3.5
#: Last score bin; higher scores fall into it (fixed value).
MOST_BIN = 10_000
FDR_LOW, FDR_DECADES, FDR_BINS = -8, 16, 3200


def score_fit(df: DataFrame, key: str, score: str) -> DataFrame:
    """Per key: rows, slope and intercept of log10(survival count) over score bins; fixed values under 200 rows or without a fit."""
    bins = df.where(F.col(score).isNotNull()).select(key, F.least(F.greatest((F.col(score) * SCALE + 0.5).cast("int"), F.lit(0)), F.lit(MOST_BIN)).alias("b"))
    counted = bins.groupBy(key, "b").agg(F.count("*").alias("n"))
    ends = counted.groupBy(key).agg(F.max("b").alias("last"), F.sum("n").alias("total"))
    dense = ends.select(key, "last", "total", F.explode(F.sequence(F.lit(0), "last")).alias("b")).join(counted, [key, "b"], "left")
    above = Window.partitionBy(key).orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)
    sums = dense.withColumn("s", F.sum(F.coalesce("n", F.lit(0))).over(above))
    whole = Window.partitionBy(key)
    tail = F.min("s").over(whole)  # the last bin's own count
    value = F.when(F.col("b") == F.col("last"), tail).otherwise(F.col("s") - tail)
    shown = sums.withColumn("v", value).withColumn("first", F.max(F.when(F.col("b") == 0, F.col("v"))).over(whole))
    used = (F.col("v") >= LEAST) & (F.col("v") <= F.floor(0.5 + F.col("first") / 2))
    y, x = F.when(used, F.log10(F.col("v").cast("double"))), F.when(used, F.col("b").cast("double"))
    fit = shown.groupBy(key).agg(F.max("total").alias("n"), F.regr_slope(y, x).alias("s"), F.regr_intercept(y, x).alias("i"))
    enough = (F.col("n") >= ENOUGH) & F.col("s").isNotNull() & ~F.isnan("s")
    return fit.select(key, "n", F.when(enough, F.col("s")).otherwise(SLOPE).alias("slope"), F.when(enough, F.col("i")).otherwise(INTERCEPT).alias("intercept"))


def with_expectation(df: DataFrame, key: str, score: str) -> DataFrame:
    """Adds expect = 10^(intercept + slope * 0.05 * score) from each key's own fit."""
    return df.join(score_fit(df, key, score).select(key, "slope", "intercept"), key).withColumn("expect", F.pow(F.lit(10.0), F.col("intercept") + F.col("slope") * SCALE * F.col(score))).drop("slope", "intercept")


def tail_bin(score: Column) -> Column:
    """Score bin, a tenth wide; scores beyond MOST_BIN share the last bin."""
    return F.least(F.greatest((score * 10 + 0.5).cast("int"), F.lit(0)), F.lit(MOST_BIN)).cast("int")


def tail_regression(histogram: np.ndarray) -> tuple[float, float]:
    """Slope (a bin) and intercept of log10 survival over score bins, where the highest scores, likely true matches, are left out.

    The bulk ends before the first empty bin that another empty one or the second highest filled bin follows; without one it
    ends at the latter, two lower if that is over 12. The line goes through the bulk's last quarter (from bin 30 on), half (from 15 on) or
    all of it, and starts lower until it falls. Bins of survival 1 count for the means only.
    """
    h = np.asarray(histogram, np.int64)
    filled = np.flatnonzero(h[:-1] > 0)
    top = int(filled[-1]) if len(filled) else -1
    empty = [i for i in range(max(top, 0)) if h[i] == 0 and (h[i + 1] == 0 or i + 1 == top)]
    end = max(empty[0] - 1, 0) if empty else max(top - 2 if top > 12 else top, 0)
    survival = np.cumsum(h[end::-1])[::-1].astype(float) if len(h) else np.zeros(1)
    survival[1:][h[1 : end + 1] == 0] = 0  # empty bins but the first don't count
    start = int(0.75 * end) if end >= 30 else int(0.5 * end) if end >= 15 else 0
    slope = intercept = 0.0
    for lo in range(start, -1, -1):
        x, v = np.arange(lo, end + 1), survival[lo:]
        some = v > 0
        y = np.log10(v, where=some, out=np.zeros(len(v)))
        mx, my = (x[some].mean(), y[some].mean()) if some.any() else (0.0, 0.0)
        more = v > 1
        sx, sxy = ((x - mx) ** 2)[more].sum(), ((x - mx) * (y - my))[more].sum()
        slope = float(sxy / sx) if sx > 0 else 0.0
        intercept = float(my - slope * mx)
        if slope < 0:
            break
    return slope, intercept


def tail_fit(histogram: Column) -> Column:
    """slope and intercept of `tail_regression` from an array of (b, n) structs; at most MOST_BIN + 1 of them make a histogram."""

    @F.pandas_udf("struct<slope:double,intercept:double>")
    def fit(rows: pd.Series) -> pd.DataFrame:
        out = []
        for r in rows:
            h = np.zeros(max((x["b"] for x in r), default=0) + 1, np.int64)
            for x in r:
                h[x["b"]] += x["n"]
            out.append(tail_regression(h))
        return pd.DataFrame(out, columns=["slope", "intercept"])

    return fit(histogram)


def tail_fits(histograms: DataFrame, key: str) -> DataFrame:
    """Per key slope and intercept from its rows (key, b, n), which may be partial counts."""
    counted = histograms.groupBy(key, "b").agg(F.sum("n").alias("n"))
    listed = counted.groupBy(key).agg(F.collect_list(F.struct("b", "n")).alias("_h"))
    return listed.withColumn("_f", tail_fit(F.col("_h"))).select(key, "_f.slope", "_f.intercept")


def tail_value(score: Column, slope: Column, intercept: Column) -> Column:
    """Expectation of a score by its spectrum's line; the slope is that of a bin, a tenth of a score."""
    return F.pow(F.lit(10.0), intercept + 10 * slope * score)


def tail_expectation(df: DataFrame, key: str, score: str) -> DataFrame:
    """Per key slope and intercept by `tail_regression`, from a histogram made by partial aggregation; null scores don't count."""
    return tail_fits(df.where(F.col(score).isNotNull()).groupBy(key, tail_bin(F.col(score)).alias("b")).agg(F.count("*").alias("n")), key)


def fdr_curve(df: DataFrame, score: str, decoy: str, by: str | None = None, high_is_good: bool = True) -> DataFrame:
    """Per log10 score bin the cumulative targets and decoys from the good end, fdr = decoys / all, their ratio, q (least fdr at this bin or a worse one),
    and tpr and fpr: the share of all targets, and of all decoys, that are this good or better (null where there are none).

    Windows run over at most 3200 bins (for each value of `by`), not over hits.
    """
    raw = F.floor((F.log10(F.col(score)) - FDR_LOW) * (FDR_BINS / FDR_DECADES))
    bins = F.least(F.greatest(raw, F.lit(0)), F.lit(FDR_BINS - 1)).cast("int")
    keys = [by] if by else []
    n = df.where(F.col(score) > 0).groupBy(*keys, bins.alias("bin")).agg(F.count_if(~F.col(decoy)).alias("t"), F.count_if(decoy).alias("f"))
    order = F.desc("bin") if high_is_good else F.asc("bin")
    back = F.asc("bin") if high_is_good else F.desc("bin")
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    run = part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = n.select(*keys, "bin", F.sum("t").over(run).alias("targets"), F.sum("f").over(run).alias("decoys"))
    fdr = F.col("decoys") / (F.col("targets") + F.col("decoys"))
    out = sums.withColumn("fdr", fdr).withColumn("ratio", F.when(F.col("targets") > 0, F.col("decoys") / F.col("targets")))
    share = lambda c: F.col(c) / F.nullif(F.max(c).over(part), F.lit(0))
    return out.withColumn("q", F.min("fdr").over(part.orderBy(back).rowsBetween(Window.unboundedPreceding, 0))).withColumn("tpr", share("targets")).withColumn("fpr", share("decoys"))
