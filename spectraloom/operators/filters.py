"""Row filters, samplers and projections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectraloom.functions.staging import staged


def with_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """Global running index from 0 in the given order.

    Rows are dealt by range and numbered inside their partition; the partitions' sizes (one row a partition) give
    the offsets. No task sees more than its range. Ties in `order` may take either place.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    table = staged(dealt, "index").withColumn("_p", F.shiftright("_m", 33))
    sizes = table.groupBy("_p").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return table.join(F.broadcast(starts), "_p").withColumn(out, (F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_m", "_p", "_before")


def with_real_id(df: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is neither null nor empty."""
    return df.where(F.length(F.col(id_col).cast("string")) > 0)


def percentile_slice(df: DataFrame, index: str, start: int, end: int) -> DataFrame:
    """Rows whose index modulo 100 lies in [start, end)."""
    return df.where(F.pmod(F.col(index), F.lit(100)).between(start, end - 1))


def one_in(df: DataFrame, index: str, k: int, start: int = 0) -> DataFrame:
    return df.where(F.pmod(F.col(index) + start, F.lit(k)) == 0)


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def hashed_fraction(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """About `share` of the rows, chosen by hashed key: the same rows on every run and layout."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000))
    return df.where(draw < int(share * 1_000_000))


def random_fraction(df: DataFrame, share: float, seed: int = 42, replace: bool = False) -> DataFrame:
    return df.sample(withReplacement=replace, fraction=share, seed=seed)


def limit_by_share(df: DataFrame, index: str, most: int) -> DataFrame:
    """Caps a table at about `most` rows by keeping a whole percentage of indexed rows."""
    total = df.count()
    return df if total <= most else percentile_slice(df, index, 0, max(1, 100 * most // total))


def valid_peptide(sequence: Column, least: int = 4, most: int = 40) -> Column:
    return F.rlike(sequence, F.lit("^[ACDEFGHIKLMNPQRSTVWY]+$")) & F.length(sequence).between(least, most)


def scorable(n_peaks: Column, charge: Column, mass: Column, peaks: int = 5, charges: int = 4, low: float = 0.0, high: float = 5000.0) -> Column:
    return (n_peaks >= peaks) & (charge <= charges) & (mass >= low) & (mass <= high)


def in_used_bins(df: DataFrame, other: DataFrame, bin_col: str) -> DataFrame:
    """Rows whose bin exists on the other side."""
    return df.join(other.select(bin_col).distinct(), bin_col, "left_semi")


def all_of(*tests: Column) -> Column:
    """Conjunction; no test keeps every row."""
    return reduce(and_, tests, F.lit(True))


def any_of(*tests: Column) -> Column:
    """Disjunction; no test keeps every row."""
    return reduce(or_, tests) if tests else F.lit(True)


def unmixed(df: DataFrame, keys: Sequence[str], decoy: str) -> DataFrame:
    """One row per key with is_decoy, without keys whose rows mix target and decoy."""
    return df.groupBy(*keys).agg(F.bool_and(decoy).alias("is_decoy"), F.bool_or(decoy).alias("_any")).where("is_decoy = _any").drop("_any")


def in_list(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def whole_groups(df: DataFrame, keys: Sequence[str], score: str, least: float) -> DataFrame:
    """All rows of the groups whose best score reaches `least`."""
    good = df.groupBy(*keys).agg(F.max(score).alias("_best")).where(F.col("_best") >= least).select(*keys)
    return df.join(good, list(keys), "left_semi")


def swapped(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(F.col(value).alias(key), F.col(key).alias(value), *[c for c in df.columns if c not in (key, value)])
