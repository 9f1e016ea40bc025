"""Where rows go: packed bins, modulo and letter partitions, sizes, persistence, and jobs of mapper and reducer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectraloom.functions.staging import ship_package, staged


def packed_bins(bins: DataFrame, bin_col: str, weight: str, most_weight: int = 50, most_keys: int = 20, lanes: int = 64, deal: Column | None = None) -> DataFrame:
    """Bin to part: heaviest bins first, packed until a part holds over most_weight or most_keys bins.

    Bins are dealt to `lanes` by hash (or by `deal`) and packed inside a lane by running sums, so no task plans all bins.
    """
    dealt = bins.withColumn("_lane", F.pmod(F.xxhash64(bin_col) if deal is None else deal, F.lit(lanes)).cast("int"))
    order = Window.partitionBy("_lane").orderBy(F.desc(weight), bin_col)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    by_weight = F.floor(F.coalesce(F.sum(weight).over(upto), F.lit(0)) / most_weight)
    by_keys = F.floor((F.row_number().over(order) - 1) / most_keys)
    slots = dealt.select(bin_col, weight, "_lane", F.greatest(by_weight, by_keys).cast("long").alias("_slot"))
    return slots.select(bin_col, weight, (F.col("_slot") * lanes + F.col("_lane")).alias("part"))


def planned_groups(bins: DataFrame, bin_col: str, left: str, right: str, most_left: int, most_right: int, least: int = 1, lane_bins: int = 50_000) -> DataFrame:
    """Adds to bins with row counts of two sides where their rows meet: salts, sections and part.

    A bin of more rows than most_left or most_right is cut into salts x sections pieces, each a group of its own (part -1 - n of the bin's
    number). Other bins have a load, their rows or pairs as a share of what a group may hold, and are packed in their order: a group is
    as many neighbouring bins as their running load fills once, and holds at most twice most_left and most_right rows. Rows
    that look into several neighbouring bins are so copied to one group, or two; packing the heaviest first would scatter them. Loads
    are stretched so that there are about `least` groups. Ranges of about lane_bins bins are packed each for itself.
    """
    cut = lambda c, most: F.greatest(F.lit(1), F.ceil(F.col(c) / most)).cast("int")
    sized = bins.withColumn("salts", cut(left, most_left)).withColumn("sections", cut(right, most_right))
    load = F.greatest(F.col(left) / most_left, F.col(right) / most_right, F.col(left) * F.col(right) / (float(most_left) * most_right))
    whole = (F.col("salts") == 1) & (F.col("sections") == 1)
    n, total, low, high = sized.where(whole).agg(F.count("*"), F.coalesce(F.sum(load), F.lit(0.0)), F.coalesce(F.min(bin_col), F.lit(0)), F.coalesce(F.max(bin_col), F.lit(0))).first()
    lanes = max(1, -(-n // lane_bins))
    wide = max(1, -(-(high - low + 1) // lanes))
    stretch = max(1.0, least / total) if total else 1.0
    packed = sized.where(whole).withColumn("_lane", F.floor((F.col(bin_col) - low) / wide)).withColumn("_load", load)
    before = Window.partitionBy("_lane").orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    slot = F.floor(F.coalesce(F.sum("_load").over(before), F.lit(0.0)) * stretch)
    packed = packed.withColumn("part", (slot * lanes + F.col("_lane")).cast("long")).drop("_lane", "_load")
    return packed.unionByName(sized.where(~whole).withColumn("part", -1 - F.abs(F.col(bin_col) * 2 + F.when(F.col(bin_col) < 0, 1).otherwise(0)).cast("long")))


def by_part(df: DataFrame, parts: DataFrame, bin_col: str, n: int) -> DataFrame:
    """Rows dealt so that each planned part stays together."""
    return df.join(parts.select(bin_col, "part"), bin_col).repartition(n, "part")


def placed(df: DataFrame, part: str, n: int) -> DataFrame:
    """df with the rows of part i in partition i of n (rows of parts outside 0..n-1 go to part modulo n, those without one to 0).

    The plan's numbers are the partitions' own; a shuffle by hash of the part would put several parts into one partition and leave others empty.
    """
    return df.repartitionById(n, F.coalesce(F.pmod(F.col(part), F.lit(n)), F.lit(0)).cast("int"))


def placement(df: DataFrame, part: str) -> DataFrame:
    """Per part its rows, how many of them lie in the partition of that number, and in how many partitions they lie."""
    return df.withColumn("_p", F.spark_partition_id()).groupBy(part).agg(F.count("*").alias("n"), F.count_if(F.col("_p") == F.col(part)).alias("n_placed"), F.count_distinct("_p").alias("n_partitions"))


def by_modulo(df: DataFrame, key: Column, n: int) -> DataFrame:
    return df.withColumn("part", F.pmod(key, F.lit(n)).cast("int"))


def first_letter_part(word: Column) -> Column:
    return F.when(F.rlike(word, F.lit("^[A-Za-z]")), F.ascii(F.upper(F.substring(word, 1, 1))) - F.lit(ord("A"))).otherwise(26).cast("int")


def sized(df: DataFrame, rows: int, per_part: int, slack: float = 2.0) -> DataFrame:
    """Repartitions only if the number of partitions is far from rows / per_part."""
    want = max(1, -(-rows // per_part))
    now = df.rdd.getNumPartitions()
    if want / slack <= now <= want * slack:
        return df
    return df.coalesce(want) if want < now else df.repartition(want)


def persisted(df: DataFrame, on: bool = True) -> tuple[DataFrame, int]:
    """df kept for reuse (if on) and its number of rows."""
    kept = df.persist() if on else df
    return kept, kept.count()


def map_reduce(
    df: DataFrame, mapper: Callable[[pd.DataFrame], pd.DataFrame], mapped: str, reducer: Callable[[tuple, pd.DataFrame], pd.DataFrame], reduced: str, key: str, parts: int | None = None,
    partition: Column | None = None, consumers: Sequence[Callable[[DataFrame], object]] = (),
) -> DataFrame:
    """A job of two Python functions: mapper on batches of rows, reducer on all rows of a key.

    A key's rows must fit in one task; jobs chain by feeding one's result to the next. With `partition`, a column of the mapped
    rows that depends on the key only, rows go to the partition of that number (modulo parts). The result is staged and given to each of the
    consumers before it is returned, if there are any.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield mapper(b)

    rows = df.mapInPandas(run, mapped)
    if partition is not None:
        # all rows of a key are in one partition already: they are grouped there, without another shuffle
        n = parts or df.sparkSession.sparkContext.defaultParallelism
        own = rows.withColumn("_part", F.pmod(partition, F.lit(n)).cast("int"))
        kind = rows.schema

        def group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [b.drop(columns="_part") for b in batches]
            whole = pd.concat(held) if held else pd.DataFrame(columns=kind.names)
            for k, some in whole.groupby(key, dropna=False, sort=True):
                yield reducer((k,), some)

        out = own.repartitionById(n, F.col("_part")).mapInPandas(group, reduced)
    else:
        rows = rows.repartition(parts, key) if parts else rows
        out = rows.groupBy(key).applyInPandas(reducer, reduced)
    if consumers:
        out = staged(out, "job")
        for c in consumers:
            c(out)
    return out


def join_stress(spark, keys: int, rows: int) -> DataFrame:
    """`keys` keys with `rows` rows on both sides, joined: pairs per key (rows squared)."""
    return pair_counts(spark.range(keys * rows).select((F.col("id") % keys).alias("key"), F.col("id").alias("value")), "key", "value")


def pair_counts(side: DataFrame, key: str, value: str) -> DataFrame:
    """Pairs per key of a table joined with itself: the square of each key's rows."""
    return side.select(key, value).join(side.select(key, F.col(value).alias("_other")), key).groupBy(key).agg(F.count("*").alias("n"))


def chained(df: DataFrame, jobs: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for job in jobs:
        df = job(df)
    return df
