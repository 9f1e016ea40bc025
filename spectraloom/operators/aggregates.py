"""Counts, mergeable statistics, histograms and top hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def bin_work(spectra: DataFrame, peptides: DataFrame, bin_col: str) -> DataFrame:
    """Per bin that both sides have: spectra, peptides and their product."""
    return counts_by(spectra, bin_col, out="n_spectra").join(counts_by(peptides, bin_col, out="n_peptides"), bin_col).withColumn("n_pairs", F.col("n_spectra") * F.col("n_peptides"))


def largest_bins(work: DataFrame, bin_col: str, n: int = 200) -> DataFrame:
    return work.orderBy(F.desc("n_pairs"), bin_col).limit(n)


def merged_peptides(df: DataFrame, key: str, protein: str) -> DataFrame:
    """One row per peptide with the sorted union of its proteins, for tables where no peptide is in very many: the search keeps places as rows instead."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(protein)).alias("proteins"))


def bounded_per_key(df: DataFrame, key: str, item: str, most: int) -> DataFrame:
    """The first `most` distinct items of each key in their order."""
    return df.select(key, item).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(item))).where(F.col("_r") <= most).drop("_r")


def top_matches(df: DataFrame, key: str, score: str, item: str, k: int = 4, floor: float = 1e-8) -> DataFrame:
    """The k best items per key with their rank; ties by item. An item that a key meets more than once keeps its best score. Scores up to `floor` don't rank."""
    once = df.where(F.col(score) > floor).groupBy(key, item).agg(F.max(score).alias(score))
    order = Window.partitionBy(key).orderBy(F.desc(score), item)
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_two(df: DataFrame, key: str, score: str, item: str) -> DataFrame:
    """Best and second-best item and score per key."""
    t = top_matches(df, key, score, item, 2, float("-inf"))
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    return t.groupBy(key).agg(pick(item, 1).alias("best"), pick(score, 1).alias("best_score"), pick(item, 2).alias("second"), pick(score, 2).alias("second_score"))


def listed(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sorted values per key with their number."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias("values")).withColumn("n", F.size("values").cast("long"))


def any_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key: the smallest, so that it is the same on every run."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def joined_text(df: DataFrame, key: str, value: str, separator: str = ",") -> DataFrame:
    return df.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(value)), separator).alias("joined"))


def word_counts(words: DataFrame, word: str) -> DataFrame:
    return counts_by(words, word)


def statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n, sum, mean, sample and population deviation, least and most; nulls don't count. All merge, so they combine before the shuffle."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.sum(value).alias("sum"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
        F.stddev_pop(value).alias("sd_pop"), F.min(value).alias("least"), F.max(value).alias("most"),
    )


def regression(df: DataFrame, keys: Sequence[str], y: str, x: str) -> DataFrame:
    """Slope, intercepts and correlation per key; 0 for under two points or where undefined."""
    zero = lambda c: F.coalesce(F.when(F.col("n") >= 2, F.nanvl(c, F.lit(0.0))), F.lit(0.0))
    raw = df.groupBy(*keys).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("s"), F.regr_intercept(y, x).alias("i"), F.corr(y, x).alias("c"))
    out = raw.select(*keys, "n", zero(F.col("s")).alias("slope"), zero(F.col("i")).alias("intercept"), zero(F.col("c")).alias("correlation"))
    return out.withColumn("x_intercept", F.when(F.col("slope") != 0, -F.col("intercept") / F.col("slope")).otherwise(F.lit(0.0)))


def power_of_two_histogram(df: DataFrame, value: str) -> DataFrame:
    """Counts by the number of binary digits of a whole number (0 for values below 1)."""
    v = F.col(value).cast("long")
    return df.where(v.isNotNull()).groupBy(F.when(v < 1, 0).otherwise(F.length(F.bin(v))).cast("int").alias("digits")).agg(F.count("*").alias("n"), F.max(v).alias("most"))


def multiset_difference(a: DataFrame, b: DataFrame, item: str) -> DataFrame:
    """Items with their counts on both sides and the difference."""
    x, y = counts_by(a, item, out="n_a"), counts_by(b, item, out="n_b")
    return x.join(y, item, "full_outer").select(item, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_a", "n_b")]).withColumn("difference", F.col("n_a") - F.col("n_b"))


def cumulative_share(df: DataFrame, item: str) -> DataFrame:
    """Per count value: items with it, and the share of all rows at this count or above (over the table of distinct counts)."""
    sizes = counts_by(counts_by(df, item), "n", out="n_items").withColumn("rows", F.col("n") * F.col("n_items"))
    total = sizes.agg(F.sum("rows").alias("_t"))
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    return sizes.crossJoin(F.broadcast(total)).select("n", "n_items", (F.sum("rows").over(above) / F.col("_t")).alias("share"))


def distinct_values(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def hash_spread(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows and keys per hash partition: how even a shuffle on key would be."""
    return df.groupBy(F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part")).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def run_counters(df: DataFrame, **tests: Column) -> DataFrame:
    """One row with the number of rows that meet each test, and of all rows."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_if(t).alias(n) for n, t in tests.items()])


def observed(df: DataFrame, name: str, **tests: Column):
    """df with run counters gathered while it is used (read them from the observation after an action)."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(t).alias(n) for n, t in tests.items()]), seen


def validity(df: DataFrame, key: str, decoy: str) -> DataFrame:
    """Target and decoy counts per key and what they make of it: Real, Decoy or Real_and_Decoy."""
    out = df.groupBy(key).agg(F.count_if(~F.col(decoy)).alias("n_target"), F.count_if(decoy).alias("n_decoy"))
    kind = F.when((F.col("n_target") > 0) & (F.col("n_decoy") > 0), "Real_and_Decoy").when(F.col("n_decoy") > 0, "Decoy").when(F.col("n_target") > 0, "Real").otherwise("Unknown")
    return out.withColumn("validity", kind)


def database_sizes(df: DataFrame, mass: str, modified: str) -> DataFrame:
    """Per whole mass: entries, modified and unmodified."""
    return df.groupBy(F.floor(mass).cast("long").alias("mass_int")).agg(F.count("*").alias("entries"), F.count_if(modified).alias("modified"), F.count_if(~F.col(modified)).alias("unmodified"))


def merged_hits(hits: DataFrame, query: str, item: str, score: str, k: int = 5) -> DataFrame:
    """Hits of the same query from many partial searches, each item once, ranked anew, the k best kept."""
    return top_matches(hits, query, score, item, k, float("-inf"))
