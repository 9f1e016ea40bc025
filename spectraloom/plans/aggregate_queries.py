"""Queries of the aggregates, windows, sorts and partitioning."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from spectraloom.functions.masses import sequence_mass
from spectraloom.operators import aggregates as ag
from spectraloom.operators import expectation as ex
from spectraloom.operators import partitioning as pt
from spectraloom.operators import windows as wn

from .derived import HITS, MASS, PEAKS, PEPTIDES, WORDS, hits, peaks, peptides, tail_sql, words
from .registry import query, table


def events(spark, d):
    return table(spark, d, "events")


BINS_S = "SELECT floor(s_acctbal / 100)::BIGINT AS bin FROM supplier"
BINS_C = "SELECT floor(c_acctbal / 100)::BIGINT AS bin FROM customer"


def bins(spark, d):
    return table(spark, d, "supplier").select(F.floor(F.col("s_acctbal") / 100).alias("bin")), table(spark, d, "customer").select(F.floor(F.col("c_acctbal") / 100).alias("bin"))


@query(f"SELECT bin, count(*) AS n FROM ({BINS_C}) GROUP BY bin")
def a1_rows_per_bin(spark, d):
    return ag.counts_by(bins(spark, d)[1], "bin")


WORK = f"SELECT bin, a AS n_spectra, b AS n_peptides, a * b AS n_pairs FROM (SELECT bin, count(*) AS a FROM ({BINS_S}) GROUP BY bin) JOIN (SELECT bin, count(*) AS b FROM ({BINS_C}) GROUP BY bin) USING (bin)"


@query(f"SELECT * FROM ({WORK}) ORDER BY n_pairs DESC, bin LIMIT 200")
def a2_work_per_bin(spark, d):
    return ag.largest_bins(ag.bin_work(*bins(spark, d), "bin"), "bin")


@query(f"SELECT sequence, array_to_string(list_sort(list(DISTINCT protein_id)), ',') AS proteins FROM ({PEPTIDES}) GROUP BY sequence")
def a3_merged_peptides(spark, d):
    m = ag.merged_peptides(peptides(spark, d), "sequence", "protein_id")
    return m.select("sequence", F.array_join(F.transform("proteins", lambda p: p.cast("string")), ",").alias("proteins"))


@query("SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS r FROM (SELECT DISTINCT user_id, event_type FROM events)) WHERE r <= 2")
def a4_bounded_per_key(spark, d):
    return ag.bounded_per_key(events(spark, d), "user_id", "event_type", 2)


TOPK = "SELECT user_id, event_type, value, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_type)::INTEGER AS rank FROM (SELECT user_id, event_type, max(value) AS value FROM events WHERE value > 1e-8::DOUBLE GROUP BY 1, 2)) WHERE rank <= {k}"


@query(TOPK.format(k=4))
def a5_top_matches(spark, d):
    return ag.top_matches(events(spark, d), "user_id", "value", "event_type")


@query(f"SELECT user_id, max(event_type) FILTER (rank = 1) AS best, max(value) FILTER (rank = 1) AS best_score, max(event_type) FILTER (rank = 2) AS second, max(value) FILTER (rank = 2) AS second_score FROM ({TOPK.format(k=2).replace('WHERE value > 1e-8::DOUBLE ', '')}) GROUP BY user_id")
def a6_best_two(spark, d):
    return ag.best_two(events(spark, d), "user_id", "value", "event_type")


@query("SELECT user_id, event_type, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type)::INTEGER AS rank FROM (SELECT user_id, event_type, max(value * value) AS score FROM events GROUP BY 1, 2) WHERE score > 1e-8::DOUBLE) WHERE rank <= 4")
def a7_scored_while_grouped(spark, d):
    return ag.top_matches(events(spark, d).withColumn("score", F.col("value") * F.col("value")), "user_id", "score", "event_type")


@query("SELECT user_id, array_to_string(list_sort(list(event_type)), ',') AS kinds, count(*) AS n FROM events GROUP BY user_id")
def a8_listed(spark, d):
    return ag.listed(events(spark, d), "user_id", "event_type").select("user_id", F.array_join("values", ",").alias("kinds"), "n")


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def a9_any_value(spark, d):
    return ag.any_value(events(spark, d), "user_id", "event_id")


@query("SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ';' ORDER BY o_orderkey::VARCHAR) AS joined FROM orders GROUP BY o_custkey")
def a10_joined_text(spark, d):
    return ag.joined_text(table(spark, d, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("key")), "o_custkey", "key", ";")


@query(f"SELECT w, count(*) AS n FROM ({WORDS}) GROUP BY w")
def a11_word_count(spark, d):
    return ag.word_counts(words(spark, d), "w")


@query(f"SELECT substr(w, 1, 1) AS letter, count(*) AS n, count(DISTINCT w) AS n_words, sum(length(w))::BIGINT AS n_letters FROM ({WORDS}) GROUP BY 1")
def a11_words_by_letter(spark, d):
    return words(spark, d).groupBy(F.substring("w", 1, 1).alias("letter")).agg(F.count("*").alias("n"), F.count_distinct("w").alias("n_words"), F.sum(F.length("w")).alias("n_letters"))


@query("SELECT event_type, count(value) AS n, round(sum(value), 3) AS sum, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, round(stddev_pop(value), 6) AS sd_pop, min(value) AS least, max(value) AS most FROM events GROUP BY event_type")
def a12_statistics(spark, d):
    s = ag.statistics(events(spark, d), ["event_type"], "value")
    return s.select("event_type", "n", F.round("sum", 3).alias("sum"), *[F.round(c, 6).alias(c) for c in ("mean", "sd", "sd_pop")], "least", "most")


@query("SELECT user_id, count(value) AS n, round(avg(value), 6) AS mean, round(coalesce(stddev_pop(value), 0), 6) AS sd_pop FROM events GROUP BY user_id")
def a13_population_statistics(spark, d):
    return ag.statistics(events(spark, d), ["user_id"], "value").select("user_id", "n", F.round("mean", 6).alias("mean"), F.round("sd_pop", 6).alias("sd_pop"))


@query("SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(corr(l_extendedprice, l_quantity), 6) AS correlation, round(-regr_intercept(l_extendedprice, l_quantity) / regr_slope(l_extendedprice, l_quantity), 5) AS x_intercept FROM lineitem GROUP BY l_returnflag")
def a14_regression(spark, d):
    r = ag.regression(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")
    return r.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("correlation", 6).alias("correlation"), F.round("x_intercept", 5).alias("x_intercept"))


FITS = f"""WITH c AS (SELECT lang, least(greatest(floor(score * 0.05::DOUBLE + 0.5::DOUBLE)::BIGINT, 0), 10000) AS b, count(*) AS n FROM ({HITS}) GROUP BY 1, 2),
 e AS (SELECT lang, max(b) AS last, sum(n) AS total FROM c GROUP BY lang),
 x AS (SELECT lang, last, total, unnest(range(0, last + 1)) AS b FROM e),
 s AS (SELECT x.lang, x.b, last, total, sum(coalesce(n, 0)) OVER (PARTITION BY x.lang ORDER BY x.b DESC) AS s FROM x LEFT JOIN c ON c.lang = x.lang AND c.b = x.b),
 v AS (SELECT lang, b, total, CASE WHEN b = last THEN min(s) OVER (PARTITION BY lang) ELSE s - min(s) OVER (PARTITION BY lang) END AS v FROM s),
 f AS (SELECT *, max(v) FILTER (b = 0) OVER (PARTITION BY lang) AS first FROM v),
 g AS (SELECT lang, max(total)::BIGINT AS n, regr_slope(log10(v), b) FILTER (v >= 10 AND v <= floor(0.5 + first / 2)) AS s, regr_intercept(log10(v), b) FILTER (v >= 10 AND v <= floor(0.5 + first / 2)) AS i FROM f GROUP BY lang)
 SELECT lang, n, CASE WHEN n >= 200 AND s IS NOT NULL THEN s ELSE -0.18::DOUBLE END AS s, CASE WHEN n >= 200 AND s IS NOT NULL THEN i ELSE 3.5::DOUBLE END AS i FROM g"""


@query(f"SELECT lang, n, round(s, 5) AS slope, round(i, 5) AS intercept FROM ({FITS})")
def a15_score_fit(spark, d):
    f = ex.score_fit(hits(spark, d), "lang", "score")
    return f.select("lang", "n", F.round("slope", 5).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query(f"SELECT doc_id, lang, score, round(i + s * 0.05::DOUBLE * score, 6) AS log_expect FROM ({HITS}) JOIN ({FITS}) USING (lang)")
def a15_expectation(spark, d):
    out = ex.with_expectation(hits(spark, d), "lang", "score")
    return out.select("doc_id", "lang", "score", F.round(F.log10("expect"), 6).alias("log_expect"))


@query(f"SELECT key AS event_type, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM ({tail_sql('SELECT event_type AS key, value / 10 AS score FROM events')})")
def a16_tail_expectation(spark, d):
    fits = ex.tail_expectation(events(spark, d).withColumn("score", F.col("value") / 10), "event_type", "score")
    return fits.select("event_type", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


FDR = f"""WITH n AS (SELECT {{by}}least(greatest(floor((log10(score) + 8) * 200.0::DOUBLE), 0), 3199)::INTEGER AS bin, count(*) FILTER (NOT decoy) AS t, count(*) FILTER (decoy) AS f FROM ({HITS}) WHERE score > 0 GROUP BY ALL),
 s AS (SELECT {{by}}bin, (sum(t) OVER ({{part}}ORDER BY bin DESC))::BIGINT AS targets, (sum(f) OVER ({{part}}ORDER BY bin DESC))::BIGINT AS decoys FROM n),
 r AS (SELECT *, decoys / (targets + decoys)::DOUBLE AS fdr FROM s)
 SELECT {{by}}bin, targets, decoys, round(fdr, 9) AS fdr, round(CASE WHEN targets > 0 THEN decoys / targets::DOUBLE END, 9) AS ratio, round(min(fdr) OVER ({{part}}ORDER BY bin), 9) AS q,
 round(targets / nullif(max(targets) OVER ({{whole}}), 0)::DOUBLE, 9) AS tpr, round(decoys / nullif(max(decoys) OVER ({{whole}}), 0)::DOUBLE, 9) AS fpr FROM r"""


def rounded(df, *keys):
    return df.select(*keys, "bin", "targets", "decoys", *[F.round(c, 9).alias(c) for c in ("fdr", "ratio", "q", "tpr", "fpr")])


@query(FDR.format(by="", part="", whole=""))
def a17_fdr_curve(spark, d):
    return rounded(ex.fdr_curve(hits(spark, d), "score", "decoy"))


@query(FDR.format(by="lang, ", part="PARTITION BY lang ", whole="PARTITION BY lang"))
def a17_fdr_by_kind(spark, d):
    return rounded(ex.fdr_curve(hits(spark, d), "score", "decoy", "lang"), "lang")


@query("SELECT (CASE WHEN n_chars < 1 THEN 0 ELSE length(bin(n_chars)) END)::INTEGER AS digits, count(*) AS n, max(n_chars) AS most FROM documents GROUP BY 1")
def a18_power_of_two(spark, d):
    return ag.power_of_two_histogram(table(spark, d, "documents"), "n_chars")


@query("SELECT item, coalesce(a, 0) AS n_a, coalesce(b, 0) AS n_b, coalesce(a, 0) - coalesce(b, 0) AS difference FROM (SELECT c_nationkey AS item, count(*) AS a FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS item, count(*) AS b FROM supplier GROUP BY 1) USING (item)")
def a19_multiset_difference(spark, d):
    return ag.multiset_difference(table(spark, d, "customer").select(F.col("c_nationkey").alias("item")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("item")), "item")


@query("WITH c AS (SELECT count(*) AS n FROM events GROUP BY user_id), s AS (SELECT n, count(*) AS n_items FROM c GROUP BY n) SELECT n, n_items, round(sum(n * n_items) OVER (ORDER BY n DESC)::DOUBLE / (SELECT count(*) FROM events), 9) AS share FROM s")
def a19_cumulative_share(spark, d):
    return ag.cumulative_share(events(spark, d), "user_id").select("n", "n_items", F.round("share", 9).alias("share"))


@query(f"SELECT DISTINCT w FROM ({WORDS})")
def a20_distinct_words(spark, d):
    return ag.distinct_values(words(spark, d), "w")


@query(f"SELECT protein_id, count(DISTINCT sequence) AS n_hits, min(sequence) AS first_hit FROM ({PEPTIDES}) GROUP BY protein_id")
def a21_hits_by_protein(spark, d):
    return peptides(spark, d).groupBy("protein_id").agg(F.count_distinct("sequence").alias("n_hits"), F.min("sequence").alias("first_hit"))


@query(TOPK.format(k=5).replace("WHERE value > 1e-8::DOUBLE ", ""))
def a22_merged_hits(spark, d):
    e = events(spark, d)
    return ag.merged_hits(e.unionByName(e), "user_id", "event_type", "value")


@query(f"SELECT floor({MASS})::BIGINT AS mass_bin, count(*) AS n FROM (SELECT DISTINCT sequence FROM ({PEPTIDES})) GROUP BY 1")
def a23_rows_per_mass_bin(spark, d):
    peptides(spark, d).select("sequence").distinct().select(F.floor(sequence_mass(F.col("sequence"))).alias("mass_bin")).createOrReplaceTempView("peptide_bins")
    return spark.sql("SELECT mass_bin, count(*) AS n FROM peptide_bins GROUP BY mass_bin")


@query("SELECT 16::BIGINT AS n_parts, count(*)::BIGINT AS n_rows, count(DISTINCT o_custkey)::BIGINT AS n_keys, true AS even FROM orders")
def a24_hash_spread(spark, d):
    """The spread over 16 parts summed up: no row or key is lost or in two parts, and no part has twice its share of keys."""
    parts = ag.hash_spread(table(spark, d, "orders"), "o_custkey", 16)
    return parts.agg(F.count("*").alias("n_parts"), F.sum("n_rows").alias("n_rows"), F.sum("n_keys").alias("n_keys"), (F.max("n_keys") < 2 * F.avg("n_keys")).alias("even"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (event_type = 'click') AS n_click, sum(value > 50)::BIGINT AS n_kept FROM events")
def a25_observed_counters(spark, d):
    """Counters that come from the observation of a query while it writes its high values, with the rows it wrote."""
    from spectraloom.functions.staging import staged

    watched, seen = ag.observed(events(spark, d), "run", n_high=F.col("value") > 50, n_click=F.col("event_type") == "click")
    kept = staged(watched.where("value > 50"), "kept-events")
    counts = seen.get
    return kept.agg(F.count("*").alias("n_kept")).select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("n_rows", "n_high", "n_click")], "n_kept")


@query("SELECT count(*) AS n_rows, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (event_type = 'click') AS n_click FROM events")
def a25_run_counters(spark, d):
    return ag.run_counters(events(spark, d), n_high=F.col("value") > 50, n_click=F.col("event_type") == "click")


@query(f"SELECT source, count(*) FILTER (NOT decoy) AS n_target, count(*) FILTER (decoy) AS n_decoy, CASE WHEN bool_or(decoy) AND bool_or(NOT decoy) THEN 'Real_and_Decoy' WHEN bool_or(decoy) THEN 'Decoy' ELSE 'Real' END AS validity FROM ({HITS}) GROUP BY source")
def a26_validity(spark, d):
    return ag.validity(hits(spark, d), "source", "decoy")


@query("SELECT count(*) AS n FROM orders WHERE o_totalprice >= 1000 AND o_totalprice <= 50000")
def a28_sql_range_count(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("range_orders")
    return spark.sql("SELECT count(*) AS n FROM range_orders WHERE o_totalprice >= 1000 AND o_totalprice <= 50000")


SIZES = "SELECT floor(p_retailprice)::BIGINT AS mass_int, count(*) AS entries, count(*) FILTER (p_size > 25) AS modified, count(*) FILTER (NOT p_size > 25) AS unmodified FROM part GROUP BY 1"


@query(SIZES)
def a29_database_sizes(spark, d):
    return ag.database_sizes(table(spark, d, "part").withColumn("m", F.col("p_size") > 25), "p_retailprice", "m")


@query(f"SELECT sum(entries)::BIGINT AS total, max(entries) AS most, sum(modified)::BIGINT AS modified FROM ({SIZES})")
def a29_size_totals(spark, d):
    return a29_database_sizes(spark, d).agg(F.sum("entries").alias("total"), F.max("entries").alias("most"), F.sum("modified").alias("modified"))


RANKS = "SELECT event_id, user_id, value, row_number() OVER w AS r, lead(value) OVER w AS nxt, first_value(value) OVER w AS top FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id)"


@query(f"SELECT event_id, user_id, value, r::INTEGER AS rank, round(CASE WHEN nxt IS NULL OR value = 0 THEN 0.0::DOUBLE ELSE 1 - nxt / value END, 8) AS delta_cn, round(CASE WHEN nxt IS NULL OR top = 0 THEN 0.0::DOUBLE ELSE 1 - value / top END, 8) AS delta_cn_star FROM ({RANKS})")
def w1_hit_ranks(spark, d):
    r = wn.hit_ranks(events(spark, d).select("event_id", "user_id", "value"), "user_id", "value", "event_id")
    return r.select("event_id", "user_id", "value", "rank", F.round("delta_cn", 8).alias("delta_cn"), F.round("delta_cn_star", 8).alias("delta_cn_star"))


@query(f"WITH s AS (SELECT vec_id, pos, sqrt(value) * 100 / max(sqrt(value)) OVER (PARTITION BY vec_id) AS v, floor(pos / (max(pos) OVER (PARTITION BY vec_id) // 10 + 1)::DOUBLE) AS w FROM ({PEAKS}) WHERE value > 0) SELECT vec_id, pos, round(n, 5) AS normalised FROM (SELECT vec_id, pos, v, v * 50 / max(v) OVER (PARTITION BY vec_id, w) AS n FROM s) WHERE v > 5")
def w2_window_normalised(spark, d):
    return wn.window_normalised(peaks(spark, d), "vec_id", "pos", "value").select("vec_id", "pos", F.round("normalised", 5).alias("normalised"))


@query(f"SELECT vec_id, pos, round(value - (sum(value) OVER (PARTITION BY vec_id ORDER BY pos RANGE BETWEEN 75 PRECEDING AND 75 FOLLOWING) - value) / 150, 5) AS corrected FROM ({PEAKS})")
def w3_background(spark, d):
    return wn.background(peaks(spark, d), "vec_id", "pos", "value").select("vec_id", "pos", F.round("corrected", 5).alias("corrected"))


@query(f"WITH p AS ({PEAKS}) SELECT p.vec_id, p.pos, round(p.value + 0.2::DOUBLE * (coalesce(a.value, 0) + coalesce(b.value, 0)), 5) AS with_loss FROM p LEFT JOIN p a ON a.vec_id = p.vec_id AND a.pos = p.pos - 18 LEFT JOIN p b ON b.vec_id = p.vec_id AND b.pos = p.pos - 17")
def w4_neutral_loss(spark, d):
    return wn.neutral_loss(peaks(spark, d), "vec_id", "pos", "value", 18, 17).select("vec_id", "pos", F.round("with_loss", 5).alias("with_loss"))


@query(f"SELECT vec_id, pos, round(value - sum(value) OVER (PARTITION BY vec_id ORDER BY pos RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING) / 101, 5) AS corrected FROM ({PEAKS})")
def w5_window_mean(spark, d):
    return wn.window_mean(peaks(spark, d), "vec_id", "pos", "value").select("vec_id", "pos", F.round("corrected", 5).alias("corrected"))


@query(f"SELECT vec_id, pos, round(greatest(value - sum(value) OVER (PARTITION BY vec_id ORDER BY pos RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) / 11, 0), 5) AS corrected FROM ({PEAKS})")
def w6_sliding_window(spark, d):
    return wn.window_mean(peaks(spark, d), "vec_id", "pos", "value", 5, True).select("vec_id", "pos", F.round("corrected", 5).alias("corrected"))


@query("SELECT event_type, bin, n, (sum(n) OVER (PARTITION BY event_type ORDER BY bin DESC))::BIGINT AS at_least FROM (SELECT event_type, floor(value)::BIGINT AS bin, count(*) AS n FROM events GROUP BY 1, 2)")
def w7_survival(spark, d):
    return wn.survival(events(spark, d).withColumn("bin", F.floor("value")), "event_type", "bin")


@query("SELECT lower(role) AS word, count(*) AS n FROM conversations GROUP BY 1")
def w8_run_lengths(spark, d):
    """Equal words of a sorted table counted as one, wherever partitions end."""
    return ag.counts_by(table(spark, d, "conversations").select(F.lower("role").alias("word")), "word")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def o1_global_sort(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query(f"SELECT vec_id, pos, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY value DESC, pos) AS r FROM ({PEAKS})) WHERE r <= 50")
def o2_top_peaks(spark, d):
    return wn.top_peaks(peaks(spark, d), "vec_id", "pos", "value", 50).select("vec_id", "pos", F.round("value", 6).alias("value"))


@query("SELECT substr(md5(l_orderkey || '-' || l_linenumber), 1, 3) AS key, count(*) AS n FROM lineitem GROUP BY 1")
def o3_key_counts(spark, d):
    """A random key for each row: digits of a digest, so that any engine draws the same."""
    keys = table(spark, d, "lineitem").select(F.substring(F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).cast("binary")), 1, 3).alias("key"))
    return ag.counts_by(keys, "key")


CENTRES = f"WITH p AS (SELECT vec_id, pos, value - 10 AS v FROM ({PEAKS})), s AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY vec_id ORDER BY pos) = 1 THEN 0 ELSE 1 END AS b FROM p WHERE v > 0), r AS (SELECT *, sum(b) OVER (PARTITION BY vec_id ORDER BY pos) AS run FROM s) SELECT vec_id, round(sum(pos * v) / sum(v), 5) AS centre, round(sum(v), 5) AS total, count(*) AS width FROM r GROUP BY vec_id, run"


@query(CENTRES)
def d14_centroids(spark, d):
    p = peaks(spark, d).withColumn("value", F.col("value") - 10)
    return wn.centroids(p, "vec_id", "pos", "value").select("vec_id", F.round("centre", 5).alias("centre"), F.round("total", 5).alias("total"), "width")


@query(f"SELECT vec_id, centre, total, width FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY total DESC, centre) AS k FROM ({CENTRES}) WHERE centre >= 20) WHERE k <= 5")
def d14_best_centroids(spark, d):
    """The five largest centroids from position 20 on."""
    p = peaks(spark, d).withColumn("value", F.col("value") - 10)
    return wn.centroids(p, "vec_id", "pos", "value", 20, 5).select("vec_id", F.round("centre", 5).alias("centre"), F.round("total", 5).alias("total"), "width")


@query("SELECT l_suppkey, weight, (greatest(floor(coalesce(sum(weight) OVER w, 0) / 2000)::BIGINT, floor((row_number() OVER (PARTITION BY lane ORDER BY weight DESC, l_suppkey) - 1) / 20)::BIGINT) * 8 + lane)::BIGINT AS part FROM (SELECT l_suppkey, count(*) AS weight, l_suppkey % 8 AS lane FROM lineitem GROUP BY l_suppkey) WINDOW w AS (PARTITION BY lane ORDER BY weight DESC, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def p1_packed_bins(spark, d):
    bins_ = ag.counts_by(table(spark, d, "lineitem"), "l_suppkey", out="weight")
    return pt.packed_bins(bins_, "l_suppkey", "weight", 2000, 20, 8, F.col("l_suppkey")).select("l_suppkey", "weight", "part")


PLACED = "SELECT part, count(*) AS n, count(*) AS n_placed, 1::BIGINT AS n_partitions FROM ({}) GROUP BY part"


@query(PLACED.format("SELECT (o_custkey % 8)::INTEGER AS part FROM orders"))
def p2_placed_rows(spark, d):
    """Orders dealt by key modulo 8, each part in the partition of its number."""
    return pt.placement(pt.placed(pt.by_modulo(table(spark, d, "orders").select("o_custkey", "o_orderkey"), F.col("o_custkey"), 8), "part", 8), "part")


@query(f"WITH p AS (SELECT l_suppkey, weight, (greatest(floor(coalesce(sum(weight) OVER w, 0) / 2000)::BIGINT, floor((row_number() OVER (PARTITION BY lane ORDER BY weight DESC, l_suppkey) - 1) / 20)::BIGINT) * 8 + lane)::BIGINT AS part FROM (SELECT l_suppkey, count(*) AS weight, l_suppkey % 8 AS lane FROM lineitem GROUP BY l_suppkey) WINDOW w AS (PARTITION BY lane ORDER BY weight DESC, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) {PLACED.format('SELECT part FROM lineitem JOIN p USING (l_suppkey)')}")
def p1_packed_rows(spark, d):
    """Line items in the partitions that the packing of their suppliers plans, as many as the plan has."""
    items = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey")
    plan = pt.packed_bins(ag.counts_by(items, "l_suppkey", out="weight"), "l_suppkey", "weight", 2000, 20, 8, F.col("l_suppkey"))
    n = plan.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0] + 1
    return pt.placement(pt.placed(items.join(plan.select("l_suppkey", "part"), "l_suppkey"), "part", n), "part")


@query("SELECT part, count(*) AS n FROM (SELECT (o_custkey % 8)::INTEGER AS part FROM orders) GROUP BY part")
def p2_modulo_parts(spark, d):
    return ag.counts_by(pt.by_modulo(table(spark, d, "orders"), F.col("o_custkey"), 8), "part")


@query(f"SELECT (ascii(substr(w, 1, 1)) - 65)::INTEGER AS part, count(*) AS n FROM ({WORDS}) GROUP BY 1")
def p2_first_letter(spark, d):
    return words(spark, d).select(pt.first_letter_part(F.col("w")).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT c_nationkey AS part, count(*) AS n FROM customer GROUP BY 1")
def p3_sized(spark, d):
    c = table(spark, d, "customer")
    return ag.counts_by(pt.sized(c.repartition(20), c.count(), 10_000).select(F.col("c_nationkey").alias("part")), "part")


@query("SELECT role AS key, count(*) AS n, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY role")
def p5_map_reduce(spark, d):
    """Mapper: a row to its role and length, added up per batch; reducer: sums."""

    def mapper(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": b["role"], "n": 1, "chars": b["text"].str.len()}).groupby("key", as_index=False).sum()

    def reducer(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "n": [b["n"].sum()], "chars": [b["chars"].sum()]})

    schema = "key string, n long, chars long"
    return pt.map_reduce(table(spark, d, "conversations").select("role", "text"), mapper, schema, reducer, schema, "key")


@query("SELECT o_custkey % 13 AS key, count(*) AS n, round(sum(o_totalprice), 2) AS total, 13 AS parts FROM orders GROUP BY 1")
def p5_partitioned_job(spark, d):
    """A job whose keys go to the partitions that their own function names; a consumer counts the keys of the result."""
    seen: list[int] = []

    def mapper(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": b["o_custkey"] % 13, "n": 1, "total": b["o_totalprice"].astype(float)}).groupby("key", as_index=False).sum()

    def reducer(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "n": [b["n"].sum()], "total": [b["total"].sum()]})

    schema = "key long, n long, total double"
    out = pt.map_reduce(table(spark, d, "orders").select("o_custkey", "o_totalprice"), mapper, schema, reducer, schema, "key", parts=4, partition=F.col("key"), consumers=[lambda df: seen.append(df.count())])
    return out.select("key", "n", F.round("total", 2).alias("total"), F.lit(seen[0]).alias("parts"))


@query("SELECT o_orderkey // 128 AS key, count(*) * count(*) AS n FROM orders GROUP BY 1")
def p6_join_stress(spark, d):
    """Orders in groups by key range, each joined with itself: the square of a group's rows."""
    side = table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 128).cast("long").alias("key"), "o_orderkey")
    return pt.pair_counts(side, "key", "o_orderkey")
