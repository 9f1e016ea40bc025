"""Queries of the filters, samplers and projections, and of text and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions import text as tx
from spectraloom.functions.bins import LinearBins, LogBins
from spectraloom.functions.masses import formula_mass_of, matching_mass, precursor_mass, sequence_mass
from spectraloom.operators import digest as dg
from spectraloom.operators import filters as fl

from .derived import HITS, MASS, PARTS, PEPTIDES, PROTEINS, WORDS, hits, peptides, proteins, words
from .registry import query, table

INDEXED = "SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS idx FROM orders"


def indexed(spark: SparkSession, d: str) -> DataFrame:
    return fl.with_index(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS idx FROM documents")
def f1_running_index(spark, d):
    return fl.with_index(table(spark, d, "documents").select("doc_id"), ["doc_id"])


@query("SELECT event_id, value, (row_number() OVER (ORDER BY value, event_id) - 1)::BIGINT AS idx FROM events")
def f2_index_by_order(spark, d):
    return fl.with_index(table(spark, d, "events").select("event_id", "value"), ["value", "event_id"])


@query("SELECT event_id, props FROM events WHERE length(props) > 0")
def f3_real_id(spark, d):
    return fl.with_real_id(table(spark, d, "events").select("event_id", "props"), "props")


@query(f"SELECT * FROM ({INDEXED}) WHERE idx % 100 >= 20 AND idx % 100 < 45")
def f4_percentile_slice(spark, d):
    return fl.percentile_slice(indexed(spark, d), "idx", 20, 45)


@query(f"SELECT * FROM ({INDEXED}) WHERE (idx + 3) % 7 = 0")
def f5_one_in_k(spark, d):
    return fl.one_in(indexed(spark, d), "idx", 7, 3)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def f6_first_n(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("down"))
    return fl.first_n(o, 100, ["down", "o_orderkey"]).drop("down")


@query("SELECT count(*) AS n_rows, true AS near_share, true AS repeatable, 0::BIGINT AS n_foreign FROM orders")
def f7_fraction(spark, d):
    """A quarter of the orders by hashed key: how near to a quarter (six standard deviations), the same when drawn again, and no other rows."""
    o = table(spark, d, "orders").select("o_orderkey")
    drawn, again = (fl.hashed_fraction(o, "o_orderkey", 0.25).withColumn(c, F.lit(1)) for c in ("a", "b"))
    both = o.withColumn("own", F.lit(1)).join(drawn, "o_orderkey", "full_outer").join(again, "o_orderkey", "full_outer")
    near = F.abs(F.count("a") - 0.25 * F.count("own")) <= 6 * F.sqrt(0.25 * 0.75 * F.count("own"))
    return both.agg(F.count("own").alias("n_rows"), near.alias("near_share"), (F.count_if(~F.col("a").eqNullSafe(F.col("b"))) == 0).alias("repeatable"), F.count_if(F.col("own").isNull()).alias("n_foreign"))


@query(f"SELECT * FROM ({INDEXED}) WHERE idx % 100 < (SELECT greatest(1, 100 * 1000 // count(*)) FROM orders)")
def f8_limit_by_share(spark, d):
    return fl.limit_by_share(indexed(spark, d), "idx", 1000)


@query(f"SELECT protein_id, p AS sequence FROM (SELECT protein_id, unnest({PARTS}) AS p FROM ({PROTEINS})) WHERE regexp_matches(p, '^[ACDEFGHIKLMNPQRSTVWY]+$') AND length(p) BETWEEN 4 AND 40")
def f9_valid_peptide(spark, d):
    all_ = dg.digest(proteins(spark, d), least=1, most=1_000_000)
    return all_.where(fl.valid_peptide(F.col("sequence"))).select("protein_id", "sequence")


@query("SELECT vec_id, n::BIGINT AS n_peaks, label FROM (SELECT vec_id, label, len(list_filter(embedding, lambda x: x > 0)) AS n FROM embeddings) WHERE n >= 5 AND label <= 4 AND n BETWEEN 0 AND 5000")
def f10_scorable(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n_peaks"), "label")
    return e.where(fl.scorable(F.col("n_peaks"), F.col("label"), F.col("n_peaks"))).select("vec_id", "n_peaks", "label")


@query("SELECT c_custkey, floor(c_acctbal)::BIGINT AS bin FROM customer WHERE floor(c_acctbal) IN (SELECT floor(s_acctbal) FROM supplier)")
def f11_used_bins(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.floor("c_acctbal").alias("bin"))
    return fl.in_used_bins(c, table(spark, d, "supplier").select(F.floor("s_acctbal").alias("bin")), "bin").select("c_custkey", "bin")


@query("SELECT event_id, (value > 20 AND value <= 80) AS in_range, (value < 10 OR event_type = 'click') AS either FROM events WHERE (value > 20 AND value <= 80) OR value < 10 OR event_type = 'click'")
def f12_combined(spark, d):
    v, kind = F.col("value"), F.col("event_type")
    both, either = fl.all_of(v > 20, v <= 80), fl.any_of(v < 10, kind == "click")
    return table(spark, d, "events").where(fl.any_of(both, either)).select("event_id", both.alias("in_range"), either.alias("either"))


@query(f"SELECT source, lang, bool_and(decoy) AS is_decoy FROM ({HITS}) GROUP BY source, lang HAVING bool_and(decoy) = bool_or(decoy)")
def f13_unmixed(spark, d):
    return fl.unmixed(hits(spark, d), ["source", "lang"], "decoy")


@query(f"SELECT sequence, min(protein_id) AS protein_id FROM ({PEPTIDES}) GROUP BY sequence HAVING count(DISTINCT protein_id) = 1")
def f14_unique_peptides(spark, d):
    n = peptides(spark, d).groupBy("sequence").agg(F.min("protein_id").alias("protein_id"), F.max("protein_id").alias("last"))
    return n.where("protein_id = last").drop("last")


@query(f"SELECT protein_id FROM ({PROTEINS}) WHERE protein_id IN (SELECT protein_id FROM ({PEPTIDES}))")
def f15_with_matches(spark, d):
    return fl.in_list(proteins(spark, d).select("protein_id"), peptides(spark, d), "protein_id")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def f16_id_list(spark, d):
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return fl.in_list(table(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id HAVING max(value) >= 90)")
def f17_whole_groups(spark, d):
    return fl.whole_groups(table(spark, d, "events").select("event_id", "user_id", "value"), ["user_id"], "value", 90).select("event_id", "user_id")


@query("SELECT event_id, value FROM events WHERE value < 0.5")
def f18_small_expectation(spark, d):
    return table(spark, d, "events").where(F.col("value") < 0.5).select("event_id", "value")


@query("SELECT count(*) AS n_rows, true AS near_share, true AS some_twice, 0::BIGINT AS n_foreign FROM orders")
def f19_sample_with_replacement(spark, d):
    """Half as many draws as there are orders, with replacement: their number (six standard deviations), that some order comes twice, and no other rows."""
    o = table(spark, d, "orders").select("o_orderkey")
    drawn = fl.random_fraction(o, 0.5, replace=True).groupBy("o_orderkey").agg(F.count("*").alias("n"))
    both = o.withColumn("own", F.lit(1)).join(drawn, "o_orderkey", "full_outer")
    near = F.abs(F.sum("n") - 0.5 * F.count("own")) <= 6 * F.sqrt(0.5 * F.count("own"))
    return both.agg(F.count("own").alias("n_rows"), near.alias("near_share"), (F.max("n") > 1).alias("some_twice"), F.count_if(F.col("own").isNull()).alias("n_foreign"))


@query("SELECT o_custkey AS o_orderkey, o_orderkey AS o_custkey FROM orders")
def f20_swapped(spark, d):
    return fl.swapped(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey")


@query("SELECT event_id, value FROM events WHERE value > 50")
def f21_least_score(spark, d):
    return table(spark, d, "events").where(F.col("value") > 50).select("event_id", "value")


@query(f"SELECT doc_id, w, count(*) AS n FROM ({WORDS}) GROUP BY doc_id, w")
def x1_clean_words(spark, d):
    return words(spark, d).groupBy("doc_id", "w").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, round((greatest(length(c_name), length(n_name)) - levenshtein(lower(c_name), lower(n_name)))::DOUBLE / greatest(length(c_name), length(n_name)), 6) AS similarity FROM customer JOIN nation ON c_nationkey = n_nationkey")
def x2_similarity(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.round(tx.similarity(F.col("c_name"), F.col("n_name")), 6).alias("similarity"))


VARIED = "SELECT s, count(*) AS n FROM (SELECT unnest(CASE WHEN length(t) >= 3 THEN list_transform(range(1, length(t) - 1), lambda i: substr(t, i::INT, 3)) ELSE [] END) AS s FROM (SELECT upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')) AS t FROM part)) GROUP BY s"


@query(f"SELECT (CASE WHEN a = 1 THEN upper(substr(s, 1, 1)) ELSE lower(substr(s, 1, 1)) END || CASE WHEN b = 1 THEN upper(substr(s, 2, 1)) ELSE lower(substr(s, 2, 1)) END || CASE WHEN c = 1 THEN upper(substr(s, 3, 1)) ELSE lower(substr(s, 3, 1)) END) AS form, n FROM ({VARIED}), (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b), (SELECT unnest([0, 1]) AS c)")
def x3_case_variations(spark, d):
    s = table(spark, d, "part").select(F.explode(tx.fixed_substrings(F.col("p_name"), 3)).alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    return s.select(F.explode(tx.case_variations(F.col("s"), 3)).alias("form"), "n")


@query("SELECT page_id, nullif(regexp_extract(html, '\\bhref=\"([^\"]*)\"', 1), '') AS href, nullif(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '') AS title, length(regexp_replace(html, '\\bhref=\"[^\"]*\"', 'href=\"x\"', 'g'))::BIGINT AS replaced FROM pages")
def x4_attributes(spark, d):
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", tx.attribute(h, "href").alias("href"), tx.tag_text(h, "title").alias("title"), F.length(tx.with_attribute(h, "href", "x")).cast("long").alias("replaced"))


@query("SELECT event_id, round(value, 4) AS seconds FROM events")
def x5_retention_time(spark, d):
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("PT"), F.col("value").cast("string"), F.lit("S")).alias("t"))
    return e.select("event_id", F.round(tx.retention_seconds(F.col("t")), 4).alias("seconds"))


@query("SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 12, '0') AS padded FROM orders")
def x6_padded_id(spark, d):
    return table(spark, d, "orders").select("o_orderkey", tx.padded_id(F.col("o_orderkey").cast("string")).alias("padded"))


@query(f"SELECT protein_id, sequence, 0 AS missed_cleavages FROM ({PEPTIDES})")
def d1_digest(spark, d):
    return peptides(spark, d)


MISSED = f"SELECT protein_id, array_to_string(parts[i:i + m], '') AS sequence, m::INTEGER AS missed_cleavages FROM (SELECT protein_id, parts, unnest(range(1, len(parts) + 1))::INT AS i FROM (SELECT protein_id, list_filter({PARTS}, lambda x: x <> '') AS parts FROM ({PROTEINS}))), (SELECT unnest([0, 1, 2])::INT AS m) WHERE i + m <= len(parts)"


@query(f"SELECT * FROM ({MISSED}) WHERE length(sequence) BETWEEN 4 AND 40")
def d1_missed_cleavages(spark, d):
    return peptides(spark, d, 2)


@query(f"WITH p AS (SELECT DISTINCT sequence FROM ({PEPTIDES})) SELECT DISTINCT sequence, unnest(list_distinct(list_concat([sequence], list_concat(list_transform(range(4, length(sequence)), lambda n: substr(sequence, 1, n::INT)), list_transform(range(4, length(sequence)), lambda n: substr(sequence, (length(sequence) - n + 1)::INT, n::INT)))))) AS semi FROM p")
def d2_semi_peptides(spark, d):
    return dg.semi_peptides(peptides(spark, d).select("sequence").distinct())


@query(f"SELECT protein_id, sequence, len(list_filter(range(1, length(sequence)), lambda i: substr(sequence, i::INT, 1) IN ('K', 'R') AND substr(sequence, i::INT + 1, 1) <> 'P'))::BIGINT AS missed, NOT regexp_matches(sequence, '[KR]$') AS semi FROM (SELECT protein_id, sequence FROM ({MISSED}) WHERE length(sequence) BETWEEN 4 AND 40)")
def d3_count_missed(spark, d):
    s = F.col("sequence")
    return peptides(spark, d, 2).select("protein_id", "sequence", dg.missed_cleavages(s).cast("long").alias("missed"), dg.probably_semi(s).alias("semi"))


@query(f"WITH p AS (SELECT sequence, m, (1 + m + m * (m - 1) // 2 + m * (m - 1) * (m - 2) // 6)::BIGINT AS n_forms, length(sequence) - length(replace(sequence, 'C', '')) AS c FROM (SELECT DISTINCT sequence, length(sequence) - length(replace(sequence, 'M', '')) AS m FROM ({PEPTIDES}))) SELECT sequence, n_forms, least(m, 3)::INTEGER AS most_mods, (15995 * (m + m * (m - 1) + m * (m - 1) * (m - 2) // 2) + 57021 * c * n_forms)::BIGINT AS sum_delta, (n_forms * (length(sequence) + 8 * c) + 8 * (m + m * (m - 1) + m * (m - 1) * (m - 2) // 2))::BIGINT AS n_letters FROM p")
def d4_modifications(spark, d):
    """Variants of every peptide: C always changed, up to three oxidised M; counted and summed up by peptide."""
    forms = dg.modify(peptides(spark, d).select("sequence").distinct(), ["15.995@M"], 3, fixed=["57.021@C"])
    return forms.groupBy("sequence").agg(F.count("*").alias("n_forms"), F.max("n_mods").alias("most_mods"), F.round(F.sum("mod_delta") * 1000).cast("long").alias("sum_delta"), F.sum(F.length("modified")).cast("long").alias("n_letters"))


@query(f"SELECT protein_id::VARCHAR AS protein_id, sequence, false AS is_decoy FROM ({PROTEINS}) UNION ALL SELECT 'DECOY_' || protein_id::VARCHAR, reverse(sequence), true FROM ({PROTEINS})")
def d5_decoys(spark, d):
    return dg.decoys(proteins(spark, d))


@query(f"SELECT sequence, round({MASS}, 4) AS mass, round({MASS} + 19.0178, 4) AS matching_mass FROM (SELECT DISTINCT sequence FROM ({PEPTIDES}))")
def d6_masses(spark, d):
    m = sequence_mass(F.col("sequence"))
    return peptides(spark, d).select("sequence").distinct().select("sequence", F.round(m, 4).alias("mass"), F.round(matching_mass(m), 4).alias("matching_mass"))


@query("SELECT l_orderkey, l_linenumber, round(12.0::DOUBLE * l_quantity::INT + 1.007825035::DOUBLE * l_linenumber + 15.99491463::DOUBLE + 31.9720707::DOUBLE, 5) AS mass FROM lineitem")
def d7_formula_mass(spark, d):
    f = F.concat(F.lit("C"), F.col("l_quantity").cast("int").cast("string"), F.lit("H"), F.col("l_linenumber").cast("string"), F.lit("OS"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(formula_mass_of(f), 5).alias("mass"))


@query("SELECT o_orderkey, round((o_totalprice - 1.00727646688) * greatest(1, o_orderkey % 4) + 1.00727646688, 4) AS precursor_mass FROM orders")
def d7_precursor_mass(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.round(precursor_mass(F.col("o_totalprice"), F.col("o_orderkey") % 4), 4).alias("precursor_mass"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 0 WHEN o_totalprice >= 400000 THEN 49 ELSE floor((o_totalprice - 1000) / 7980)::INT END AS linear_bin,
 CASE WHEN o_totalprice <= 900 THEN 0 WHEN o_totalprice >= 500000 THEN 99 ELSE floor(log10(o_totalprice / 900) / (log10(500000 / 900.0) / 100))::INT END AS log_bin,
 CASE WHEN o_totalprice < 1000 THEN 2 WHEN o_totalprice >= 400000 THEN 2 ELSE 1 + (floor((o_totalprice - 1000) / 7980) > 0)::INT + (floor((o_totalprice - 1000) / 7980) < 49)::INT END AS n_near FROM orders""")
def d15_bins(spark, d):
    lin, log, p = LinearBins(1000, 400000, 50), LogBins(900, 500000, 100), F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", lin.bin(p).alias("linear_bin"), log.bin(p).alias("log_bin"), F.size(lin.neighbours(p)).alias("n_near"))


@query(f"SELECT translate(sequence, 'I', 'L') AS key, count(DISTINCT sequence) AS n FROM ({PEPTIDES}) GROUP BY 1")
def d17_same_spectrum(spark, d):
    return peptides(spark, d).groupBy(dg.same_spectrum_key(F.col("sequence")).alias("key")).agg(F.count_distinct("sequence").alias("n"))


