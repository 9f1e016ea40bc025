"""Queries of the joins."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectraloom.functions.masses import sequence_mass
from spectraloom.functions.staging import looked_up, share_map, shared_path
from spectraloom.functions.text import similarity
from spectraloom.operators import filters as fl
from spectraloom.operators import joins as jn
from spectraloom.operators.digest import digest
from spectraloom.sinks.reports import read_peptide_bin, write_peptide_table

from .derived import MASS, NOT_LETTERS, PEPTIDES, PROTEINS, peptides, proteins
from .registry import query, table

PPM = 10.0


def orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice")


def items(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(f"SELECT l_orderkey, l_linenumber, o_orderkey FROM lineitem JOIN orders ON abs(l_extendedprice - o_totalprice) < o_totalprice * {PPM} / 1000000.0::DOUBLE")
def j1_ppm_join(spark, d):
    return jn.ppm_join(items(spark, d), orders(spark, d), "l_extendedprice", "o_totalprice", PPM).select("l_orderkey", "l_linenumber", "o_orderkey")


BINNED = "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON floor(s_acctbal / 10) = floor(c_acctbal / 10)"


@query(BINNED)
def j2_bin_join(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.floor(F.col("s_acctbal") / 10).alias("bin"))
    c = table(spark, d, "customer").select("c_custkey", F.floor(F.col("c_acctbal") / 10).alias("bin"))
    return s.join(c, "bin").select("s_suppkey", "c_custkey")


@query("SELECT n_nationkey::BIGINT AS n_nationkey, count(*) AS n_pairs, round(max(c_acctbal * s_acctbal), 2) AS best FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def j3_cogroup(spark, d):
    """Each side comes down to one row a nation and salt before the two meet, so no call sees a nation's whole rows."""

    def side(name: str, nation: str, value: str, key: str) -> DataFrame:
        rows = table(spark, d, name).select(F.col(nation).cast("long").alias("n_nationkey"), F.pmod(key, F.lit(16)).alias("salt"), value)
        return rows.groupBy("n_nationkey", "salt").agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).drop("salt")

    def score(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"n_nationkey": [], "n_pairs": [], "best": []})
        best = max(x * y for x in (a["low"].min(), a["high"].max()) for y in (b["low"].min(), b["high"].max()))
        return pd.DataFrame({"n_nationkey": [key[0]], "n_pairs": [a["n"].sum() * b["n"].sum()], "best": [best]})

    c, s = side("customer", "c_nationkey", "c_acctbal", "c_custkey"), side("supplier", "s_nationkey", "s_acctbal", "s_suppkey")
    return jn.cogrouped(c, s, ["n_nationkey"], score, "n_nationkey long, n_pairs long, best double").select("n_nationkey", "n_pairs", F.round("best", 2).alias("best"))


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey")
def j4_salted_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    return jn.salted_join(c, s, "nation", F.xxhash64("c_custkey")).select("c_custkey", "s_suppkey")


@query("SELECT s_suppkey, array_to_string(list_sort(list(DISTINCT c_mktsegment))[1:3], ',') AS segments FROM supplier JOIN customer ON c_nationkey = s_nationkey GROUP BY s_suppkey")
def j5_listed_join(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), "c_mktsegment")
    return jn.listed_join(s, c, "nation", "c_mktsegment", 3).select("s_suppkey", F.array_join("values", ",").alias("segments"))


@query("SELECT p_partkey, charge, floor(0.5::DOUBLE + p_retailprice / charge / 0.01::DOUBLE)::BIGINT AS mz_bin FROM part, (SELECT unnest([1, 2, 3, 4])::INTEGER AS charge)")
def j6_charged_keys(spark, d):
    return jn.charged_keys(table(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice").select("p_partkey", "charge", "mz_bin")


@query("SELECT s_suppkey, c_custkey, z FROM supplier, (SELECT unnest([1, 2, 3])::INTEGER AS z), customer WHERE (c_acctbal - s_acctbal) / z >= -2.1::DOUBLE AND (c_acctbal - s_acctbal) / z <= 4.1::DOUBLE")
def j7_window_join(spark, d):
    c, s = table(spark, d, "customer").select("c_custkey", "c_acctbal"), table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return jn.window_join(c, s, "c_acctbal", "s_acctbal", 2.1, 4.1).select("s_suppkey", "c_custkey", "z")


@query("SELECT s_suppkey, c_custkey, floor(c_acctbal)::BIGINT AS mass_int FROM supplier JOIN customer ON floor(c_acctbal) BETWEEN floor(s_acctbal - 2) AND floor(s_acctbal + 4)")
def j8_integer_mass_join(spark, d):
    c, s = table(spark, d, "customer").select("c_custkey", "c_acctbal"), table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return jn.integer_mass_join(c, s, "c_acctbal", "s_acctbal", 2, 4).select("s_suppkey", "c_custkey", "mass_int")


@query("SELECT s_suppkey, p_partkey, floor(p_retailprice / 10)::BIGINT AS mass_section FROM supplier JOIN part ON floor(p_retailprice / 10) BETWEEN floor((s_acctbal - 2) / 10) AND floor((s_acctbal + 4) / 10) WHERE s_acctbal BETWEEN 900 AND 1100")
def j8_pruned_sections(spark, d):
    """Suppliers of some balances as precursors against parts stored in one folder for every ten of price: only folders they ask for are read."""
    path = shared_path(spark, "mass-sections")
    jn.write_mass_sections(table(spark, d, "part").select("p_partkey", "p_retailprice"), path, "p_retailprice", 10.0)
    stored = spark.read.schema("p_partkey long, p_retailprice double, mass_section long").parquet(path)
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal").where("s_acctbal between 900 and 1100")
    return jn.pruned_mass_join(stored, s, "s_acctbal", 2, 4, 10.0).select("s_suppkey", "p_partkey", "mass_section")


SECTIONS = "SELECT l_orderkey, l_linenumber, l_suppkey, floor((row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1) / 100)::INTEGER AS section FROM lineitem"


ITEMS = "SELECT mass_int, s AS \"start\", least(s + 10, n) AS \"end\" FROM (SELECT mass_int, n, unnest(range(0, n, 10)) AS s FROM (SELECT floor(p_retailprice)::BIGINT AS mass_int, count(*) AS n FROM part GROUP BY 1))"


@query(f"SELECT c_custkey, z, i.mass_int || ':' || i.start || ':' || i.end AS item FROM (SELECT c_custkey, z, unnest(range(floor(c_acctbal * z - 2)::BIGINT, floor(c_acctbal * z + 1)::BIGINT + 1)) AS mass_int FROM customer, (SELECT unnest([1, 2, 3])::INTEGER AS z) WHERE c_nationkey NOT BETWEEN 1 AND 3 OR z = c_nationkey) JOIN ({ITEMS}) i USING (mass_int)")
def j8b_hot_sections(spark, d):
    """Customers as scans (nations 1 to 3 know their charge) against the work items of the parts' whole prices."""
    items = jn.work_items(table(spark, d, "part"), "p_retailprice", 10)
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.when(F.col("c_nationkey").between(1, 3), F.col("c_nationkey")).alias("charge"))
    return jn.scan_items(c, items, "c_acctbal", "charge", 2, 1).select("c_custkey", "z", "item")


@query(SECTIONS)
def d16_sections(spark, d):
    return jn.sections(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", ["l_orderkey", "l_linenumber"], 100)


@query(f"WITH p AS (SELECT DISTINCT sequence, floor(0.5::DOUBLE + ({MASS}) / 1.0)::BIGINT AS mass_bin FROM ({PEPTIDES})) SELECT c_custkey, sequence FROM customer JOIN p ON mass_bin = floor(c_acctbal)::BIGINT WHERE mass_bin BETWEEN 400 AND 5000")
def j9_stored_table(spark, d):
    """Customers' balances as precursors against a stored peptide table, its bins read by range and filtered to used ones."""
    p = peptides(spark, d).select("sequence").distinct().withColumn("mass_bin", F.floor(F.lit(0.5) + sequence_mass(F.col("sequence"))).cast("long"))
    path = shared_path(spark, "peptides")
    write_peptide_table(p, path)
    c = table(spark, d, "customer").select("c_custkey", F.floor("c_acctbal").alias("mass_bin"))
    found = fl.in_used_bins(read_peptide_bin(spark, path, 400, 5000), c, "mass_bin")
    return jn.dealt_join(found, c, ["mass_bin"], F.xxhash64("sequence"), F.xxhash64("c_custkey")).select("c_custkey", "sequence")


CHUNKS = "SELECT (s_suppkey % 16)::INTEGER AS a, count(*) AS n, min(s_acctbal) AS low FROM supplier GROUP BY 1"


@query(f"SELECT s.a, c.b, s.n * c.n AS n_pairs, round(c.high - s.low, 2) AS widest FROM ({CHUNKS}) s, (SELECT (c_custkey % 32)::INTEGER AS b, count(*) AS n, max(c_acctbal) AS high FROM customer GROUP BY 1) c")
def j10_chunk_pairs(spark, d):
    """Every pair of 16 chunks of suppliers and 32 of customers, with what the pair's work would be."""
    a = table(spark, d, "supplier").groupBy((F.col("s_suppkey") % 16).cast("int").alias("a")).agg(F.count("*").alias("n_a"), F.min("s_acctbal").alias("low"))
    b = table(spark, d, "customer").groupBy((F.col("c_custkey") % 32).cast("int").alias("b")).agg(F.count("*").alias("n_b"), F.max("c_acctbal").alias("high"))
    return jn.chunk_pairs(a, b).select("a", "b", (F.col("n_a") * F.col("n_b")).alias("n_pairs"), F.round(F.col("high") - F.col("low"), 2).alias("widest"))


@query("SELECT s_suppkey, s_nationkey AS nation, max(CASE WHEN (s_suppkey + c_custkey) % 3 = 0 THEN c_custkey END) AS best FROM supplier JOIN customer ON c_nationkey = s_nationkey GROUP BY 1, 2")
def j11_join_then_max(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return jn.join_then_max(s, c, "nation", F.col("c_custkey"), (F.pmod("s_suppkey", F.lit(3)), F.pmod(-F.col("c_custkey"), F.lit(3))))


A = "SELECT user_id, min(event_type) AS item, max(value) AS score FROM events WHERE value > 30 GROUP BY user_id"
B = "SELECT user_id, max(event_type) AS item, min(value) AS score FROM events WHERE value < 60 GROUP BY user_id"


def result_sets(spark, d):
    e = table(spark, d, "events")
    a = e.where("value > 30").groupBy("user_id").agg(F.min("event_type").alias("item"), F.max("value").alias("score"))
    return a, e.where("value < 60").groupBy("user_id").agg(F.max("event_type").alias("item"), F.min("value").alias("score"))


@query(f"SELECT user_id, a.item AS item_a, a.score AS score_a, b.item AS item_b, b.score AS score_b, CASE WHEN b.score IS NULL THEN 'a only' WHEN a.score IS NULL THEN 'b only' ELSE 'both' END AS side, coalesce(a.item = b.item, false) AS same FROM ({A}) a FULL JOIN ({B}) b USING (user_id)")
def j12_compare_results(spark, d):
    return jn.compare_results(*result_sets(spark, d), "user_id", "item", "score")


@query(f"""WITH j AS (SELECT user_id, a.item AS x, b.item AS y, a.score AS s, b.score AS t FROM ({A}) a JOIN ({B}) b USING (user_id)),
 n AS (SELECT *, greatest(s / (SELECT avg(s) FROM j), t / (SELECT avg(t) FROM j)) AS v FROM j), k AS (SELECT *, ntile(10) OVER (ORDER BY v DESC, user_id) AS decile FROM n)
 SELECT decile::INTEGER AS decile, count(*) AS n, count(*) FILTER (x = y) AS n_same, round(min(v), 6) AS least, round(max(v), 6) AS most FROM k GROUP BY 1""")
def j12_decile_agreement(spark, d):
    out = jn.decile_agreement(*result_sets(spark, d), "user_id", "item", "score")
    return out.select("decile", "n", "n_same", F.round("least", 6).alias("least"), F.round("most", 6).alias("most"))


@query(f"SELECT count(*) AS n_expected, count(a.score) AS n_found, count(*) - count(a.score) AS n_missing, count(*) FILTER (abs(a.score - b.wanted) <= 40) AS n_close FROM (SELECT user_id, item, score AS wanted FROM ({B})) b LEFT JOIN ({A}) a USING (user_id, item)")
def j12b_check_expected(spark, d):
    a, b = result_sets(spark, d)
    return jn.check_expected(a, b.withColumnRenamed("score", "wanted"), ["user_id", "item"], "score", "wanted", 40)


WANTED = f"SELECT DISTINCT p AS peptide FROM (SELECT unnest(str_split(replace(regexp_replace(sequence, '([KR])', '\\1|', 'g'), '|P', 'P'), '|')) AS p FROM (SELECT upper(regexp_replace(coalesce(text, ''), '{NOT_LETTERS}', '', 'g')) AS sequence FROM benchmark)) WHERE length(p) BETWEEN 4 AND 40"


def wanted(spark, d):
    return digest(proteins(spark, d, "benchmark", "item_id")).select(F.col("sequence").alias("peptide")).distinct()


@query(f"SELECT protein_id, peptide FROM ({PROTEINS}) JOIN ({WANTED}) ON contains(sequence, peptide)")
def j13_containing(spark, d):
    """Texts that hold a benchmark peptide."""
    return jn.containing(proteins(spark, d), wanted(spark, d), "protein_id", "sequence", "peptide")


#: DuckDB's distance counts bytes: small letters of Latin-1 become capitals and control characters, which lower-cased text has not.
LATIN = "".join(chr(c) for c in range(0xDF, 0x100))
ONE_BYTE = " || ".join(f"chr({c})" for c in [*range(65, 91), *range(1, 8)])
NEAREST = f"""WITH t AS (SELECT conv_id, turn, translate(lower(text), '{LATIN}', {ONE_BYTE}) AS x FROM conversations),
 p AS (SELECT a.conv_id, a.turn, b.turn AS other, greatest(length(a.x), length(b.x)) AS n, levenshtein(a.x, b.x) AS e FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn <> b.turn AND abs(a.turn - b.turn) <= 200),
 s AS (SELECT *, CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE (n - e) / n::DOUBLE END AS score FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC NULLS LAST, other) AS place FROM s)
 SELECT conv_id, turn AS line, other AS best_line, score AS best_score FROM k WHERE place = 1"""


@query(NEAREST)
def j14_nearest_line(spark, d):
    """Whole texts, letter by letter."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    return jn.nearest_line(c, "conv_id", "turn", "text", similarity)


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def j15_broadcast(spark, d):
    """A side of fixed size (nations) to all workers."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("SELECT c_custkey, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j15_named_objects(spark, d):
    """Two maps made of tables and shared by name, looked up by tasks."""
    share_map(spark, "nation-name", table(spark, d, "nation"), "n_nationkey", "n_name")
    share_map(spark, "nation-region", table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")), "n_nationkey", "r_name")
    c = looked_up(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "nation-name", "c_nationkey", "nation", "string")
    return looked_up(c, "nation-region", "c_nationkey", "region", "string").select("c_custkey", "nation", "region")


TOP = "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 50"


@query(f"SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM ({TOP}))")
def j16_test_set(spark, d):
    """The 50 best hits' users with all their rows."""
    e = table(spark, d, "events")
    best = e.orderBy(F.desc("value"), "event_id").limit(50).select("user_id")
    return fl.in_list(e.select("event_id", "user_id", "event_type"), best, "user_id").select("event_id", "user_id", "event_type")


@query(f"SELECT user_id FROM ({A}) EXCEPT SELECT user_id FROM ({B})")
def u2_only_in_first(spark, d):
    a, b = result_sets(spark, d)
    return a.select("user_id").exceptAll(b.select("user_id"))


@query(f"SELECT user_id FROM ({A}) INTERSECT SELECT user_id FROM ({B})")
def u2_in_both(spark, d):
    a, b = result_sets(spark, d)
    return a.select("user_id").intersect(b.select("user_id"))


@query(f"SELECT DISTINCT sequence FROM ({PEPTIDES})")
def u1_distinct(spark, d):
    return peptides(spark, d).select("sequence").distinct()
