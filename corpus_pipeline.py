"""Corpus pipeline: language ID, near-dedup by SimHash and shingles, suffix-array dedup, secret scans, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; all but the last
return the columns of `documents`. Null ids, null texts, repeated rows and empty tables are allowed: see each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.staging import scratch, ship_package
from spectraloom.llm import language_id, secret_ledger
from spectraloom.llm.common import connected_components, load, staged
from spectraloom.llm.near_sets import similar_components
from spectraloom.llm.packing import pack_documents
from spectraloom.llm.queries import tokenizer_path
from spectraloom.llm.simhash import simhash_components
from spectraloom.llm.substrings import PASSAGE_WORDS, remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no language (null, no letter); fills a null lang with the prediction, unless its codeword is ambiguous: such a row stays without one.

    Without any labelled row nothing can be told apart, and only texts that are null or empty go.
    """
    docs = docs.select(*COLUMNS)
    model = language_id.train(docs)
    if model is None:
        return docs.where("text is not null and text <> ''")
    seen = language_id.identify(docs.withColumnRenamed("text", "body"), model, [c if c != "text" else "body" for c in COLUMNS], text="body")
    kept = seen.where(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.select("doc_id", F.col("body").alias("text"), F.coalesce("lang", F.when(~F.col("ambiguous"), F.col("lang_pred"))).alias("lang"), "source", "n_chars")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of smallest id of every group of near copies: what links of operator 10 (SimHash fingerprints of two differing bits at most) and of five-word shingle sets that are 4/5 the same connect.

    The shingle sets find what fingerprints, by design, can't: at a similarity of 4/5 two differ in some ten bits. Rows without an id stay; rows
    of one id are told apart by their texts, and equal rows are one.
    """
    docs = docs.select(*COLUMNS)
    own = docs.where("doc_id is not null")
    with scratch(spark) as keep:
        # a text is one node however many rows hold it, so what connects are at most as many links of each kind as there are texts
        prints = staged(simhash_components(own.select(F.xxhash64("text").alias("h"), "text"), id_col="h").where("h <> component_id").select(F.col("h").alias("u"), F.col("component_id").alias("v")).distinct(), "near-prints")
        near = staged(similar_components(own), "near-rows")
        first = near.groupBy("component").agg(F.min("h").alias("v"), F.max("h").alias("most")).where("v < most").select("component", "v")
        links = near.select("component", F.col("h").alias("u")).distinct().join(first, "component").select("u", "v").where("u <> v").unionByName(prints)
        joined = connected_components(links, "near-all").select(F.col("node").alias("h"), F.col("component").alias("joined"))
        found = keep(near.select("id", "h").join(joined, "h", "left").select("id", "h", F.coalesce("joined", "h").alias("component")), "near-components")
    return first_rows(docs, found)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As `simhash_stage`, by links of shingle sets alone; not a stage of the pipeline."""
    docs = docs.select(*COLUMNS)
    with scratch(spark) as keep:
        found = keep(similar_components(docs.where("doc_id is not null")), "near-components")
    return first_rows(docs, found)


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row of smallest id of every component of (id, h, component), and rows without an id."""
    first = found.groupBy("component").agg(F.min(F.struct("id", "h")).alias("m")).select(F.col("m.id").alias("doc_id"), F.col("m.h").alias("h"))
    named = docs.withColumn("h", F.xxhash64("text")).join(first, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every repeated string of 400 bytes and every repeated passage of over 50 words out of the texts, and drops rows of which nothing but white space is left."""
    out = remove_repeats(docs, keep=("lang", "source"), passages=PASSAGE_WORDS, cut_passages=True)
    # a cut may fall inside a character: what is left of it goes
    whole = F.replace(F.expr("make_valid_utf8(cast(kept as string))"), F.lit("�"), F.lit(""))
    text = F.when(F.size("removed") > 0, whole).otherwise(F.col("text"))
    rows = out.select("doc_id", text.alias("text"), F.col("kept_columns.lang").alias("lang"), F.col("kept_columns.source").alias("source"))
    return rows.withColumn("n_chars", F.length("text").cast("long")).where(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; all rows stay."""
    docs = docs.select(*COLUMNS)
    found, _ = secret_ledger.scan_secrets(docs)
    hits = found.where(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    joined = docs.withColumn("blob", F.sha2(F.coalesce("text", F.lit("")), 256)).join(hits, "blob", "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(secret_ledger.redact(F.col("text"), F.col("spans")))
    return joined.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences of 2048 ids."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", repeated_text_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL can express none of the fitted, hashed or tokenised stages; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's inner tables are deleted once its output is written, and all outputs but the last at the end."""
    ship_package(spark)
    docs = load(spark, sf_dir, "documents")
    with scratch(spark) as keep_last:
        for name, stage in STAGES[:-1]:
            with scratch(spark) as keep:
                docs = keep(stage(spark, docs, sf_dir), name)
        return keep_last(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
