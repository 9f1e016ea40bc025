"""The registered queries of the text-pipeline operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.staging import shared_path

from . import language_id, quality_classifier, quality_rules, secret_ledger
from .alignment import align_tokenizers
from .centroids import cluster_vectors
from .common import load, staged
from .embedding_pq import near_vectors
from .license_scan import scan_licenses
from .packing import pack_documents
from .sentence_pieces import decode_pieces, encode_pieces
from .sharding import shard_rows
from .simhash import simhash_components
from .substrings import PASSAGE_WORDS, remove_repeats


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and n_passages: runs of words in passages of over 50 words that stand anywhere else too."""
    out = remove_repeats(load(spark, sf_dir, "documents"), passages=PASSAGE_WORDS)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_passages",
    )


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(load(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_policy(quality_rules.rule_ledger(load(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger stored once; from its bits alone what each policy keeps and what each of its rules costs."""
    ledger = staged(quality_rules.rule_ledger(load(spark, sf_dir, "documents")), "rule-ledger")
    return quality_rules.ablations(ledger)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids per text, and what they decode to: doc_id, n_tokens, ids_hash (of the id array), n_chars and round_trip."""
    model = tokenizer_path("piece_bpe_32k.model")
    encoded = encode_pieces(load(spark, sf_dir, "documents"), model)
    decoded = decode_pieces(encoded, model, ["doc_id", "text"], keep_ids=True)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), F.length("decoded").cast("long").alias("n_chars"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches with one ledger: the second scans only blobs that the first has not seen."""
    docs = load(spark, sf_dir, "documents")
    late = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    found = secret_ledger.scan_batches([docs.where(~late), docs.where(late)], shared_path(spark, "secret-ledger"))
    s = F.col("spans")
    counts = {f"n_{kind}": secret_ledger.count_kind(s, i) for i, kind in enumerate(("assign", "access", "hex"))}
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(secret_ledger.span_text(s, secret_ledger.BASE_KINDS), 256).alias("base_sha256"), secret_ledger.span_text(s).alias("spans"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id", 5, 0)
    model = quality_classifier.train(docs, load(spark, sf_dir, "labels").where(~held))
    scored = quality_classifier.score_quality(docs, model, ["doc_id", held.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id", 4, 2)
    model = language_id.train(docs.where(~held))
    return language_id.identify(docs, model, ["doc_id", held.alias("held_out")])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(load(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(load(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(load(spark, sf_dir, "documents")).drop("spans")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(load(spark, sf_dir, "embeddings"))


REGISTERED = (
    op1_suffix_array_dedup, op2_embedding_near_dedup, op3_quality_rules, op4_sentencepiece, op5_secret_scan, op6_packing, op7_quality_classifier, op8_language_id, op9_sharding,
    op10_simhash_near_dedup, op11_cross_tokenizer_alignment, op12_license_scan, op13_centroid_clustering, quality_ablations,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in REGISTERED}


QUALITY_SQL = """WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 s AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words, list_filter(str_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
 g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1))::INT AS i FROM s)),
 c AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
 r AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words FROM c GROUP BY doc_id),
 m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, COUNT_SYMBOLS AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaims, (length(t) - length(regexp_replace(t, '[0-9]', '', 'g')))::BIGINT AS n_digits,
  len(list_filter(list_transform(words, lambda w: replace(w, 'ß', 's')), lambda w: w = upper(w) AND w <> lower(w)))::BIGINT AS n_capital_words, len(lines)::BIGINT AS n_lines,
  (length(array_to_string(lines, '')) - length(array_to_string(list_distinct(lines), '')))::BIGINT AS dup_line_chars, length(t)::BIGINT AS text_chars, len(list_distinct(words))::BIGINT AS n_distinct_words,
  len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…')))::BIGINT AS n_ellipses, len(list_filter(lines, lambda x: starts_with(x, '- ') OR starts_with(x, '* ') OR starts_with(x, '• ')))::BIGINT AS n_bullets
  FROM s LEFT JOIN r USING (doc_id)),
 b AS (SELECT *, (BITS)::BIGINT AS fail_bits FROM m)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & BASE) <> 0 AS base_failed, (fail_bits & ALL_RULES) = 0 AS kept, fail_bits FROM b"""


def quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(quality_rules.RULES))
    all_rules = quality_rules.mask_of(quality_rules.POLICIES["v2"] + quality_rules.BASE_RULES)
    out = QUALITY_SQL.replace("COUNT_SYMBOLS", "(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT")
    return out.replace("(BITS)", f"({bits})").replace("& BASE)", f"& {quality_rules.mask_of(quality_rules.BASE_RULES)})").replace("ALL_RULES", str(all_rules))


def ablation_sql() -> str:
    """Counts over the bits that the rules' own SQL gives, rule by rule."""
    bits = quality_sql()
    rows = [f"('{p}', '{name}', {quality_rules.mask_of(rules)}, {1 << i})" for p, rules in quality_rules.POLICIES.items() for i, (name, _) in enumerate(quality_rules.RULES) if name in rules]
    count = lambda c: f"count(*) FILTER ({c})"
    return (
        f"SELECT policy, rule, count(*) AS n_rows, {count('fail_bits & mask = 0')} AS n_kept, {count('fail_bits & bit <> 0')} AS n_failed, {count('fail_bits & mask = bit')} AS n_only "
        f"FROM ({bits}), (VALUES {', '.join(rows)}) AS p(policy, rule, mask, bit) GROUP BY policy, rule"
    )


def secrets_sql() -> str:
    """Spans from what each pattern matches and the pieces between its matches."""
    words = ("password", "passwd", "secret", "token")
    either = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in words) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    selects = []
    for i, (kind, pattern, group, least, _) in enumerate(secret_ledger.RULES):
        p = pattern.replace("(?i:password|passwd|secret|token|api_?key)", either).replace("'", "''")
        selects.append(
            f"SELECT doc_id, {i} AS k, '{kind}' AS kind, m[i] AS whole, g[i] AS part, (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s, {least} AS least FROM "
            f"(SELECT *, unnest(range(1, len(m) + 1))::INT AS i FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS g, regexp_split_to_array(t, '{p}') AS p FROM d WHERE regexp_matches(t, '{p}')))"
        )
    spans = " UNION ALL ".join(selects)
    text = "kind || ':' || s || ':' || (s + length(whole))"
    count = lambda k: f"count(*) FILTER (k = {k})"
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), a AS (SELECT * FROM ({spans}) WHERE length(part) >= least), "
        f"f AS (SELECT doc_id, {count(0)} AS n_assign, {count(1)} AS n_access, {count(2)} AS n_hex, coalesce(string_agg({text}, ',' ORDER BY s, k) FILTER (k < {secret_ledger.BASE_KINDS}), '') AS base, string_agg({text}, ',' ORDER BY s, k) AS spans FROM a GROUP BY doc_id) "
        "SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN f USING (doc_id)"
    )


def centroid_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds written one after another; every vector meets every centroid."""
    nearest = lambda c: (
        f"SELECT r, vec_id, v, m.d AS distance, m.c AS cluster FROM (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': c}}) AS m FROM kept, {c} GROUP BY r)"
    )
    with_ = [
        "kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS c, v AS w FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {k}))",
    ]
    for i in range(rounds):
        with_ += [
            f"a{i} AS MATERIALIZED ({nearest(f'c{i}')})",
            f"m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS w FROM (SELECT cluster AS c, i, sum(v[i]) AS s, count(*)::HUGEINT AS n FROM a{i}, range(1, 65) AS d(i) GROUP BY ALL) GROUP BY c)",
            f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.w, c{i}.w) AS w FROM c{i} LEFT JOIN m{i} USING (c))",
        ]
    return (
        f"WITH {', '.join(with_)}, placed AS MATERIALIZED ({nearest(f'c{rounds}')}) "
        "SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, "
        f"sha256(array_to_string(w, ',')) AS centroid_sha256 FROM placed JOIN c{rounds} ON c = cluster"
    )


def oracle_sql() -> dict[str, str]:
    return {"op13_centroid_clustering": centroid_sql(), "op3_quality_rules": quality_sql(), "op5_secret_scan": secrets_sql(), "quality_ablations": ablation_sql()}
