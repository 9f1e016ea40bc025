"""Quality rules as a bitmask ledger (operator 3), in Spark expressions only.

Every rule is measured once per text. The ledger holds the measurements and one long of failure bits; a policy
is a version name and a mask of the rules it enforces, so a new policy or an ablation reads the ledger and
never a text: a text passes a policy when `fail_bits & mask` is zero, and what a rule costs comes from counts
per bit pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: name, failing condition over the measurements (SQL on the columns of `MEASURES`, integer arithmetic only).
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("many_words", "n_words > 1000000"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("exclamations", "10 * n_exclaims > n_words"),
    ("digits", "5 * n_digits > word_chars"),
    ("capitals", "2 * n_capital_words > n_words"),
    ("dup_lines", "2 * n_dup_lines > n_lines"),
    ("dup_line_chars", "5 * dup_line_chars > text_chars"),
    ("repeat_words", "100 * n_repeat_words > 50 * n_words"),
    ("some_repeat_words", "100 * n_repeat_words > 30 * n_words"),
    ("few_distinct_words", "n_distinct_words * n_distinct_words < n_words"),
    ("ellipses", "10 * n_ellipses > 3 * n_lines"),
    ("bullets", "10 * n_bullets > 9 * n_lines"),
]
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_exclaims", "n_digits", "n_capital_words",
    "n_lines", "dup_line_chars", "text_chars", "n_distinct_words", "n_ellipses", "n_bullets",
]
#: Policy versions: the rules each enforces.
POLICIES: dict[str, list[str]] = {
    "v1": ["few_words", "many_words", "short_words", "long_words", "symbols", "repeat_words"],
    "v2": [name for name, _ in RULES],
}
BASE_RULES = ["few_words", "repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def mask_of(rules: list[str]) -> int:
    return sum(1 << i for i, (name, _) in enumerate(RULES) if name in rules)


def count_of(text: Column, chars: str) -> Column:
    """How many characters of text are in chars (ASCII)."""
    left = text
    for c in chars:
        left = F.replace(left, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(left)


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the array holds twice or more."""

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["g"] == x["g"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"))
        return F.aggregate(let(pairs, positions), start, step, lambda a: a["n"])

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    # most texts repeat no window: a hash set tells, and only the others are sorted
    found = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(0))
    return F.when(F.size(words) >= 3, found).otherwise(0)


def measures(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(*keep, t.alias("_t"))

    def per_line(lines: Column) -> Column:
        def made(distinct: Column) -> Column:
            chars = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
            return F.struct(
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(distinct)).cast("long").alias("n_dup_lines"),
                (chars(lines) - chars(distinct)).alias("dup_line_chars"),
                F.size(F.filter(lines, lambda x: x.endswith("...") | x.endswith("…"))).cast("long").alias("n_ellipses"),
                F.size(F.filter(lines, lambda x: x.startswith("- ") | x.startswith("* ") | x.startswith("• "))).cast("long").alias("n_bullets"),
            )

        return let(F.array_distinct(lines), made)

    def capital(word: Column) -> Column:
        w = F.replace(word, F.lit("ß"), F.lit("s"))  # it has no capital of its own
        return (w == F.upper(w)) & (w != F.lower(w))

    def per_word(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, capital)).cast("long").alias("n_capital_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct_words"),
        )

    words = F.filter(F.split("_t", WHITE), lambda w: w != "")
    lines = F.filter(F.split("_t", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    counted = own.select(
        *keep, let(words, per_word).alias("_w"), let(lines, per_line).alias("_l"),
        count_of(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"), count_of(F.col("_t"), "!").cast("long").alias("n_exclaims"),
        count_of(F.col("_t"), "0123456789").cast("long").alias("n_digits"), F.length("_t").cast("long").alias("text_chars"),
    )
    return counted.select(*keep, *[F.col(f"_w.{m}") if m in ("n_words", "word_chars", "n_repeat_words", "n_capital_words", "n_distinct_words") else F.col(f"_l.{m}") if m in ("n_lines", "n_dup_lines", "dup_line_chars", "n_ellipses", "n_bullets") else F.col(m) for m in MEASURES])


def rule_ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of docs: the id, every measurement (long) and `fail_bits` (bit i: RULES[i] failed).

    A null or empty text has no words and no lines: it fails `few_words` alone. Null and repeated ids keep their
    rows; repeated rows are measured alike; other columns are ignored, whatever their names. No row, no ledger.
    """
    measured = measures(docs.select(F.col(id_col), F.col(text)), text, [id_col])
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("fail_bits", bits)


def apply_policy(ledger: DataFrame, policy: str = "v2") -> DataFrame:
    """Adds base_failed and kept (base passed and no rule of the policy failed) to a ledger."""
    base = F.col("fail_bits").bitwiseAND(F.lit(mask_of(BASE_RULES))) != 0
    return ledger.withColumns({"base_failed": base, "kept": ~base & (F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0)})


def ablations(ledger: DataFrame, policies: dict[str, list[str]] | None = None) -> DataFrame:
    """Per policy and rule: rows (`n_rows`) that pass, that fail the rule, and that only this rule rejects.

    Texts collapse to counts per bit pattern first, so policies and rules are crossed with patterns only.
    """
    policies = POLICIES if policies is None else policies
    spark = ledger.sparkSession
    patterns = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    grid = [(p, name, mask_of(rules), 1 << i) for p, rules in policies.items() for i, (name, _) in enumerate(RULES) if name in rules]
    table = F.broadcast(spark.createDataFrame(grid, "policy string, rule string, mask long, bit long"))
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return patterns.join(table, F.col("bit") > 0).groupBy("policy", "rule").agg(
        F.sum("n").cast("long").alias("n_rows"), total(hit == 0).alias("n_kept"),
        total(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), total(hit == F.col("bit")).alias("n_only"),
    )
