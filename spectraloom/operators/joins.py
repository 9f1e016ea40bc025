"""Joins within mass tolerances, over salted bins, and of result sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectraloom.functions.bins import ratio_bin
from spectraloom.functions.masses import matching_mass, sequence_mass
from spectraloom.functions.staging import ship_package, small_batches, staged

from .filters import with_index


def ppm_join(peptides: DataFrame, spectra: DataFrame, mass: str, precursor: str, ppm: float) -> DataFrame:
    """Pairs with abs(mass - precursor) < precursor * ppm / 1e6.

    Both sides get a bin whose width is a share of the mass, so the reach follows from the tolerance at any mass. A
    peptide has one bin, a spectrum three: an equi-join, then the exact test. Rows with a null or non-positive
    mass pair with nothing.
    """
    left = peptides.where(F.col(mass) > 0).withColumn("_bin", ratio_bin(F.col(mass), ppm))
    own = ratio_bin(F.col(precursor), ppm)
    right = spectra.where(F.col(precursor) > 0).withColumn("_bin", F.explode(F.sequence(own - 1, own + 1)))
    return left.join(right, "_bin").where(F.abs(F.col(mass) - F.col(precursor)) < F.col(precursor) * F.lit(ppm) / F.lit(1e6)).drop("_bin")


def asked_peptides(peptides: DataFrame, spectra: DataFrame, precursor: str, ppm: float, sent: int = 200_000) -> DataFrame:
    """(sequence, matching_mass) of the distinct peptides of which ppm_join may find a pair. At most `sent` bins go to the workers, so that other peptides are never shuffled; more bins are joined after that."""
    own = ratio_bin(F.col(precursor), ppm)
    used = staged(spectra.where(F.col(precursor) > 0).select(F.explode(F.sequence(own - 1, own + 1)).alias("_bin")).distinct(), "asked-bins")
    few = used.count() <= sent
    rows = peptides.select("sequence") if few else peptides.select("sequence").distinct()
    rows = rows.withColumn("matching_mass", matching_mass(sequence_mass(F.col("sequence")))).withColumn("_bin", ratio_bin(F.col("matching_mass"), ppm))
    rows = rows.join(F.broadcast(used) if few else used, "_bin", "left_semi").drop("_bin")
    return rows.distinct() if few else rows


def window_join(left: DataFrame, right: DataFrame, mass: str, target: str, minus: float, plus: float, charge: str | None = None) -> DataFrame:
    """Pairs with -minus <= (mass - target) / charge <= plus, in absolute units; without a charge it tries 1, 2 and 3 (column z)."""
    tries = F.array(F.lit(1), F.lit(2), F.lit(3)) if charge is None else F.when(F.col(charge).isNull(), F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.col(charge)))
    width = minus + plus
    l = left.withColumn("_bin", F.floor(F.col(mass) / width))
    r = right.withColumn("z", F.explode(tries))
    lo, hi = F.floor((F.col(target) - minus * F.col("z")) / width), F.floor((F.col(target) + plus * F.col("z")) / width)
    r = r.withColumn("_bin", F.explode(F.sequence(lo, hi)))
    d = (F.col(mass) - F.col(target)) / F.col("z")
    met = dealt_join(l, r, ["_bin"], F.xxhash64(*left.columns), F.xxhash64(*right.columns))
    return met.where((d >= -minus) & (d <= plus)).drop("_bin")


def integer_mass_join(peptides: DataFrame, spectra: DataFrame, mass: str, precursor: str, minus: float, plus: float) -> DataFrame:
    """Pairs by whole-number mass: a spectrum looks up every integer mass in its range."""
    l = peptides.withColumn("mass_int", F.floor(F.col(mass)).cast("long"))
    r = spectra.withColumn("mass_int", F.explode(F.sequence(F.floor(F.col(precursor) - minus), F.floor(F.col(precursor) + plus))))
    return l.join(r, "mass_int")


def sections(df: DataFrame, key: str, order: Sequence[str], most: int = 10_000) -> DataFrame:
    """Cuts every key's rows into numbered sections of at most `most` (column section).

    Rows are dealt by range of key and order and numbered inside a range, and the ranges' sizes give the offsets: a hot
    key is spread over as many tasks as it needs.
    """
    dealt = staged(df.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), "sections")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    offsets = sizes.select(F.col(key).alias("_key"), F.col("_part").alias("_in"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = dealt.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    placed = numbered.join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
    return placed.select(*df.columns, F.floor((F.col("_before") + F.col("_r")) / most).cast("int").alias("section"))


def work_items(peptides: DataFrame, mass: str, most: int = 10_000) -> DataFrame:
    """Every whole mass cut into intervals of at most `most` of its peptides: mass_int, start, end and item (mass:start:end)."""
    sizes = peptides.groupBy(F.floor(mass).cast("long").alias("mass_int")).agg(F.count("*").alias("_n"))
    starts = sizes.select("mass_int", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(most).cast("long"))).alias("start"))
    out = starts.select("mass_int", "start", F.least(F.col("start") + most, "_n").alias("end"))
    return out.withColumn("item", F.concat_ws(":", F.col("mass_int").cast("string"), F.col("start").cast("string"), F.col("end").cast("string")))


def scan_items(scans: DataFrame, items: DataFrame, mz: str, charge: str, minus: float, plus: float) -> DataFrame:
    """A row for each scan and work item of the whole masses in its range; a scan without a charge tries 1, 2 and 3 (column z)."""
    z = F.explode(F.when(F.col(charge) > 0, F.array(F.col(charge).cast("int"))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3))))
    own = scans.withColumn("z", z)
    m = F.col(mz) * F.col("z")
    return own.withColumn("mass_int", F.explode(F.sequence(F.floor(m - minus), F.floor(m + plus)))).join(items, "mass_int")


def hot_splits(df: DataFrame, key: str, most: int, sent: int = 100_000) -> DataFrame:
    """Keys with many rows and into how many salts each goes (_n).

    A key counts if it has over `most` rows and over a `sent`-th of all rows; fewer than `sent` keys can, so they may be broadcast.
    """
    sizes = staged(df.groupBy(key).agg(F.count("*").alias("_c")).where(F.col("_c") > most), "hot-keys")
    total = sizes.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    return sizes.where(F.col("_c") > total // sent).select(key, (1 + F.floor(F.col("_c") / most)).cast("int").alias("_n"))


#: Rows of either side that meet in one piece of a hot key.
PIECE = 3000


def dealt_join(left: DataFrame, right: DataFrame, keys: Sequence[str], deal_left: Column, deal_right: Column, most: int = PIECE, sent: int = 100_000) -> DataFrame:
    """Inner join whose tasks follow from the pairs, not from the bytes of its sides, which say little where every row meets many.

    A key of over most * most pairs is cut into salts x sections of `most` rows a side: its left rows are dealt to the salts and copied to the
    sections, its right rows the other way round, so copies are a `most`-th of the pairs. There is a task for as many pairs as
    a piece holds. Cut keys hold over a `sent`-th of a side, so they are few enough to be told to the workers.
    """
    counted = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    sizes = staged(counted(left, "_l").join(counted(right, "_r"), list(keys)), "join-sizes")
    n_l, n_r, pairs = sizes.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("_l", "_r")], F.coalesce(F.sum(F.col("_l").cast("double") * F.col("_r")), F.lit(0.0))).first()
    spark = left.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, int(pairs // (most * most)) + 1))
    hot = sizes.where((F.col("_l").cast("double") * F.col("_r") > most * most) & ((F.col("_l") > n_l // sent) | (F.col("_r") > n_r // sent)))
    cut = lambda c: F.ceil(F.col(c) / most).cast("int")
    hot = F.broadcast(hot.select(*keys, cut("_l").alias("_salts"), cut("_r").alias("_sections")))

    def pieces(df: DataFrame, own: str, deal: Column, other: str) -> DataFrame:
        known = lambda c: F.coalesce(F.col(c), F.lit(1))
        rows = df.join(hot, list(keys), "left").withColumn("_own", F.pmod(deal, known(own)).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), known(other) - 1)))
        salt, section = ("_own", "_other") if own == "_salts" else ("_other", "_own")
        rows = rows.withColumn("_piece", F.col(salt).cast("long") * known("_sections") + F.col(section))
        return rows.select(*df.columns, "_piece").repartition(parts, *keys, "_piece")

    return pieces(left, "_salts", deal_left, "_sections").join(pieces(right, "_sections", deal_right, "_salts").hint("merge"), [*keys, "_piece"]).drop("_piece")


#: Tasks of one join at most.
MOST_PARTS = 20_000


def salted_join(hot: DataFrame, other: DataFrame, key: str, deal: Column, most: int = PIECE) -> DataFrame:
    """Inner join on key where a key of many pairs is split on both sides, so that neither is shuffled by the unsalted key.

    The hot side's rows are dealt by `deal`, the other side's by a hash of all of a row. The result is that of the plain join.
    """
    return dealt_join(hot, other, [key], deal, F.xxhash64(*other.columns), most)


def cogrouped(left: DataFrame, right: DataFrame, keys: Sequence[str], score: Callable, schema: str) -> DataFrame:
    """score(left rows, right rows) for every key, both sides of a key together."""
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, schema)


def listed_join(items: DataFrame, lists: DataFrame, key: str, value: str, most: int | None = None) -> DataFrame:
    """Items with the sorted list of distinct values of their key, at most `most` of them if a limit is asked for."""
    listed = F.sort_array(F.collect_set(value))
    return items.join(lists.groupBy(key).agg((F.slice(listed, 1, most) if most else listed).alias("values")), key)


def charged_keys(df: DataFrame, mass: str, charges: int = 4, width: float = 0.01) -> DataFrame:
    """One row per charge 1..charges with mz_bin of mass / charge."""
    return df.withColumn("charge", F.explode(F.sequence(F.lit(1), F.lit(charges)))).withColumn("mz_bin", F.floor(F.lit(0.5) + F.col(mass) / F.col("charge") / width).cast("long"))


def chunk_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of two sets of chunks: for chunk tables only, whose number is bounded by how they were cut."""
    return left.crossJoin(right)


def join_then_max(left: DataFrame, right: DataFrame, key: str, value: Column, met: tuple[Column, Column]) -> DataFrame:
    """Per left row the largest `value` of its pairs for which `met`, a column of each side, is equal (null if none is).

    The right side comes down to one row for each key and value of its `met` before the two meet: no pair is ever made.
    """
    own, other = met
    best = right.groupBy(key, other.alias("_met")).agg(F.max(value).alias("best"))
    keys = right.select(key).distinct()
    rows = left.distinct().join(keys, key, "left_semi").withColumn("_met", own)
    return rows.join(best, [key, "_met"], "left").select(*left.columns, "best")


def compare_results(a: DataFrame, b: DataFrame, key: str, item: str, score: str) -> DataFrame:
    """Full comparison of two result sets: both items and scores, which side has the id, and whether items agree."""
    x = a.select(key, F.col(item).alias("item_a"), F.col(score).alias("score_a"))
    y = b.select(key, F.col(item).alias("item_b"), F.col(score).alias("score_b"))
    both = x.join(y, key, "full_outer")
    side = F.when(F.col("score_b").isNull(), "a only").when(F.col("score_a").isNull(), "b only").otherwise("both")
    return both.withColumn("side", side).withColumn("same", F.coalesce(F.col("item_a") == F.col("item_b"), F.lit(False)))


def decile_agreement(a: DataFrame, b: DataFrame, key: str, item: str, score: str, tiles: int = 10) -> DataFrame:
    """Per tenth of the ids that both result sets have, best first: rows, how many agree on the item, and the scores between which they lie.

    An id's score is the larger of its two, each as a share of its set's mean over these ids; ties by id. Tenths are those of
    `ntile`, exact, but no task sorts the whole table: ranges of scores are numbered and their sizes added up.
    """
    x = a.select(key, F.col(item).alias("_i"), F.col(score).alias("_x"))
    y = b.select(key, F.col(item).alias("_j"), F.col(score).alias("_y"))
    both = staged(x.join(y, key), "both-results")
    n, mean_x, mean_y = both.agg(F.count("*"), F.avg("_x"), F.avg("_y")).first()
    if not n:
        return both.select(F.lit(1).alias("decile"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_same"), F.lit(0.0).alias("least"), F.lit(0.0).alias("most")).limit(0)
    scored = both.withColumn("_s", F.greatest(F.col("_x") / mean_x, F.col("_y") / mean_y)).withColumn("_d", -F.col("_s"))
    placed = tiled(scored, ["_d", key], tiles, n)
    return placed.groupBy(F.col("tile").alias("decile")).agg(F.count("*").alias("n"), F.count_if(F.col("_i") == F.col("_j")).alias("n_same"), F.min("_s").alias("least"), F.max("_s").alias("most"))


def tiled(df: DataFrame, order: Sequence[str], tiles: int, n: int) -> DataFrame:
    """Adds tile, 1 to `tiles`, of n rows in order, as `ntile` deals them: the first n % tiles hold one row more."""
    each, more = divmod(n, tiles)
    r = F.col("_idx")
    early = F.floor(r / (each + 1))
    late = F.lit(more) + F.floor((r - more * (each + 1)) / each) if each else F.lit(0)
    return with_index(df, order, "_idx").withColumn("tile", (F.when(r < more * (each + 1), early).otherwise(late) + 1).cast("int")).drop("_idx")


def write_mass_sections(peptides: DataFrame, path: str, mass: str, width: float = 1.0) -> None:
    """Peptides in one folder for every `width` of mass (mass_section)."""
    peptides.withColumn("mass_section", F.floor(F.col(mass) / width)).repartition("mass_section").write.mode("overwrite").partitionBy("mass_section").parquet(path)


def pruned_mass_join(stored: DataFrame, spectra: DataFrame, precursor: str, minus: float, plus: float, width: float = 1.0) -> DataFrame:
    """Spectra (few enough to be broadcast, as a filter leaves them) with the stored peptides of every mass section in their range.

    The join key is the stored table's partition column, so that the sections the spectra ask for, known only when they
    have been read, choose the folders (dynamic partition pruning).
    """
    low, high = (F.floor((F.col(precursor) + d) / width) for d in (-minus, plus))
    asked = spectra.withColumn("mass_section", F.explode(F.sequence(low, high)))
    return stored.join(F.broadcast(asked), "mass_section")


def check_expected(scored: DataFrame, expected: DataFrame, keys: Sequence[str], score: str, wanted: str, tolerance: float = 0.1) -> DataFrame:
    """Counts of expected pairs that were found, missed, and found with a score within the tolerance."""
    j = expected.join(scored, list(keys), "left")
    return j.agg(
        F.count("*").alias("n_expected"), F.count_if(F.col(score).isNotNull()).alias("n_found"), F.count_if(F.col(score).isNull()).alias("n_missing"),
        F.count_if(F.abs(F.col(score) - F.col(wanted)) <= tolerance).alias("n_close"),
    )


#: Letters of wanted peptides that may be sent to workers as an automaton.
SENT_LETTERS = 16 << 20


def found_words(words: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: every (key, word) of the words that a row's text contains, by one pass of an automaton of all words over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(words):
            automaton.add_word(w, i)
        automaton.make_automaton()
        table = pa.array(words, pa.string())
        for batch in batches:
            rows, hits = [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                own = {i for _, i in automaton.iter(text)} if text else ()
                rows += [r] * len(own)
                hits += own
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), table.take(pa.array(hits, pa.int64()))], names=["_key", "_word"])

    return run


def containing(proteins: DataFrame, peptides: DataFrame, protein: str, sequence: str, peptide: str, k: int = 4, sent: int = SENT_LETTERS) -> DataFrame:
    """(protein, peptide) of every wanted peptide (of at least k letters) that a protein's sequence contains, once a protein row.

    Wanted peptides of up to `sent` letters in all go to the workers as one automaton (goto and failure links), and every text is
    read once, without a shuffle. More of them meet by seeds of k letters: ids and seeds first, then a sequence is fetched once for each
    peptide that its protein may hold, and verified. Both give the same rows if protein ids are distinct.
    """
    wanted = peptides.where(F.length(peptide) >= k).select(F.col(peptide)).distinct()
    n, letters = wanted.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(peptide)), F.lit(0))).first()
    if n and letters <= sent:
        words = tuple(sorted(r[0] for r in wanted.collect()))
        kinds = {f.name: f.dataType.simpleString() for f in (proteins.schema[protein], peptides.schema[peptide])}
        ship_package(proteins.sparkSession)
        met = proteins.select(protein, sequence).mapInArrow(found_words(words), f"_key {kinds[protein]}, _word {kinds[peptide]}")
        return met.select(F.col("_key").alias(protein), F.col("_word").alias(peptide))
    seeds = F.array_distinct(F.regexp_extract_all(F.col(sequence), F.lit(f"(?=(.{{{k}}}))"), 1))  # one pass, where substrings by position would start anew each time
    keyed = wanted.withColumn("_seed", F.substring(peptide, 1, k))
    left = proteins.where(F.length(sequence) >= k).select(protein, F.explode(seeds).alias("_seed"))
    maybe = left.join(keyed, "_seed").select(protein, peptide).distinct()
    return maybe.join(proteins.select(protein, sequence), protein).where(F.contains(F.col(sequence), F.col(peptide))).select(protein, peptide)


def nearest_line(lines: DataFrame, chapter: str, line: str, text: str, similarity: Callable[[Column, Column], Column], reach: int = 200) -> DataFrame:
    """Per line the most similar other line of its chapter within `reach` lines (best_line, best_score; smallest line of equals).

    The similarity must be the same both ways: a pair is compared once, from its earlier line, and counts for both.
    """
    a = lines.select(F.col(chapter), F.col(line).alias("line"), F.col(text).alias("_a"), F.floor(F.col(line) / reach).alias("_b"))
    b = lines.select(F.col(chapter), F.col(line).alias("other"), F.col(text).alias("_t"), F.explode(F.sequence(F.floor(F.col(line) / reach) - 1, F.floor(F.col(line) / reach))).alias("_b"))
    near = a.join(b, [chapter, "_b"]).where((F.col("line") < F.col("other")) & (F.col("other") - F.col("line") <= reach))
    small_batches(lines.sparkSession)
    once = near.withColumn("score", similarity(F.col("_a"), F.col("_t"))).select(chapter, "line", "other", "score")
    both = F.array(F.struct("line", "other"), F.struct(F.col("other").alias("line"), F.col("line").alias("other")))
    scored = once.withColumn("_w", F.explode(both)).select(chapter, "_w.line", "_w.other", "score")
    best = F.max(F.struct("score", (-F.col("other")).alias("o")))
    return scored.groupBy(chapter, "line").agg(best.alias("m")).select(chapter, "line", (-F.col("m.o")).alias("best_line"), F.col("m.score").alias("best_score"))
