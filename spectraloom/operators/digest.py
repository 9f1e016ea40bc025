"""Proteins to peptides: cutting, semi-enzymatic ends, decoys and modifications."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spectraloom.functions.masses import C_TERMINUS, RESIDUES
from spectraloom.functions.staging import small_batches

DECOY_PREFIX = "DECOY_"
#: Label prefixes of other programs' decoys (fixed values).
DECOY_LABELS = ["DECOY_", "REV_", "REV1_", "RND_", "###REV###", "###RND###"]
#: Named cut rules (fixed values): letters to cut after, letters that prevent the cut if they follow.
NAMED_RULES = {"trypsin": "[RK]|{P}", "lysc": "[K]"}


def cut_rule(text: str) -> tuple[str, str]:
    """(letters cut after, letters not cut before) of a rule such as `[RK]|{P}`, or of a named one."""
    after, _, not_before = NAMED_RULES.get(text.strip().lower(), text.strip()).partition("|")
    after, not_before = (x.strip("[]{} ").upper() for x in (after, not_before))
    if not after.isalpha() or not (not_before.isalpha() or not not_before):
        raise ValueError(f"no cut rule: {text}")
    return after, not_before


def cut(batch: pa.RecordBatch, after: np.ndarray, before: np.ndarray, missed: int, least: int, most: int) -> tuple[np.ndarray, ...]:
    """Peptides of a batch whose second column is the sequence: their row, text, missed cleavages and start. All sequences are cut at once, in the batch's own bytes."""
    column = batch.column(1)
    _, ends, held = column.buffers()
    off = np.frombuffer(ends, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    body = np.frombuffer(held, np.uint8)[off[0] : off[-1]] if held is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    sites = np.flatnonzero(after[body[:-1]]) + 1
    cuts = np.union1d(sites[~before[body[sites]]], off)
    row = np.searchsorted(off, cuts[:-1], "right") - 1
    letters = np.r_[0, np.cumsum((body & 0xC0) != 0x80)]  # before each byte
    found = []
    for m in range(missed + 1):
        i = np.flatnonzero(row[: max(0, len(row) - m)] == row[m:])
        n = letters[cuts[i + m + 1]] - letters[cuts[i]]
        i = i[(n >= least) & (n <= most)]
        found.append((row[i], cuts[i], cuts[i + m + 1], np.full(len(i), m, np.int32)))
    own, start, stop, joined = (np.concatenate(x) for x in zip(*found, strict=True))
    places = np.r_[0, np.cumsum(stop - start)]
    data = body[np.repeat(start - places[:-1], stop - start) + np.arange(places[-1])]
    text = pa.Array.from_buffers(pa.string(), len(own), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)])
    return own, text, joined, (letters[start] - letters[off[own]]).astype(np.int32)


#: Residue masses by byte, 0 for other bytes.
BYTE_MASS = np.array([RESIDUES.get(chr(i), 0.0) for i in range(256)])
#: Share of a mass by which sums of residues may differ with their order, for up to thousands of letters (40 differ by some 1e-14).
SUM_ERROR = 1e-12


def near_bins(bins: np.ndarray, ppm: float) -> Callable[[pa.Array], np.ndarray]:
    """Tells which peptides of an Arrow column lie in mass bins (of `ratio_bin`) among `bins`.

    Masses are added up letter by letter here, so one that stands at a border of bins counts for both: all that `ratio_bin` of
    `sequence_mass` puts there are found, and now and then one beside them.
    """
    bins, step = np.unique(bins), math.log1p(2 * ppm / 1e6)

    def found(mass: np.ndarray) -> np.ndarray:
        own = np.floor(np.log(mass) / step).astype(np.int64)
        return bins[np.minimum(np.searchsorted(bins, own), len(bins) - 1)] == own

    def near(texts: pa.Array) -> np.ndarray:
        _, ends, held = texts.buffers()
        off = np.frombuffer(ends, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        if not len(bins) or held is None or off[0] == off[-1]:
            return np.zeros(len(texts), bool)
        # a last entry keeps the sum of an empty text at the end in range; an empty text has no residue
        run = np.r_[BYTE_MASS[np.frombuffer(held, np.uint8)[off[0] : off[-1]]], 0.0]
        mass = np.where(np.diff(off) > 0, np.add.reduceat(run, off[:-1] - off[0]), 0.0) + C_TERMINUS
        return found(mass * (1 - SUM_ERROR)) | found(mass * (1 + SUM_ERROR))

    return near


def kept_peptides(peptides: DataFrame, keep: Callable[[pa.Array], np.ndarray], sequence: str = "sequence") -> DataFrame:
    """Rows whose sequence `keep` tells to keep, a batch at a time."""
    small_batches(peptides.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(sequence)), pa.bool_()))

    return peptides.mapInArrow(run, peptides.schema)


def digest(proteins: DataFrame, protein: str = "protein_id", sequence: str = "sequence", missed: int = 0, least: int = 4, most: int = 40, after: str = "KR", not_before: str = "P", starts: bool = False, keep: Callable[[pa.Array], np.ndarray] | None = None) -> DataFrame:
    """Peptides with up to `missed` missed cleavages: protein, sequence and missed_cleavages, and where they start in it (start, from 0) if asked for.

    Sequences are cut after each letter of `after` unless one of `not_before` follows, and neighbouring fragments are joined; a null sequence has none.
    With `keep` (of an Arrow column of peptides) others don't leave the task.
    """
    if not (after + not_before).isascii():
        raise ValueError(f"cut letters must be ASCII: {after} {not_before}")
    sets = [np.isin(np.arange(256), [ord(c) for c in letters]) for letters in (after, not_before)]
    names = [protein, "sequence", "missed_cleavages", *["start"] * starts]
    small_batches(proteins.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, text, joined, start = cut(batch, *sets, missed, max(least, 1), most)
            if keep is not None:
                some = np.flatnonzero(keep(text))
                own, text, joined, start = own[some], text.take(pa.array(some)), joined[some], start[some]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), text, pa.array(joined), *[pa.array(start)] * starts], names=names)

    rows = proteins.select(F.col(protein), F.coalesce(F.col(sequence), F.lit("")).alias("sequence"))
    kind = StructType([rows.schema[protein], *StructType.fromDDL("sequence string, missed_cleavages int, start int" if starts else "sequence string, missed_cleavages int").fields])
    return rows.mapInArrow(run, kind)


def semi_places(peptides: DataFrame, sequence: str = "sequence", start: str = "start", least: int = 4) -> DataFrame:
    """As `semi_peptides`, each prefix and suffix with its own start."""
    s, n = F.col(sequence), F.length(sequence)
    ends = F.when(n > least, F.sequence(F.lit(least), n - 1)).otherwise(F.array().cast("array<int>"))
    one = lambda x, at: F.struct(x.alias("semi"), at.cast("int").alias("start"))
    all_ = F.concat(F.array(one(s, F.col(start))), F.transform(ends, lambda k: one(F.substring(s, F.lit(1), k), F.col(start))), F.transform(ends, lambda k: one(F.substring(s, n - k + 1, k), F.col(start) + n - k)))
    kept = [c for c in peptides.columns if c not in (sequence, start)]
    return peptides.withColumn("_x", F.explode(F.array_distinct(all_))).select(*kept, F.col("_x.semi").alias(sequence), F.col("_x.start").alias(start))


def semi_peptides(peptides: DataFrame, sequence: str = "sequence", least: int = 4) -> DataFrame:
    """Each peptide with all its prefixes and suffixes of at least `least` letters (column semi)."""
    s = F.col(sequence)
    ends = F.when(F.length(s) > least, F.sequence(F.lit(least), F.length(s) - 1)).otherwise(F.array().cast("array<int>"))
    both = F.array_distinct(F.concat(F.array(s), F.transform(ends, lambda n: F.substring(s, 1, n)), F.transform(ends, lambda n: F.substring(s, F.length(s) - n + 1, n))))
    return peptides.withColumn("semi", F.explode(both))


def missed_cleavages(sequence: Column) -> Column:
    """Inner K or R that no P follows."""
    return F.size(F.regexp_extract_all(sequence, F.lit("[KR](?=[^P])"), 0))


def probably_semi(sequence: Column) -> Column:
    """Whether the last letter is no cut site."""
    return ~F.rlike(sequence, F.lit("[KR]$"))


def decoys(proteins: DataFrame, protein: str = "protein_id", sequence: str = "sequence") -> DataFrame:
    """The proteins and, for each, its reversed sequence under a decoy name (is_decoy)."""
    own = proteins.select(F.col(protein).cast("string").alias(protein), sequence, F.lit(False).alias("is_decoy"))
    return own.unionByName(own.select(F.concat(F.lit(DECOY_PREFIX), protein).alias(protein), F.reverse(sequence).alias(sequence), F.lit(True).alias("is_decoy")))


def normal_label(label: Column) -> Column:
    """A decoy label of any known program under the one prefix."""
    prefixes = "|".join(DECOY_LABELS)
    return F.regexp_replace(label, f"^({prefixes})", DECOY_PREFIX)


def same_spectrum_key(sequence: Column) -> Column:
    """Key under which peptides that differ in I and L only are the same."""
    return F.translate(sequence, "I", "L")


@dataclass(frozen=True)
class Modification:
    """Mass delta at a residue, or at a terminus ('[' at the first, ']' at the last residue)."""

    delta: float
    site: str

    @staticmethod
    def parse(text: str) -> Modification:
        delta, _, site = text.partition("@")
        return Modification(float(delta), site)

    def places(self, sequence: str) -> list[int]:
        if self.site == "[":
            return [0] if sequence else []
        if self.site == "]":
            return [len(sequence) - 1] if sequence else []
        return [i for i, c in enumerate(sequence) if c == self.site]


def modified_forms(sequence: str, mods: Sequence[Modification], most: int, fixed: Sequence[Modification] = ()) -> Iterator[tuple[str, float, int]]:
    """Text form, mass delta and number of potential sites of the peptide and every variant of up to `most` modified residues.

    Fixed modifications are on every site of every form; a potential one on the same residue adds to them.
    """
    base: dict[int, float] = {}
    for m in fixed:
        for i in m.places(sequence):
            base[i] = base.get(i, 0.0) + m.delta
    places: dict[int, list[float]] = {}
    for m in mods:
        for i in m.places(sequence):
            places.setdefault(i, []).append(m.delta)
    for n in range(min(most, len(places)) + 1):
        for chosen in combinations(sorted(places), n):
            forms: list[dict[int, float]] = [base]
            for i in chosen:
                forms = [f | {i: base.get(i, 0.0) + d} for f in forms for d in places[i]]
            for f in forms:
                yield "".join(c + (f"[{f[i]:.3f}]" if i in f else "") for i, c in enumerate(sequence)), sum(f.values()), n


def _at(m: Modification, letter: Column, i: Column, length: Column) -> Column:
    """Whether a modification can be on the letter at i of a peptide."""
    return i == 0 if m.site == "[" else i == length - 1 if m.site == "]" else letter == m.site


def _sites(m: Modification, sequence: Column) -> Column:
    """How many letters of a peptide a modification can be on."""
    if m.site in "[]":
        return F.when(F.length(sequence) > 0, 1).otherwise(0)
    return F.length(sequence) - F.length(F.replace(sequence, F.lit(m.site), F.lit("")))


def counted_forms(peptides: DataFrame, mods: Sequence[str], most: int = 3, sequence: str = "sequence", fixed: Sequence[str] = ()) -> DataFrame:
    """How often each potential modification is on a peptide (mod_counts, at most `most` in all), and what that and the fixed ones add to its mass (mod_delta).

    Every variant of a peptide with the same counts has the same mass, so masses can be matched before sites are placed.
    """
    parsed, always = [Modification.parse(m) for m in mods], [Modification.parse(m) for m in fixed]
    s = F.col(sequence)
    delta = F.lit(0.0)
    for m in always:
        delta = delta + _sites(m, s) * F.lit(m.delta)
    rows = peptides.where(s.isNotNull()).withColumn("mod_counts", F.array().cast("array<int>")).withColumn("mod_delta", delta)
    for m in parsed:
        free = F.lit(most) - F.aggregate("mod_counts", F.lit(0), lambda a, k: a + k)
        rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.least(_sites(m, s), free))))
        rows = rows.withColumn("mod_counts", F.array_append("mod_counts", F.col("_k"))).withColumn("mod_delta", F.col("mod_delta") + F.col("_k") * F.lit(m.delta)).drop("_k")
    return rows


def placed_forms(counted: DataFrame, mods: Sequence[str], most: int = 3, sequence: str = "sequence", fixed: Sequence[str] = ()) -> DataFrame:
    """Every way to place a row's mod_counts on letters of its own: modified (text form, masses in brackets) and n_mods.

    One step for each modification a peptide may have: the next one stands behind the last. Counts for which there is no
    way (two that need the same letter) vanish.
    """
    parsed, always = [Modification.parse(m) for m in mods], [Modification.parse(m) for m in fixed]
    names = [c for c in counted.columns if c != "mod_counts"]
    letters = F.filter(F.split(sequence, ""), lambda c: c != "")
    rows = counted.withColumn("_n", F.length(sequence)).withColumn("_c", letters)
    total = F.aggregate("mod_counts", F.lit(0), lambda a, k: a + k)
    place = "struct<at:int,mod:int>"

    def sites(c: Column, i: Column) -> Column:
        ways = [F.when(_at(m, c, i, F.col("_n")), F.struct(i.cast("int").alias("at"), F.lit(j).alias("mod"))) for j, m in enumerate(parsed)]
        return F.filter(F.array(*ways).cast(f"array<{place}>"), lambda x: x.isNotNull()) if ways else F.array().cast(f"array<{place}>")

    rows = rows.withColumn("_w", F.flatten(F.transform("_c", sites))).withColumn("n_mods", total).withColumn("_at", F.array().cast(f"array<{place}>"))
    for step in range(most if parsed else 0):
        last = F.coalesce(F.element_at("_at", -1)["at"] if step else F.lit(-1), F.lit(-1))
        taken = lambda x: F.size(F.filter("_at", lambda y: y["mod"] == x["mod"]))
        open_ = F.filter("_w", lambda x: (x["at"] > last) & (taken(x) < F.get("mod_counts", x["mod"])))
        rows = rows.withColumn("_x", F.explode(F.when(F.col("n_mods") > step, open_).otherwise(F.array(F.lit(None).cast(place)))))
        rows = rows.withColumn("_at", F.when(F.col("_x").isNull(), F.col("_at")).otherwise(F.array_append("_at", F.col("_x")))).drop("_x")
    deltas = F.array(*[F.lit(m.delta) for m in parsed]) if parsed else F.array().cast("array<double>")

    def shown(c: Column, i: Column) -> Column:
        own = F.filter("_at", lambda x: x["at"] == i)
        mass, has = F.aggregate(own, F.lit(0.0), lambda a, x: a + F.get(deltas, x["mod"])), F.size(own) > 0
        for m in always:
            there = _at(m, c, i, F.col("_n"))
            mass, has = mass + F.when(there, m.delta).otherwise(0.0), has | there
        return F.when(has, F.concat(c, F.format_string("[%.3f]", mass))).otherwise(c)

    return rows.where(F.size("_at") == F.col("n_mods")).select(*names, F.array_join(F.transform("_c", shown), "").alias("modified"), "n_mods")


def modify(peptides: DataFrame, mods: Sequence[str], most: int = 3, sequence: str = "sequence", fixed: Sequence[str] = ()) -> DataFrame:
    """Every variant of each row's peptide: modified (text form), mod_delta and n_mods; the form without potential ones is one of them."""
    forms = placed_forms(counted_forms(peptides, mods, most, sequence, fixed), mods, most, sequence, fixed)
    return forms.select(*peptides.columns, "modified", "mod_delta", "n_mods")
