"""The search: proteins and spectra to ranked peptide matches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectraloom.functions.bins import ratio_bin
from spectraloom.functions.masses import matching_mass, precursor_mass, sequence_mass
from spectraloom.functions.staging import ship_package, staged
from spectraloom.operators import aggregates as ag
from spectraloom.operators import digest as dg
from spectraloom.operators import expectation as ex
from spectraloom.operators import scoring as sc
from spectraloom.operators import windows as wn
from spectraloom.operators.filters import scorable
from spectraloom.operators.partitioning import planned_groups
from spectraloom.sinks.reports import write_pepxml

from .config import SearchConfig

#: Keys that may be broadcast as hot; bins of a plan that may be broadcast whole.
SENT, SENT_PLAN = 100_000, 200_000


def peptide_places(proteins: DataFrame, config: SearchConfig, keep: Callable[[pa.Array], np.ndarray] | None = None) -> DataFrame:
    """(sequence, protein_id, start) of every peptide of proteins (protein_id, sequence): a row a place, however many proteins hold it. With `keep` only of those it tells to keep."""
    source = proteins.select(F.col("protein_id").cast("string").alias("protein_id"), "sequence")
    if config.max_proteins is not None:
        source = source.orderBy("protein_id").limit(config.max_proteins)
    if config.decoys:
        source = dg.decoys(source).drop("is_decoy")
    found = dg.digest(source, missed=config.missed_cleavages, after=config.cut_after, not_before=config.not_before, starts=True, keep=None if config.semi else keep)
    if config.semi:
        found = dg.semi_places(found)
        found = found if keep is None else dg.kept_peptides(found, keep)
        return found.select("sequence", "protein_id", "start").distinct()
    return found.select("sequence", "protein_id", "start")


def candidate_places(proteins: DataFrame, used: DataFrame, config: SearchConfig) -> DataFrame:
    """peptide_places without those whose mass no spectrum asks for, where that can be told before modifications: few used bins are sent to where proteins are cut, so that other peptides never leave those tasks. A peptide at the border of a used bin may stay."""
    if config.modifications or config.fixed_modifications or used.count() > SENT_PLAN:
        return peptide_places(proteins, config)
    bins = np.array([r.bin for r in used.select("bin").collect()], np.int64)
    return peptide_places(proteins, config, dg.near_bins(bins, config.ppm))


def distinct_peptides(places: DataFrame) -> DataFrame:
    """One row a peptide: its first protein and the start in it, how many proteins hold it, whether all are decoys, and its mass. No row grows with its proteins."""
    first = F.min(F.struct("protein_id", "start"))
    one = places.groupBy("sequence", "protein_id").agg(F.min("start").alias("start"))
    kept = one.groupBy("sequence").agg(first.alias("_f"), F.count("*").alias("n_proteins"), F.min(F.startswith("protein_id", F.lit(dg.DECOY_PREFIX))).alias("is_decoy"))
    return kept.select("sequence", F.col("_f.protein_id").alias("protein"), F.col("_f.start").alias("start"), "n_proteins", "is_decoy", matching_mass(sequence_mass(F.col("sequence"))).alias("matching_mass"))


def peptide_masses(peptides: DataFrame, config: SearchConfig) -> DataFrame:
    """Peptides with a row for each of their masses (matching_mass, mod_counts): one for each count of modifications, whatever their sites. Decoys have fixed ones only, unless modified_decoys."""
    if not config.modifications and not config.fixed_modifications:
        return peptides.withColumn("mod_counts", F.array().cast("array<int>"))
    rows = dg.counted_forms(peptides, config.modifications, config.max_modifications, fixed=config.fixed_modifications)
    if not config.modified_decoys:
        rows = rows.where(~F.col("is_decoy") | ~F.exists("mod_counts", lambda k: k > 0))
    return rows.withColumn("matching_mass", F.col("matching_mass") + F.col("mod_delta")).drop("mod_delta")


def placed_sequences(masses: DataFrame, config: SearchConfig) -> DataFrame:
    """Rows of peptide_masses with `plain` letters and, as sequence, each text form with the modifications on their sites."""
    if not config.modifications and not config.fixed_modifications:
        return masses.drop("mod_counts").withColumn("plain", F.col("sequence"))
    forms = dg.placed_forms(masses, config.modifications, config.max_modifications, fixed=config.fixed_modifications)
    return forms.withColumnRenamed("sequence", "plain").withColumnRenamed("modified", "sequence").drop("n_mods")


def peptide_table(proteins: DataFrame, config: SearchConfig) -> DataFrame:
    """Distinct peptides (sequence, plain, protein, start, n_proteins, is_decoy, matching_mass) of proteins (protein_id, sequence); a modified residue is followed by its mass in brackets."""
    return placed_sequences(peptide_masses(distinct_peptides(peptide_places(proteins, config)), config), config)


def scorable_spectra(spectra: DataFrame, config: SearchConfig) -> DataFrame:
    """Spectra fit to be scored, with precursor_mass and charge 1 where none is given."""
    charge = F.greatest(F.coalesce("precursor_charge", F.lit(1)), F.lit(1))
    own = spectra.where(F.length("spectrum_id") > 0).withColumn("precursor_charge", charge).withColumn("precursor_mass", precursor_mass(F.col("precursor_mz"), F.col("precursor_charge")))
    return own.where(scorable(F.size("peaks"), F.col("precursor_charge"), F.col("precursor_mass"), config.least_peaks, config.most_charge))


def with_plan(rows: DataFrame, plan: DataFrame, hot: Column) -> DataFrame:
    """Rows joined to their bin's plan. A plan of few bins is sent whole; of a larger one only the bins that are hot, of which there are fewer than SENT, so that no task gets a hot bin's rows."""
    if plan.count() <= SENT_PLAN:
        return rows.join(F.broadcast(plan), "bin")
    sent = F.broadcast(plan.where(hot))
    return rows.join(sent, "bin").unionByName(rows.join(sent.select("bin"), "bin", "left_anti").join(plan.where(~hot), "bin"))


@dataclass
class Groups:
    """Where peptides and spectra meet: both sides with the columns `part` and `piece` of their scoring group."""

    peptides: DataFrame
    spectra: DataFrame
    plan: DataFrame


def scoring_groups(peptides: DataFrame, spectra: DataFrame, config: SearchConfig) -> Groups:
    """Groups of the peptides (sequence, matching_mass, bin) and of the bins of spectra (row, bin).

    A bin of more spectra or peptides than a group is planned for is cut into pieces of salts x sections: its spectra are
    dealt to the salts and copied to the sections, its peptides the other way round. Other bins are packed together. So
    no group holds more than twice the planned rows of either side, whatever the tables or bins hold.
    """
    sizes = staged(ag.counts_by(spectra, "bin", out="n_s").join(ag.counts_by(peptides, "bin", out="n_p"), "bin"), "bins")
    total_s, total_p = sizes.agg(F.coalesce(F.sum("n_s"), F.lit(0)), F.coalesce(F.sum("n_p"), F.lit(0))).first()
    least = 2 * spectra.sparkSession.sparkContext.defaultParallelism
    plan = staged(planned_groups(sizes, "bin", "n_s", "n_p", config.group_spectra, config.group_rows, least), "groups")
    hot = (F.col("n_s") > total_s // SENT) | (F.col("n_p") > total_p // SENT)
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    piece = (F.col("_salt") * F.col("sections") + F.col("_section")).alias("piece")
    left = with_plan(peptides, plan, hot).withColumn("_section", dealt("sequence", "sections")).withColumn("_salt", every("salts"))
    right = with_plan(spectra, plan, hot).withColumn("_salt", dealt("row", "salts")).withColumn("_section", every("sections"))
    return Groups(left.select(*peptides.columns, "part", piece), right.select("row", "part", piece).distinct(), plan)


def search(proteins: DataFrame, spectra: DataFrame, config: SearchConfig | None = None, with_proteins: bool = True) -> DataFrame:
    """Ranked matches of every spectrum.

    Returns spectrum_id, precursor_mass, precursor_charge, sequence (modified residues with their mass), plain, xcorr, matched_ions,
    mass_diff, rank, delta_cn, delta_cn_star, expect, protein and start (the first place), n_proteins and is_decoy; with
    `with_proteins` also the sorted ids of all its proteins, for kept matches only (`match_places` gives them as rows).
    Candidates meet by mass bin; only bins that spectra use keep their peptides, and modifications are placed on sites after
    that. Scores up to the floor are dropped; the best `top` of each spectrum are ranked, ties by sequence. Expectations are fitted
    to the scores of all of a spectrum's candidates, which are counted while they are scored. A spectrum id that stands in
    several rows is several spectra.
    """
    config = config or SearchConfig()
    measured, used = measured_spectra(spectra, config)
    places = staged(candidate_places(proteins, used, config), "places")
    found = matches(staged(distinct_peptides(places), "peptides"), measured, used, config)
    if not with_proteins:
        return found
    all_ = match_places(found, places).groupBy("plain").agg(F.sort_array(F.collect_set("protein_id")).alias("proteins"))
    return found.join(all_, "plain")


def measured_spectra(spectra: DataFrame, config: SearchConfig) -> tuple[DataFrame, DataFrame]:
    """Stored spectra fit to be scored, with a row number each and their mass bins, and the distinct bins."""
    own = ratio_bin(F.col("precursor_mass"), config.ppm)
    measured = scorable_spectra(spectra, config).select("spectrum_id", "precursor_mass", "precursor_charge", F.col("peaks.mz").alias("mz"), F.col("peaks.intensity").alias("intensity"), F.sequence(own - 1, own + 1).alias("bins"))
    measured = staged(measured.withColumn("row", F.monotonically_increasing_id()), "spectra")
    return measured, staged(measured.select(F.explode("bins").alias("bin")).distinct(), "used-bins")


def matches(peptides: DataFrame, measured: DataFrame, used: DataFrame, config: SearchConfig) -> DataFrame:
    """The matches of `search` between distinct peptides and measured spectra, without the lists of proteins."""
    bins = measured.select("row", F.explode("bins").alias("bin"))
    masses = peptide_masses(peptides, config).withColumn("bin", ratio_bin(F.col("matching_mass"), config.ppm))
    forms = staged(placed_sequences(masses.join(used, "bin", "left_semi"), config), "forms")
    groups = scoring_groups(forms.select("sequence", "matching_mass", "bin"), bins, config)
    # peaks are joined to their groups by row, so they are dealt evenly, and shuffled once more to the groups themselves
    asked = groups.spectra.groupBy("row").agg(F.collect_list(F.struct("part", "piece")).alias("_g"))
    asked = measured.drop("spectrum_id", "bins").join(asked, "row").withColumn("_g", F.explode("_g")).select("*", "_g.part", "_g.piece").drop("_g")
    keys = ["part", "piece"]
    ship_package(measured.sparkSession)
    scored = groups.peptides.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(sc.score_groups(config.ppm, config.top, config.score_floor), sc.MATCH_SCHEMA)
    scored = staged(scored, "scored")
    # a pair meets in one group only, so its row is the pair's only one
    order = Window.partitionBy("row").orderBy(F.desc("xcorr"), "sequence")
    best = scored.select("row", F.explode("matches").alias("m")).select("row", "m.*").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= config.top).drop("_r")
    histogram = scored.select("row", F.explode(F.arrays_zip("bins", "counts")).alias("h")).select("row", F.col("h.bins").alias("b"), F.col("h.counts").alias("n"))
    fits = ex.tail_fits(histogram, "row")
    ranked = wn.hit_ranks(best, "row", "xcorr", "sequence").join(fits, "row")
    ranked = ranked.withColumn("expect", ex.tail_value(F.col("xcorr"), F.col("slope"), F.col("intercept"))).drop("slope", "intercept")
    named = ranked.join(measured.select("row", "spectrum_id", "precursor_mass", "precursor_charge"), "row")
    return named.join(forms.drop("matching_mass", "bin"), "sequence").select(
        "spectrum_id", "precursor_mass", "precursor_charge", "sequence", "plain", "xcorr", "matched_ions", "mass_diff", "rank", "delta_cn", "delta_cn_star", "expect", "protein", "start", "n_proteins", "is_decoy",
    )


def match_places(found: DataFrame, places: DataFrame) -> DataFrame:
    """(plain, protein_id, start) of the peptides of kept matches: a row for each place, so that a peptide of many proteins is many rows."""
    return places.withColumnRenamed("sequence", "plain").join(found.select("plain").distinct(), "plain", "left_semi")


def search_to_pepxml(proteins: DataFrame, spectra: DataFrame, path: str, config: SearchConfig | None = None, parameters: dict[str, str] | None = None) -> DataFrame:
    """The search written as one pepXML report, with expectations, alternative proteins and masses of modified residues; returns the matches."""
    config = config or SearchConfig()
    measured, used = measured_spectra(spectra, config)
    places = staged(candidate_places(proteins, used, config), "places")
    found = staged(matches(staged(distinct_peptides(places), "peptides"), measured, used, config), "matches")
    write_pepxml(found, path, {"ppm": str(config.ppm)} | (parameters or {}), match_places(found, places))
    return found


def spectra_of(peptides: DataFrame, sequence: str = "sequence", charge: int = 2) -> DataFrame:
    """Theoretical spectra as if measured: each peptide's singly charged b and y ions with intensity 100, its own precursor."""
    ions = sc.ions(peptides.select(F.col(sequence).alias("sequence")).distinct(), "sequence", 1)
    peaks = ions.groupBy("sequence").agg(F.sort_array(F.collect_list(F.struct("mz", F.lit(100.0).cast("float").alias("intensity")))).alias("peaks"))
    mass = matching_mass(sequence_mass(F.col("sequence")))
    mz = (mass - 1.00727646688) / charge + 1.00727646688
    return peaks.select(F.col("sequence").alias("spectrum_id"), mz.alias("precursor_mz"), F.lit(charge).alias("precursor_charge"), "peaks")
