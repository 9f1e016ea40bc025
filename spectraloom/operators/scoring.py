"""Spectrum conditioning, theoretical ions and match scores."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spectraloom.functions.arrays import once
from spectraloom.functions.masses import C_TERMINUS, PROTON, RESIDUES
from spectraloom.functions.staging import ship_package

from .expectation import MOST_BIN

BIN_WIDTH = 0.02
REACH = 75
WINDOWS, WINDOW_MOST = 10, 50.0
WATER, AMMONIA = 18.010565, 17.026549
SCORE_UNIT, SCORE_FLOOR = 0.005, 1e-8
SCORE_DIGITS = 9
K_WIDTH = 1.0005
#: Spectra that are handed on at a time with their bins; letters of peptides whose ions are made at a time.
CONDITIONED, ION_CELLS = 64, 1 << 16
#: Masses by letter, the last entry for letters that have none.
RESIDUE_TABLE = np.array([RESIDUES.get(chr(i), np.nan) for i in range(128)] + [np.nan])
MODIFIED = re.compile(r"([A-Z])(?:\[([^\]]*)\])?")


def mz_bin(mz: Column, width: float = BIN_WIDTH) -> Column:
    return (mz / width + 1).cast("int")


def ion_masses(sequences: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Singly charged ions of peptides of two letters and more, some peptides at a time: their places in the list and lengths, and b and y masses by place and position (from 1).

    Masses are added up letter by letter along each peptide; behind a letter without a mass they are not numbers.
    """
    texts = [s or "" for s in sequences]
    lengths = np.array([len(s) for s in texts], np.int64)
    rows = np.argsort(lengths, kind="stable")
    rows = rows[lengths[rows] > 1]
    while len(rows):
        n = min(len(rows), max(1, ION_CELLS // int(lengths[rows[0]])))
        n = max(1, min(n, ION_CELLS // int(lengths[rows[n - 1]])))
        at, rows = rows[:n], rows[n:]
        own, most = lengths[at], int(lengths[at[-1]])
        letters = np.frombuffer("".join(texts[i].ljust(most, "\0") for i in at.tolist()).encode("utf-32-le", "surrogatepass"), "<u4")
        run = np.cumsum(RESIDUE_TABLE[np.minimum(letters, 128)].reshape(n, most), axis=1)
        total = run[np.arange(n), own - 1]
        back = np.clip(own[:, None] - np.arange(2, most + 1), 0, None)
        yield at, own, run[:, :-1] + PROTON, total[:, None] - np.take_along_axis(run, back, axis=1) + C_TERMINUS


def charged(mass: np.ndarray, z: int) -> np.ndarray:
    return (mass + (z - 1) * PROTON) / z


def numbers(x: np.ndarray) -> pa.Array:
    """Doubles, null where they are not numbers."""
    return pa.array(x, pa.float64(), mask=np.isnan(x))


def ions(peptides: DataFrame, sequence: str = "sequence", charges: int = 3) -> DataFrame:
    """b and y ions of every bond and charge: ion, position, ion_charge, mz."""
    column = peptides.columns.index(sequence)
    ship_package(peptides.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, *kinds in ion_masses(batch.column(column).to_pylist()):
                row, bond = np.nonzero(np.arange(1, int(n[-1])) < n[:, None])
                own = batch.take(pa.array(at[row]))
                for ion, mass in zip("by", kinds, strict=True):
                    for z in range(1, charges + 1):
                        added = [pa.array([ion] * len(row), pa.string()), pa.array((bond + 1).astype(np.int32)), pa.array(np.full(len(row), z, np.int32)), numbers(charged(mass[row, bond], z))]
                        yield pa.RecordBatch.from_arrays([*own.columns, *added], names=[*batch.schema.names, "ion", "position", "ion_charge", "mz"])

    kind = StructType([*peptides.schema.fields, *StructType.fromDDL("ion string, position int, ion_charge int, mz double").fields])
    return peptides.mapInArrow(run, kind)


def ion_sums(peptides: DataFrame, sequence: str = "sequence", charges: int = 3) -> DataFrame:
    """Per row of peptides, ion and charge what `ions` has: n ions, the least and most mz, and the sum of mz times position. Nothing is grouped: a peptide's ions are summed up where they are made."""
    column = peptides.columns.index(sequence)
    ship_package(peptides.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, *kinds in ion_masses(batch.column(column).to_pylist()):
                position = np.arange(1, int(n[-1]))
                there = position < n[:, None]
                own = batch.take(pa.array(at))
                for ion, mass in zip("by", kinds, strict=True):
                    for z in range(1, charges + 1):
                        mz = charged(mass, z)
                        known = there & ~np.isnan(mz)
                        none = ~known.any(axis=1)
                        sums = [np.where(known, mz, np.inf).min(axis=1), np.where(known, mz, -np.inf).max(axis=1), np.where(known, mz * position, 0.0).sum(axis=1)]
                        added = [pa.array([ion] * len(at), pa.string()), pa.array(np.full(len(at), z, np.int32)), pa.array(n - 1), *[numbers(np.where(none, np.nan, x)) for x in sums]]
                        yield pa.RecordBatch.from_arrays([*own.columns, *added], names=[*batch.schema.names, "ion", "ion_charge", "n", "lo", "hi", "w"])

    kind = StructType([*peptides.schema.fields, *StructType.fromDDL("ion string, ion_charge int, n long, lo double, hi double, w double").fields])
    return peptides.mapInArrow(run, kind)


def conditioned(mz: np.ndarray, intensity: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins within reach of a peak, their background-corrected values, and those with neutral losses added."""
    keep = intensity > 0
    if not keep.any():
        none = np.zeros(0)
        return none.astype(np.int64), none, none
    bins = (mz[keep] / BIN_WIDTH + 1).astype(np.int64)
    shift = int(WATER / BIN_WIDTH + 1)
    raw = np.zeros(bins.max() + 1)
    np.maximum.at(raw, bins, np.sqrt(intensity[keep]))
    raw *= 100 / raw.max()
    window = np.arange(len(raw)) // ((len(raw) - 1) // WINDOWS + 1)
    largest = np.zeros(window[-1] + 1)
    np.maximum.at(largest, window, raw)
    peaks = np.where(raw > 5, raw * (WINDOW_MOST / np.where(largest > 0, largest, WINDOW_MOST))[window], 0)
    wide = np.concatenate([np.zeros(REACH), peaks, np.zeros(2 * REACH + shift)])
    sums = np.concatenate([[0], np.cumsum(wide)])
    n = len(peaks) + REACH
    own = np.concatenate([peaks, np.zeros(REACH)])
    near = sums[np.minimum(np.arange(n) + 2 * REACH + 1, len(sums) - 1)] - sums[np.arange(n)]
    plain = own - (near - own) / (2 * REACH)
    loss = plain.copy()
    for d in (int(WATER / BIN_WIDTH + 1), int(AMMONIA / BIN_WIDTH + 1)):
        if d < n:
            loss[d:] += 0.2 * plain[: n - d]
    some = np.flatnonzero((np.abs(plain) > 1e-3) | (np.abs(loss) > 1e-3))
    return some, plain[some], loss[some]


def condition(spectra: DataFrame, peaks: str = "peaks") -> DataFrame:
    """Adds sparse arrays bins, plain and loss to spectra whose peaks are array<struct<mz,intensity>>.

    A spectrum may have some ten thousand bins, so tasks hand on CONDITIONED spectra at a time, however many they were given.
    """
    column = spectra.columns.index(peaks)
    ship_package(spectra.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CONDITIONED):
                some = batch.slice(start, CONDITIONED)
                out = []
                for row in some.column(column):
                    own = row.values
                    mz, intensity = ([], []) if own is None else (own.field("mz").to_numpy(zero_copy_only=False), own.field("intensity").to_numpy(zero_copy_only=False))
                    out.append(conditioned(np.asarray(mz, float), np.asarray(intensity, float)))
                kinds = (pa.int32(), pa.float64(), pa.float64())
                added = [pa.array([o[i] for o in out], pa.list_(k)) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*some.columns, *added], names=[*batch.schema.names, "bins", "plain", "loss"])

    kind = StructType([*spectra.schema.fields, *StructType.fromDDL("bins array<int>, plain array<double>, loss array<double>").fields])
    return spectra.mapInArrow(run, kind)


def residue_masses(sequence: str) -> list[float]:
    """Masses along a sequence; a number in brackets adds to the residue before it."""
    if "[" not in sequence:
        return [RESIDUES[c] for c in sequence]
    return [RESIDUES[c] + (float(d) if d else 0.0) for c, d in MODIFIED.findall(sequence)]


def ion_bins(sequence: str, charges: int = 3) -> list[tuple[np.ndarray, int]]:
    mass = np.cumsum(residue_masses(sequence))
    singly = np.concatenate([mass[:-1] + PROTON, mass[-1] - mass[:-1] + C_TERMINUS])
    return [(((singly + (z - 1) * PROTON) / z / BIN_WIDTH + 1).astype(np.int64), z) for z in range(1, charges + 1)]


def xcorr(sequence: str, bins: np.ndarray, plain: np.ndarray, loss: np.ndarray, charge: int) -> tuple[float, int]:
    """Cross-correlation score and the number of ions that count."""
    total, used = 0.0, 0
    top = charge - 1 if charge > 1 else charge
    for at, z in ion_bins(sequence):
        if z > 1 and z > top or not len(bins):
            continue
        i = np.minimum(np.searchsorted(bins, at), len(bins) - 1)
        v = np.where(bins[i] == at, (loss if z == 1 else plain)[i], 0)
        v = v[np.abs(v) > 1e-4]
        total += v.sum()
        used += len(v)
    return (max(total * SCORE_UNIT, SCORE_FLOOR) if used else 0.0), used


def xcorr_all(theory: list[list[tuple[np.ndarray, int]]], bins: np.ndarray, plain: np.ndarray, loss: np.ndarray, charge: int) -> tuple[np.ndarray, np.ndarray]:
    """xcorr of one spectrum with all of its candidates, given by their ions' bins, in one pass."""
    n, top = len(theory), charge - 1 if charge > 1 else charge
    total, used = np.zeros(n), np.zeros(n, np.int64)
    for k, z in enumerate((1, 2, 3)):
        if z > 1 and z > top or not len(bins):
            continue
        at = np.concatenate([t[k][0] for t in theory])
        owner = np.repeat(np.arange(n), [len(t[k][0]) for t in theory])
        i = np.minimum(np.searchsorted(bins, at), len(bins) - 1)
        v = np.where(bins[i] == at, (loss if z == 1 else plain)[i], 0)
        some = np.abs(v) > 1e-4
        total += np.bincount(owner[some], weights=v[some], minlength=n)
        used += np.bincount(owner[some], minlength=n)
    return np.where(used > 0, np.maximum(total * SCORE_UNIT, SCORE_FLOOR), 0.0), used


def score_groups(ppm: float, top: int, floor: float) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Scorer for a co-group of peptides and spectra: for every spectrum the `top` best pairs inside the tolerance, and how many of all its pairs fall into each score bin.

    Both parts merge with those of the spectrum's other groups: the best are ranked anew, the counts added. Scores are rounded
    to SCORE_DIGITS, so that sums of the same ions in another order are ties, on every layout.
    """

    def run(key: tuple, peptides: pd.DataFrame, spectra: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        peptides = peptides.sort_values(["matching_mass", "sequence"], kind="stable")
        mass, sequences = (peptides[c].to_numpy() for c in ("matching_mass", "sequence"))
        theory: dict[int, list[tuple[np.ndarray, int]]] = {}  # of the group's peptides, made once
        for s in spectra.drop_duplicates("row").sort_values("row").itertuples():
            reach = s.precursor_mass * ppm / 1e6
            lo, hi = np.searchsorted(mass, [s.precursor_mass - 2 * reach, s.precursor_mass + 2 * reach])
            near = lo + np.flatnonzero(np.abs(mass[lo:hi] - s.precursor_mass) < reach)
            if not len(near):
                continue  # a spectrum is conditioned only where it has a candidate
            for i in near.tolist():
                if i not in theory:
                    theory[i] = ion_bins(sequences[i])
            cells = conditioned(np.asarray(s.mz, float), np.asarray(s.intensity, float))
            scores, used = xcorr_all([theory[i] for i in near.tolist()], *cells, s.precursor_charge)
            scores = np.round(scores, SCORE_DIGITS)
            order = np.lexsort((sequences[near], -scores))
            best = order[scores[order] > floor][:top]
            bins, counts = np.unique(np.minimum((scores * 10 + 0.5).astype(np.int64), MOST_BIN), return_counts=True)
            matches = [{"sequence": q, "xcorr": x, "matched_ions": m, "mass_diff": d} for q, x, m, d in zip(sequences[near[best]].tolist(), scores[best].tolist(), used[best].tolist(), (mass[near[best]] - s.precursor_mass).tolist(), strict=True)]
            out.append((s.row, matches, bins.tolist(), counts.tolist()))
        return pd.DataFrame(out, columns=["row", "matches", "bins", "counts"])

    return run


MATCH_SCHEMA = "row long, matches array<struct<sequence:string,xcorr:double,matched_ions:int,mass_diff:double>>, bins array<int>, counts array<long>"


def xcorr_joined(pairs: DataFrame, conditioned_spectra: DataFrame, charges: int = 3) -> DataFrame:
    """The same score for (spectrum_id, sequence, precursor_charge) pairs as joins and sums only: ions met with bins."""
    theory = ions(pairs, "sequence", charges)
    top = F.greatest(F.lit(1), F.col("precursor_charge") - 1)
    theory = theory.where(F.col("ion_charge") <= F.greatest(F.lit(1), top)).withColumn("bin", mz_bin(F.col("mz")))
    cells = conditioned_spectra.select("spectrum_id", F.explode(F.arrays_zip("bins", "plain", "loss")).alias("c")).select("spectrum_id", F.col("c.bins").alias("bin"), "c.plain", "c.loss")
    value = F.when(F.col("ion_charge") == 1, F.col("loss")).otherwise(F.col("plain"))
    # cells are thousands for each row they come from, so what Spark takes their size for says nothing: they are never sent whole
    met = theory.join(cells.hint("merge"), ["spectrum_id", "bin"]).withColumn("v", value).where(F.abs("v") > 1e-4)
    return met.groupBy("spectrum_id", "sequence").agg(F.greatest(F.sum("v") * SCORE_UNIT, F.lit(SCORE_FLOOR)).alias("xcorr"), F.count("*").cast("int").alias("matched_ions"))


def k_bin(mz: Column) -> Column:
    return F.when(mz == F.floor(mz), mz).otherwise(mz / K_WIDTH + 0.5).cast("int")


def k_score(theory: DataFrame, peaks: DataFrame, spectrum: str = "spectrum_id", sequence: str = "sequence") -> DataFrame:
    """Direct hits and half of the hits one bin off, each measured bin counted once by its largest use, times the length factor."""
    t = theory.withColumn("_b", k_bin(F.col("mz"))).withColumn("_o", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    t = t.select(spectrum, sequence, (F.col("_b") + F.col("_o")).alias("k_bin"), F.when(F.col("_o") == 0, 1.0).otherwise(0.5).alias("_w"))
    p = peaks.groupBy(spectrum, k_bin(F.col("mz")).alias("k_bin")).agg(F.max("intensity").alias("_v"))
    used = t.join(p, [spectrum, "k_bin"]).groupBy(spectrum, sequence, "k_bin").agg(F.max(F.col("_w") * F.col("_v")).alias("_u"))
    length = F.length(sequence)
    return used.groupBy(spectrum, sequence).agg(F.sum("_u").alias("dot")).withColumn("k_score", F.col("dot") * 1000 * F.log(length.cast("double")) / (3 * F.sqrt(length.cast("double"))))


def residue_weight(ion: Column, last: Column, position: Column) -> Column:
    """Weight of an ion by the residue at its end (fixed values)."""
    b = F.when(last == "D", 5.0).when(last.isin("N", "Q"), 2.0).when(last.isin("V", "E", "I", "L"), 3.0).otherwise(1.0)
    first = F.when(position == 1, F.when(last == "P", 10.0).otherwise(3.0)).otherwise(1.0)
    return F.when(ion == "y", F.when(last == "P", 5.0).otherwise(1.0)).otherwise(b * first)


def dot_product(theory: DataFrame, peaks: DataFrame, error: float = 0.4, spectrum: str = "spectrum_id", sequence: str = "sequence") -> DataFrame:
    """Weighted sum of met intensities times the factorials of the met ions of each kind (at most 10 each)."""
    cell = lambda c: (c / error + 0.5).cast("int")
    n = F.length(sequence)
    letter = F.when(F.col("ion") == "b", F.substring(sequence, F.col("position"), F.lit(1))).otherwise(F.substring(sequence, n - F.col("position") + 1, F.lit(1)))
    t = theory.withColumn("w", residue_weight(F.col("ion"), letter, F.col("position"))).withColumn("cell", cell(F.col("mz")))
    p = peaks.groupBy(spectrum, cell(F.col("mz")).alias("cell")).agg(F.max("intensity").alias("v"))
    met = t.join(p, [spectrum, "cell"]).groupBy(spectrum, sequence).agg(F.sum(F.col("w") * F.col("v")).alias("dot"), F.count_if(F.col("ion") == "b").alias("n_b"), F.count_if(F.col("ion") == "y").alias("n_y"))
    some = lambda c: F.factorial(F.least(F.col(c), F.lit(10)).cast("int"))
    return met.withColumn("hyperscore", F.when(F.col("dot") > 0, F.col("dot") * some("n_b") * some("n_y")).otherwise(0.0))


def ion_use(met: DataFrame, keys: list[str], ion: str, value: str) -> DataFrame:
    """Number and sum of met ions by kind."""
    return met.groupBy(*keys).agg(*[a for k in ("b", "y") for a in (F.count_if(F.col(ion) == k).alias(f"n_{k}"), F.sum(F.when(F.col(ion) == k, F.col(value)).otherwise(0.0)).alias(f"sum_{k}"))])


def normalised_peaks(
    peaks: Column, precursor_mz: Column, charge: Column, dynamic: float = 100.0, least_mz: float = 150.0, n: int = 50, isotope: float = 0.95, carbon: float = 1.5,
    most_mz: float = 6000.0, masses: tuple[float, float] = (150.0, 6000.0), most_charge: int = 4, least_peaks: int = 5, noise: bool = True,
) -> Column:
    """Peak array of a conditioned spectrum in m/z order, null if the spectrum is not to be scored.

    Peaks over least_mz: of those within `isotope` of the one kept the larger stays; peaks within 2 / charge of the
    parent and those from most_mz on go; the rest is scaled to `dynamic`, and peaks under 1 go. Above m/z 200 the largest peak stays
    of those within `carbon` of the first of a run. The n largest are kept. Null: parent mass outside `masses`, a charge over
    most_charge, fewer than least_peaks after scaling, or (noise) no peak above mass / charge (mass - 600 for charges below 3).
    """
    z = F.greatest(F.coalesce(charge, F.lit(1)), F.lit(1))
    mass = (precursor_mz - PROTON) * z + PROTON
    order = F.array_sort(peaks, lambda a, b: F.when(a["mz"] < b["mz"], -1).when(a["mz"] > b["mz"], 1).otherwise(0))
    kept = F.transform(F.filter(order, lambda p: (p["mz"] > least_mz) & (p["intensity"] > 0)), lambda p: F.struct(p["mz"].alias("mz"), p["intensity"].cast("double").alias("intensity")))

    def larger(a: Column, p: Column) -> Column:
        last = F.element_at(a, -1)
        near = (F.size(a) > 0) & (p["mz"] < last["mz"] + isotope)
        return F.when(near & (p["intensity"] < last["intensity"]), a).when(near, F.array_append(F.slice(a, 1, F.size(a) - 1), p)).otherwise(F.array_append(a, p))

    off = lambda p: F.abs(p["mz"] - precursor_mz)
    apart = lambda a: F.filter(a, lambda p: ((off(p) == 0) | (off(p) >= 2.0 / z)) & (p["mz"] < most_mz))

    def scaled(a: Column) -> Column:
        return once(F.array_max(F.transform(a, lambda p: p["intensity"])), lambda top: F.filter(F.transform(a, lambda p: F.struct(p["mz"].alias("mz"), (p["intensity"] * dynamic / top).alias("intensity"))), lambda p: p["intensity"] >= 1))

    run = lambda first, p: F.struct(first.alias("first"), p.alias("peak"))

    def run_step(a: Column, p: Column) -> Column:
        last = F.element_at(a, -1)
        same = (F.size(a) > 0) & (p["mz"] - last["first"] < carbon) & (p["mz"] > 200)
        best = F.when(p["intensity"] > last["peak"]["intensity"], p).otherwise(last["peak"])
        return F.when(same, F.array_append(F.slice(a, 1, F.size(a) - 1), run(last["first"], best))).otherwise(F.array_append(a, run(p["mz"], p)))

    by_size = lambda a, b: F.when(a["intensity"] > b["intensity"], -1).when(a["intensity"] < b["intensity"], 1).when(a["mz"] < b["mz"], -1).otherwise(1)

    def cleaned(a: Column) -> Column:
        enough = mass.between(*masses) & (z <= most_charge) & (F.size(a) >= least_peaks)
        if noise:
            high = F.when(z < 3, mass - 600.0).otherwise(mass / z)
            enough &= F.exists(a, lambda p: p["mz"] > high)
        runs = F.aggregate(a, F.transform(F.slice(a, 1, 0), lambda p: run(p["mz"], p)), run_step)
        return F.when(enough, F.sort_array(F.slice(F.array_sort(F.transform(runs, lambda r: r["peak"]), by_size), 1, n)))

    single = once(kept, lambda k: F.aggregate(k, F.slice(k, 1, 0), larger))
    return once(once(apart(single), scaled), cleaned)


def length_factor(n: int) -> float:
    return 1000 * math.log(n) / (3 * math.sqrt(n))
