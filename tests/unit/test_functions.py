"""Masses, text functions and bins against hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from spectraloom.functions import text as tx
from spectraloom.functions.bins import LinearBins, LogBins, ratio_bin
from spectraloom.functions.masses import PROTON, RESIDUES, formula_mass, formula_mass_of, matching_mass, precursor_mass, residue_array, sequence_mass


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"]).select(column.alias("r")).first()["r"]


def test_residue_masses():
    assert RESIDUES["G"] == pytest.approx(57.02146, abs=1e-4)
    assert RESIDUES["A"] == pytest.approx(71.03711, abs=1e-4)
    assert RESIDUES["C"] == pytest.approx(103.00919 + 57.02146, abs=1e-4)
    assert RESIDUES["B"] == RESIDUES["N"] and RESIDUES["Z"] == RESIDUES["Q"] and RESIDUES["I"] == RESIDUES["L"]
    assert formula_mass("H2O") == pytest.approx(18.01056, abs=1e-4)
    assert formula_mass("H2O", average=True) == pytest.approx(18.01528, abs=1e-4)


def test_sequence_masses(spark):
    rows = spark.createDataFrame([("PEPTIDE",), ("",), (None,), ("CCX",)], "s string")
    got = {r.s: (r.m, r.a) for r in rows.select("s", sequence_mass(F.col("s")).alias("m"), F.aggregate(residue_array(F.col("s")), F.lit(0.0), lambda a, x: a + x).alias("a")).collect()}
    assert got["PEPTIDE"][0] == pytest.approx(sum(RESIDUES[c] for c in "PEPTIDE")) == pytest.approx(got["PEPTIDE"][1])
    assert got[""] == (0.0, 0.0) and got[None] == (None, None)
    assert got["CCX"][0] == pytest.approx(2 * RESIDUES["C"] + 111.06)
    assert one(spark, matching_mass(F.lit(100.0))) == pytest.approx(119.0178)


def test_precursor(spark):
    assert one(spark, precursor_mass(F.lit(500.0), F.lit(2))) == pytest.approx(2 * (500 - PROTON) + PROTON)
    assert one(spark, precursor_mass(F.lit(500.0), F.lit(0))) == pytest.approx(500.0) == one(spark, precursor_mass(F.lit(500.0), F.lit(None).cast("int")))


def test_formula_column(spark):
    assert one(spark, formula_mass_of(F.lit("C3H5ON"))) == pytest.approx(formula_mass("C3H5ON"))
    assert one(spark, formula_mass_of(F.lit(None).cast("string"))) is None


def test_text(spark):
    assert one(spark, tx.clean_word(F.lit(" it's, Über! "))) == "ITSBER"
    assert one(spark, tx.words_of(F.lit(None).cast("string"))) == []
    assert one(spark, tx.similarity(F.lit(""), F.lit(""))) == 1.0
    assert one(spark, tx.similarity(F.lit("Kitten"), F.lit("sitting"))) == pytest.approx(4 / 7)
    assert one(spark, tx.fixed_substrings(F.lit("ab cd"), 3)) == ["ABC", "BCD"]
    assert one(spark, tx.fixed_substrings(F.lit("a"), 3)) == []
    assert sorted(one(spark, tx.case_variations(F.lit("ab"), 2))) == ["AB", "Ab", "aB", "ab"]
    row = F.lit('<hit peptide="AK" rank="1"><q>x</q></hit>')
    assert one(spark, tx.attribute(row, "peptide")) == "AK" and one(spark, tx.attribute(row, "none")) is None
    assert one(spark, tx.tag_text(row, "q")) == "x"
    assert one(spark, tx.with_attribute(row, "rank", "2")) == '<hit peptide="AK" rank="2"><q>x</q></hit>'
    assert one(spark, tx.retention_seconds(F.lit("PT5.5898S"))) == pytest.approx(5.5898)
    assert one(spark, tx.retention_seconds(F.lit("soon"))) is None
    assert one(spark, tx.padded_id(F.lit("42"), 5)) == "00042" and one(spark, tx.padded_id(F.lit("a42"), 5)) == "a42"


def test_linear_bins(spark):
    b = LinearBins(0, 10, 5)
    got = [one(spark, b.bin(F.lit(float(v)))) for v in (-1, 0, 1.9, 2, 9.99, 10, 50)]
    assert got == [0, 0, 0, 1, 4, 4, 4]
    strict = LinearBins(0, 10, 5, overflow=False)
    assert [one(spark, strict.bin(F.lit(v))) for v in (-1.0, 10.0, 5.0)] == [None, None, 2]
    assert one(spark, b.label(F.lit(3.0))) == "2.00-4.00"
    assert one(spark, b.neighbours(F.lit(0.5))) == [0, 1] and one(spark, b.neighbours(F.lit(5.0))) == [1, 2, 3]


def test_log_bins(spark):
    b = LogBins(1, 1000, 3)
    assert [one(spark, b.bin(F.lit(float(v)))) for v in (0.5, 1, 9, 11, 999, 5000)] == [0, 0, 0, 1, 2, 2]
    assert one(spark, b.start(F.lit(1))) == pytest.approx(10)


@pytest.mark.parametrize("ppm", [1.0, 20.0, 500.0])
def test_ratio_bins_are_at_most_one_apart(spark, ppm):
    rows = [(m, m * (1 + s * ppm / 1e6)) for m in (1.5, 300.0, 2345.6, 480000.0) for s in (-1, 1)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert df.where(F.abs(ratio_bin(F.col("a"), ppm) - ratio_bin(F.col("b"), ppm)) > 1).count() == 0
    assert math.isfinite(ppm)
