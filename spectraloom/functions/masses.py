"""Masses of atoms, residues, peptides and ions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Monoisotopic and average atom masses, residue formulas, terminal masses.
ATOMS = {"H": 1.007825035, "O": 15.99491463, "N": 14.003074, "C": 12.0, "S": 31.9720707, "P": 30.973762}
AVERAGE_ATOMS = {"H": 1.00794, "O": 15.9994, "N": 14.0067, "C": 12.0107, "S": 32.065, "P": 30.973761}
FORMULAS = {
    "A": "C3H5ON", "B": "C4H6O2N2", "C": "C3H5ONS", "D": "C4H5O3N", "E": "C5H7O3N", "F": "C9H9ON", "G": "C2H3ON", "H": "C6H7ON3",
    "I": "C6H11ON", "K": "C6H12ON2", "L": "C6H11ON", "M": "C5H9ONS", "N": "C4H6O2N2", "O": "C4H6O2N2", "P": "C5H7ON", "Q": "C5H8O2N2",
    "R": "C6H12ON4", "S": "C3H5O2N", "T": "C4H7O2N", "V": "C5H9ON", "W": "C11H10ON2", "Y": "C9H9O2N", "Z": "C5H8O2N2",
}
ODD_RESIDUES = {"U": 150.953640, "X": 111.060000, "J": 0.0}
CYSTEINE_SHIFT = 57.02146
PROTON = 1.00727646688
C_TERMINUS = 19.0178


def formula_mass(formula: str, average: bool = False) -> float:
    atoms = AVERAGE_ATOMS if average else ATOMS
    return sum(atoms[a] * int(n or 1) for a, n in re.findall(r"([A-Z])(\d*)", formula))


RESIDUES = {a: round(formula_mass(f) + (CYSTEINE_SHIFT if a == "C" else 0.0), 8) for a, f in FORMULAS.items()} | ODD_RESIDUES


def formula_mass_of(formula: Column, average: bool = False) -> Column:
    """Mass of a formula column such as C3H5ON; null stays null, an unknown atom gives null."""
    atoms = AVERAGE_ATOMS if average else ATOMS
    table = F.create_map(*[F.lit(v) for pair in atoms.items() for v in pair])
    parts = F.regexp_extract_all(formula, F.lit(r"([A-Z])(\d*)"), 0)

    def one(p: Column) -> Column:
        count = F.when(F.length(p) > 1, F.substring(p, 2, 9).cast("int")).otherwise(1)
        return F.element_at(table, F.substring(p, 1, 1)) * count

    return F.aggregate(parts, F.lit(0.0), lambda a, p: a + one(p))


def sequence_mass(sequence: Column) -> Column:
    """Sum of residue masses: per residue its count times its mass, so it stays one code-generated expression."""
    total = F.lit(0.0)
    for residue, mass in RESIDUES.items():
        if mass:
            total = total + (F.length(sequence) - F.length(F.replace(sequence, F.lit(residue), F.lit("")))) * F.lit(mass)
    return total


def sequence_mass_sql(sequence: str) -> str:
    """The same sum as SQL text."""
    return " + ".join(f"(length({sequence}) - length(replace({sequence}, '{r}', ''))) * {m!r}::DOUBLE" for r, m in RESIDUES.items() if m)


def matching_mass(mass: Column) -> Column:
    return mass + F.lit(C_TERMINUS)


def precursor_mass(mz: Column, charge: Column) -> Column:
    """M+H of a precursor; charge 0 or null counts as 1."""
    z = F.when(F.coalesce(charge, F.lit(0)) == 0, F.lit(1)).otherwise(charge)
    return (mz - F.lit(PROTON)) * z + F.lit(PROTON)


def residue_array(sequence: Column) -> Column:
    """Array of residue masses along a sequence."""
    table = F.create_map(*[F.lit(v) for pair in RESIDUES.items() for v in pair])
    return F.transform(F.filter(F.split(sequence, ""), lambda c: c != ""), lambda c: F.element_at(table, c))
