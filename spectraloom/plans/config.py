"""Search options: defaults, from a dict of keys, or from an XML parameter file."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.text import attribute
from spectraloom.operators.digest import cut_rule
from spectraloom.sources.files import element_rows


@dataclass(frozen=True)
class SearchConfig:
    ppm: float = 10.0
    missed_cleavages: int = 0
    cut_after: str = "KR"
    not_before: str = "P"
    modifications: tuple[str, ...] = ()
    fixed_modifications: tuple[str, ...] = ()
    max_modifications: int = 3
    decoys: bool = False
    modified_decoys: bool = False
    semi: bool = False
    least_peaks: int = 5
    most_charge: int = 4
    score_floor: float = 0.01
    top: int = 4
    max_proteins: int | None = None
    #: Spectra and peptides that one scoring group is planned for; a bin of more is split.
    group_spectra: int = 500
    group_rows: int = 5000


#: Keys of parameter files and the option each sets (fixed values).
KEYS = {
    "comet.mass_tolerance": "ppm", "scoring, maximum missed cleavage sites": "missed_cleavages", "residue, potential modification mass": "modifications",
    "residue, modification mass": "fixed_modifications",
    "scoring, include reverse": "decoys", "protein, cleavage semi": "semi", "spectrum, minimum peaks": "least_peaks", "spectrum, maximum parent charge": "most_charge",
}

#: Key of the cut rule, such as [RK]|{P} (fixed value).
CUT_RULE = "protein, cleavage site"


def from_keys(values: dict[str, str], base: SearchConfig | None = None) -> SearchConfig:
    """Unknown keys are ignored; yes and no are booleans; lists are comma-separated."""
    out = {}
    if rule := values.get(CUT_RULE):
        out["cut_after"], out["not_before"] = cut_rule(rule)
    types = {f.name: f.type for f in fields(SearchConfig)}
    for key, value in values.items():
        name = KEYS.get(key, key)
        kind = types.get(name)
        if kind is None:
            continue
        if kind == "bool":
            out[name] = value.strip().lower() in ("yes", "true", "1")
        elif kind.startswith("tuple"):
            out[name] = tuple(v.strip() for v in value.split(",") if v.strip())
        else:
            out[name] = float(value) if kind == "float" else int(value) if kind.startswith("int") else value
    return replace(base or SearchConfig(), **out)


def from_xml(spark: SparkSession, path: str) -> SearchConfig:
    """A parameter file of note elements with a label each."""
    notes = element_rows(spark, path, "note").select(attribute(F.col("element"), "label").alias("k"), F.regexp_extract("element", "(?s)<note[^>]*>(.*)</note>", 1).alias("v"))
    return from_keys({r.k: r.v for r in notes.where("k is not null").collect()})
