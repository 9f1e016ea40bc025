"""The search: groups, expectations, places, modifications and its report, against slow forms."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectraloom.functions.masses import C_TERMINUS, RESIDUES
from spectraloom.operators import digest as dg
from spectraloom.operators import expectation as ex
from spectraloom.operators import scoring as sc
from spectraloom.operators.partitioning import planned_groups
from spectraloom.plans.config import SearchConfig, from_keys
from spectraloom.plans.search import distinct_peptides, match_places, peptide_places, peptide_table, scorable_spectra, scoring_groups, search, search_to_pepxml, spectra_of
from spectraloom.sources import files as fs

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


@pytest.fixture(scope="module")
def proteins(spark):
    rng = random.Random(4)
    rows = [(f"p{i}", "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 400)))) for i in range(60)]
    shared = "AEPTMIDEAK"
    rows += [(f"s{i}", f"K{shared}{'G' * i}R") for i in range(40)] + [("none", None), ("empty", "")]
    return spark.createDataFrame(rows, "protein_id string, sequence string"), dict(rows)


def slow_places(proteins: dict, missed: int) -> Counter:
    out: Counter = Counter()
    for name, text in proteins.items():
        ends = [0, *(i + 1 for i in range(len(text or "")) if text[i] in "KR" and i + 1 < len(text) and text[i + 1] != "P"), len(text or "")]
        for a in range(len(ends) - 1):
            for b in range(a + 1, min(a + 2 + missed, len(ends))):
                if 4 <= ends[b] - ends[a] <= 40:
                    out[text[ends[a] : ends[b]], name, ends[a]] += 1
    return out


@pytest.mark.parametrize("missed", [0, 2])
def test_places_and_distinct_peptides(spark, proteins, missed):
    df, rows = proteins
    config = SearchConfig(missed_cleavages=missed)
    places = peptide_places(df, config)
    want = slow_places(rows, missed)
    assert sorted(map(tuple, places.collect())) == sorted(want)
    held: dict[str, list] = {}
    for s, p, at in sorted(want, key=lambda x: (x[0], x[1], x[2])):
        held.setdefault(s, []).append((p, at))
    got = {r.sequence: (r.protein, r.start, r.n_proteins, r.is_decoy) for r in distinct_peptides(places).collect()}
    assert got == {s: (*v[0], len({p for p, _ in v}), False) for s, v in held.items()}
    assert got["AEPTMIDEAK"][2] == 40
    semi = peptide_places(df, SearchConfig(semi=True)).collect()
    assert all(rows[r.protein_id][r.start : r.start + len(r.sequence)] == r.sequence for r in semi) and len(semi) > len(want) * 2


@pytest.mark.parametrize("mods", [["15.995@M"], ["16@M", "32@M", "1@["], ["42@[", "1@]", "80@S"]])
def test_placed_forms_are_those_of_the_slow_form(spark, mods):
    rng = random.Random(7)
    texts = ["".join(rng.choice("MSKAC") for _ in range(rng.randint(0, 8))) for _ in range(40)]
    fixed = ["57.021@C", "2@["]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id int, sequence string")
    counted = dg.counted_forms(df, mods, 3, fixed=fixed)
    got = Counter((r.id, r.modified, round(r.mod_delta, 3), r.n_mods) for r in dg.placed_forms(counted, mods, 3, fixed=fixed).collect())
    parse = dg.Modification.parse
    want = Counter((i, a, round(b, 3), n) for i, t in enumerate(texts) for a, b, n in dg.modified_forms(t, [parse(m) for m in mods], 3, [parse(m) for m in fixed]))
    assert got == want and len(want) > 100
    assert counted.count() < sum(want.values())  # masses are fewer than forms


def test_modified_decoys_only_if_asked(spark):
    p = spark.createDataFrame([("p", "AAMCDK"), ("q", "GGGGMGGR")], "protein_id string, sequence string")
    mods = {"modifications": ("15.995@M",), "decoys": True}
    plain, asked = (peptide_table(p, SearchConfig(modified_decoys=m, **mods)).collect() for m in (False, True))
    assert not any(r.is_decoy and "[" in r.sequence for r in plain) and any(r.is_decoy and "[" in r.sequence for r in asked)
    assert {r.sequence for r in plain if not r.is_decoy} == {r.sequence for r in asked if not r.is_decoy} and any("[" in r.sequence for r in plain)


def test_rules(spark):
    assert dg.cut_rule("[RK]|{P}") == dg.cut_rule("Trypsin") == ("RK", "P") and dg.cut_rule("lysC") == dg.cut_rule("[K]") == ("K", "")
    with pytest.raises(ValueError, match="no cut rule"):
        dg.cut_rule("[1]|{P}")
    assert (from_keys({"protein, cleavage site": "[KR]"}).cut_after, from_keys({"protein, cleavage site": "[KR]"}).not_before) == ("KR", "")
    df = spark.createDataFrame([("p", "AAAAKPAAAARAAAA")], "protein_id string, sequence string")
    for rule in ("trypsin", "lysC", "[A]|{K}", "[R]|{AP}"):
        after, not_before = dg.cut_rule(rule)
        for missed in (0, 1):
            kw = {"after": after, "not_before": not_before, "least": 1, "missed": missed}
            rows = dg.digest(df, starts=True, **kw).collect()
            assert Counter(r.sequence for r in rows) == Counter(r.sequence for r in dg.digest(df, **kw).collect())
            assert all("AAAAKPAAAARAAAA"[r.start :].startswith(r.sequence) for r in rows)
    x = spark.createDataFrame([("REV1_a",)], "l string")
    assert x.select(dg.normal_label(F.col("l"))).first()[0] == "DECOY_a"


def test_no_group_grows(spark):
    """25 and 2,500 spectra in each of 4,000 bins of one peptide, one bin with a third of both sides."""
    for each in (25, 2500):
        bins = spark.range(4000).select((F.col("id") - 50).alias("bin"), F.lit(each).cast("long").alias("n_s"), F.lit(1).cast("long").alias("n_p"))
        bins = bins.unionByName(spark.createDataFrame([(9999, 1500 * each, 200_000)], "bin long, n_s long, n_p long"))
        plan = planned_groups(bins, "bin", "n_s", "n_p", 500, 5000, 16).collect()
        assert len(plan) == 4001
        held: dict = {}
        for r in plan:
            for piece in [0] if r.salts * r.sections == 1 else range(1):
                g = held.setdefault((r.part, piece), [0, 0])
                g[0] += math.ceil(r.n_s / r.salts)
                g[1] += math.ceil(r.n_p / r.sections)
        assert max(s for s, _ in held.values()) <= 1000 and max(p for _, p in held.values()) <= 10_000
        assert each > 25 or len(held) < 600  # small bins are packed
    config = SearchConfig(group_spectra=40, group_rows=30)
    spectra = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).cast("long").alias("bin"))
    peptides = spark.range(2000).select(F.col("id").cast("string").alias("sequence"), F.lit(1.0).alias("matching_mass"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 300).cast("long").alias("bin"))
    groups = scoring_groups(peptides, spectra, config)
    for side in (groups.peptides, groups.spectra):
        sizes = [r["count"] for r in side.groupBy("part", "piece").count().collect()]
        assert max(sizes) <= 2 * 40 + 40
    met = groups.peptides.join(groups.spectra.join(spectra.withColumnRenamed("bin", "b"), "row"), ["part", "piece"]).where("bin = b").groupBy("row", "sequence").count()
    want = peptides.join(spectra, "bin").count()
    assert met.count() == want and met.agg(F.max("count")).first()[0] == 1


def slow_line(h: list[int]) -> tuple[float, float]:
    """The fit, step by step over lists."""
    top = max((i for i in range(len(h) - 1) if h[i] > 0), default=-1)
    end, found = 0, False
    for i in range(top):
        if h[i] == 0 and (h[i + 1] == 0 or i + 1 == top):
            end, found = max(i - 1, 0), True
            break
    if not found and top >= 0:
        end = top - 2 if top > 12 else top
    survival = [sum(h[i : end + 1]) for i in range(end + 1)]
    survival = [0 if i and h[i] == 0 else v for i, v in enumerate(survival)]
    start = int(end * 0.75) if end >= 30 else int(end * 0.5) if end >= 15 else 0
    slope = intercept = 0.0
    while start >= 0:
        points = [(i, math.log10(survival[i])) for i in range(start, end + 1) if survival[i] > 0]
        mx, my = (sum(p[k] for p in points) / len(points) if points else 0.0 for k in (0, 1))
        sx, sxy = sum((x - mx) ** 2 for x, y in points if y > 0), sum((x - mx) * (y - my) for x, y in points if y > 0)
        slope = sxy / sx if sx > 0 else 0.0
        intercept = my - slope * mx
        if slope < 0:
            break
        start -= 1
    return slope, intercept


def test_tail_line():
    rng = np.random.default_rng(3)
    for k in range(300):
        h = rng.poisson(rng.uniform(0.2, 200) * np.exp(-np.arange(rng.integers(1, 60)) * rng.uniform(0, 0.4))).tolist()
        assert ex.tail_regression(np.array(h)) == pytest.approx(slow_line(h)), (k, h)


@pytest.mark.parametrize(("spectra_most", "rows_most"), [(3, 5), (500, 5000)])
def test_expectations_are_those_of_all_candidates(spark, proteins, spectra_most, rows_most):
    df, _ = proteins
    config = SearchConfig(ppm=20_000, group_spectra=spectra_most, group_rows=rows_most, top=3)
    wanted = distinct_peptides(peptide_places(df, config)).where("n_proteins = 1 and length(sequence) between 7 and 9").select("sequence").orderBy("sequence").limit(25)
    spectra = spectra_of(wanted)
    got = search(df, spectra, config).collect()
    peptides = peptide_table(df, config).select("sequence", "matching_mass").collect()
    measured = scorable_spectra(spectra, config).collect()
    by_id: dict[str, list] = {}
    for r in got:
        by_id.setdefault(r.spectrum_id, []).append(r)
    assert len(measured) == 25 and max(len(v) for v in by_id.values()) == 3
    many = 0
    for s in measured:
        cells = sc.conditioned(np.array([p.mz for p in s.peaks]), np.array([p.intensity for p in s.peaks]))
        near = [p.sequence for p in peptides if abs(p.matching_mass - s.precursor_mass) < s.precursor_mass * config.ppm / 1e6]
        scores = {q: round(sc.xcorr(q, *cells, s.precursor_charge)[0], 9) for q in near}
        h = np.bincount([int(10 * x + 0.5) for x in scores.values()])
        slope, intercept = slow_line(h.tolist())
        best = sorted((q for q in near if scores[q] > config.score_floor), key=lambda q: (-scores[q], q))[:3]
        mine = sorted(by_id.get(s.spectrum_id, []), key=lambda r: r["rank"])
        assert [r.sequence for r in mine] == best
        for r in mine:
            assert r.xcorr == pytest.approx(scores[r.sequence]) and r.expect == pytest.approx(10 ** (intercept + 10 * slope * r.xcorr))
        many += len(near) > 10
    assert many > 10


def test_search_to_report_and_back(spark, proteins, tmp_path):
    df, rows = proteins
    wanted = spark.createDataFrame([("AEPTM[15.995]IDEAK",)], "sequence string")
    text, run, peaks = "AEPTMIDEAK", 0.0, []
    masses = [RESIDUES[c] + (15.995 if c == "M" else 0) for c in text]
    for m in masses[:-1]:
        run += m
        peaks += [(run + 1.00727646688, 100.0), (sum(masses) - run + C_TERMINUS, 100.0)]
    spectra = spark.createDataFrame([("a<b", (sum(masses) + C_TERMINUS + 1.00727646688) / 2, 2, sorted(peaks))], "spectrum_id string, precursor_mz double, precursor_charge int, peaks array<struct<mz:double,intensity:float>>")
    path = f"file://{tmp_path}/report.pep.xml"
    found = search_to_pepxml(df, spectra, path, SearchConfig(ppm=20, modifications=("15.995@M",), decoys=True)).collect()
    assert wanted.first()[0] in [r.sequence for r in found]
    got = fs.read_pepxml(spark, path).collect()
    assert len(got) == len(found)
    hit = next(r for r in got if r["rank"] == 1)
    first = next(r for r in found if r["rank"] == 1)
    assert (hit.spectrum, hit.peptide, hit.modified_peptide, hit.charge, hit.protein) == ("a<b", text, "AEPTM[15.995]IDEAK", 2, "s0")
    assert hit.xcorr == pytest.approx(first.xcorr, rel=1e-5) and hit.expect == pytest.approx(first.expect, rel=1e-4) and hit.neutral_mass == pytest.approx(first.precursor_mass - 1.00727646688, abs=1e-5)
    assert sorted(hit.alt_proteins) == sorted(f"s{i}" for i in range(1, 40)) and first.n_proteins == 40
    report = open(f"{tmp_path}/report.pep.xml").read()
    mass = re.search(r'<mod_aminoacid_mass position="5" mass="([0-9.]+)"/>', report)
    assert float(mass.group(1)) == pytest.approx(RESIDUES["M"] + 15.995, abs=1e-3)
    assert report.index("<spectrum_query") < report.index("<search_hit") < report.index("</search_hit>") < report.rindex("</spectrum_query>")


def test_places_of_matches_are_rows(spark, proteins):
    df, _ = proteins
    places = peptide_places(df, SearchConfig())
    found = spark.createDataFrame([("AEPTMIDEAK",)], "plain string")
    got = match_places(found, places).collect()
    assert len(got) == 40 and {r.start for r in got} == {1}


def test_empty_sides(spark, proteins):
    df, _ = proteins
    spectra = spectra_of(spark.createDataFrame([("AEPTMIDEAK",)], "sequence string"))
    assert search(df.limit(0), spectra).count() == 0 and search(df, spectra.limit(0)).count() == 0
