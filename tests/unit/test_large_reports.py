"""Reports whose peptides stand in very many proteins, and peptides told apart by mass where they are cut."""

import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spectraloom.functions.bins import ratio_bin
from spectraloom.functions.masses import matching_mass, sequence_mass
from spectraloom.operators import digest as dg
from spectraloom.plans.config import SearchConfig
from spectraloom.plans.search import candidate_places, peptide_places
from spectraloom.sources.files import read_pepxml


def element(spectrum, alternatives):
    hit = f'<search_hit hit_rank="1" peptide="AAAK" protein="P" massdiff="0.5">{alternatives}<search_score name="xcorr" value="1.5"/></search_hit>'
    return f'<spectrum_query spectrum="{spectrum}" start_scan="1" precursor_neutral_mass="400.5" assumed_charge="2"><search_result>{hit}</search_result></spectrum_query>\n'


def test_one_hit_of_very_many_proteins(spark, tmp_path):
    path = str(tmp_path / "many.pep.xml")
    n = 250_000
    with open(path, "w") as f:
        f.write("<msms>\n" + element("a", "\n".join(f'<alternative_protein protein="P{i}"/>' for i in range(n))) + element("b", "") + "</msms>\n")
    t = time.time()
    rows = read_pepxml(spark, path)
    got = {r.spectrum: (r.n, r.first, r.last, r.xcorr) for r in rows.select("spectrum", F.size("alt_proteins").alias("n"), F.get("alt_proteins", F.lit(0)).alias("first"), F.get("alt_proteins", F.lit(n - 1)).alias("last"), "xcorr").collect()}
    assert got == {"a": (n, "P0", f"P{n - 1}", 1.5), "b": (0, None, None, 1.5)}
    assert time.time() - t < 20  # by copies of the list so far it takes minutes


def test_alternatives_of_any_form_in_order(spark, tmp_path):
    path = str(tmp_path / "forms.pep.xml")
    forms = [
        '<alternative_protein protein="A/1" protein_descr="x > y"/>', "<alternative_protein num_tol_term='2' protein='B&amp;2'></alternative_protein>", '<alternative_protein\nprotein="C"\n/>',
        '<alternative_protein protein="D"><parameter name="p" value="/"/></alternative_protein >', "<alternative_protein protein='E \"e\"'/>",
    ]
    want = ["A/1", "B&2", "C", "D", 'E "e"']
    with open(path, "w") as f:
        f.write("<msms>\n" + element("a", " ".join(forms * 150)) + element("b", "<!-- aside -->".join(forms)) + element("c", forms[2]) + "</msms>\n")
    got = {r.spectrum: r.alt_proteins for r in read_pepxml(spark, path).collect()}
    assert got == {"a": want * 150, "b": want, "c": ["C"]}


def test_an_element_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "one.pep.xml")
    with open(path, "w") as f:
        f.write("<msms>\n" + element("AAAK", '<alternative_protein protein="Q"/>') + "</msms>\n")
    rows = read_pepxml(spark, path).where("peptide = spectrum").select("spectrum", F.size("alt_proteins"), "xcorr")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1
    assert rows.collect() == [("AAAK", 1, 1.5)]


def test_peptides_of_other_masses_do_not_leave_the_cutting_task(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ACDEFGHIKLMNPQRSTVWY"), size=400)) for _ in range(60)] + ["", "K", "PEPTIDEK"]
    proteins = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "protein_id string, sequence string")
    for config in (SearchConfig(), SearchConfig(semi=True), SearchConfig(decoys=True, missed_cleavages=1)):
        all_ = peptide_places(proteins, config).withColumn("bin", ratio_bin(matching_mass(sequence_mass(F.col("sequence"))), config.ppm))
        used = all_.where(F.pmod(F.xxhash64("sequence"), F.lit(5)) == 0).select("bin").distinct()
        kept = candidate_places(proteins, used, config)
        assert "replace" not in kept._jdf.queryExecution().optimizedPlan().toString()
        want = Counter(map(tuple, all_.join(used, "bin", "left_semi").select("sequence", "protein_id", "start").collect()))
        got = Counter(map(tuple, kept.collect()))
        assert not want - got and (got - want).total() <= 2  # one at a border may stay
        assert 0 < got.total() < all_.count()
    assert candidate_places(proteins, used.where("false"), SearchConfig()).count() == 0


def test_a_mass_at_the_border_of_bins_is_kept():
    ppm, mass = 10.0, dg.BYTE_MASS[[ord(c) for c in "PEPTIDEK"]].sum() + dg.C_TERMINUS
    own = int(np.floor(np.log(mass) / np.log1p(2 * ppm / 1e6)))
    texts = pa.array(["", "PEPTIDEK", "GGGGK", ""]).slice(1)
    assert dg.near_bins(np.array([own]), ppm)(texts).tolist() == [True, False, False]
    assert dg.near_bins(np.array([own + 1]), ppm)(texts).tolist() == [False, False, False]
    # so narrow that sums in another order fall beside: the bin and its neighbours within the error count
    narrow = 1e-7
    at = int(np.floor(np.log(mass * (1 - dg.SUM_ERROR)) / np.log1p(2 * narrow / 1e6)))
    assert dg.near_bins(np.array([at]), narrow)(texts).tolist()[0]
