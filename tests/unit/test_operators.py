"""Operators on small tables: invariance to salts and partitions, ties, nulls and empty inputs."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectraloom.operators import aggregates as ag
from spectraloom.operators import digest as dg
from spectraloom.operators import expectation as ex
from spectraloom.operators import filters as fl
from spectraloom.operators import joins as jn
from spectraloom.operators import partitioning as pt
from spectraloom.operators import scoring as sc
from spectraloom.operators import windows as wn


def test_index_is_global(spark):
    df = spark.range(0, 1000, 1, 7).select((F.lit(1000) - F.col("id")).alias("v"))
    got = {r.v: r.idx for r in fl.with_index(df, ["v"]).collect()}
    assert got == {v: v - 1 for v in range(1, 1001)}
    assert fl.with_index(df.limit(0), ["v"]).count() == 0


def test_predicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "x int, id string")
    assert [r.x for r in fl.with_real_id(df, "id").collect()] == [1]
    assert df.where(fl.all_of()).count() == 3 and df.where(fl.any_of()).count() == 3
    assert df.where(fl.any_of(F.col("x") == 1, F.col("x") == 3)).count() == 2
    s = spark.createDataFrame([("PEPTIDE",), ("PEP",), ("PEPTIDEX",), ("A" * 41,)], "s string")
    assert [r.s for r in s.where(fl.valid_peptide(F.col("s"))).collect()] == ["PEPTIDE"]


def test_hashed_fraction_does_not_depend_on_layout(spark):
    a = fl.hashed_fraction(spark.range(1000).toDF("k"), "k", 0.3)
    b = fl.hashed_fraction(spark.range(0, 1000, 1, 13).toDF("k"), "k", 0.3)
    assert {r.k for r in a.collect()} == {r.k for r in b.collect()} and 200 < a.count() < 400


@pytest.mark.parametrize("ppm", [1.0, 50.0, 2000.0])
def test_ppm_join_is_the_theta_join(spark, ppm):
    rng = random.Random(1)
    mass = [rng.uniform(500, 520) for _ in range(300)] + [None, 0.0, -3.0]
    left = spark.createDataFrame([(i, m) for i, m in enumerate(mass)], "a long, m double")
    right = spark.createDataFrame([(i, m) for i, m in enumerate(reversed(mass))], "b long, p double")
    want = {(i, j) for i, m in enumerate(mass) for j, p in enumerate(reversed(mass)) if m and p and m > 0 and p > 0 and abs(m - p) < p * ppm / 1e6}
    assert {(r.a, r.b) for r in jn.ppm_join(left, right, "m", "p", ppm).collect()} == want


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_salting_changes_nothing(spark, most):
    hot = spark.createDataFrame([(i, i % 3 if i % 2 else 0) for i in range(60)] + [(99, None)], "i long, k int")
    other = spark.createDataFrame([(j, j % 4) for j in range(12)], "j long, k int")
    plain = sorted((r.i, r.j) for r in hot.join(other, "k").collect())
    assert sorted((r.i, r.j) for r in jn.salted_join(hot, other, "k", F.xxhash64("i"), most).collect()) == plain


def test_containing(spark):
    p = spark.createDataFrame([(1, "MKPEPTIDEKAAA"), (2, "AAAA"), (3, None)], "p long, s string")
    w = spark.createDataFrame([("PEPTIDE",), ("AAAA",), ("XX",)], "w string")
    assert sorted((r.p, r.w) for r in jn.containing(p, w, "p", "s", "w").distinct().collect()) == [(1, "PEPTIDE"), (2, "AAAA")]


def test_top_matches_ties_and_merge_order(spark):
    rows = [("s", "B", 2.0), ("s", "A", 2.0), ("s", "C", 1.0), ("s", "A", 3.0), ("s", "D", 1e-9), ("t", "Z", 0.5)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, item string, score double").repartition(4)
        got = sorted((r.k, r.rank, r.item) for r in ag.top_matches(df, "k", "score", "item", 2).collect())
        assert got == [("s", 1, "A"), ("s", 2, "B"), ("t", 1, "Z")]


def test_statistics_of_few_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", -2.0), ("b", -4.0), ("c", None)], "k string, v double")
    got = {r.k: r for r in ag.statistics(df, ["k"], "v").collect()}
    assert got["a"].sd is None and got["a"].sd_pop == 0.0 and got["b"].most == -2.0 and got["c"].n == 0 and got["c"].mean is None
    r = {r.k: r for r in ag.regression(df.withColumn("x", F.col("v") * 2), ["k"], "v", "x").collect()}
    assert (r["a"].slope, r["c"].slope) == (0.0, 0.0) and r["b"].slope == pytest.approx(0.5) and r["b"].correlation == pytest.approx(1.0)


def test_packed_parts_keep_their_limits(spark):
    rng = random.Random(2)
    bins = spark.createDataFrame([(i, rng.randint(1, 40)) for i in range(500)], "b long, w long")
    parts = defaultdict(list)
    for r in pt.packed_bins(bins, "b", "w", 50, 20, lanes=4).collect():
        parts[r.part].append(r.w)
    assert sum(map(len, parts.values())) == 500
    assert all(len(p) <= 20 and sum(p) - min(p) <= 50 + 40 for p in parts.values())


def test_observed_counters(spark):
    df, seen = ag.observed(spark.range(10).toDF("x"), "run", even=F.col("x") % 2 == 0)
    df.collect()
    assert seen.get == {"n_rows": 10, "even": 5}


def test_digest(spark):
    p = spark.createDataFrame([(1, "MKRPAAKKLRWKP"), (2, ""), (3, None)], "protein_id long, sequence string")
    got = [r.sequence for r in dg.digest(p, least=1).collect()]
    assert got == ["MK", "RPAAK", "K", "LR", "WKP"]
    one = sorted(r.sequence for r in dg.digest(p, missed=1, least=1).where("missed_cleavages = 1").collect())
    assert one == sorted(["MKRPAAK", "RPAAKK", "KLR", "LRWKP"])
    assert [r.sequence for r in dg.digest(p, least=1, after="K", not_before="").collect()] == ["MK", "RPAAK", "K", "LRWK", "P"]
    semi = spark.createDataFrame([("PEPTIDEK",)], "sequence string")
    assert sorted(r.semi for r in dg.semi_peptides(semi, least=6).collect()) == sorted(["PEPTIDEK", "PEPTID", "PEPTIDE", "PTIDEK", "EPTIDEK"])
    n = spark.createDataFrame([("AKRPLK", 1, False), ("AKBRC", 2, True)], "s string, n int, semi boolean")
    assert all(r.n == r.m and r.semi == r.q for r in n.select("*", dg.missed_cleavages(F.col("s")).alias("m"), dg.probably_semi(F.col("s")).alias("q")).collect())


def test_decoys_and_labels(spark):
    p = spark.createDataFrame([(1, "ABC")], "protein_id long, sequence string")
    assert [(r.protein_id, r.sequence, r.is_decoy) for r in dg.decoys(p).collect()] == [("1", "ABC", False), ("DECOY_1", "CBA", True)]
    x = spark.createDataFrame([("REV_a",), ("###REV###b",), ("c",)], "l string")
    assert [r[0] for r in x.select(dg.normal_label(F.col("l"))).collect()] == ["DECOY_a", "DECOY_b", "c"]


def test_modifications(spark):
    forms = {(a, round(b, 3), n) for a, b, n in dg.modified_forms("AMMK", [dg.Modification.parse("15.995@M"), dg.Modification.parse("1.0@]")], 2)}
    assert ("AMMK", 0, 0) in forms and ("AM[15.995]M[15.995]K", 31.99, 2) in forms and ("AM[15.995]MK[1.000]", 16.995, 2) in forms
    assert len(forms) == 1 + 3 + 3 and all(n <= 2 for *_, n in forms)
    df = dg.modify(spark.createDataFrame([("MK",), (None,)], "sequence string"), ["15.995@M"])
    assert sorted(r.modified for r in df.collect()) == ["MK", "M[15.995]K"] or sorted(r.modified for r in df.collect()) == ["M[15.995]K", "MK"]


def test_conditioning_against_slow_form():
    rng = np.random.default_rng(1)
    mz, intensity = np.sort(rng.uniform(150, 160, 40)), rng.uniform(0, 50, 40)
    bins, plain, loss = sc.conditioned(mz, intensity)
    raw: dict[int, float] = {}
    for m, i in zip(mz, intensity, strict=True):
        b = int(m / sc.BIN_WIDTH + 1)
        raw[b] = max(raw.get(b, 0), i**0.5)
    top, last = max(raw.values()), max(raw)
    raw = {b: v * 100 / top for b, v in raw.items()}
    width = last // 10 + 1
    most = {w: max(v for b, v in raw.items() if b // width == w) for w in {b // width for b in raw}}
    peaks = {b: v * 50 / most[b // width] for b, v in raw.items() if v > 5}
    want = lambda b: peaks.get(b, 0) - sum(v for x, v in peaks.items() if 0 < abs(x - b) <= 75) / 150
    for b, p, n in list(zip(bins, plain, loss, strict=True))[::37]:
        assert p == pytest.approx(want(b), abs=1e-9)
        assert n == pytest.approx(want(b) + 0.2 * (want(b - int(sc.WATER / 0.02 + 1)) + want(b - int(sc.AMMONIA / 0.02 + 1))), abs=1e-9)
    assert all(len(x) == 0 for x in sc.conditioned(mz, 0 * intensity))


def test_ions(spark):
    got = {(r.ion, r.position, r.ion_charge): r.mz for r in sc.ions(spark.createDataFrame([("GAK",)], "sequence string"), charges=2).collect()}
    g, a, k = (sc.RESIDUES[c] for c in "GAK")
    assert len(got) == 8
    assert got["b", 1, 1] == pytest.approx(g + sc.PROTON) and got["y", 1, 1] == pytest.approx(k + sc.C_TERMINUS)
    assert got["y", 2, 2] == pytest.approx((a + k + sc.C_TERMINUS + sc.PROTON) / 2)


def test_two_forms_of_the_score_agree(spark):
    from spectraloom.plans.search import scorable_spectra, spectra_of
    from spectraloom.plans.config import SearchConfig

    seqs = ["PEPTIDEK", "ACDEFGHK", "WWLLMMNNR"]
    s = scorable_spectra(spectra_of(spark.createDataFrame([(x,) for x in seqs], "sequence string")), SearchConfig())
    pairs = s.select("spectrum_id", F.explode(F.array(*map(F.lit, seqs))).alias("sequence"), "precursor_charge")
    joined = {(r.spectrum_id, r.sequence): (r.xcorr, r.matched_ions) for r in sc.xcorr_joined(pairs, sc.condition(s)).collect()}
    for r in sc.condition(s).collect():
        for q in seqs:
            score, used = sc.xcorr(q, np.array(r.bins), np.array(r.plain), np.array(r.loss), r.precursor_charge)
            if used:
                assert joined[r.spectrum_id, q][0] == pytest.approx(score, abs=1e-6) and joined[r.spectrum_id, q][1] == used


def test_k_score_counts_a_bin_once(spark):
    theory = spark.createDataFrame([("s", "ABCD", 100.2), ("s", "ABCD", 101.2), ("s", "ABCD", 300.0)], "spectrum_id string, sequence string, mz double")
    peaks = spark.createDataFrame([("s", 100.2, 10.0), ("s", 299.0, 4.0)], "spectrum_id string, mz double, intensity double")
    r = sc.k_score(theory, peaks).first()
    assert r.dot == pytest.approx(10 + 2) and r.k_score == pytest.approx(12 * sc.length_factor(4))


def slowly_normalised(peaks, mz, z, n=50):
    """The steps of conditioning one peak at a time; None if the spectrum is not to be scored."""
    mass = (mz - 1.00727646688) * z + 1.00727646688
    kept = []
    for m, i in sorted((m, i) for m, i in peaks if m > 150 and i > 0):
        if kept and m < kept[-1][0] + 0.95:
            if i >= kept[-1][1]:
                kept[-1] = (m, i)
        else:
            kept.append((m, i))
    kept = [(m, i) for m, i in kept if (m == mz or abs(m - mz) >= 2 / z) and m < 6000]
    top = max((i for _, i in kept), default=1)
    kept = [(m, i * 100 / top) for m, i in kept if i * 100 / top >= 1]
    if len(kept) < 5 or not 150 <= mass <= 6000 or z > 4 or not any(m > (mass - 600 if z < 3 else mass / z) for m, _ in kept):
        return None
    out, first = [], None
    for m, i in kept:
        if out and m - first < 1.5 and m > 200:
            if i > out[-1][1]:
                out[-1] = (m, i)
        else:
            out.append((m, i))
            first = m
    return sorted(sorted(out, key=lambda p: (-p[1], p[0]))[:n])


def test_normalised_peaks(spark):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        z, mz = rng.randint(1, 5), rng.choice([260.0, 350.0, 900.0, 40.0, 6100.0])
        ms = sorted({rng.randint(1000, 5500) / 10 for _ in range(rng.choice([0, 3, 12, 90, 400]))} | ({mz} if rng.random() < 0.3 else set()))
        rows.append((k, mz, z, [(m, float(rng.choice([0, 1, 5, 5, 20, 90, 300]))) for m in ms]))
    df = spark.createDataFrame(rows, "k int, mz double, z int, peaks array<struct<mz:double,intensity:float>>")
    got = {r.k: r.p for r in df.select("k", sc.normalised_peaks(F.col("peaks"), F.col("mz"), F.col("z"), n=40).alias("p")).collect()}
    scored = 0
    for k, mz, z, peaks in rows:
        want = slowly_normalised(peaks, mz, z, 40)
        assert (got[k] is None) == (want is None), k
        if want is not None:
            scored += 1
            assert [(p.mz, round(p.intensity, 6)) for p in got[k]] == [(m, round(i, 6)) for m, i in want], k
    assert 30 < scored < 270


def test_hit_ranks(spark):
    df = spark.createDataFrame([("s", "A", 4.0), ("s", "B", 2.0), ("t", "C", 1.0)], "k string, i string, v double")
    got = {r.i: (r.rank, r.delta_cn, r.delta_cn_star) for r in wn.hit_ranks(df, "k", "v", "i").collect()}
    assert got == {"A": (1, 0.5, 0.0), "B": (2, 0.0, 0.0), "C": (1, 0.0, 0.0)}


def test_score_fit_against_numpy(spark):
    rng = np.random.default_rng(3)
    scores = rng.exponential(150, 3000)
    df = spark.createDataFrame([("k", float(s)) for s in scores] + [("few", 10.0)], "k string, s double")
    got = {r.k: r for r in ex.score_fit(df, "k", "s").collect()}
    assert (got["few"].slope, got["few"].intercept) == (ex.SLOPE, ex.INTERCEPT)
    bins = (scores * 0.05 + 0.5).astype(int)
    h = np.bincount(bins)
    sums = h[::-1].cumsum()[::-1]
    value = sums - sums[-1]
    value[-1] = sums[-1]
    use = (value >= 10) & (value <= int(0.5 + value[0] / 2))
    slope, intercept = np.polyfit(np.flatnonzero(use), np.log10(value[use]), 1)
    assert got["k"].slope == pytest.approx(slope) and got["k"].intercept == pytest.approx(intercept)


def test_tail_regression():
    h = np.round(1000 * 10 ** (-0.4 * np.arange(8))).astype(int)
    slope, intercept = ex.tail_regression(h)
    assert slope < 0 and intercept > 0
    assert ex.tail_regression(np.zeros(5)) == (0.0, 0.0)


def test_fdr(spark):
    df = spark.createDataFrame([(100.0, False), (100.0, False), (10.0, True), (1.0, False), (0.0, True)], "s double, d boolean")
    rows = sorted((r.bin, r.targets, r.decoys, round(r.fdr, 4), round(r.q, 4)) for r in ex.fdr_curve(df, "s", "d").collect())
    assert [r[1:] for r in rows] == [(3, 1, 0.25, 0.25), (2, 1, 0.3333, 0.25), (2, 0, 0.0, 0.0)]
    assert ex.fdr_curve(df.limit(0), "s", "d").count() == 0


def test_persist_size_and_chain(spark):
    df, n = pt.persisted(spark.range(10))
    assert n == 10 and pt.persisted(spark.range(3), on=False)[1] == 3
    assert pt.sized(spark.range(100).repartition(10), 100, 50).rdd.getNumPartitions() == 2
    assert pt.chained(df, [lambda d: d.where("id > 3"), lambda d: d.where("id < 6")]).count() == 2
    assert {r.n for r in pt.join_stress(spark, 5, 20).collect()} == {400}


def test_fixed_and_terminal_modifications():
    parse = dg.Modification.parse
    forms = {(a, round(b, 3), n) for a, b, n in dg.modified_forms("CMK", [parse("16@M"), parse("1@]")], 2, [parse("57@C"), parse("2@[")])}
    assert forms == {("C[59.000]MK", 59.0, 0), ("C[59.000]M[16.000]K", 75.0, 1), ("C[59.000]MK[1.000]", 60.0, 1), ("C[59.000]M[16.000]K[1.000]", 76.0, 2)}


def test_search_finds_a_modified_peptide(spark):
    from spectraloom.functions.masses import RESIDUES
    from spectraloom.plans.config import SearchConfig
    from spectraloom.plans.search import search

    text = "AEPTMIDEAK"
    masses = [RESIDUES[c] + (15.995 if c == "M" else 0) for c in text]
    total, run, peaks = sum(masses), 0.0, []
    for m in masses[:-1]:
        run += m
        peaks += [(run + 1.00727646688, 100.0), (total - run + 18.010565 + 1.00727646688, 100.0)]
    proteins = spark.createDataFrame([("p", "AAAAAK" + text + "GGGGGGR"), ("q", "VVVVVVVK")], "protein_id string, sequence string")
    spectra = spark.createDataFrame([("s", (total + 18.010565 + 2 * 1.00727646688) / 2, 2, sorted(peaks))], "spectrum_id string, precursor_mz double, precursor_charge int, peaks array<struct<mz:double,intensity:float>>")
    assert search(proteins, spectra, SearchConfig(ppm=20)).count() == 0
    best = search(proteins, spectra, SearchConfig(ppm=20, modifications=("15.995@M",))).collect()
    assert [(r.sequence, r.matched_ions, r.proteins) for r in best] == [("AEPTM[15.995]IDEAK", 18, ["p"])]


def test_hot_keys_are_split_and_others_are_not(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), "id")
    assert [(r.k, r._n) for r in jn.hot_splits(hot, "k", 30).collect()] == [(1, 67)]
    other = spark.createDataFrame([(1, "a"), (1, "b"), (2500, "c"), (9999, "d")], "k long, v string")
    got = jn.salted_join(hot, other, "k", F.xxhash64("id"))
    assert got.count() == 4001 and got.distinct().count() == 4001


def test_sections_of_a_hot_key(spark):
    rows = [(1, i) for i in range(950)] + [(2, i) for i in range(30)] + [(None, i) for i in range(15)]
    got = jn.sections(spark.createDataFrame(rows, "k int, i int").repartition(5), "k", ["i"], 100).collect()
    assert sorted((r.k or 0, r.i, r.section) for r in got) == sorted((k or 0, i, i // 100) for k, i in rows)


def test_work_items_and_scans(spark):
    p = spark.createDataFrame([(100.5,)] * 25 + [(101.2,)], "m double")
    items = jn.work_items(p, "m", 10)
    assert sorted(r.item for r in items.collect()) == ["100:0:10", "100:10:20", "100:20:25", "101:0:1"]
    scans = spark.createDataFrame([("a", 50.3, None), ("b", 50.3, 1), ("c", 50.3, 2)], "s string, mz double, z0 int")
    got = jn.scan_items(scans, items, "mz", "z0", 0.2, 0.5)
    assert sorted((r.s, r.z, r.item) for r in got.collect()) == sorted((s, 2, x) for s in "ac" for x in ["100:0:10", "100:10:20", "100:20:25", "101:0:1"])


def test_nearest_line(spark):
    from spectraloom.functions.text import similarity

    rows = [(c, i, t) for c in (1, 2) for i, t in enumerate(["straße groß", "strasse gross", "étude", "etude", "", "Straße groß"])]
    got = jn.nearest_line(spark.createDataFrame(rows, "c int, i int, t string"), "c", "i", "t", similarity, 3).collect()

    def distance(a: str, b: str) -> int:
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for r in got:
        scores = {}
        for c, i, t in rows:
            if c == r.c and i != r.line and abs(i - r.line) <= 3:
                own = next(x for cc, ii, x in rows if cc == c and ii == r.line)
                n = max(len(own), len(t))
                scores[i] = (n - distance(own.lower(), t.lower())) / n if n else 1.0
        best = max(scores.values())
        assert abs(r.best_score - best) < 1e-9 and r.best_line == min(i for i, v in scores.items() if v == best)
