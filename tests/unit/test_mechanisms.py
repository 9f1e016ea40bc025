"""Placement, pruning, observed counters, stored tables, one-file writes and shared objects."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from spectraloom.functions import staging as sg
from spectraloom.operators import expectation as ex
from spectraloom.operators import joins as jn
from spectraloom.operators import partitioning as pt
from spectraloom.operators import windows as wn
from spectraloom.sinks import reports as rp
from spectraloom.sinks.peptide_store import manifest, read_store, update_store
from spectraloom.sources import files as fs


def test_parts_lie_in_their_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("part"), "id").repartition(7)
    got = pt.placement(pt.placed(df, "part", 9), "part").collect()
    assert {(r.part, r.n, r.n_placed, r.n_partitions) for r in got} == {(i, 200, 200, 1) for i in range(5)}
    odd = spark.createDataFrame([(None, 1), (12, 2), (-1, 3)], "part long, id long")
    assert {r.id: r.p for r in pt.placed(odd, "part", 9).withColumn("p", F.spark_partition_id()).collect()} == {1: 0, 2: 3, 3: 8}


def test_job_by_partition_function_equals_the_plain_one(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.randint(0, 40), rng.random()) for _ in range(500)], "k long, v double").repartition(6)
    mapper = lambda b: b.assign(n=1)
    reducer = lambda k, b: pd.DataFrame({"k": [k[0]], "n": [b["n"].sum()], "low": [b["v"].min()]})
    given = []
    args = (df, mapper, "k long, v double, n long", reducer, "k long, n long, low double", "k")
    plain = sorted(map(tuple, pt.map_reduce(*args).collect()))
    placed = pt.map_reduce(*args, parts=3, partition=F.col("k") * 7, consumers=[lambda d: given.append(d.count()), lambda d: given.append(d.columns)])
    assert sorted(map(tuple, placed.collect())) == plain and given == [len(plain), ["k", "n", "low"]]
    assert pt.map_reduce(df.limit(0), *args[1:], parts=3, partition=F.col("k")).count() == 0


def test_one_file_at_offsets(spark, tmp_path, monkeypatch):
    folder = tmp_path / "a b%20ü"
    folder.mkdir()
    path = f"{folder}/out.txt"
    rows = spark.range(0, 3000, 1, 11).select(F.concat(F.format_string("%05d", "id"), F.lit("ß" * 50)).alias("t"))
    want = "<h>\n" + "".join(f"{i:05d}{'ß' * 50}\n" for i in range(3000)) + "</h>\n"
    for _ in range(2):  # the second time over a file that is there
        rp.write_one_file(rows, "t", path, "<h>\n", "</h>\n")
        assert open(path, encoding="utf-8").read() == want
    rp.write_one_file(rows.limit(3), "t", path)
    assert open(path, encoding="utf-8").read() == "".join(f"{i:05d}{'ß' * 50}\n" for i in range(3))
    assert sorted(os.listdir(folder)) == ["out.txt"]
    # file systems that can't write at an offset: the driver's stream gives the same bytes
    monkeypatch.setattr(rp, "_local", lambda fs, p: None)
    rp.write_one_file(rows, "t", path, "<h>\n", "</h>\n")
    assert open(path, encoding="utf-8").read() == want


@pytest.mark.parametrize("k", [4, 6])
def test_automaton_and_seeds_agree(spark, k):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("AKRP") for _ in range(rng.randint(0, 80)))) for i in range(60)] + [(90, None), (91, ""), (92, "AAAAAAAAAAAA")]
    wanted = sorted({"".join(rng.choice("AKRP") for _ in range(rng.randint(1, 9))) for _ in range(80)} | {"AAAA", "AAAAA", "AAAAAAAA"})
    p = spark.createDataFrame(texts, "p long, s string")
    w = spark.createDataFrame([(x,) for x in [*wanted, *wanted[:3], None]], "w string")
    want = sorted((i, x) for i, t in texts for x in wanted if t and len(x) >= k and x in t)
    for sent in (1 << 20, 0):
        assert sorted(map(tuple, jn.containing(p, w, "p", "s", "w", k, sent=sent).collect())) == want
    assert jn.containing(p, w.limit(0), "p", "s", "w").count() == 0


def test_folders_are_pruned_by_what_the_spectra_ask_for(spark, tmp_path):
    path = f"file://{tmp_path}/sections"
    peptides = spark.range(2000).select(F.col("id").cast("string").alias("sequence"), (F.col("id") * 1.0).alias("m"))
    jn.write_mass_sections(peptides, path, "m", 50.0)
    stored = spark.read.parquet(path)
    spectra = spark.range(100).select("id", (F.col("id") * 20.0 + 0.5).alias("precursor")).where("precursor between 300 and 400")
    met = jn.pruned_mass_join(stored, spectra, "precursor", 3, 3, 50.0)
    assert "dynamicpruning" in met._jdf.queryExecution().executedPlan().toString().lower()
    want = {(i, str(m)) for i in range(100) if 300 <= i * 20 + 0.5 <= 400 for m in range(2000) if (i * 20 + 0.5 - 3) // 50 <= m // 50 <= (i * 20 + 0.5 + 3) // 50}
    assert {(r.id, r.sequence) for r in met.collect()} == want


def test_deciles_are_those_of_ntile(spark):
    for n in (0, 3, 10, 97):
        rng = random.Random(n)
        df = spark.createDataFrame([(i, float(rng.randint(0, 20))) for i in range(n)], "id long, v double").repartition(4)
        got = {r.id: r.tile for r in jn.tiled(df, ["v", "id"], 10, n).collect()} if n else {}
        order = [r.id for r in df.orderBy("v", "id").collect()]
        each, more = divmod(n, 10)
        sizes = [each + (t < more) for t in range(10)]
        want, at = {}, 0
        for t, s in enumerate(sizes, 1):
            want |= dict.fromkeys(order[at : at + s], t)
            at += s
        assert got == want
    a = spark.createDataFrame([(i, "x" if i % 2 else "y", 10.0 + i) for i in range(40)], "id long, item string, score double")
    b = spark.createDataFrame([(i, "x", 100.0 - i) for i in range(5, 60)], "id long, item string, score double")
    out = jn.decile_agreement(a, b, "id", "item", "score").collect()
    assert sorted(r.decile for r in out) == list(range(1, 11)) and sum(r.n for r in out) == 35 and sum(r.n_same for r in out) == 18
    assert jn.decile_agreement(a, b.limit(0), "id", "item", "score").count() == 0


def mgf(bad: int) -> str:
    blocks, left = [], bad
    for i in range(50):
        here = min(left, 50)
        left -= here
        blocks.append(f"BEGIN IONS\nTITLE=s{i}\nPEPMASS=500.5\n" + "100.5 3\n200.25 4\n" + "what is this\n" * here + "END IONS\n")
    return "".join(blocks)


def test_budget_of_bad_lines(spark, tmp_path):
    for bad, fails in ((0, False), (2000, False), (2001, True)):
        path = tmp_path / f"{bad}.mgf"
        path.write_text(mgf(min(bad, 2000)).replace("TITLE=s49\n", "TITLE=s49\noops\n" if bad > 2000 else "TITLE=s49\n"))
        if fails:
            with pytest.raises(ValueError, match="2001 lines"):
                fs.read_mgf_within(spark, f"file://{path}")
        else:
            stored, counts = fs.read_mgf_within(spark, f"file://{path}")
            assert counts == {"n_spectra": 50, "n_peaks": 100, "n_bad": bad} and stored.count() == 50


def test_store_follows_its_proteins(spark, tmp_path):
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randint(20, 120)))
    first = {f"p{i}": text() for i in range(80)}
    table = lambda d: spark.createDataFrame(list(d.items()), "protein_id string, sequence string")
    path, whole = f"file://{tmp_path}/store", f"file://{tmp_path}/whole"
    rows = lambda p, *a: sorted(map(tuple, read_store(spark, p, *a).collect()))
    built = update_store(table(first), path)
    assert built.changed_proteins == 80 and built.rewritten_bins == built.bins == manifest(spark, path).count()
    assert update_store(table(first), path) == type(built)(2, 0, built.bins, 0)
    second = {k: v for k, v in first.items() if k not in ("p3", "p7")} | {"p9": first["p9"][:30] + "MMMMMK", "new": "WWWWK", "null": None}
    changed = update_store(table(second), path)
    assert changed.changed_proteins == 5 and 0 < changed.rewritten_bins < changed.bins / 2
    update_store(table(second), whole)
    assert rows(path) == rows(whole)
    got, want = (sorted((r.bin, r.n, r.least, r.most) for r in manifest(spark, p).collect()) for p in (path, whole))
    assert got == want
    low, high = 500.0, 560.0
    some = read_store(spark, path, low, high)
    assert sorted(map(tuple, some.collect())) == [r for r in rows(path) if low <= r[3] <= high]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bin" in plan and {r.bin for r in some.select("bin").distinct().collect()} <= set(range(25, 29))
    third = update_store(table({}), path)
    assert third.bins == 0 and read_store(spark, path).count() == 0


def test_named_objects(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    sg.share_map(spark, "letters", t, "k", "v")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    got = sg.looked_up(df, "letters", "k", "v", "string").collect()
    assert [r.v for r in got] == ["b", "c", None, None]
    sg.share(spark, "letters", {3: "z"})
    assert [r.v for r in sg.looked_up(df, "letters", "k", "v", "string").collect()] == [None, None, "z", None]
    with pytest.raises(ValueError, match="more than 2"):
        sg.share_map(spark, "many", spark.range(3).select("id", F.col("id").alias("v")), "id", "v", most_rows=2)
    with pytest.raises(ValueError, match="bytes"):
        sg.share(spark, "large", b"x" * 1000, most=100)
    with pytest.raises(KeyError, match="no object"):
        sg.shared_object(spark, "nothing")


def test_rates_and_limits(spark):
    df = spark.createDataFrame([(10.0, False), (10.0, True), (100.0, False), (1000.0, False)], "s double, d boolean")
    got = sorted(ex.fdr_curve(df, "s", "d").select("targets", "decoys", "tpr", "fpr").collect())
    assert [(r.targets, r.decoys, round(r.tpr, 6), r.fpr) for r in got] == [(1, 0, 0.333333, 0.0), (2, 0, 0.666667, 0.0), (3, 1, 1.0, 1.0)]
    assert ex.fdr_curve(df.where("not d"), "s", "d").where("fpr is not null").count() == 0
    peaks = spark.createDataFrame([(1, p, v) for p, v in ((100, 5.0), (101, 5.0), (150, 1.0), (160, 9.0), (170, 3.0), (180, 3.0))], "k int, p int, v double")
    assert sorted(r.centre for r in wn.centroids(peaks, "k", "p", "v", least=150, most=2).collect()) == [160, 170]
