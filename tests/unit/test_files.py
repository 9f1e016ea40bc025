"""Odd files: line ends, blank records, unknown keys, nested scans, modifications, many partitions."""

import os

import pytest
from pyspark.sql import functions as F

from spectraloom.operators.filters import with_index
from spectraloom.plans.config import SearchConfig, from_keys, from_xml
from spectraloom.sinks import reports as rp
from spectraloom.sources import files as fs
from spectraloom.streaming import spectra as st


def put(tmp_path, name: str, text: str) -> str:
    path = os.path.join(tmp_path, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "a.fasta", ">sp|P1|NAME first protein\r\nMKAA\r\nccc\r\n>DECOY_2\nAAAK\n>\nXX\n>empty\n>plain>odd\nAC DE\n")
    got = {r.protein_id: (r.sequence, r.is_decoy) for r in fs.read_fasta(spark, path).collect()}
    assert got == {"P1": ("MKAACCC", False), "DECOY_2": ("AAAK", True), "empty": ("", False), "plain>odd": ("ACDE", False)}


def test_fasta_over_many_splits(spark, tmp_path):
    text = "".join(f">p{i}\n{'ACDEFGHIK' * (i % 7 + 1)}\n" for i in range(3000))
    path = put(tmp_path, "b.fasta", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = fs.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert {r.protein_id: len(r.sequence) for r in df.collect()} == {f"p{i}": 9 * (i % 7 + 1) for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


MGF = "BEGIN IONS\nTITLE=a b=c\nPEPMASS=445.12 1000\nCHARGE=2+ and 3+\nRTINSECONDS=12.5\n100.5\t3\n101 0.0\n102.25 1e3 1+\n???\nEND IONS\n\r\nBEGIN IONS\r\nTITLE=d\r\nPEPMASS=500\r\n1 2\r\nEND IONS\r\n\n"


def test_mgf(spark, tmp_path):
    rows = {r.spectrum_id: r for r in fs.read_mgf(spark, put(tmp_path, "a.mgf", MGF)).collect()}
    a = rows["a b=c"]
    assert (a.precursor_mz, a.precursor_charge, a.retention_time, a.bad_lines) == (445.12, 2, 12.5, 1)
    assert [(p.mz, p.intensity) for p in a.peaks] == [(100.5, 3.0), (102.25, 1000.0)]
    assert rows["d"].precursor_charge is None and len(rows["d"].peaks) == 1 and len(rows) == 2


def test_mgf_unknown_key(spark, tmp_path):
    path = put(tmp_path, "u.mgf", MGF.replace("RTINSECONDS", "WHATEVER"))
    with pytest.raises(Exception, match="unknown key"):
        fs.read_mgf(spark, path).collect()
    assert fs.read_mgf(spark, path, strict=False).count() == 2


@pytest.mark.parametrize(("bits", "zipped"), [(32, False), (32, True), (64, False), (64, True)])
def test_mzxml_nested(spark, tmp_path, bits, zipped):
    def scan(n: int, inner: str = "") -> str:
        kind = ' compressionType="zlib"' if zipped else ""
        return f'<scan num="{n}" msLevel="{2 if n % 2 else 1}" retentionTime="PT{n}.5S"><precursorMz precursorCharge="2">4{n}.5</precursorMz><peaks precision="{bits}"{kind}>{fs.encode_peaks([100.0, 200.5], [1.0, n], bits, zipped)}</peaks>{inner}</scan>'

    path = put(tmp_path, "a.mzXML", f"<mzXML><msRun>{scan(1)}{scan(2, scan(3) + scan(5))}</msRun></mzXML>")
    got = {r.spectrum_id: r for r in fs.read_mzxml(spark, path).collect()}
    assert sorted(got) == ["1", "2", "3", "5"]
    assert got["3"].precursor_mz == 43.5 and got["3"].retention_time == 3.5 and [(p.mz, p.intensity) for p in got["5"].peaks] == [(100.0, 1.0), (200.5, 5.0)]


def test_pepxml(spark, tmp_path):
    hit = '<search_hit hit_rank="{r}" peptide="AMK" protein="{p}">{x}<search_score name="xcorr" value="1.5"/><search_score name="expect" value="0.01"/></search_hit>'
    alt, mod = '<alternative_protein protein="DECOY_q"/>', '<modification_info modified_peptide="AM[16]K"/>'
    text = f'<a><spectrum_query spectrum="s1" start_scan="7" precursor_neutral_mass="500.5" assumed_charge="2" retention_time_sec="3"><search_result>{hit.format(r=1, p="p", x=alt + mod)}{hit.format(r=2, p="DECOY_z", x="")}</search_result></spectrum_query><spectrum_query spectrum="none"/></a>'
    rows = sorted(fs.read_pepxml(spark, put(tmp_path, "a.xml", text)).collect(), key=lambda r: r["rank"])
    assert [(r.spectrum, r.protein, r.alt_proteins, r.modified_peptide, r.is_target, r.is_modified, r.xcorr, r.expect) for r in rows] == [
        ("s1", "p", ["DECOY_q"], "AM[16]K", True, True, 1.5, 0.01), ("s1", "DECOY_z", [], "AMK", False, False, 1.5, 0.01)]
    assert rows[0].hyperscore is None


def test_one_file_in_order(spark, tmp_path):
    path = f"file://{tmp_path}/out.txt"
    df = spark.range(0, 500, 1, 9).select(F.format_string("%05d", "id").alias("t"))
    rp.write_one_file(df.orderBy(F.desc("t")), "t", path, "<h>\n", "</h>\n")
    lines = open(f"{tmp_path}/out.txt").read().split("\n")
    assert lines[0] == "<h>" and lines[-2] == "</h>" and lines[1:-2] == [f"{i:05d}" for i in range(499, -1, -1)]
    rp.write_one_file(df.limit(0), "t", path, "h", "f")
    assert open(f"{tmp_path}/out.txt").read() == "hf"


def test_table_built_once(spark, tmp_path):
    path, built = f"file://{tmp_path}/peptides", []

    def build():
        built.append(1)
        return spark.createDataFrame([("A", 1), ("B", 2)], "sequence string, mass_bin int")

    assert rp.build_if_needed(spark, path, {"cut": "KR"}, build) and not rp.build_if_needed(spark, path, {"cut": "KR"}, build)
    assert rp.build_if_needed(spark, path, {"cut": "K"}, build) and len(built) == 2
    assert [r.sequence for r in rp.read_peptide_bin(spark, path, 2).collect()] == ["B"]
    rp.drop(spark, path)
    assert not rp.exists(spark, path)


def test_chunks(spark, tmp_path):
    path = put(tmp_path, "x.xml", "<r>" + "".join(f'<scan num="{i}">x</scan>\n' for i in range(5)) + "</r>")
    got = sorted((r.chunk, r.n, r.text) for r in fs.mzxml_chunks(spark, path, 2, "<r>", "</r>", with_index).collect())
    assert [g[:2] for g in got] == [(0, 2), (1, 2), (2, 1)] and got[2][2] == '<r><scan num="4">x</scan></r>'


def test_config(spark, tmp_path):
    path = put(tmp_path, "p.xml", '<bioml><note type="input" label="comet.mass_tolerance">5</note>\n<note label="residue, potential modification mass">15.995@M, 1.0@]</note><note label="scoring, include reverse">yes</note><note label="other">1</note></bioml>')
    c = from_xml(spark, path)
    assert (c.ppm, c.modifications, c.decoys) == (5.0, ("15.995@M", "1.0@]"), True)
    assert from_keys({}) == SearchConfig()


def test_search_finds_its_own_peptides(spark):
    from spectraloom.plans.search import search, spectra_of

    proteins = spark.createDataFrame([(1, "MPEPTIDEKACDEFGHIKLMNPQR"), (2, "PEPTIDEKWWYYVVK")], "protein_id long, sequence string")
    wanted = spark.createDataFrame([("MPEPTIDEK",), ("ACDEFGHIK",), ("WWYYVVK",)], "sequence string")
    for hot, rows in ((1, 1), (30, 5000)):
        got = search(proteins, spectra_of(wanted), SearchConfig(ppm=20, group_spectra=hot, group_rows=rows)).collect()
        assert {r.spectrum_id: r.sequence for r in got if r["rank"] == 1} == {s: s for s in ("MPEPTIDEK", "ACDEFGHIK", "WWYYVVK")}
        assert len(got) == 3 and all(abs(r.mass_diff) < 1e-6 for r in got)


def test_streams(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([("a", 100.2, "2024-01-01 00:10:00"), ("b", 100.7, "2024-01-01 00:20:00"), ("c", 250.0, "2024-01-01 01:10:00")], "id string, mass double, t string").withColumn("t", F.to_timestamp("t")).write.parquet(src)
    stream = st.arriving(spark, src, "id string, mass double, t timestamp")
    q = st.windowed_bin_counts(stream, "t", "mass", 10.0).writeStream.outputMode("complete").format("memory").queryName("bin_counts").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.bin, r.n) for r in spark.table("bin_counts").collect()) == [(10, 2), (25, 1)]
    peptides = spark.createDataFrame([("P", 100.2001), ("Q", 900.0)], "sequence string, m double")
    q = st.candidates(st.arriving(spark, src, "id string, mass double, t timestamp"), peptides, "m", "mass", 10).writeStream.format("memory").queryName("met").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.id, r.sequence) for r in spark.table("met").collect()] == [("a", "P")]
