"""Reports and tables: one ordered file with header and footer, pepXML, BioML, MGF, TSV, peptide tables."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.masses import PROTON, RESIDUES
from spectraloom.functions.staging import ship_package


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    _, fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def drop(spark: SparkSession, path: str) -> None:
    _, fs, p = _fs(spark, path)
    fs.delete(p, True)


def _concatenated(spark: SparkSession, path: str, parts: list[str]) -> bool:
    """Whether the file system itself could append the parts to the file at path (HDFS can; local folders and object stores can't)."""
    jvm, fs, target = _fs(spark, path)
    sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, p in enumerate(parts):
        sources[i] = jvm.org.apache.hadoop.fs.Path(p)
    try:
        fs.concat(target, sources)
    except UnsupportedOperationException:
        return False
    return True


def put_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes pieces (target, at, source, text) at their own places of local files: bytes of text, or of a whole source file, block by block."""
    for batch in batches:
        for r in batch.to_pylist():
            out = os.open(r["target"], os.O_CREAT | os.O_WRONLY, 0o644)
            at = r["at"]
            try:
                if r["source"] is None:
                    at += os.pwrite(out, r["text"], at)
                else:
                    with open(r["source"], "rb") as part:
                        while block := part.read(1 << 20):
                            at += os.pwrite(out, block, at)
            finally:
                os.close(out)
            yield pa.RecordBatch.from_arrays([pa.array([at - r["at"]], pa.int64())], names=["written"])


def _local(fs, p) -> str | None:
    """Plain name of a path on a file: system, None on another."""
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_one_file(df: DataFrame, text: str, path: str, header: str = "", footer: str = "") -> None:
    """The text column in row order as one file, whose partitions are written in parallel first.

    Where the file system appends files to a file (HDFS), it appends them. On file systems that are mounted on driver and executors
    (file:), the parts' lengths give their places, and tasks copy each part to its own place of the target, a retry to the same
    place; the driver reads no part. Elsewhere (object stores) one stream on the driver joins them.
    """
    spark = df.sparkSession
    folder = f"{path}.parts"
    df.select(F.col(text)).write.mode("overwrite").option("lineSep", "\n").text(folder)
    jvm, fs, target = _fs(spark, path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    whole = jvm.org.apache.hadoop.fs.Path(folder)
    found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(whole) if s.getPath().getName().startswith("part-") and s.getLen() > 0)
    parts = [f"{folder}/{name}" for name, _ in found]

    def put(out, data: str) -> None:
        out.write(bytearray(data.encode()))

    own = _local(fs, target)
    if own is not None:
        fs.delete(target, True)  # with its checksum file, which would not fit any more
        sizes = [len(header.encode()), *(n for _, n in found), len(footer.encode())]
        starts = [sum(sizes[:i]) for i in range(len(sizes))]
        sources = [None, *(_local(fs, jvm.org.apache.hadoop.fs.Path(p)) for p in parts), None]
        texts = [header.encode(), *[None] * len(parts), footer.encode()]
        pieces = spark.createDataFrame([(own, at, source, t) for at, source, t in zip(starts, sources, texts, strict=True)], "target string, at long, source string, text binary")
        ship_package(spark)
        done = pieces.repartition(len(sizes)).mapInArrow(put_pieces, "written long").agg(F.sum("written")).first()[0]
        if done != sum(sizes):
            raise OSError(f"{done} of {sum(sizes)} bytes of {path} were written")
        fs.delete(whole, True)
        return
    out = fs.create(target, True)
    try:
        put(out, header)
        if header and parts:
            out.close()
            if _concatenated(spark, path, parts):
                out, parts = fs.append(target), []
            else:
                out = fs.create(target, True)
                put(out, header)
        for p in parts:
            source = fs.open(jvm.org.apache.hadoop.fs.Path(p))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            source.close()
        put(out, footer)
    finally:
        out.close()
    fs.delete(whole, True)


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


#: Names of scores in a pepXML report, and the columns they are taken from where there are such (fixed values).
SCORES = [("xcorr", "xcorr"), ("deltacn", "delta_cn"), ("deltacnstar", "delta_cn_star"), ("spscore", "sp_score"), ("hyperscore", "hyperscore"), ("expect", "expect")]


def residue_mass_lines(sequence: Column) -> Column:
    """mod_aminoacid_mass elements of a text form: position (from 1) and mass of every residue that carries a modification."""
    table = F.create_map(*[F.lit(v) for pair in RESIDUES.items() for v in pair])
    letters = F.regexp_extract_all(sequence, F.lit(r"[A-Z](\[[^\]]*\])?"), 0)
    total = lambda x: F.coalesce(F.element_at(table, F.substring(x, 1, 1)), F.lit(0.0)) + F.substring(x, 3, 99).substr(F.lit(1), F.length(x) - 3).cast("double")
    rows = F.transform(letters, lambda x, i: F.when(F.length(x) > 1, F.format_string('<mod_aminoacid_mass position="%d" mass="%.3f"/>', i + 1, total(x))))
    return F.array_join(F.filter(rows, lambda x: x.isNotNull()), "")


def pepxml_lines(hits: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Lines of the spectrum_query elements of ranked hits (spectrum_id, line) with the columns that order them (rank, part, id).

    Each element is several lines, and each alternative protein one: no row grows with a spectrum's hits or a peptide's
    proteins. places (plain, protein_id): the proteins of plain sequences; those other than a hit's own are its alternatives.
    """
    plain = F.regexp_replace("sequence", r"\[[^\]]*\]", "")
    modified = F.when(plain != F.col("sequence"), F.concat(F.format_string('<modification_info modified_peptide="%s">', escaped(F.col("sequence"))), residue_mass_lines(F.col("sequence")), F.lit("</modification_info>"))).otherwise("")
    score = lambda name, c: F.format_string(f'<search_score name="{name}" value="%.6g"/>', F.col(c).cast("double"))
    scores = [score(name, c) for name, c in SCORES if c in hits.columns]
    n_proteins = F.format_string(' num_tot_proteins="%d"', F.col("n_proteins").cast("long")) if "n_proteins" in hits.columns else F.lit("")
    head = F.concat(F.format_string('<search_hit hit_rank="%d" peptide="%s" protein="%s"', F.col("rank"), escaped(plain), escaped(F.col("protein"))), n_proteins, F.format_string(' massdiff="%.6f">', F.col("mass_diff")))
    tail = F.concat(modified, *scores, F.lit("</search_hit>"))
    id_ = escaped(F.col("spectrum_id"))
    query = F.format_string('<spectrum_query spectrum="%s" start_scan="%s" precursor_neutral_mass="%.6f" assumed_charge="%d"><search_result>', id_, id_, F.col("m") - PROTON, F.col("z"))
    none = F.lit("").alias("id")
    spectra = hits.groupBy("spectrum_id").agg(F.first("precursor_mass").alias("m"), F.first("precursor_charge").alias("z"))
    lines = hits.select("spectrum_id", "rank", F.explode(F.array(F.struct(F.lit(0).alias("part"), head.alias("line")), F.struct(F.lit(2).alias("part"), tail.alias("line")))).alias("_l")).select("spectrum_id", "rank", "_l.part", none, "_l.line")
    ends = spectra.select("spectrum_id", F.explode(F.array(F.struct(F.lit(0).alias("rank"), query.alias("line")), F.struct(F.lit((1 << 31) - 1).alias("rank"), F.lit("</search_result></spectrum_query>").alias("line")))).alias("_l"))
    lines = lines.unionByName(ends.select("spectrum_id", "_l.rank", F.lit(0).alias("part"), none, "_l.line"))
    if places is not None:
        other = hits.select("spectrum_id", "rank", plain.alias("plain"), F.col("protein").alias("_own")).join(places.select("plain", "protein_id").distinct(), "plain").where(F.col("protein_id") != F.col("_own"))
        lines = lines.unionByName(other.select("spectrum_id", "rank", F.lit(1).alias("part"), F.col("protein_id").alias("id"), F.format_string('<alternative_protein protein="%s"/>', escaped(F.col("protein_id"))).alias("line")))
    return lines


def write_pepxml(hits: DataFrame, path: str, parameters: dict[str, str] | None = None, places: DataFrame | None = None) -> None:
    """Ranked hits as one pepXML file with a search summary, spectra in text order of their ids; places as in `pepxml_lines`."""
    named = "".join(f'<parameter name="{k}" value="{v}"/>' for k, v in (parameters or {}).items())
    header = f'<?xml version="1.0" encoding="UTF-8"?>\n<msms_pipeline_analysis><msms_run_summary>\n<search_summary precursor_mass_type="monoisotopic" fragment_mass_type="monoisotopic">{named}</search_summary>\n'
    write_one_file(pepxml_lines(hits, places).orderBy("spectrum_id", "rank", "part", "id"), "line", path, header, "</msms_run_summary></msms_pipeline_analysis>\n")


def write_bioml(hits: DataFrame, path: str) -> None:
    """Best hits (scan_id, mh, charge, protein, peptide, hyperscore, expect) as one BioML report."""
    row = F.format_string('<group id="%s" mh="%.6f" z="%d" type="model"><protein label="%s"><peptide><domain seq="%s" hyperscore="%.4f" expect="%.6g"/></peptide></protein></group>', "scan_id", "mh", "charge", escaped(F.col("protein")), "peptide", "hyperscore", "expect")
    write_one_file(hits.select("scan_id", row.alias("element")).orderBy("scan_id"), "element", path, '<?xml version="1.0"?>\n<bioml>\n', "</bioml>\n")


def mgf_text(spectra: DataFrame) -> DataFrame:
    """One MGF block per spectrum (column block)."""
    peaks = F.array_join(F.transform("peaks", lambda p: F.format_string("%.5f %.3f", p["mz"], p["intensity"].cast("double"))), "\n")
    charge = F.when(F.col("precursor_charge").isNotNull(), F.format_string("CHARGE=%d+\n", "precursor_charge")).otherwise("")
    block = F.concat(F.lit("BEGIN IONS\nTITLE="), "spectrum_id", F.format_string("\nPEPMASS=%.6f\n", "precursor_mz"), charge, peaks, F.lit("\nEND IONS"))
    return spectra.select("spectrum_id", block.alias("block"))


def write_mgf(spectra: DataFrame, path: str) -> None:
    mgf_text(spectra).select("block").write.text(path)


def mgf_of_best(spectra: DataFrame, scores: DataFrame, least_score: float | None = None, most_expect: float | None = None) -> DataFrame:
    """MGF blocks of the spectra whose best score reaches least_score and whose expectation is at most most_expect."""
    good = scores
    if least_score is not None:
        good = good.where(F.col("score") >= least_score)
    if most_expect is not None:
        good = good.where(F.col("expect") <= most_expect)
    return mgf_text(spectra.join(good.select("spectrum_id").distinct(), "spectrum_id", "left_semi"))


def shortened(spectra: DataFrame, n: int) -> DataFrame:
    """Spectra with their n largest peaks only, in order of m/z; of a verbose file nothing else but id, precursor and charge is kept."""
    larger = lambda a, b: F.when(a["intensity"] > b["intensity"], -1).when(a["intensity"] < b["intensity"], 1).when(a["mz"] < b["mz"], -1).otherwise(1)
    peaks = F.sort_array(F.slice(F.array_sort("peaks", larger), 1, n))
    return spectra.select("spectrum_id", "precursor_mz", "precursor_charge", peaks.alias("peaks"))


def write_fasta(proteins: DataFrame, path: str, id_col: str = "protein_id", sequence: str = "sequence", width: int = 60) -> None:
    folded = F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")
    proteins.select(F.concat(F.lit(">"), F.col(id_col).cast("string"), F.lit("\n"), folded)).write.text(path)


def write_peptide_table(peptides: DataFrame, path: str, mass_bin: str = "mass_bin", parts: int | None = None, only_if_absent: bool = False) -> None:
    """Peptides as Parquet, dealt by range of mass bin and sorted, so that a bin's rows lie in few row groups."""
    dealt = peptides.repartitionByRange(parts, mass_bin) if parts else peptides.repartitionByRange(mass_bin)
    dealt.sortWithinPartitions(mass_bin).write.mode("ignore" if only_if_absent else "overwrite").parquet(path)


def read_peptide_bin(spark: SparkSession, path: str, low: int, high: int | None = None, mass_bin: str = "mass_bin") -> DataFrame:
    return spark.read.parquet(path).where(F.col(mass_bin).between(low, high if high is not None else low))


def write_by_mass(peptides: DataFrame, path: str, mass: str = "mass", columns: Sequence[str] = ("sequence", "mass", "proteins")) -> None:
    """CSV files in one folder per whole mass."""
    peptides.withColumn("mass_int", F.floor(mass).cast("long")).select(*columns, "mass_int").repartition("mass_int").write.mode("overwrite").partitionBy("mass_int").csv(path)


def write_tsv(proteins: DataFrame, path: str) -> None:
    """protein and its sorted peptides, tab-separated."""
    proteins.groupBy("protein").agg(F.array_join(F.sort_array(F.collect_set("peptide")), " ").alias("peptides")).write.mode("overwrite").csv(path, sep="\t")


def same_rules(spark: SparkSession, path: str, rules: dict) -> bool:
    """Whether the table at path was built by these rules."""
    if not exists(spark, f"{path}_rules"):
        return False
    row = spark.read.text(f"{path}_rules").first()
    return row is not None and json.loads(row[0]) == json.loads(json.dumps(rules))


def build_if_needed(spark: SparkSession, path: str, rules: dict, build) -> bool:
    """Writes build() to path unless a table by the same rules is there; whether it was built."""
    if exists(spark, path) and same_rules(spark, path, rules):
        return False
    write_peptide_table(build(), path)
    spark.createDataFrame([(json.dumps(rules, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}_rules")
    return True


def write_binning_report(work: DataFrame, path: str) -> None:
    work.write.mode("overwrite").option("header", True).csv(path)
