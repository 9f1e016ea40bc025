"""Inputs that the queries derive from the tables, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectraloom.functions.masses import sequence_mass_sql
from spectraloom.functions.staging import small_batches
from spectraloom.functions.text import words_of
from spectraloom.operators.digest import digest

from .registry import table

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
NOT_LETTERS = f"[^{LETTERS}{LETTERS.lower()}]"


def residue_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (second column) without all but residue letters, in upper case: a batch's texts at once."""
    byte = np.arange(256)
    kept = np.isin(byte, [ord(c) for c in LETTERS + LETTERS.lower()])
    upper = np.where(byte >= ord("a"), byte & ~0x20, byte).astype(np.uint8)
    for batch in batches:
        _, ends, held = batch.column(1).buffers()
        off = np.frombuffer(ends, np.int32, batch.num_rows + 1, 4 * batch.column(1).offset)
        body = np.frombuffer(held, np.uint8)[off[0] : off[-1]] if held is not None else np.zeros(0, np.uint8)
        some = kept[body]
        places = np.r_[0, np.cumsum(some)][off - off[0]].astype(np.int32)
        text = pa.Array.from_buffers(pa.string(), batch.num_rows, [None, pa.py_buffer(places), pa.py_buffer(upper[body[some]])])
        yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["protein_id", "sequence"])


def proteins(spark: SparkSession, sf_dir: str, name: str = "documents", id_col: str = "doc_id") -> DataFrame:
    """Every text as a protein: its residue letters, in upper case."""
    small_batches(spark)
    rows = table(spark, sf_dir, name).select(F.col(id_col).alias("protein_id"), F.coalesce("text", F.lit("")).alias("sequence"))
    return rows.mapInArrow(residue_letters, rows.schema)


PROTEINS = f"SELECT doc_id AS protein_id, upper(regexp_replace(coalesce(text, ''), '{NOT_LETTERS}', '', 'g')) AS sequence FROM documents"
PARTS = "str_split(replace(regexp_replace(sequence, '([KR])', '\\1|', 'g'), '|P', 'P'), '|')"
PEPTIDES = f"SELECT protein_id, p AS sequence FROM (SELECT protein_id, unnest({PARTS}) AS p FROM ({PROTEINS})) WHERE length(p) BETWEEN 4 AND 40"
MASS = sequence_mass_sql("sequence")
WORDS = "SELECT doc_id, w FROM (SELECT doc_id, unnest(list_transform(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: upper(regexp_replace(x, '[^A-Za-z]', '', 'g')))) AS w FROM documents) WHERE w <> ''"
#: Every component of a vector as a peak: position and intensity (100 times its size).
PEAKS = "SELECT vec_id, pos, abs(v) * 100 AS value FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1)::BIGINT AS pos FROM embeddings)"


def tail_sql(scores: str) -> str:
    """(key, slope, intercept) of rows (key, score): the end of the bulk, and the first of the lines that fall, each start of a line tried by itself."""
    return f"""WITH c AS (SELECT key, least(greatest(floor(score * 10 + 0.5::DOUBLE)::BIGINT, 0), 10000) AS b, count(*) AS n FROM ({scores}) GROUP BY ALL),
 m AS (SELECT key, max(b) AS last FROM c GROUP BY key), t AS (SELECT m.key, coalesce(max(b) FILTER (b < last), -1) AS top FROM m JOIN c USING (key) GROUP BY m.key),
 d AS (SELECT x.key, top, i AS b, coalesce(n, 0) AS n FROM (SELECT key, top, unnest(range(0, last + 1)) AS i FROM m JOIN t USING (key)) x LEFT JOIN c ON c.key = x.key AND c.b = i),
 e AS (SELECT *, lead(n) OVER (PARTITION BY key ORDER BY b) AS nxt FROM d),
 g AS (SELECT key, top, min(b) FILTER (b < top AND n = 0 AND (nxt = 0 OR b + 1 = top)) AS gap FROM e GROUP BY ALL),
 f AS (SELECT key, CASE WHEN gap IS NOT NULL THEN greatest(gap - 1, 0) WHEN top > 12 THEN top - 2 ELSE greatest(top, 0) END AS stop FROM g),
 s AS (SELECT key, b, stop, CASE WHEN b > 0 AND n = 0 THEN 0 ELSE sum(n) OVER (PARTITION BY key ORDER BY b DESC) END AS v FROM d JOIN f USING (key) WHERE b <= stop),
 l AS (SELECT s.key, lo, b, v, log10(CASE WHEN v > 0 THEN v END) AS y FROM s JOIN (SELECT key, unnest(range(0, CASE WHEN stop >= 30 THEN floor(0.75::DOUBLE * stop) WHEN stop >= 15 THEN floor(0.5::DOUBLE * stop) ELSE 0 END::BIGINT + 1)) AS lo FROM f) z ON z.key = s.key AND b >= lo),
 a AS (SELECT *, avg(b) FILTER (v > 0) OVER w AS mx, avg(y) FILTER (v > 0) OVER w AS my FROM l WINDOW w AS (PARTITION BY key, lo)),
 r AS (SELECT key, lo, coalesce(max(mx), 0) AS mx, coalesce(max(my), 0) AS my, coalesce(sum((b - mx) * (b - mx)) FILTER (v > 1), 0) AS sx, coalesce(sum((b - mx) * (y - my)) FILTER (v > 1), 0) AS sxy FROM a GROUP BY ALL),
 k AS (SELECT *, CASE WHEN sx > 0 THEN sxy / sx ELSE 0 END AS slope FROM r),
 q AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN slope < 0 THEN lo ELSE -1 - lo END DESC, lo) AS pick, bool_or(slope < 0) OVER (PARTITION BY key) AS falls FROM k)
 SELECT key, slope, my - slope * mx AS intercept FROM q WHERE CASE WHEN falls THEN pick = 1 ELSE lo = 0 END"""


def peptides(spark: SparkSession, sf_dir: str, missed: int = 0) -> DataFrame:
    return digest(proteins(spark, sf_dir), missed=missed)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(words_of(F.col("text"))).alias("w"))


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return rows.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.abs(F.col("v").cast("double")) * 100).alias("value"))


def vector_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as spectra: peak i at 200 + 10 * i, precursor from the label."""
    e = table(spark, sf_dir, "embeddings")
    peak = F.transform("embedding", lambda v, i: F.struct((200 + 10 * i).cast("double").alias("mz"), F.abs(v * 100).cast("float").alias("intensity")))
    return e.select(F.col("vec_id").cast("string").alias("spectrum_id"), (500.5 + F.col("label")).cast("double").alias("precursor_mz"), (1 + F.col("label") % 3).cast("int").alias("precursor_charge"), peak.alias("peaks"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as hits: toxic texts are decoys, text length is the score."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return l.join(d, "doc_id").select("doc_id", (F.col("toxic") == 1).alias("decoy"), F.col("quality"), F.col("lang"), F.col("source"), F.col("n_chars").cast("double").alias("score"))


HITS = "SELECT l.doc_id, toxic = 1 AS decoy, quality, lang, source, n_chars::DOUBLE AS score FROM labels l JOIN documents d USING (doc_id)"
