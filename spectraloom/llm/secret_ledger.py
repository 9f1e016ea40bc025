"""Secret scans over an incremental blob ledger (operator 5), in Spark expressions only.

Every version of a text is addressed by the SHA-256 of its content. The ledger has one row per scan of a blob: the
version of every rule that it was scanned with, and what was found. A run scans only the pairs of blob and rule
version that the ledger lacks, adds them, and joins findings back to every path (id) that holds the blob.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_id, staged
from .quality_rules import let

#: kind, pattern, group whose length is bounded, least length, version. Fixed values; the first three are the base.
RULES: list[tuple[str, str, int, int, int]] = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, 1),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, 1),
    ("hex", r"[0-9a-f]{24,}", 0, 24, 1),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\x20\r\n]*-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1, 2),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, 1),
    ("hub_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, 1),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15, 1),
]
VERSIONS = [v for *_, v in RULES]
BASE_KINDS = 3
SPANS = "array<struct<start:int,stop:int,kind:int>>"
LEDGER = f"blob string, versions array<int>, spans {SPANS}"


#: Matches of a text that are walked one by one with what came before carried along; longer lists go block by block.
BLOCK = 256


def block_starts(sizes: Column) -> Column:
    """From the blocks' sizes the sum of those before each, one entry a block."""
    grow = lambda a, n: F.array_append(a, F.element_at(a, -1) + n)
    return F.aggregate(sizes, F.array(F.lit(0).cast("long")), grow)


def block_numbers(items: Column) -> Column:
    """0 to the last block of an array that is not empty."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))


def found(text: Column, number: int) -> Column:
    """Leftmost matches of one rule that do not overlap, as (start, stop, rule number) in code points; short ones dropped.

    Where a match stands follows from the lengths before it. Blocks of matches are added up first, so that the work and the
    copies made along the way grow with the number of matches, not with its square.
    """
    _, pattern, group, least, _ = RULES[number]
    regex = F.lit(pattern)

    def placed(x: Column) -> Column:
        n = F.size(x["matches"])
        total = lambda b: F.aggregate(F.slice(x["steps"], b * BLOCK + 1, BLOCK), F.lit(0).cast("long"), lambda a, v: a + v)

        def walked(starts: Column) -> Column:
            def step(a: Column, i: Column) -> Column:
                s = a["at"] + F.length(F.get(x["pieces"], i))
                e = s + F.length(F.get(x["matches"], i))
                span = F.struct(s.cast("int").alias("start"), e.cast("int").alias("stop"), F.lit(number).alias("kind"))
                return F.struct(e.alias("at"), F.when(F.length(F.get(x["parts"], i)) >= least, F.array_append(a["out"], span)).otherwise(a["out"]).alias("out"))

            def block(b: Column) -> Column:
                begin = F.struct(F.get(starts, b).alias("at"), F.array().cast(SPANS).alias("out"))
                return F.aggregate(F.sequence(b * BLOCK, F.least((b + 1) * BLOCK, n) - 1), begin, step, lambda a: a["out"])

            return F.flatten(F.transform(block_numbers(x["matches"]), block))

        return let(block_starts(F.transform(block_numbers(x["matches"]), total)), walked)

    whole = F.regexp_extract_all(text, regex, 0)
    parts = F.regexp_extract_all(text, regex, group) if group else whole

    def stepped(x: Column) -> Column:
        steps = F.zip_with(x["matches"], x["pieces"], lambda m, p: (F.coalesce(F.length(m), F.lit(0)) + F.length(p)).cast("long"))
        return let(F.struct(x["pieces"].alias("pieces"), x["matches"].alias("matches"), x["parts"].alias("parts"), steps.alias("steps")), placed)

    work = let(F.struct(F.split(text, pattern, -1).alias("pieces"), whole.alias("matches"), parts.alias("parts")), stepped)
    return F.when(F.rlike(text, regex), work).otherwise(F.array().cast(SPANS))


def versions_now() -> Column:
    return F.array(*[F.lit(v) for v in VERSIONS])


def scan(blobs: DataFrame) -> DataFrame:
    """(blob, text, versions, known) to ledger rows (blob, versions, spans), spans by start and then by rule.

    `versions` and `known` are what the ledger has (null: nothing); a rule is run only where its version there is another.
    """
    def of_rule(i: int) -> Column:
        kept = F.filter(F.coalesce("known", F.array().cast(SPANS)), lambda s: s["kind"] == i)
        return F.when(F.coalesce(F.get("versions", F.lit(i)) == VERSIONS[i], F.lit(False)), kept).otherwise(found(F.col("text"), i))

    each = [of_rule(i) for i in range(len(RULES))]
    return blobs.select("blob", versions_now().alias("versions"), F.sort_array(F.concat(*each)).alias("spans"))


def latest(ledger: DataFrame) -> DataFrame:
    """The last scan of each blob: versions only rise."""
    return ledger.groupBy("blob").agg(F.max(F.struct("versions", "spans")).alias("_s")).select("blob", "_s.versions", "_s.spans")


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Findings per row of docs, and the ledger rows that this run added.

    Findings: the id column, `blob` (SHA-256 of the text, lowercase hex) and `spans` (start, stop in code points,
    kind as the rule's number), for every row, an empty array where nothing was found. A null text is the empty
    blob. Exact copies and repeated rows are scanned once and all get the findings. `ledger` holds what earlier
    runs added (None: nothing): a blob in it is scanned again only by rules whose version has changed. An empty table
    adds nothing.
    """
    versions = docs.select(F.col(id_col), row_id(id_col).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    paths = staged(versions.select(id_col, "_row", "blob"), "secret-paths")
    # a blob is scanned in the row of its smallest id; where several rows have that id and text, in one of them
    alike = paths.groupBy("blob", "_row").agg(F.count("*").alias("_alike"))
    unseen = alike.groupBy("blob").agg(F.min(F.struct("_row", "_alike")).alias("_m")).select("blob", "_m._row", "_m._alike")
    if ledger is None:
        known = None
        unseen = unseen.select("blob", "_row", "_alike", F.lit(None).cast("array<int>").alias("versions"), F.lit(None).cast(SPANS).alias("known"))
    else:
        known = latest(ledger)
        unseen = unseen.join(known.withColumnRenamed("spans", "known"), "blob", "left").where(~F.coalesce(F.col("versions") == versions_now(), F.lit(False)))
        known = known.where(F.col("versions") == versions_now())
    texts = versions.select("_row", "blob", "text").join(unseen, ["_row", "blob"])
    names = ["blob", "text", "versions", "known"]
    once = texts.where("_alike = 1").select(names).unionByName(texts.where("_alike > 1").select(names).dropDuplicates(["blob"]))
    added = staged(scan(once), "secret-ledger")
    ledger_now = added if known is None else known.unionByName(added)
    return paths.join(ledger_now.select("blob", "spans"), "blob").select(id_col, "blob", "spans"), added


def scan_batches(batches: list[DataFrame], path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Findings of batches that arrive one after another and keep one ledger at `path`: each scans what none before has seen."""
    spark = batches[0].sparkSession
    out = []
    for i, docs in enumerate(batches):
        ledger = spark.read.schema(LEDGER).parquet(path) if i else None
        found_now, added = scan_secrets(docs, ledger, text, id_col)
        append_ledger(added, path)
        out.append(found_now)
    return reduce(DataFrame.unionByName, out)


def append_ledger(added: DataFrame, path: str) -> None:
    added.write.mode("append").parquet(path)


def span_text(spans: Column, kinds: int = len(RULES)) -> Column:
    """kind:start:end of the first `kinds` rules' spans, comma-joined by start and then by rule."""
    names = F.array(*[F.lit(k) for k, *_ in RULES])
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"] < kinds), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """text with every found span, overlaps as one, replaced by mark. Spans are sorted by start.

    The text between spans is cut out of the piece of text that a block of spans lies in, so that a text of many spans isn't
    read from its start for each.
    """

    def furthest(b: Column) -> Column:
        return F.array_max(F.transform(F.slice(spans, b * BLOCK + 1, BLOCK), lambda s: s["stop"]))

    def reached(stops: Column) -> Column:
        """How far the spans before each block reach, and all of them at the end."""
        grow = lambda a, n: F.array_append(a, F.greatest(F.element_at(a, -1), n))
        return F.aggregate(stops, F.array(F.lit(0)), grow)

    def cut(ends: Column) -> Column:
        def block(b: Column) -> Column:
            own, begin = F.slice(spans, b * BLOCK + 1, BLOCK), F.get(ends, b)

            def inside(piece: Column) -> Column:
                def step(a: Column, s: Column) -> Column:
                    fresh = s["start"] >= a["at"]
                    out = F.concat(a["out"], F.substring(piece, a["at"] - begin + 1, s["start"] - a["at"]), F.lit(mark))
                    return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(fresh, out).otherwise(a["out"]).alias("out"))

                return F.aggregate(own, F.struct(begin.alias("at"), F.lit("").alias("out")), step, lambda a: a["out"])

            return let(F.substring(text, begin + 1, F.greatest(F.element_at(own, -1)["start"] - begin, F.lit(0))), inside)

        tail = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(block_numbers(spans), block), ""), tail)

    whole = let(F.transform(block_numbers(spans), furthest), lambda stops: let(reached(stops), cut))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
