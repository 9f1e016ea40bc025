"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts (operator 11).

Both tokenizers spell the same bytes. A byte offset where a token of each ends is a shared cut. An interval of tokens
looks for a shared cut near its middle: the ends of one tokenizer, from the middle outwards, are bisected for in those of
the other. Both halves go on alike; an interval without a cut inside is a leaf group. All intervals of a slice of texts take
each step together. Pairs of token ids that share a group are counted by the documents that hold them.

The pairs of a text travel once, as its distinct pairs with how often each occurs. Their document counts are looked up in
two parts: the most frequent pairs (at most `head`) are sent to all workers, which takes the hot keys away; the others,
each of fewer documents, are joined by pair.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, staged, text_buffers, worker_cache

SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: White space and what follows it up to the next: no token of either tokenizer spans the border of two chunks.
CHUNK = re.compile(f"{SPACE}*[^{SPACE[1:-1]}]+|{SPACE}+")
#: Chunks whose ids a worker keeps in each of two generations; pairs sent to all workers; groups of more pairs are counted by distinct ids.
CACHE_CHUNKS, HEAD, WIDE = 200_000, 1 << 20, 4096
MARK = "▁"


def byte_letters() -> dict[str, int]:
    """Letter to byte of byte-level vocabularies: printable Latin-1 bytes are themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class TokenPair:
    """Ids of both tokenizers for texts with a space before them, and the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        self.bytes_b = [b""] * self.b.vocab_size()
        for i in range(len(self.bytes_b)):
            piece = self.b.id_to_piece(i)
            self.bytes_b[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()
        # white space that stands behind other letters in some piece: texts with it are not cut into chunks
        inner = re.compile(f"(?<=[^{SPACE[1:-1]}]){SPACE}")
        self.joining = {c for i in range(len(self.bytes_b)) for c in inner.findall(self.b.id_to_piece(i).replace(MARK, " "))}
        if len(self.bytes_a) * len(self.bytes_b) > 1 << 32:
            raise ValueError("a pair of ids must fit in 32 bits")
        self.digits = digit_table(max(len(self.bytes_a), len(self.bytes_b)))
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # ids of chunks by side, in two generations; bytes only, which the collector of cycles needn't visit
        self.young: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.misspelt: set[str] = set()

    def spelt(self, chunk: str, a: np.ndarray, b: np.ndarray) -> bool:
        raw = chunk.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw

    def learn(self, chunks: set[str]) -> None:
        unknown = list(chunks.difference(self.old[0]))
        for c in chunks.intersection(self.old[0]):
            for young, old in zip(self.young, self.old, strict=True):
                young[c] = old[c]
        for lo in range(0, len(unknown), 4096):
            some = unknown[lo : lo + 4096]
            ids_a = [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            # a first space is the one the model adds; other chunks stand behind a line end, which is a space and a byte
            ids_b = self.b.encode([c[1:] if c[0] == " " and len(c) > 1 else "\n" + c for c in some])
            ids_b = [b if c[0] == " " and len(c) > 1 else b[2:] for c, b in zip(some, ids_b, strict=True)]
            raw = [c.encode() for c in some]
            for young, ids, table, lengths in ((self.young[0], ids_a, self.bytes_a, self.lengths_a), (self.young[1], ids_b, self.bytes_b, self.lengths_b)):
                joined, ends = np.fromiter(chain.from_iterable(ids), "<i4"), np.cumsum([0, *map(len, ids)])
                spans = np.diff(np.r_[0, np.cumsum(lengths[joined])][ends])
                if (spans != np.fromiter(map(len, raw), np.int64)).any() or b"".join(map(table.__getitem__, joined.tolist())) != b"".join(raw):
                    self.misspelt.update(c for c, i, r in zip(some, ids, raw, strict=True) if b"".join(map(table.__getitem__, i)) != r)
                all_, at = joined.tobytes(), (4 * ends).tolist()
                young.update(zip(some, [all_[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], strict=True))

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of each text as 32-bit integers, None where the bytes of one side differ from those of space and text."""
        if len(self.young[0]) > CACHE_CHUNKS:
            self.old, self.young = self.young, ({}, {})
            self.misspelt.intersection_update(self.old[0])
        parts = [[] if any(c in t for c in self.joining) else CHUNK.findall(" " + t) for t in texts]
        missing: set[str] = set()
        for p in parts:
            missing.update(p)
        self.learn(missing.difference(self.young[0]))
        out: list[tuple[bytes, bytes] | None] = []
        for text, part in zip(texts, parts, strict=True):
            if part:
                a, b = (b"".join(map(young.__getitem__, part)) for young in self.young)
                good = not self.misspelt or self.misspelt.isdisjoint(part)
            else:
                a, b = (np.array(x, "<i4").tobytes() for x in (self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)))
                good = False
            good = good or self.spelt(" " + text, np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4"))
            out.append((a, b) if good and text else None)
        return out


def token_pair(path_a: str, path_b: str) -> TokenPair:
    return worker_cache(("pair", path_a, path_b), lambda: TokenPair(path_a, path_b))


def ragged(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value): for every row its `counts` numbers from `starts` on."""
    rows = np.repeat(np.arange(len(starts)), counts)
    ends = np.cumsum(counts)
    return rows, np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def middle_cuts(a0: np.ndarray, a1: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every interval of A tokens the inner one next to the middle whose end is also a B end, and that B token; -1 without."""
    middle, found_a, found_b = (a0 + a1 - 2) // 2, np.full(len(a0), -1), np.full(len(a0), -1)
    open_, near, reach = np.arange(len(a0)), 0, 1
    while len(open_):
        # a ring around the middle, twice as wide each time
        m, lo, hi = middle[open_], a0[open_], a1[open_] - 2
        left = np.maximum(m - reach + 1, lo)
        n_left = np.maximum(m - near + 1 - left, 0)
        right = m + np.maximum(near, 1)
        n_right = np.maximum(np.minimum(m + reach - 1, hi) + 1 - right, 0)
        rows, at = ragged(np.concatenate([left, right]), np.concatenate([n_left, n_right]))
        rows %= len(open_)
        b = np.searchsorted(ends_b, ends_a[at])
        hit = ends_b[b] == ends_a[at]
        rows, at, b = rows[hit], at[hit], b[hit]
        order = np.lexsort((np.abs(at - m[rows]), rows))
        rows, at, b = rows[order], at[order], b[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
        found_a[open_[rows[first]]], found_b[open_[rows[first]]] = at[first], b[first]
        done = (m - reach + 1 <= lo) & (m + reach - 1 >= hi)
        open_ = open_[(found_a[open_] < 0) & ~done]
        near, reach = reach, 2 * reach
    return found_a, found_b


def shared_groups(ends_a: np.ndarray, ends_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First A and first B token of every leaf group of texts whose tokens lie one after another.

    ends_*: end offsets of all tokens, rising; texts_*: n+1 offsets of the texts' tokens in them.
    """
    some = np.flatnonzero(np.diff(texts_a) > 0)
    a0, a1, b0, b1 = texts_a[some], texts_a[some + 1], texts_b[some], texts_b[some + 1]
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a0):
        at, bt = np.full(len(a0), -1), np.full(len(a0), -1)
        wide = np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1))
        at[wide], bt[wide] = middle_cuts(a0[wide], a1[wide], ends_a, ends_b)
        leaf, cut = at < 0, at >= 0
        leaves.append((a0[leaf], b0[leaf]))
        a0, a1, b0, b1 = (np.concatenate(x) for x in ((a0[cut], at[cut] + 1), (at[cut] + 1, a1[cut]), (b0[cut], bt[cut] + 1), (bt[cut] + 1, b1[cut])))
    if not leaves:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first_a, first_b = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.argsort(first_a)
    return first_a[order], first_b[order]


def digit_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1 as bytes, padded by zeros to one byte more than the longest, and how many there are."""
    text = np.char.encode(np.arange(n).astype(str), "ascii")
    width = text.dtype.itemsize
    table = np.zeros((n, width + 1), np.uint8)
    table[:, :width] = np.frombuffer(text.tobytes(), np.uint8).reshape(n, width)
    return table, (table > 0).sum(axis=1)


@dataclass
class Groups:
    """Leaf groups of a slice of texts: their first tokens, sizes, and texts."""

    first_a: np.ndarray
    first_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    text: np.ndarray

    def spelt(self, ids_a: np.ndarray, ids_b: np.ndarray, digits: tuple[np.ndarray, np.ndarray], n_texts: int) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of every text."""
        table, lengths = digits
        ids, mark = np.zeros(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
        # a group's A tokens stand behind all tokens of the groups before it, its B tokens behind its A tokens
        ids[np.arange(len(ids_a)) + np.repeat(self.first_b, self.n_a)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(self.first_a + self.n_a, self.n_b)] = ids_b
        ends_a, ends_b = self.first_a + self.n_a, self.first_b + self.n_b
        mark[ends_a + self.first_b - 1] = ord("|")
        mark[ends_a + ends_b - 1] = ord(";")
        wide, n = table[ids], lengths[ids]
        wide[np.arange(len(ids)), n] = mark
        flat = wide.ravel()
        flat = flat[flat > 0].tobytes()
        at = np.r_[0, np.cumsum(n + 1)]
        upto = np.searchsorted(self.text, np.arange(n_texts + 1))
        ends = at[np.r_[ends_a + ends_b, 0][upto - 1]].tolist()  # behind the last group of each text and those before it
        return [flat[x : max(x, y - 1)] for x, y in zip(ends[:-1], ends[1:], strict=True)]

    def pairs(self, ids_a: np.ndarray, ids_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair code, occurrences) of the distinct linked id pairs of every text, ordered."""
        small = self.n_a * self.n_b <= WIDE
        group = np.repeat(np.arange(len(self.first_a)), self.n_a)
        own, at_b = ragged(self.first_b[group], np.where(small, self.n_b, 0)[group])
        key, times = counted(self.text[group[own]] << 32 | ids_a[own] * size_b + ids_b[at_b])
        for g in np.flatnonzero(~small):
            # long runs without a shared cut repeat few ids: count by distinct ones
            a, times_a = counted(ids_a[self.first_a[g] : self.first_a[g] + self.n_a[g]])
            b, times_b = counted(ids_b[self.first_b[g] : self.first_b[g] + self.n_b[g]])
            more = (self.text[g] << 32 | a[:, None] * size_b + b[None, :]).ravel()
            key, times = summed(np.concatenate([key, more]), np.concatenate([times, (times_a[:, None] * times_b[None, :]).ravel()]))
        return key >> 32, key & 0xFFFFFFFF, times


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    starts = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]])
    return keys[starts], np.diff(np.r_[starts, len(keys)])


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def narrow(times: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return times.astype(np.min_scalar_type(int(times.max(initial=0))).newbyteorder("<")).tobytes()


def widened(times: bytes, n: int) -> np.ndarray:
    return np.frombuffer(times, f"<u{len(times) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


ALIGNED = pa.schema([("id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary())])


def align_texts(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            for lo, hi in slices(offsets, 1 << 20):
                pair = token_pair(path_a, path_b)
                size_b, n = len(pair.bytes_b), hi - lo
                texts = [raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(lo, hi)]
                encoded = pair.encode(texts)
                ids, offset = [], []
                for side in (0, 1):
                    parts = [e[side] if e else b"" for e in encoded]
                    ids.append(np.frombuffer(b"".join(parts), "<i4").astype(np.int64))
                    offset.append(np.cumsum([0, *(len(p) // 4 for p in parts)]))
                (ids_a, ids_b), (texts_a, texts_b) = ids, offset
                first_a, first_b = shared_groups(np.cumsum(pair.lengths_a[ids_a]), np.cumsum(pair.lengths_b[ids_b]), texts_a, texts_b)
                groups = Groups(first_a, first_b, np.diff(np.r_[first_a, len(ids_a)]), np.diff(np.r_[first_b, len(ids_b)]), np.searchsorted(texts_a, first_a, "right") - 1)
                spelt = groups.spelt(ids_a, ids_b, pair.digits, n)
                text, code, times = groups.pairs(ids_a, ids_b, size_b)
                links = np.zeros(n, np.int64)
                np.add.at(links, groups.text, groups.n_a * groups.n_b)
                at = np.searchsorted(text, np.arange(n + 1))
                code, cuts = code.astype("<u4"), list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, n), pa.array(np.diff(texts_a)), pa.array(np.diff(texts_b)), pa.array(np.bincount(groups.text, minlength=n).astype(np.int64)), pa.array(links),
                     pa.array([hashlib.sha256(s).hexdigest() if e else "" for s, e in zip(spelt, encoded, strict=True)]), pa.array([code[x:y].tobytes() for x, y in cuts], pa.binary()),
                     pa.array([narrow(times[x:y]) for x, y in cuts], pa.binary())],
                    schema=ALIGNED,
                )

    return run


def pair_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair codes to (code, documents) of a task, in parts of bounded size."""
    runs: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[np.ndarray] = []

    def rows() -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(runs[0][0]) if runs else 0, 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + (1 << 18)]) for x in runs[0]], names=["code", "n"])

    for batch in batches:
        held.append(np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<u4").astype(np.int64))
        if sum(map(len, held)) > 1 << 21:
            runs.append(counted(np.concatenate(held)))
            held = []
        if sum(len(r[0]) for r in runs) > 1 << 22:
            runs = [summed(*map(np.concatenate, zip(*runs, strict=True)))]
            if len(runs[0][0]) > 1 << 21:
                yield from rows()
                runs = []
    if held:
        runs.append(counted(np.concatenate(held)))
    if runs:
        runs = [summed(*map(np.concatenate, zip(*runs, strict=True)))]
    yield from rows()


def looked_up(head: np.ndarray, counts: np.ndarray, best: np.ndarray, size_b: int):
    """What the most frequent pairs give each text, and its other pairs."""
    keep = ("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("codes").to_pylist()
            sizes = [len(r) // 4 for r in raw]
            code = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
            times = np.concatenate([np.zeros(0, np.int64), *map(widened, batch.column("times").to_pylist(), sizes)])
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(head, code), max(len(head) - 1, 0))
            hit = head[at] == code if len(head) else np.zeros(len(code), bool)
            n = counts[at[hit]]
            top = n == best[code[hit] // size_b]
            total, most = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner[hit], n * times[hit])
            np.add.at(most, owner[hit][top], times[hit][top])
            rest = np.r_[0, np.cumsum(np.bincount(owner[~hit], minlength=batch.num_rows))].astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~hit])) for x in (code, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(total), pa.array(most), *left], names=[*keep, "count_sum", "n_best", "codes", "times"])

    return run


def align_tokenizers(docs: DataFrame, tokenizer_a: str, model_b: str, text: str = "text", id_col: str = "doc_id", head: int = HEAD) -> DataFrame:
    """Aligns the tokens of a byte-level tokenizer (file tokenizer_a) and a SentencePiece model (model_b) in every text.

    A reads a space and the text, B the text, before which it puts that space itself. Returns per row: the id, n_a, n_b,
    n_groups, n_links (pairs of an A and a B token of one group), n_best (links whose pair is in as many documents
    as any pair of its A id), count_sum (documents that hold its pair, summed over links), groups_sha256. Texts that are
    null or empty, or that the tokens don't spell byte by byte, have no tokens: zeros and ''. Every row is a document of its
    own, whatever its id (null ids stay null). An empty table gives an empty table. At most `head` pairs are sent
    to workers; any value gives the same rows.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary"
    aligned = staged(arrow_map(keyed, align_texts(tokenizer_a, model_b), schema, cached=True).withColumn("row", F.monotonically_increasing_id()), "aligned")
    from sentencepiece import SentencePieceProcessor

    size_b = SentencePieceProcessor(model_file=model_b).vocab_size()
    of_a = F.floor(F.col("code") / size_b).cast("int")
    counts = staged(arrow_map(aligned.select("codes"), pair_documents, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    counts = counts.withColumn("level", F.floor(F.log2("n") * 8))
    # at most one row an A id, and eight levels a doubling
    tops = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("top"))
    of_id = {r["a"]: r["top"] for r in tops.collect()}
    best = np.zeros(max(of_id, default=0) + 1, np.int64)
    best[list(of_id)] = list(of_id.values())
    least, room = None, head
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["level"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["level"]
    frequent = counts.where(F.col("level") >= least).select("code", "n").toPandas().sort_values("code") if least is not None else None
    codes, ns = (frequent[c].to_numpy(np.int64) if frequent is not None else np.zeros(0, np.int64) for c in ("code", "n"))
    out = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, count_sum long, n_best long, codes array<long>, times array<long>"
    found = staged(arrow_map(aligned, looked_up(codes, ns, best, size_b), out), "aligned-found")
    pairs = found.select("row", F.explode(F.arrays_zip("codes", "times")).alias("p")).select("row", F.col("p.codes").alias("code"), F.col("p.times").alias("times"))
    rare = counts if least is None else counts.where(F.col("level") < least)
    met = pairs.join(rare.select("code", "n"), "code").join(F.broadcast(tops), of_a == F.col("a"))
    tail = met.groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("tail_sum"), F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("tail_best"))
    none = F.lit(0).cast("long")
    return found.join(tail, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("tail_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("tail_sum", none)).alias("count_sum"), "groups_sha256",
    )

