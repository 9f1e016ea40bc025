"""Sequence packing by shortest-pack-first over the length histogram (operator 6).

Texts become token ids, one end id is added, and each document is cut into full sequences and, of what is
left, pieces of 1024, 512 and 256 tokens and a rest below 256: lengths that fill a sequence whatever lengths
the corpus has. Only the histogram of piece lengths (at most `size` numbers) reaches the driver. There lengths
are placed longest first, each into the least filled pack that has room, as counts of packing patterns; the
patterns' slots are looked up by the pieces' rank among pieces of the same length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, PART_ROWS, arrow_map, ranked, row_id, slices, staged, text_buffers, worker_cache

PIECE_SCHEMA = "id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Words whose ids a worker keeps, in each of two generations.
CACHE_WORDS = 250_000
#: Texts of these characters only (ASCII and Latin letters) are split here as the tokenizer's own pattern splits them; others go to it whole.
PLAIN = re.compile(r"[\t\n\r !-~À-ÖØ-öø-įı-ſ]*")
#: The tokenizer's split pattern for such characters in lower case (fixed values).
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\sa-z0-9ß-öø-ſ]+")


class WordEncoder:
    """Ids of texts by a tokenizer that lowers case, splits at white space, letters and digits, and ends words by `</w>`.

    The ids of a split word depend on that word alone, so each distinct one that a worker meets goes to the
    tokenizer once, many in a call, and the word-end tokens tell which ids are whose.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str]) -> None:
        unknown = []
        for w in words:
            if (ids := self.old.get(w)) is None:
                unknown.append(w)
            else:
                self.young[w] = ids
        for a in range(0, len(unknown), 2000):
            some = unknown[a : a + 2000]
            ids = self.ids(["\n".join(some)])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and (not len(ids) or cuts[-1] == len(ids)):
                flat, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.young.update(zip(some, [flat[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], strict=True))
            else:
                self.young.update(zip(some, [x.tobytes() for x in self.ids(some)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        parts = [SPLIT.findall(t.lower()) if PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        missing: set[str] = set()
        for p in parts:
            missing.update(p or ())
        self.learn(missing.difference(self.young))
        get = self.young.__getitem__
        return [self.ids([t])[0].tobytes() if p is None else b"".join(map(get, p)) for t, p in zip(texts, parts, strict=True)]


def encoder(path: str) -> WordEncoder:
    return worker_cache(("words", path), lambda: WordEncoder(path))


def piece_lengths(n: int, size: int, grain: int) -> list[int]:
    out = [size] * (n // size)
    left, part = n % size, size // 2
    while part >= grain:
        if left >= part:
            out.append(part)
            left -= part
        part //= 2
    return out + [left] * (left > 0)


def cut_pieces(path: str, end_id: int, size: int, grain: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for a, b in slices(offsets, 1 << 20):
                cols: list[list[int]] = [[], [], [], [], []]
                texts = [raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(a, b)]
                for id_, tokens in zip(ids[a:b], encoder(path).encode(texts), strict=True):
                    tokens += end
                    at, n = 0, len(tokens) // 4
                    for m in piece_lengths(n, size, grain):
                        for c, v in zip(cols, (id_, at, m, zlib.crc32(tokens[4 * at : 4 * (at + m)]), n), strict=True):
                            c.append(v)
                        at += m
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Packing patterns as (count, lengths): lengths placed longest first, each into the least filled packs that have room."""
    open_: dict[int, list[tuple[int, list[int]]]] = {}  # by room left
    done: list[tuple[int, list[int]]] = []

    def put(count: int, pack: list[int], room: int) -> None:
        if room:
            open_.setdefault(room, []).append((count, pack))
        else:
            done.append((count, pack))

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            room = max((r for r in open_ if r >= length), default=None)
            if room is None:
                # a new pack takes as many of this length as a fresh pack holds; a last one takes the rest
                each = size // length
                full, rest = divmod(todo, each)
                if full:
                    put(full, [length] * each, size - each * length)
                if rest:
                    put(1, [length] * rest, size - rest * length)
                todo = 0
                break
            count, pack = open_[room].pop()
            if not open_[room]:
                del open_[room]
            # a pattern takes as many of the length as keep the packs even
            used = min(count, todo)
            if used < count:
                put(count - used, pack, room)
            put(used, [*pack, length], room - length)
            todo -= used
    for packs in open_.values():
        done += packs
    return done


def slots_of(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, packs, first sequence, offset) of every run of equal lengths of every pattern.

    A run of r equal lengths in `packs` packs holds r * packs ranks: all packs' first places, then their second ones.
    There are at most 3 patterns for each length up to `size`, and 63 different lengths fit in 2048, so the slots are
    bounded by the sequence length (387,000 for 2048), whatever the corpus.
    """
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for packs, lengths in patterns:
        offset = 0
        for length, run in groupby(lengths):
            r = len(list(run))
            lo = ranks.get(length, 0)
            out.append((length, lo, packs, sequence, offset))
            ranks[length] = lo + packs * r
            offset += length * r
        sequence += packs
    return out


def place_pieces(slots: list[tuple[int, int, int, int, int]]) -> Callable:
    """Rows with length and rank to rows with sequence_id and offset, by binary search in the slots."""
    table = np.array(sorted(slots), np.int64).reshape(-1, 5).T
    codes = table[0] << 44 | table[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            _, lo, packs, first, offset = table[:, np.searchsorted(codes, length << 44 | rank, "right") - 1]
            turn, pack = np.divmod(rank - lo, packs)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(first + pack), pa.array(offset + turn * length)], names=[*names, "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", size: int = 2048, grain: int = 256, end_id: int = 1, part_rows: int = PART_ROWS) -> DataFrame:
    """Packs all tokens of docs into sequences of at most `size` ids.

    `tokenizer` is the path of a tokenizer file as `WordEncoder` describes. Returns per piece: the id,
    start (its document's ids before it), length, ids_crc32, doc_tokens, sequence_id (from 0) and offset in it.
    A null or empty text is its end id alone. Null ids keep null; repeated ids and repeated rows are packed each
    for itself. An empty table gives no piece. Pieces of one length are numbered in parts of about `part_rows`.
    """
    keyed = docs.select(row_id(id_col).alias("id"), F.col(text).alias("text"))
    pieces = staged(arrow_map(keyed, cut_pieces(tokenizer, end_id, size, grain), PIECE_SCHEMA, cached=True), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    numbered = ranked(pieces, "length", ["id", "start", "doc_tokens", "ids_crc32"], "rank", F.xxhash64("id", "start", "ids_crc32"), histogram, part_rows)
    placed = arrow_map(numbered, place_pieces(slots_of(shortest_pack_first(histogram, size))), f"{PIECE_SCHEMA}, sequence_id long, offset long")
    return placed.select(
        F.when(F.col("id") != F.lit(NULL_ID), F.col("id")).alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        "sequence_id", "offset",
    )
