"""SentencePiece encoding and decoding by suffix-array matching (operator 4).

For a byte-pair model with byte fallback. Text is cut where no piece can span (before a run of word marks, around line
ends), and each distinct chunk that a worker has not met is put into one batch text. The batch is indexed by a
suffix array (prefix doubling, as deep as the longest piece); every piece is binary-searched for its range of
occurrences; the occurrences, sorted by position, are the edges. Relaxing takes, in every segment at once, the
edge of best score (leftmost of equal ones) that spans exactly two of the symbols reached so far, until none does:
the model's merges. A segment ends where no edge that is left spans the border; so long texts without a space don't
take a round for each of their merges. If nothing that can be merged from a piece scores as well as the piece, no
merge of it can make a better edge, and all its edges that are a segment's best are taken in one round.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, row_id, slices, text_buffers, worker_cache

MARK = "▁"
CHUNK = re.compile(r"▁+[^▁\n]*|[^▁\n]+|\n")
#: Characters indexed at once; chunks a worker keeps in each of two generations.
BATCH_CHARS, CACHE_CHUNKS = 500_000, 300_000


class PieceTable:
    """What encoding needs of a model file: pieces with scores, byte pieces, and the bytes each id decodes to."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_ids = np.zeros(256, np.int64)
        self.decoded: list[bytes] = [b""] * model.vocab_size()
        normal = []
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.decoded[i] = bytes([int(piece[3:5], 16)])
            else:
                normal.append((piece, i, model.get_score(i)))
                self.decoded[i] = piece.replace(MARK, " ").encode()
        self.chars = np.array(sorted({ord(c) for p, _, _ in normal for c in p}), np.int64)
        self.char_ids = np.full(len(self.chars) + 1, -1, np.int64)  # by letter number, 0 for letters of no piece
        for p, i, _ in normal:
            if len(p) == 1:
                self.char_ids[1 + np.searchsorted(self.chars, ord(p))] = i
        long_ = [x for x in normal if len(x[0]) > 1]
        self.longest = max((len(p) for p, _, _ in long_), default=1)
        scores = sorted({s for _, _, s in long_}, reverse=True)
        self.lengths = np.array([len(p) for p, _, _ in long_], np.int64)
        self.ids = np.array([i for _, i, _ in long_], np.int64)
        self.ranks = np.searchsorted(-np.array(scores), np.array([-s for _, _, s in long_])).astype(np.int64)  # 0 is the best score
        rank = dict(zip([p for p, _, _ in long_], self.ranks.tolist(), strict=True))
        self.settled = np.ones(len(scores) + 1, bool)  # by rank: nothing merged from the piece ranks as well
        for p, r in rank.items():
            for i in range(1, len(p)):
                if all(len(part) == 1 or part in rank for part in (p[:i], p[i:])):
                    for part in (p[:i], p[i:]):
                        if rank.get(part, -1) >= r:
                            self.settled[rank[part]] = False
        # each piece's key padded by the least and by the greatest bytes: the bounds of its occurrences
        self.least, self.most = (np.full((len(long_), 2 * self.longest), fill, np.uint8) for fill in (0, 255))
        for row, (p, _, _) in enumerate(long_):
            self.least[row, : 2 * len(p)] = self.most[row, : 2 * len(p)] = self.keys(self.letters(p)[:, None]).view(np.uint8)

    def letters(self, text: str) -> np.ndarray:
        """Numbers from 1 of the letters that pieces are made of; 0 for any other."""
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        return np.where(self.chars[at] == code, at + 1, 0)

    @staticmethod
    def keys(letters: np.ndarray) -> np.ndarray:
        """Rows of letters as byte strings in the same order (two bytes a letter, neither of them zero)."""
        pairs = np.empty((*letters.shape, 2), np.uint8)
        pairs[..., 0], pairs[..., 1] = letters // 255 + 1, letters % 255 + 1
        flat = pairs.reshape(len(letters), -1)
        return flat.view(f"S{flat.shape[1]}").reshape(-1)

    def suffix_array(self, letters: np.ndarray) -> np.ndarray:
        """Positions in the order of their next `longest` letters (prefix doubling)."""
        n = len(letters)

        def ahead(values: np.ndarray) -> np.ndarray:
            out = np.zeros(n, np.int64)
            out[: max(n - width, 0)] = values[width:]
            return out

        # as many letters as fit in one number first; the text's end sorts before all letters
        rank, width, bits = letters + 1, 1, (len(self.chars) + 1).bit_length()
        while 2 * bits < 63 and width < self.longest:
            rank = (rank << bits) | ahead(rank)
            width, bits = 2 * width, 2 * bits
        while True:
            order = np.argsort(rank)
            if width >= self.longest:
                return order
            ordered = rank[order]
            dense = np.empty(n, np.int64)
            dense[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
            rank = dense * (n + 1) + ahead(dense)
            width *= 2

    def edges(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, end, id and rank of score of every occurrence of every piece of two or more letters, by start."""
        order, wide = self.suffix_array(letters), 2 * self.longest
        pairs = self.keys(np.concatenate([letters, np.zeros(self.longest, np.int64)])[:, None]).view(np.uint8)
        suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(pairs, wide)[::2][order]).view(f"S{wide}").reshape(-1)
        lo = np.searchsorted(suffixes, self.least.view(f"S{wide}").reshape(-1), "left")
        hi = np.searchsorted(suffixes, self.most.view(f"S{wide}").reshape(-1), "right")
        times = hi - lo
        piece = np.repeat(np.arange(len(times)), times)
        start = order[np.arange(len(piece)) + np.repeat(lo - np.cumsum(times) + times, times)]
        by = np.argsort(start * (self.longest + 1) + self.lengths[piece])
        start, piece = start[by], piece[by]
        return start, start + self.lengths[piece], self.ids[piece], self.ranks[piece]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each chunk."""
        text = "\0".join(chunks) + "\0"  # no piece holds the separator, so no edge spans it
        letters = self.letters(text)
        sizes = np.array([len(c) + 1 for c in chunks])
        first = np.r_[0, np.cumsum(sizes)]
        chunk_of = np.repeat(np.arange(len(chunks)), sizes)
        start, end, ids, rank = self.edges(letters)
        token = self.char_ids[letters]
        border = np.ones(len(letters) + 1, bool)
        while len(start):
            before = np.cumsum(border) - border
            inside = before[end] - before[start]
            alive = border[start] & border[end] & (inside >= 2)
            start, end, ids, rank, inside = start[alive], end[alive], ids[alive], rank[alive], inside[alive]
            ready = np.flatnonzero(inside == 2)
            if not len(ready):
                break
            # edges in order of start fall in segments that none of them reaches beyond
            segment = np.cumsum(np.r_[True, start[1:] >= np.maximum.accumulate(end)[:-1]])[ready]
            heads = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            least = np.minimum.reduceat(rank[ready], heads)
            equal = rank[ready] == np.repeat(least, np.diff(np.r_[heads, len(ready)]))
            best, own = ready[equal], segment[equal]
            best = best[self.settled[rank[best]] | np.r_[True, own[1:] != own[:-1]]]
            # of a run of equal edges that overlap every other one is taken, from the left
            fresh = np.r_[True, start[best][1:] >= end[best][:-1]]
            at = np.arange(len(best))
            best = best[(at - np.maximum.accumulate(np.where(fresh, at, 0))) % 2 == 0]
            # exactly one border lies strictly between
            border[np.flatnonzero(border)[before[start[best]] + 1]] = False
            token[start[best]] = ids[best]
        heads = np.flatnonzero(border[:-1])
        heads = heads[heads != first[chunk_of[heads] + 1] - 1]  # separators
        values = token[heads]
        unknown = values < 0
        if unknown.any():
            raw = [text[h].encode("utf-8", "surrogatepass") for h in heads[unknown].tolist()]
            times = np.ones(len(heads), np.int64)
            times[unknown] = [len(r) for r in raw]
            out = np.repeat(values, times)
            out[np.repeat(unknown, times)] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
            owner = np.repeat(chunk_of[heads], times)
        else:
            out, owner = values, chunk_of[heads]
        cuts = (4 * np.searchsorted(owner, np.arange(len(chunks) + 1))).tolist()
        flat = out.astype("<u4").tobytes()
        return [flat[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.decoded[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Encoder:
    def __init__(self, path: str):
        self.table = PieceTable(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, chunks: set[str]) -> None:
        unknown = []
        for c in chunks:
            if (ids := self.old.get(c)) is None:
                unknown.append(c)
            else:
                self.young[c] = ids
        ends = np.r_[0, np.cumsum([len(c) + 1 for c in unknown])]
        for a, b in slices(ends, BATCH_CHARS):
            self.young.update(zip(unknown[a:b], self.table.encode_chunks(unknown[a:b]), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.young) > CACHE_CHUNKS:
            self.old, self.young = self.young, {}
        parts = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        missing: set[str] = set()
        for p in parts:
            missing.update(p)
        self.learn(missing.difference(self.young))
        get = self.young.__getitem__
        return [np.frombuffer(b"".join(map(get, p)), "<u4") for p in parts]


def encoder(path: str) -> Encoder:
    return worker_cache(("pieces", path), lambda: Encoder(path))


def encode_pieces(docs: DataFrame, model: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Ids of every text: the id column as long, `text` and `ids` (array<int>).

    `model` is the path of a byte-pair SentencePiece model with identity normalisation, a dummy prefix, byte
    fallback and no piece with a word mark after another letter. Null and empty texts have no ids. Repeated rows and
    repeated or null ids keep their rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            for a, b in slices(offsets, 4 << 20):
                texts = [raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in range(a, b)]
                ids = encoder(model).encode(texts)
                cuts = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text"), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))], names=["id", "text", "ids"])

    keyed = docs.select(row_id(id_col).alias("id"), F.col(text).alias("text"))
    out = arrow_map(keyed, run, "id long, text string, ids array<int>", cached=True)
    return out.select(F.when(F.col("id") != F.lit(-(1 << 63)), F.col("id")).alias(id_col), "text", "ids")


def decode_pieces(encoded: DataFrame, model: str, keep: list[str], keep_ids: bool = False) -> DataFrame:
    """The `keep` columns (and `ids`) with `decoded`, the text that `ids` stand for (null ids: null). Bytes that are no UTF-8 become the replacement character."""
    names = [*keep, *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, table = batch.column("ids"), encoder(model).table
            known = ids.is_valid().to_pylist()
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, cuts = ids.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)]
            out = [table.decode(flat[a:b]) if k else None for a, b, k in zip(cuts[:-1].tolist(), cuts[1:].tolist(), known, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.string())], names=[*names, "decoded"])

    own = encoded.select(*keep, "ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name in names)
    return arrow_map(own, run, f"{fields}, decoded string", cached=True)
