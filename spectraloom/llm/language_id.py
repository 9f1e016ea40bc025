"""Language identification with error-correcting output codes (operator 8).

Each language has a codeword; one linear classifier per bit, on hashed byte trigrams of a text's letters,
predicts that bit. Decoding weighs each bit's loss by how well its classifier does on each language and takes
the codeword of least loss; a small gap to the second codeword flags the text as ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, slices, text_buffers

BITS = 12
#: Training texts: at most PER_LANGUAGE for a language and MOST in all (8 a language where there are over MOST / 8), of smallest hash.
PER_LANGUAGE, MOST = 600, 4000
#: Loss gap, as a share of all bits' weight, under which a prediction is flagged as ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"


def _folding() -> np.ndarray:
    """Byte to byte: ASCII letters lowered, other ASCII to space, the rest kept."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    for c in range(ord("a"), ord("z") + 1):
        table[c] = table[c - 32] = c
    return table


FOLD = _folding()


def trigram_features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: square roots of hashed trigram shares, unit length (zero where there is no trigram)."""
    n = len(offsets) - 1
    counts = np.zeros((n, 1 << BITS), np.float32)
    for a, b in slices(offsets, 1 << 20):
        part = raw[offsets[a] : offsets[b]]
        for lo in range(0, max(len(part) - 2, 0), 1 << 20):  # a long text in blocks that overlap by two bytes
            x = FOLD[part[lo : lo + (1 << 20) + 2]]
            capital = (x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E)
            x[1:][capital] |= 0x20
            if len(x) < 3:
                continue
            h = x[:-2].astype(np.uint32) * np.uint32(0x9E3779B1) + x[1:-1].astype(np.uint32) * np.uint32(0x85EBCA6B) + x[2:].astype(np.uint32) * np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            slot = (h >> np.uint32(32 - BITS)).astype(np.int64)
            at = np.arange(len(slot)) + offsets[a] + lo
            row = np.searchsorted(offsets[a + 1 : b + 1], at, "right")
            real = ((x[:-2] != 32) | (x[1:-1] != 32)) & ((x[1:-1] != 32) | (x[2:] != 32)) & (at + 2 < offsets[a + 1 : b + 1][row])
            counts[a:b] += np.bincount((row[real] << BITS) + slot[real], minlength=(b - a) << BITS).reshape(b - a, -1)
    np.sqrt(counts, out=counts)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def codewords(n: int) -> np.ndarray:
    """n codewords of +-1: all splits of up to 6 languages, hashed bits for more."""
    if n <= 6:
        columns = range(1, 1 << (n - 1)) if n > 1 else [1]
        return np.array([[1 if i == n - 1 or not c >> i & 1 else -1 for c in columns] for i in range(n)], float) if n > 1 else np.ones((1, 1))
    width = 10 * math.ceil(math.log2(n))
    return np.where(np.random.default_rng(n).random((n, width)) < 0.5, -1.0, 1.0)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weights: np.ndarray  # feature x bit
    bias: np.ndarray
    trust: np.ndarray  # language x bit, rows sum to 1

    def predict(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's index, its score in 0..1 and whether it is ambiguous."""
        margin = features @ self.weights + self.bias
        loss = np.stack([(np.maximum(0, 1 - margin * c) * t).sum(axis=1) for c, t in zip(self.code, self.trust, strict=True)], axis=1)
        best = loss.argmin(axis=1)
        ranked = np.sort(loss, axis=1)
        gap = ranked[:, 1] - ranked[:, 0] if loss.shape[1] > 1 else np.ones(len(loss))
        p = np.exp(-6 * (loss - ranked[:, :1]))
        return best, 1 / p.sum(axis=1), gap < AMBIGUOUS


def ridge_weights(x: np.ndarray, share: np.ndarray, y: np.ndarray, mean: np.ndarray, ridge: float, rounds: int = 300, exact: float = 1e-5) -> np.ndarray:
    """Weighted ridge regression of y on the centred rows of x, by conjugate gradients: nothing larger than x is held."""

    def back(r: np.ndarray) -> np.ndarray:
        return (x.T @ r.astype(np.float32)).astype(float) - np.outer(mean, r.sum(axis=0))

    def product(v: np.ndarray) -> np.ndarray:
        z = (x @ v.astype(np.float32)).astype(float) - mean @ v
        return back(z * share[:, None]) + ridge * v

    rest = back(y * share[:, None])
    out, way = np.zeros_like(rest), rest.copy()
    size = first = (rest**2).sum(axis=0)
    for _ in range(rounds):
        if (size <= exact**2 * first).all():
            break
        step = product(way)
        # a column that is solved stands still
        a = np.where(size > 0, size / np.maximum((way * step).sum(axis=0), 1e-300), 0)
        out += a * way
        rest -= a * step
        now = (rest**2).sum(axis=0)
        way = rest + np.where(size > 0, now / np.maximum(size, 1e-300), 0) * way
        size = now
    return out


def fit(features: np.ndarray, labels: np.ndarray, languages: list[str], ridge: float = 0.3) -> Model:
    """Least-squares bit classifiers, each language weighing the same; trust from held-in accuracy by language and bit."""
    code = codewords(len(languages))
    x = np.ascontiguousarray(features, np.float32)
    share = (1 / np.bincount(labels, minlength=len(languages)))[labels]
    total = share.sum()
    mean = (share.astype(np.float32) @ x / total).astype(float)
    y = code[labels]
    y0 = share @ y / total
    spread = share @ (np.einsum("ij,ij->i", x, x) - 2 * (x @ mean.astype(np.float32)) + mean @ mean)
    weights = ridge_weights(x, share, y - y0, mean, ridge * float(spread) / len(x))
    bias = y0 - mean @ weights
    margin = x @ weights.astype(np.float32) + bias
    right = np.array([np.clip((margin[labels == i] * code[i]).mean(axis=0), 0.05, 1) for i in range(len(languages))])
    return Model(languages, code, weights.astype(np.float32), bias, right / right.sum(axis=1, keepdims=True))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[tuple] = set()  # of drawn texts, so bounded as they are
    for batch in batches:
        new = []
        for i, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("h").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                new.append(i)
        batch = batch.take(pa.array(new, pa.int64()))
        raw, offsets = text_buffers(batch.column("text"))
        for a in range(0, batch.num_rows, 256):
            b = min(a + 256, batch.num_rows)
            x = trigram_features(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            some = [np.flatnonzero(r) for r in x]
            columns = [pa.array([n.astype("<u2").tobytes() for n in some], pa.binary()), pa.array([r[n].astype("<f4").tobytes() for r, n in zip(x, some, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a, b - a), batch.column("h").slice(a, b - a), *columns], names=["lang", "h", "slots", "shares"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, most: int = MOST) -> Model | None:
    """Fits on a bounded sample of labelled texts, the smallest hashes of each language, copies counted once; None without labels."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("h")).where("lang is not null and text is not null")
    texts = labelled.select("lang", "h").distinct()
    names = sorted(r["lang"] for r in texts.select("lang").distinct().collect())
    if not names:
        return None
    each = max(8, min(per_language, most // len(names)))
    drawn = texts
    for part in (["lang", F.pmod("h", F.lit(64))], ["lang"]):  # a language's parts first, so that one task reads 64 bounded parts
        drawn = drawn.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy("h"))).where(F.col("_r") <= each).drop("_r")
    met = labelled.join(F.broadcast(drawn), ["lang", "h"]).select("text", "lang", "h")
    rows = arrow_map(met, _sample_features, "lang string, h long, slots binary, shares binary").dropDuplicates(["lang", "h"]).toPandas()
    rows = rows.sort_values(["lang", "slots", "shares"], kind="stable")
    x = np.zeros((len(rows), 1 << BITS), np.float32)
    for r, slots, shares in zip(x, rows["slots"], rows["shares"], strict=True):
        r[np.frombuffer(slots, "<u2")] = np.frombuffer(shares, "<f4")
    return fit(x, np.array([names.index(v) for v in rows["lang"]]), names)


def predictor(model: Model | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            rest = [n for n in batch.schema.names if n != "text"]
            for lo in range(0, batch.num_rows, 512):
                hi = min(lo + 512, batch.num_rows)
                own, bounds = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                n = hi - lo
                letters = np.array([has_letter(own[a:b].tobytes()[:256]) or has_letter(own[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], bool)
                if model is None:
                    names, score, unsure = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                else:
                    best, score, unsure = model.predict(trigram_features(own, bounds))
                    names = [model.languages[i] if k else UNKNOWN for i, k in zip(best, letters, strict=True)]
                    score = np.where(letters, score, 0.0)
                    unsure = unsure | ~letters
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, n) for c in rest), pa.array(names), pa.array(score.astype(float)), pa.array(unsure)], names=[*rest, "lang_pred", "score", "ambiguous"])

    return run


def identify(docs: DataFrame, model: Model | None, keep: list[Column | str], text: str = "text") -> DataFrame:
    """The `keep` columns with lang_pred, score (0 to 1) and ambiguous, for every row.

    A null text or one without a letter is `und` with score 0, flagged ambiguous, as is every text when there
    was nothing to learn from. Repeated rows and repeated or null ids keep their rows. Names of `keep` may not
    be `text`, `lang_pred`, `score` or `ambiguous`.
    """
    own = docs.select(*keep, F.col(text).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text")
    return arrow_map(own, predictor(model), f"{fields}, lang_pred string, score double, ambiguous boolean")


def held_out(id_col: str, parts: int, which: int) -> Column:
    """Whether crc32 of the id as text leaves `which` modulo `parts`; a null id is held out of nothing."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == which, F.lit(False))
