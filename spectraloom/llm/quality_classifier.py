"""Quality classifier: naive Bayes support vectors (operator 7).

A text is the set of its hashed byte n-grams and of indicators of how many of its word pairs double a word and how
many of its lines repeat. Each indicator is scaled by the class log-count ratio that
naive Bayes gives the n-gram, and a linear hinge-loss model on the scaled indicators is fitted by dual coordinate
descent. A logistic curve on the margin gives the score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_buffers

BITS = 16
GRAMS = (1, 2, 3, 4)
#: Labelled rows of each class that are fitted on, at most, drawn by hashed id.
PER_CLASS = 2500
BLOCK = 1 << 20
#: Shares, in thousandths, of doubled words and of repeated lines from which an indicator each is set.
STEPS = (5, 10, 20, 50, 100, 200, 300, 500, 700)
FEATURES = (1 << BITS) + 2 * len(STEPS)


def gram_set(raw: np.ndarray) -> np.ndarray:
    """Sorted distinct feature numbers of a text's bytes."""
    seen = np.zeros(FEATURES, bool)
    text = raw.tobytes()
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    for place, n, total in ((0, sum(map(eq, words, words[1:])), len(words)), (len(STEPS), len(lines) - len(set(lines)), len(lines))):
        for i, step in enumerate(STEPS):
            seen[(1 << BITS) + place + i] = 1000 * n >= step * max(total, 1)
    for lo in range(0, max(len(raw), 1), BLOCK):
        x = raw[lo : lo + BLOCK + max(GRAMS) - 1].astype(np.uint32)
        h = np.zeros(len(x), np.uint32)
        for n in range(1, max(GRAMS) + 1):
            if len(x) < n:
                break
            h = (h[: len(x) - n + 1] + x[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if n in GRAMS:
                seen[h & np.uint32((1 << BITS) - 1)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, features: np.ndarray) -> float:
        """0 to 1; the margin is scaled by the root of the number of features, so that long texts don't dominate."""
        margin = self.weights[features].sum() / max(1.0, np.sqrt(len(features))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def fit(sets: list[np.ndarray], labels: np.ndarray, prior: float, smooth: float = 1.0, cost: float = 1.0, epochs: int = 30, beta: float = 0.75) -> Model:
    y = np.where(labels == 1, 1.0, -1.0)
    totals = np.full((2, FEATURES), smooth)
    for s, v in zip(sets, labels, strict=True):
        totals[int(v == 1), s] += 1
    ratio = np.log(totals[1] / totals[1].sum()) - np.log(totals[0] / totals[0].sum())
    rows = [ratio[s] / max(1.0, np.sqrt(len(s))) for s in sets]
    square = np.array([r @ r for r in rows]) + 1.0  # the 1 is the bias's feature
    w, b, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(sets))
    rng = np.random.default_rng(7)
    bound = cost * len(sets) / 2 / np.maximum(1, np.where(y > 0, (y > 0).sum(), (y < 0).sum()))  # classes weigh the same
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(sets)):
            gradient = y[i] * (w[sets[i]] @ rows[i] + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            if new != alpha[i]:
                d = (new - alpha[i]) * y[i]
                w[sets[i]] += d * rows[i]
                b += d
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    w = beta * w + (1 - beta) * np.abs(w).mean() * np.sign(ratio) * (np.abs(ratio) > 0)
    weights = w * ratio
    margins = np.array([weights[s].sum() / max(1.0, np.sqrt(len(s))) + b for s in sets])
    slope, shift = logistic(margins, y, prior)
    return Model(weights, b, slope, shift)


def logistic(margins: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of P(label 1 | margin), classes weighed to their shares among all labelled rows; smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    if not pos or not neg:
        return 0.0, float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, prior / pos, (1 - prior) / neg) * len(y)
    scale = margins.std() or 1.0
    x = np.stack([margins / scale, np.ones(len(y))], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-3 * theta)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(theta[0], 0.0) / scale), float(theta[1])


def _sample_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        sets = [gram_set(raw[a:b]).astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(sets, pa.binary())], names=["label", "features"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """Fits on at most about `per_class` labelled ids of each class, rows of one id counted once; None without labels of 0 or 1."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and id is not null").distinct()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    draw = F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") / float(1 << 53)
    share = F.when(F.col("label") == 1, per_class / counts.get(1, 1)).otherwise(per_class / counts.get(0, 1))
    sample = known.where(draw < share)  # about 2 x per_class rows, whatever the table's size
    drawn = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")
    rows = arrow_map(drawn, _sample_sets, "label int, features binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["label", "features"], kind="stable")
    sets = [np.frombuffer(b, "<u4").astype(np.int64) for b in rows["features"]]
    return fit(sets, rows["label"].to_numpy(), counts.get(1, 0) / sum(counts.values()))


def scorer(model: Model | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            rest = [n for n in batch.schema.names if n != "text"]
            score = [0.5 if model is None else model.score(gram_set(raw[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(score, pa.float64())], names=[*rest, "score"])

    return run


def score_quality(docs: DataFrame, model: Model | None, keep: list, text: str = "text") -> DataFrame:
    """The `keep` columns with score (0 to 1), for every row.

    Null and empty texts have no feature and get the score of the bare bias. Without a model every score is
    0.5. Repeated rows and repeated or null ids keep their rows. Names of `keep` may not be `text` or `score`.
    """
    own = docs.select(*keep, F.col(text).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "text")
    return arrow_map(own, scorer(model), f"{fields}, score double")
