"""Repeated-string removal against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spectraloom.llm.substrings import deep_shallow, remove_repeats

import numpy as np


def brute(texts: list[str | None], length: int, also: list[list[tuple[int, int]]] | None = None) -> list[bytes]:
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    kept = []
    for n, r in enumerate(raw):
        gone = np.zeros(len(r), bool)
        for a, b in also[n] if also else ():
            gone[a:b] = True
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept.append(bytes(b for b, g in zip(r, gone, strict=True) if not g))
    return kept


def texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = [prose(12) for _ in range(4)]
    out: list[str | None] = [None, "", "short", "a" * 300, "ab" * 90, "aaaa" * 10, "the " * 50, "x the " + "the " * 30 + "end", prose(9) + "abcabcd" * 30 + prose(3), "q" + "abcabcd" * 9, "abcabcd" * 5 + "abc", "the " * 11, "a" * 39 + "b" + "a" * 45]
    for _ in range(25):
        t = prose(rng.randint(5, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passage)
            t += p[rng.randint(0, 5) : len(p) - rng.randint(0, 5)] + prose(rng.randint(0, 5))
        out.append(t)
    near = list(out[10])
    near[len(near) // 2] = "Z"
    return [*out, out[12], out[12], "".join(near), out[13] + "x"]


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (2, 20_000), (3, 3)])
def test_same_as_brute_force(spark, seed, hot):
    rows = list(enumerate(texts(seed)))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, pos int")
    got = {r.doc_id: bytes(r.kept) for r in remove_repeats(docs, length=40, k=15, hot=hot).collect()}
    want = dict(enumerate(brute([t for _, t in rows], 40)))
    assert got == want


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "x" * 50), (1, "y" * 20 + "z" * 30), (1, "y" * 20 + "z" * 30), (1, None), (2, "q" * 39)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept)) for r in remove_repeats(docs, length=40, k=15).collect())
    assert got == [(False, 1, b""), (False, 1, b""), (False, 1, b""), (False, 2, b"q" * 39), (True, 0, b"")]
    assert remove_repeats(docs.limit(0), length=40, k=15).count() == 0


def test_deep_shallow_sorts():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 70))) for _ in range(300)] + [b"a" * n for n in range(60)] * 2
    groups = np.array([rng.randint(0, 2) for _ in strings])
    order, shared = deep_shallow(strings, groups)
    assert [(groups[i], strings[i]) for i in order] == sorted((g, s) for g, s in zip(groups, strings, strict=True))
    for a, b, n in zip(order[:-1], order[1:], shared[1:], strict=True):
        x, y = strings[a], strings[b]
        want = next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))
        assert n == (want if groups[a] == groups[b] else -1)


def passage_runs(texts: list[str | None], n: int) -> list[list[tuple[int, int]]]:
    """Byte ranges of each text's maximal runs of words in strings of n words that start anywhere else too."""
    words = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    grams = [[tuple(m[0] for m in w[i : i + n]) for i in range(len(w) - n + 1)] for w in words]
    seen = Counter(g for own in grams for g in own)
    out = []
    for w, own in zip(words, grams, strict=True):
        hit = np.zeros(len(w) + 2, int)
        for i, g in enumerate(own):
            if seen[g] > 1:
                hit[i + 1 : i + n + 1] = 1
        edge = np.flatnonzero(np.diff(hit))
        out.append([(w[a].start(), w[b - 1].end()) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
    return out


@pytest.mark.parametrize(("seed", "hot"), [(5, 20_000), (6, 3)])
def test_passages_of_words(spark, seed, hot):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 3)))
    gap = lambda: rng.choice([" ", "  ", "\n", "\t "])
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(n) for n in (9, 10, 11, 14, 25)]
    texts: list[str | None] = [None, "", " ", "a b c", "x " * 30, "\xa0 y\x1cz " * 12]
    for _ in range(30):
        w = prose(rng.randint(0, 12)) + (rng.choice(passages) if rng.random() < 0.6 else []) + prose(rng.randint(0, 12))
        texts.append("".join(x + gap() for x in w))
    texts += [texts[8], texts[9], " ".join((texts[10] or "").split()), " ".join(prose(12))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs, length=400, hot=hot, passages=10, cut_passages=True).collect()}
    runs = passage_runs(texts, 10)
    want = [len(r) for r in runs]
    left = brute(texts, 400, runs)
    assert {i: r.n_passages for i, r in got.items()} == dict(enumerate(want))
    assert sum(n > 0 for n in want) > 10 and sum(n == 0 for n in want) > 10
    for i, t in enumerate(texts):
        assert bytes(got[i].kept) == left[i], repr(t)


def test_many_rows_alike(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    text = " ".join(word() for _ in range(900))
    other = text[:700] + " ".join(word() for _ in range(100))
    rows = [(1, text)] * 5000 + [(2, text), (3, other), (4, "short"), (5, " ".join(word() for _ in range(200)))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), passages=51)
    kept = got.groupBy("doc_id", F.octet_length("kept").alias("n"), "n_passages").count().collect()
    clean = len(rows[-1][1])
    assert sorted((r.doc_id, r.n, r.n_passages, r["count"]) for r in kept) == [(1, 0, 1, 5000), (2, 0, 1, 1), (3, len(other) - 700, 1, 1), (4, 5, 0, 1), (5, clean, 0, 1)]


def test_texts_longer_than_a_block(spark):
    from spectraloom.llm.substrings import BLOCK

    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz   ", np.uint8)
    long = letters[rng.integers(0, len(letters), BLOCK + 9000)].tobytes().decode()
    shared = long[BLOCK - 300 : BLOCK + 500]
    docs = spark.createDataFrame([(1, long), (2, "q" * 100 + shared + "r" * 100)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept).decode() for r in remove_repeats(docs).collect()}
    assert got[1] == long[: BLOCK - 300] + long[BLOCK + 500 :]
    assert got[2] == "q" * 100 + "r" * 100
