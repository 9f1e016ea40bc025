"""Shingle hashes of many texts at once against one call for each."""

import random
import time

import numpy as np
import xxhash

from spectraloom.llm import near_sets, shingles, simhash

SPACES = [" ", "  ", "\n", "\t \r", "\x0b", "\x0c\n"]


def texts(n: int, seed: int) -> list[bytes]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcXYZ019é語\x00\x1c\xa0.") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40, 70])))
    some = [b"", b" ", b"\n\t", b"one", b" One ", b"a b", b"a b c", b"x" * 5000 + b" y z", ("é" * 3000 + " b c d e").encode()]
    for _ in range(n):
        some.append("".join(rng.choice(["", *SPACES]) if i == 0 else word() + rng.choice(SPACES) for i in range(rng.randint(1, 60))).encode().strip(rng.choice([b"", b" \n"]) or None))
    rng.shuffle(some)
    return some


def buffers(some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(some), np.uint8), np.r_[0, np.cumsum([len(t) for t in some])]


def slow(text: bytes, words: int) -> list[bytes]:
    w = text.lower().split()
    return [b" ".join(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))] if w else []


def test_xxh64_is_that_of_the_library(monkeypatch):
    some = texts(300, 1)
    for words in (1, 3, 5):
        for size in (1 << 20, 500):
            monkeypatch.setattr(shingles, "SLICE", size)
            got = list(shingles.by_text(*buffers(some), words, shingles.xxh64_shingles))
            assert [g.tolist() for g in got] == [[xxhash.xxh64_intdigest(s, 42) for s in slow(t, words)] for t in some]


def test_quick_hashes_tell_shingles_apart_wherever_they_stand(monkeypatch):
    some, code = texts(400, 2), {}
    for size in (1 << 20, 300):
        monkeypatch.setattr(shingles, "SLICE", size)
        for t, h in zip(some, shingles.by_text(*buffers(some), 5), strict=True):
            want = slow(t, 5)
            assert len(want) == len(h)
            for s, x in zip(want, h.tolist(), strict=True):
                assert code.setdefault(s, x) == x
    assert len(set(code.values())) == len(code)
    ones = np.unpackbits(np.array(list(code.values()), np.uint64).view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert abs(ones - 0.5).max() < 5 * 0.5 / len(code) ** 0.5


def test_prefixes_are_in_one_order_with_common_shingles_last():
    rng = np.random.default_rng(3)
    s = np.unique(rng.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2))
    for common in (s[:0], s[::3], s):
        order = s[np.lexsort((s << np.uint64(20), np.isin(s, common)))]
        for n in (1, 2, 5, 6, len(s)):
            own = s[:n]
            order = own[np.lexsort((own << np.uint64(20), np.isin(own, common)))]
            assert near_sets.prefix_of(own, common).tolist() == order[: n - -(-4 * n // 5) + 1].tolist()


def test_short_texts_cost_no_sort_of_all_common_shingles():
    rng = np.random.default_rng(4)
    common = np.sort(rng.integers(0, 1 << 63, 50_000).astype(np.uint64))
    sets = [np.sort(rng.integers(0, 1 << 63, 30).astype(np.uint64)) for _ in range(5000)]
    t = time.process_time()
    for s in sets:
        near_sets.prefix_of(s, common)
    assert time.process_time() - t < 2  # np.isin sorts the common ones anew for every text: over 10 s


def test_majorities_are_those_of_single_bits():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 100, 70_000):
        h = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64)
        want = sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > n)
        assert simhash.majority(h) == want
