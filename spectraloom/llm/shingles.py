"""Word shingles of many texts at once: their XXH64, and a quicker hash where none is prescribed.

Words are runs of other bytes than ASCII white space, with ASCII letters lowered. A text of no more words than a shingle has is one
shingle, one without a word has none. Whole slices of a batch go through each step together, since a call for every
shingle costs more than its hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

from .common import slices

#: Multipliers of XXH64 (fixed values).
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWERED = np.arange(256, dtype=np.uint8) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint8)
#: The lowest bytes of a word of eight, by number.
LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Bytes of text that are hashed together; bytes from which a hash is made in a call of its own.
SLICE, LONG = 1 << 20, 4096


def rotated(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def finished(h: np.ndarray) -> np.ndarray:
    """The last mixing of XXH64."""
    h = (h ^ h >> np.uint64(33)) * P2
    h = (h ^ h >> np.uint64(29)) * P3
    return h ^ h >> np.uint64(32)


def eights(body: np.ndarray) -> np.ndarray:
    """Bytes as whole words of eight, with two more behind."""
    out = np.zeros(len(body) // 8 + 3, "<u8")
    out.view(np.uint8)[: len(body)] = body
    return out


def read(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from any place each."""
    q, r = at >> 3, ((at & 7) << 3).astype(np.uint64)
    return words[q] >> r | words[q + 1] << np.uint64(1) << (np.uint64(63) - r)


def xxh64(body: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of many ranges of bytes."""
    words, n = eights(body), stop - start
    h = np.full(len(n), (seed + int(P5)) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    long = np.flatnonzero(n > LONG)
    rest = np.where(n > LONG, 0, n)
    striped = np.flatnonzero(rest >= 32)
    if len(striped):
        at, left = start[striped], rest[striped] >> 5
        lanes = [np.full(len(striped), (seed + x) & 0xFFFFFFFFFFFFFFFF, np.uint64) for x in (int(P1) + int(P2), int(P2), 0, -int(P1))]
        for k in range(int(left.max())):
            some = np.flatnonzero(left > k) if k else slice(None)
            for i, v in enumerate(lanes):
                v[some] = rotated(v[some] + read(words, at[some] + (32 * k + 8 * i)) * P2, 31) * P1
        a, b, c, d = lanes
        x = rotated(a, 1) + rotated(b, 7) + rotated(c, 12) + rotated(d, 18)
        for v in lanes:
            x = (x ^ rotated(v * P2, 31) * P1) * P1 + P4
        h[striped] = x
    h += n.astype(np.uint64)
    at, rest = start + (rest & ~31), rest & 31
    for k in range(3):
        some = np.flatnonzero(rest >= 8 * k + 8)
        if not len(some):
            break
        h[some] = rotated(h[some] ^ rotated(read(words, at[some] + 8 * k) * P2, 31) * P1, 27) * P1 + P4
    at, rest = at + (rest & ~7), rest & 7
    last = read(words, at)  # what is left of each: at most seven bytes
    some = np.flatnonzero(rest >= 4)
    h[some] = rotated(h[some] ^ (last[some] & LOW[4]) * P1, 23) * P2 + P3
    last[some] >>= np.uint64(32)
    rest = rest & 3
    for k in range(3):
        some = np.flatnonzero(rest > k)
        h[some] = rotated(h[some] ^ (last[some] >> np.uint64(8 * k) & LOW[1]) * P5, 11) * P1
    h = finished(h)
    for i in long.tolist():
        h[i] = xxhash.xxh64_intdigest(body[start[i] : stop[i]].tobytes(), seed)
    return h


def word_hashes(body: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    words, n = eights(body), stop - start
    h = n.astype(np.uint64) * P3 + P5
    long = np.flatnonzero(n > LONG)
    some, left = np.arange(len(n)), np.where(n > LONG, 0, n)
    k = 0
    while len(some := some[left[some] > 8 * k]):
        v = read(words, start[some] + 8 * k) & LOW[np.minimum(left[some] - 8 * k, 8)]
        h[some] = rotated(h[some] ^ rotated(v * P2, 31) * P1, 27) * P1 + P4
        k += 1
    for i in long.tolist():
        h[i] = xxhash.xxh64_intdigest(body[start[i] : stop[i]].tobytes(), 3)
    return finished(h)


@dataclass
class Words:
    """The words of some texts: lowered bytes, where each starts and stops, and each text's range of words."""

    body: np.ndarray
    white: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray

    def shingles(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, numbers of words, and each text's range of shingles."""
        n = np.diff(self.bounds)
        count = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
        ends = np.r_[0, np.cumsum(count)]
        first = np.repeat(self.bounds[:-1] - ends[:-1], count) + np.arange(ends[-1])
        return first, np.repeat(np.minimum(n, words), count), ends


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie in raw one behind another, the first at offsets[0]."""
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    white = WHITE[raw]
    first, last = ~white, ~white
    first[1:] &= white[:-1]
    last[:-1] &= white[1:]
    some = offsets[1:] > offsets[:-1]
    head, tail = offsets[:-1][some], offsets[1:][some] - 1
    first[head], last[tail] = ~white[head], ~white[tail]
    start = np.flatnonzero(first)
    return Words(LOWERED[raw], white, start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets))


def xxh64_shingles(raw: np.ndarray, offsets: np.ndarray, words: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the shingles of each text, words joined by one space, and each text's range."""
    w = words_of(raw, offsets)
    first, n, ends = w.shingles(words)
    # between words of a text one white byte stays, as a space
    inner = np.ones(len(w.start), bool)
    inner[w.bounds[1:][np.diff(w.bounds) > 0] - 1] = False
    kept = ~w.white
    kept[w.stop[inner]] = True
    w.body[w.stop[inner]] = 32
    start = np.r_[0, np.cumsum(kept)][w.start]
    return xxh64(w.body[kept], start[first], (start + w.stop - w.start)[first + n - 1], seed), ends


def quick_shingles(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, from its words' hashes, and each text's range."""
    w = words_of(raw, offsets)
    first, n, ends = w.shingles(words)
    own = word_hashes(w.body, w.start, w.stop)
    h = n.astype(np.uint64) * P5
    whole = bool((n == words).all())
    for k in range(words):
        some = slice(None) if whole else np.flatnonzero(n > k)
        h[some] = rotated(h[some] ^ own[first[some] + k] * P2, 31) * P1 + P4
    return finished(h), ends


def by_text(raw: np.ndarray, offsets: np.ndarray, words: int, hashes=quick_shingles) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, which are made a slice of texts at a time."""
    for a, b in slices(offsets, SLICE):
        h, ends = hashes(raw, offsets[a : b + 1], words)
        for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield h[x:y]
