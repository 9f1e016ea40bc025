"""Suffix-array removal of strings that occur more than once (operator 1).

A text is a string of symbols: its bytes, or its words as 32-bit hashes. Every window of `length` symbols is tied to
one sync point inside it: the leftmost smallest k-gram hash. Equal windows have equal sync points at equal
distances, so only suffixes at sync points need sorting, about one in a hundred positions. Sync points whose
k-gram is unique drop out. The rest are sorted with their k-gram's others by the symbols that follow and by those
that precede (deep-shallow: a multikey quicksort on 8-byte words to a shallow depth, then blind tries for the
groups that still agree), and the common-prefix lengths of sorted neighbours tell for every distance whether the
window at that distance occurs again. Windows in a run of one short period are settled inside their text first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, row_id, slices, staged, text_buffers, worker_cache

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Windows handled at once; positions inside must fit in POSITION_BITS.
BLOCK = 1 << 19
POSITION_BITS = 20
#: k-grams with more sync points than this are counted window by window, see `hot_windows`.
HOT = 20_000
#: Keys of repeated k-grams that may be sent to all workers (16 bytes each); more are joined by a shuffle.
SENT = 500_000
SHALLOW_WORDS = 4
#: Instead of a distance: rows of a text's periodic run, and of the whole text.
PERIOD, WHOLE = -1, -2
#: Words of a passage, and of the word-grams that its windows meet by.
PASSAGE_WORDS, PASSAGE_GRAM = 51, 8
WHITE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])

ANCHOR_SCHEMA = "id long, th long, key long, pos long, dlo int, dhi int"
CONTEXT_SCHEMA = "key long, id long, th long, base long, ctx binary, pos array<int>, dlo array<int>, dhi array<int>"
SPAN_SCHEMA = "id long, th long, s long, e long"
WINDOW_SCHEMA = "key long, wh long, d int, id long, th long, s long"


def _powers(n: int) -> list[np.ndarray]:
    out = []
    for b in (BASE, BASE_INVERSE):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    most = BLOCK + 4096
    up, down = worker_cache(("powers",), lambda: _powers(most)) if n <= most else _powers(n)
    return up[:n], down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    return h


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k bytes of data (len - k + 1 of them), the same for the same bytes anywhere."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: len(data) - k + 1])


def words_in(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of concatenated texts, and the number of words before each text."""
    white = WHITE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~white & (edge[:-1] | np.r_[True, white[:-1]]))
    ends = np.flatnonzero(~white & (edge[1:] | np.r_[white[1:], True])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_symbols(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash of each word, and the number of words before each text."""
    out, before = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
    up, _ = powers(4096)
    for a, b in slices(offsets, 1 << 20):
        part = raw[offsets[a] : offsets[b]]
        starts, ends, cuts = words_in(part, offsets[a : b + 1] - offsets[a])
        if len(starts):
            sizes = ends - starts
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # position in its word
            sums = np.add.reduceat((part[at + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)) * up[at & 4095], np.r_[0, np.cumsum(sizes)[:-1]])
            out.append((mixed(sums ^ (sizes.astype(np.uint64) << np.uint64(50))) >> np.uint64(32)).astype(np.uint32))
        before.append(cuts[1:] + before[-1][-1])
    return np.concatenate(out), np.concatenate(before)


def symbols(words: bool, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_symbols(raw, offsets) if words else (raw, offsets)


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    full = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[: len(x)] = x
    blocks = full.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def anchors_of(data: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Sync points of the windows inside each part bounds[i]:bounds[i+1]: part, key, position, least and most distance."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    h = rolling(data, k)
    packed = (h >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | np.arange(len(h), dtype=np.uint64)
    at = (window_min(packed, length - k + 1) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    j = np.flatnonzero(np.arange(len(at)) + length <= bounds[part + 1])
    if not len(j):
        return none, none, none, none, none
    a, p = at[j], part[j]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1])])
    last = np.r_[first[1:], len(j)] - 1
    return p[first], h[a[first]].view(np.int64), a[first], a[first] - j[last], a[first] - j[first]


def thin_periods(data: np.ndarray, bounds: np.ndarray, anchors: tuple[np.ndarray, ...], length: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Where a text repeats itself at a short period its windows repeat too: which sync points to keep, and (part, start, end) repeated.

    A window that equals the one a period before it needs no sorting: it is known to occur twice, and what it equals
    elsewhere equals the kept one as well. So a run keeps about its first period.
    """
    part, key, pos, dlo, dhi = anchors
    keep = np.ones(len(pos), bool)
    spans = []
    same = np.flatnonzero((part[1:] == part[:-1]) & (key[1:] == key[:-1])) + 1
    done = -1  # end of the last run looked at, with its period's sync points
    for i in same.tolist():
        p = int(pos[i] - pos[i - 1])
        if i <= done or not 0 < p < length:
            continue
        lo, hi = int(bounds[part[i]]), int(bounds[part[i] + 1])
        differs = np.flatnonzero(data[lo : hi - p] != data[lo + p : hi])
        at = int(np.searchsorted(differs, pos[i - 1] - lo))
        left = lo + (int(differs[at - 1]) + 1 if at else 0)
        right = lo + (int(differs[at]) if at < len(differs) else hi - p - lo) + p
        if right - left < length + p:
            continue
        spans.append((int(part[i]), left, right))
        run = np.arange(i, int(np.searchsorted(pos, right)))
        run = run[(pos[run] - dhi[run] >= left + p) & (pos[run] - dlo[run] + length <= right)]
        keep[run] = False
        done = int(run[-1]) if len(run) else i
    return keep, spans


def whole_texts(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, ths: np.ndarray, length: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each text of at least `length` words, with its words' joint hash as key and their number as position."""
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes >= length)
    if len(some):
        up, _ = powers(BLOCK)
        hashes = []
        for i in some.tolist():
            own = data[offsets[i] : offsets[i + 1]].astype(np.uint64)
            hashes.append(sum(int(((own[a : a + BLOCK] + np.uint64(1)) * up[: min(BLOCK, len(own) - a)]).sum()) * (a + 1) for a in range(0, len(own), BLOCK)) & ((1 << 64) - 1))
        key = mixed(np.array(hashes, np.uint64)).view(np.int64)
        none = np.zeros(len(some), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ths[some]), pa.array(key), pa.array(sizes[some]), pa.array(none + np.int32(WHOLE)), pa.array(none)], names=names)


def find_anchors(length: int, k: int, words: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "key", "pos", "dlo", "dhi"]
        for batch in batches:
            raw, offsets = symbols(words, *text_buffers(batch.column("text")))
            ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
            if words:
                yield from whole_texts(raw, offsets, ids, ths, length, names)
            # parts: texts, or blocks of a long text that overlap by length - 1 bytes
            parts = [(i, s, min(s + BLOCK + length - 1, int(offsets[i + 1]))) for i in range(len(ids)) for s in range(int(offsets[i]), int(offsets[i + 1]) - length + 1, BLOCK)]
            ends = np.r_[0, np.cumsum([e - s for _, s, e in parts])]
            for a, b in slices(ends, BLOCK):
                some = parts[a:b]
                data = np.concatenate([raw[s:e] for _, s, e in some])
                bounds = ends[a : b + 1] - ends[a]
                found = anchors_of(data, bounds, length, k)
                keep, spans = thin_periods(data, bounds, found, length)
                part, key, pos, dlo, dhi = (x[keep] for x in found)
                if spans:  # with the span's length in dhi
                    of, left, right = (np.array(c) for c in zip(*spans, strict=True))
                    part, key, pos, dlo, dhi = (np.r_[a, b] for a, b in ((part, of), (key, 0 * of), (pos, left), (dlo, 0 * of + PERIOD), (dhi, right - left)))
                row = np.array([x[0] for x in some])[part] if len(part) else part
                shift = np.array([s - int(offsets[i]) for i, s, _ in some])
                pos = pos - bounds[part] + shift[part] if len(part) else pos
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(ths[row]), pa.array(key), pa.array(pos), pa.array(dlo.astype(np.int32)), pa.array(dhi.astype(np.int32))], names=names)

    return run


def cut_contexts(length: int, words: bool = False):
    """Rows (id, th, text, found) to one row per run of near sync points with the same k-gram, with the symbols around; rows of one text count once."""
    width = 4 if words else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "id", "th", "base", "ctx", "pos", "dlo", "dhi"]
        seen: set[tuple] = set()  # of rows alike: a task has the texts of its keys only
        for batch in batches:
            keys = list(zip(batch.column("id").to_pylist(), batch.column("th").to_pylist(), strict=True))
            fresh = [i for i, key in enumerate(keys) if key not in seen and not seen.add(key)]
            if len(fresh) < len(keys):
                batch = batch.take(pa.array(fresh, pa.int64()))
            data, offsets = symbols(words, *text_buffers(batch.column("text")))
            raw = data.astype(">u4").view(np.uint8) if words else data
            found = batch.column("found")
            rows = np.repeat(np.arange(batch.num_rows), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            key, pos, dlo, dhi = (found.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "pos", "dlo", "dhi"))
            order = np.lexsort((dlo, pos, key, rows))
            rows, key, pos, dlo, dhi = (x[order] for x in (rows, key, pos, dlo, dhi))
            ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
            # a run: sync points of one text with one k-gram whose windows touch, of a bounded reach
            apart = (rows[1:] != rows[:-1]) | (key[1:] != key[:-1]) | (pos[1:] - pos[:-1] > length) | (pos[1:] // BLOCK != pos[:-1] // BLOCK)
            starts = np.flatnonzero(np.r_[True, apart]) if len(rows) else np.zeros(0, np.int64)
            base = np.minimum.reduceat(pos - dhi, starts) if len(starts) else starts
            stop = np.maximum.reduceat(pos - dlo + length, starts) if len(starts) else starts
            edges = np.r_[starts, len(rows)]
            reach = np.r_[0, np.cumsum(stop - base)]
            for a, b in slices(reach, 4 << 20):
                x, y = edges[a], edges[b]
                own = rows[starts[a:b]]
                at = offsets[own]
                ctx = [raw[o + s : o + e].tobytes() for o, s, e in zip((width * at).tolist(), (width * base[a:b]).tolist(), (width * stop[a:b]).tolist(), strict=True)]
                cuts = pa.array((edges[a : b + 1] - x).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (pos[x:y] - np.repeat(base[a:b], np.diff(edges[a : b + 1])), dlo[x:y], dhi[x:y])]
                yield pa.RecordBatch.from_arrays([pa.array(key[starts[a:b]]), pa.array(ids[own]), pa.array(ths[own]), pa.array(base[a:b]), pa.array(ctx, pa.binary()), *lists], names=names)

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if n != len(a):
        a = a[:n]
    if n != len(b):
        b = b[:n]
    if a == b:
        return n
    return n - (((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) >> 3)


def blind_trie(strings: list[bytes], members: list[int], known: int) -> list[int]:
    """Members in the order of their strings, which agree on `known` bytes, by a trie that keeps branching bytes only.

    An inner node is [depth, {byte or -1 at the end: child}], a leaf the list of the members of one string. A string
    goes down blindly to any leaf it may reach, is compared with that leaf's string once, and is hung in where
    the two part.
    """
    root: list | None = None
    for m in members:
        s = strings[m]
        if root is None:
            root = [-1, [m]]
            continue
        path, node = [], root
        while node[0] >= 0:
            path.append(node)
            c = s[node[0]] if node[0] < len(s) else -1
            kids = node[1]
            node = kids[c] if c in kids else next(iter(kids.values()))
        other = strings[node[1][0]]
        if s == other:
            node[1].append(m)
            continue
        part = known + common_prefix(s[known:], other[known:])
        mine, theirs = (s[part] if part < len(s) else -1), (other[part] if part < len(other) else -1)
        above = None
        below = root
        for x in path:
            if x[0] >= part:
                below = x
                break
            above = x
            c = s[x[0]] if x[0] < len(s) else -1
            below = x[1].get(c)
        if below is not None and below[0] == part:
            below[1][mine] = [-1, [m]]
            continue
        if below is None:  # a new branch at a node already at this depth
            above[1][mine] = [-1, [m]]
            continue
        fresh = [part, {theirs: below, mine: [-1, [m]]}]
        if above is None:
            root = fresh
        else:
            c = s[above[0]] if above[0] < len(s) else -1
            above[1][c] = fresh
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node[0] < 0:
            out += node[1]
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def deep_shallow(strings: list[bytes], groups: np.ndarray, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sorts strings within groups (which agree on the first `skip` bytes): order, and the bytes each shares with the one before (-1 for a group's first)."""
    n = len(strings)
    order = np.argsort(groups, kind="stable")
    rank = np.zeros(n, np.int64)
    rank[order] = np.cumsum(np.r_[0, groups[order][1:] != groups[order][:-1]])
    width = 8 * SHALLOW_WORDS
    words = np.frombuffer(b"".join(s[skip : skip + width].ljust(width, b"\0") for s in strings), ">u8").reshape(n, SHALLOW_WORDS)
    for w in range(SHALLOW_WORDS):  # multikey quicksort: split every tied range by its next word, less, equal and greater
        sizes = np.bincount(rank)
        tied = np.flatnonzero(sizes[rank] > 1)
        if not len(tied):
            break
        key = words[tied, w].astype(np.uint64)
        inner = np.lexsort((key, rank[tied]))
        r, v = rank[tied][inner], key[inner]
        step = np.r_[False, (v[1:] != v[:-1]) & (r[1:] == r[:-1])]
        # new ranks: members before in the whole order, so ranges keep their place
        starts = np.r_[0, np.cumsum(sizes)]
        if w == 0:
            rank = starts[rank]
            r = rank[tied][inner]
        place = np.arange(len(inner)) - np.searchsorted(r, r, "left")
        head = np.maximum.accumulate(np.where(np.r_[True, r[1:] != r[:-1]] | step, np.arange(len(inner)), 0))
        rank[tied[inner]] = r + place[head]
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, sorted_rank[1:] != sorted_rank[:-1]]), n]
    for a in np.flatnonzero(np.diff(cuts) > 1):
        lo, hi = cuts[a], cuts[a + 1]
        members = order[lo:hi].tolist()
        # zero padding hides where a string ends inside the shallow words, so only whole words that all have are known
        known = min(skip + width, min(len(strings[m]) for m in members))
        order[lo:hi] = blind_trie(strings, members, known)
    listed = order.tolist()
    g = groups[order]
    shared = np.full(n, -1, np.int64)
    for i in np.flatnonzero(np.r_[False, g[1:] == g[:-1]]).tolist():
        shared[i] = common_prefix(strings[listed[i - 1]], strings[listed[i]])
    return order, shared


def repeated_distances(length: int, ahead: np.ndarray, lcp_a: np.ndarray, behind: np.ndarray, lcp_b: np.ndarray, dlo: np.ndarray, dhi: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """For one k-gram's sync points, sorted by what follows and what precedes: (member, from, to) distances whose windows occur twice."""
    n = len(dlo)
    low, high = int(dlo.min()), int(dhi.max())
    cuts = np.unique(np.r_[low, length - lcp_a[1:], lcp_b[1:] + 1, dlo, dhi + 1])
    cuts = cuts[(cuts >= low) & (cuts <= high)]
    ends = np.r_[cuts[1:], high + 1] - 1
    twice = np.zeros((len(cuts), n), bool)
    class_a, class_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, d in enumerate(cuts.tolist()):
        class_a[ahead] = np.cumsum(lcp_a < length - d)
        class_b[behind] = np.cumsum(lcp_b < d)
        here = np.flatnonzero((dlo <= d) & (dhi >= d))
        if len(here) < 2:
            continue
        both = class_a[here] * (n + 1) + class_b[here]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        twice[i, here[order[1:][same]]] = True
        twice[i, here[order[:-1][same]]] = True
    for m in np.flatnonzero(twice.any(axis=0)).tolist():
        hit = twice[:, m]
        edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            yield m, int(cuts[a]), int(ends[b - 1])


def sort_groups(length: int, k: int, words: bool = False, at_once: int = 10_000):
    """Context rows, sorted by key, to the spans (id, th, s, e) that their windows cover."""

    width = 4 if words else 1

    def work(rows: list[tuple]) -> pa.RecordBatch:
        owner, group, pos, dlo, dhi, ahead, behind = [], [], [], [], [], [], []
        g, last = -1, None
        for i, (key, _, _, _, ctx, offs, lows, highs) in enumerate(rows):
            if key != last:
                g, last = g + 1, key
            for o, a, b in zip(offs, lows, highs, strict=True):
                owner.append(i)
                group.append(g)
                pos.append(o)
                dlo.append(a)
                dhi.append(b)
                ahead.append(ctx[width * o : width * (o + length - a)])
                before = ctx[width * (o - b) : width * o]
                behind.append(np.frombuffer(before, np.uint32)[::-1].tobytes() if words else before[::-1])
        groups, low, high = np.array(group), np.array(dlo), np.array(dhi)
        order_a, lcp_a = deep_shallow(ahead, groups, width * k)
        order_b, lcp_b = deep_shallow(behind, groups)
        if words:
            lcp_a, lcp_b = lcp_a // width, lcp_b // width
        out: list[tuple[int, int, int]] = []
        starts = np.r_[np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]), len(groups)]
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a == 2:
                f, r = int(lcp_a[a + 1]), int(lcp_b[a + 1])
                for m in (a, a + 1):
                    x, y = max(length - f, dlo[m]), min(r, dhi[m])
                    # both must be windows of their sync point at that distance
                    x, y = max(x, dlo[2 * a + 1 - m]), min(y, dhi[2 * a + 1 - m])
                    if x <= y:
                        out.append((m, x, y))
            elif b - a > 2:
                out += [(a + m, x, y) for m, x, y in repeated_distances(length, order_a[a:b] - a, lcp_a[a:b], order_b[a:b] - a, lcp_b[a:b], low[a:b], high[a:b])]
        cols: list[list[int]] = [[], [], [], []]
        for m, x, y in out:
            _, id_, th, base, *_ = rows[owner[m]]
            at = base + pos[m]
            for c, v in zip(cols, (id_, th, at - y, at - x + length), strict=True):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "th", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        members = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "th", "base", "ctx", "pos", "dlo", "dhi")), strict=True):
                if members >= at_once and row[0] != held[-1][0]:
                    yield work(held)
                    held, members = [], 0
                held.append(row)
                members += len(row[5])
        if held:
            yield work(held)

    return run


def hot_windows(length: int, words: bool = False):
    """Context rows to one row per window with the window's own hash: what a hot k-gram is counted by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "wh", "d", "id", "th", "s"]
        for batch in batches:
            for key, id_, th, base, ctx, offs, lows, highs in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "th", "base", "ctx", "pos", "dlo", "dhi")), strict=True):
                h = rolling(np.frombuffer(ctx, ">u4" if words else np.uint8), length).view(np.int64)
                d = np.concatenate([np.arange(a, b + 1) for a, b in zip(lows, highs, strict=True)])
                at = np.repeat(np.array(offs), np.array(highs) - np.array(lows) + 1) - d
                n = len(d)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(h[at]), pa.array(d.astype(np.int32)), pa.array(np.full(n, id_)), pa.array(np.full(n, th)), pa.array(at + base)], names=names)

    return run


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with text, spans and maybe passages (spans of words) to the bytes outside all of them, and the merged spans; other columns pass."""
    removed_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        for a, b in slices(offsets, 8 << 20):
            kept, removed = [], []
            part = batch.slice(a, b - a)
            passages = part.column("passages").to_pylist() if "passages" in batch.schema.names else [None] * (b - a)
            for i, spans, of_words in zip(range(a, b), part.column("spans").to_pylist(), passages, strict=True):
                own = raw[offsets[i] : offsets[i + 1]]
                if of_words:
                    starts, ends, _ = words_in(own, np.array([0, len(own)]))
                    spans = [*(spans or ()), *({"s": int(starts[x["s"]]), "e": int(ends[x["e"] - 1])} for x in of_words)]
                text, at, pieces, gone = own.tobytes(), 0, [], merged(spans)
                for s, e in gone:
                    pieces.append(text[at:s])
                    at = e
                pieces.append(text[at:])
                kept.append(b"".join(pieces))
                removed.append([{"start": s, "stop": e} for s, e in gone])
            rest = [n for n in batch.schema.names if n not in ("text", "spans", "passages", "id", "th")]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in rest), pa.array(kept, pa.binary()), pa.array(removed, removed_type)], names=[*rest, "kept", "removed"])


def repeated_spans(keyed: DataFrame, texts: DataFrame, length: int, k: int, hot: int = HOT, words: bool = False) -> DataFrame:
    """Spans (id, th, s, e) of symbols in a repeated string of `length` symbols, of rows keyed (id, th, text), and the same dealt by id and th."""
    long_enough = keyed.where(F.octet_length("text") >= (2 * length - 1 if words else length)).select("id", "th", "text")
    anchors = staged(arrow_map(long_enough, find_anchors(length, k, words), ANCHOR_SCHEMA), "substr-anchors")
    # an exact copy has the same sync points, so one text stands for all
    if words:
        alike = anchors.where(f"dlo = {WHOLE}").select("id", "th", F.col("pos").alias("n"), F.struct("key", "pos").alias("digest"))
    else:
        alike = staged(long_enough.select("id", "th", F.octet_length("text").cast("long").alias("n"), F.unhex(F.md5("text")).alias("digest")), "substr-ids")
    copies = staged(alike.groupBy("digest").agg(F.count("*").alias("copies"), F.min(F.struct("id", "th")).alias("rep")).where("copies > 1").select("digest", "rep"), "substr-copies")
    copied = alike.join(copies, "digest").select("id", "th", "n", "rep")
    whole = copied.select("id", "th", F.lit(0).cast("long").alias("s"), F.col("n").alias("e"))
    spare = copied.where((F.col("id") != F.col("rep.id")) | (F.col("th") != F.col("rep.th"))).select("id", "th")
    # a k-gram counts if it stands at two places of different texts or of one; copies have the same places
    place = F.xxhash64("th", "pos")
    points = anchors.where("dlo >= 0")
    counts = staged(points.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select("key", "n"), "substr-keys")
    found = points.join(F.broadcast(counts) if counts.count() <= SENT else counts.hint("merge"), "key").join(spare.hint("merge"), ["id", "th"], "left_anti")

    def contexts(some: DataFrame) -> DataFrame:
        per_text = some.groupBy("id", "th").agg(F.collect_set(F.struct("key", "pos", "dlo", "dhi")).alias("found"))
        return arrow_map(texts.join(per_text.hint("shuffle_hash"), ["id", "th"]).select("id", "th", "text", "found"), cut_contexts(length, words), CONTEXT_SCHEMA)

    sorted_rows = contexts(found.where(F.col("n") <= hot)).repartition("key").sortWithinPartitions("key")
    periods = anchors.where(f"dlo = {PERIOD}").select("id", "th", F.col("pos").alias("s"), (F.col("pos") + F.col("dhi")).alias("e"))
    spans = arrow_map(sorted_rows, sort_groups(length, k, words), SPAN_SCHEMA).union(whole).union(periods)
    if not counts.where(F.col("n") > hot).isEmpty():
        windows = staged(arrow_map(contexts(found.where(F.col("n") > hot)), hot_windows(length, words), WINDOW_SCHEMA), "substr-hot")
        twice = windows.groupBy("key", "d", "wh").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        spans = spans.union(windows.join(twice, ["key", "d", "wh"], "left_semi").select("id", "th", "s", (F.col("s") + length).alias("e")))
    return spans


def passage_spans(keyed: DataFrame, texts: DataFrame, n_words: int = PASSAGE_WORDS, hot: int = HOT) -> DataFrame:
    """Per text (id, th) that has any, `passages`: its maximal runs (s, e) of words in strings of n_words words that start anywhere else too."""
    spans = repeated_spans(keyed, texts, n_words, min(PASSAGE_GRAM, n_words - 1), hot, words=True)
    listed = spans.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("found"))

    def step(a, x):
        last = F.element_at(a, -1)
        joined = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(a) == 0) | (x["s"] > last["e"]), F.array_append(a, x)).otherwise(joined)

    return listed.select("id", "th", F.aggregate("found", F.array().cast("array<struct<s:bigint,e:bigint>>"), step).alias("passages"))


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = 400, k: int = 64, hot: int = HOT, keep: tuple[str, ...] = (), passages: int | None = None, cut_passages: bool = False) -> DataFrame:
    """Removes every byte covered by a string of `length` bytes that starts anywhere else too.

    Returns per row of docs: the id column, `text` as given, `kept` (binary, the bytes left) and `removed`
    (array of start, stop: maximal runs in bytes). A null text counts as empty: kept is empty and nothing is
    removed. Texts shorter than `length` stay whole. Exact copies (also repeated rows) of at least `length`
    bytes lose every byte. Null and repeated ids are rows of their own; other columns are ignored. An empty
    table gives an empty table. `keep` names further columns to return, as one struct `kept_columns` (rows alike
    in id and text get those of one of them). `k` sets the k-gram inside each window by which windows meet (any 1..length-1
    gives the same result); a k-gram with more than `hot` sync points is counted window by window with
    partial aggregates instead of being sorted in one task. With `passages`, strings of that many words (split at
    ASCII white space, compared by 32-bit hashes of words) are looked for in the same way: `n_passages` counts a
    text's maximal runs of words in strings that start anywhere else too, and with `cut_passages` they are
    removed as well.
    """
    keyed = docs.select(row_id(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    texts = keyed.select("id", "th", "text").repartition("id", "th")
    spans = repeated_spans(keyed, texts, length, k, hot)
    per_text = spans.groupBy("id", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    rows = texts.join(per_text.hint("shuffle_hash"), ["id", "th"], "left")
    columns = ["id", "th", "text", "spans"]
    schema = "row long, text string, kept binary, removed array<struct<start:long,stop:long>>"
    fields, names = [F.col("id").alias("row")], ["row"]
    if passages:
        rows = rows.join(passage_spans(keyed, texts, passages, hot).hint("shuffle_hash"), ["id", "th"], "left")
        fields, names, schema = [*fields, F.coalesce(F.size("passages"), F.lit(0)).cast("long").alias("n_passages")], [*names, "n_passages"], f"{schema}, n_passages long"
        columns += ["passages"] * cut_passages
    if keep:  # keyed like the texts, so this join shuffles the further columns only
        own = docs.select(row_id(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.struct(*keep).alias("kept_columns"))
        rows = rows.join(own.groupBy("id", "th").agg(F.first("kept_columns").alias("kept_columns")).hint("shuffle_hash"), ["id", "th"])
        schema += f", kept_columns {own.schema['kept_columns'].dataType.simpleString()}"
        fields, names = [*fields, "kept_columns"], [*names, "kept_columns"]
    cut = arrow_map(rows.select(*fields, *columns), _with_text(names), schema)
    return cut.select(F.when(F.col("row") != F.lit(-(1 << 63)), F.col("row")).alias(id_col), "text", "kept", "removed", *names[1:])


def _with_text(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for out in cut_texts(iter([batch])):
                part = batch.slice(at, out.num_rows)
                at += out.num_rows
                columns = {"text": part.column("text")} | {n: out.column(n) for n in ("kept", "removed", *names)}
                order = [names[0], "text", "kept", "removed", *names[1:]]
                yield pa.RecordBatch.from_arrays([columns[n] for n in order], names=order)

    return run
