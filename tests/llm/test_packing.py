"""Packing: ids as the tokenizer gives them, each in exactly one piece, gapless sequences with little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def samples() -> list[str | None]:
    rng = random.Random(5)
    letters = "abcdefgh ABC'stdrévemÀßŸſIJĐ.,!#$%|<>\n\t0189 \x1c日İΣς ́🤔"
    out = [None, "", " ", "'s't 're!'s don't I'LL", "<|endoftext|> a<|startoftext|>", "x'", "é É ÿŸ ŉ", "a" * 500, "½² ª º µ ×÷"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    out += ["".join(rng.choice(letters[:30]) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    return out + [" ".join(rng.choice(["the", "of", "Rererea", "été"]) for _ in range(n)) for n in (2000, 5000, 2047, 2048, 1023)]


def test_ids_and_layout(spark):
    from tokenizers import Tokenizer

    from spectraloom.llm.packing import pack_documents

    texts = samples()
    docs = spark.createDataFrame([(i if i else None, t, 9) for i, t in enumerate(texts)] + [(5, texts[5], 9)], "doc_id long, text string, length int")
    rows = pack_documents(docs, PATH, part_rows=20).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id or 0].append(r)
    assert len(pieces) == len(texts)
    for i, own in pieces.items():
        times = 2 if i == 5 else 1
        covered = sorted((r.start, r.length) for r in own)[::times]
        assert [s for s, _ in covered] == [0, *np.cumsum([n for _, n in covered])[:-1].tolist()]
        assert sum(n for _, n in covered) == len(ids[i]) and len(own) == times * len(covered)
        for r in own:
            assert r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][r.start : r.start + r.length], "<u4").tobytes()), repr(texts[i])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    pad = 0
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        total = sum(n for _, n in own)
        assert total <= 2048
        pad += 0 if total & (total - 1) == 0 else 2048 - total
    assert pad <= 2048
    assert pack_documents(docs.limit(0), PATH).count() == 0


def _run(patterns, sequence: int, offset: int) -> int:
    """Equal lengths from `offset` on in the pattern whose first sequence is `sequence`."""
    at = 0
    for packs, lengths in patterns:
        if at == sequence:
            before = 0
            for i, x in enumerate(lengths):
                if before == offset:
                    return sum(1 for y in lengths[i:] if y == x)
                before += x
        at += packs
    raise AssertionError


def test_pieces_are_looked_up_without_multiplying_rows():
    import pyarrow as pa

    from spectraloom.llm.packing import place_pieces, shortest_pack_first, slots_of

    rng = random.Random(3)
    histogram = {rng.randint(1, 700): rng.randint(1, 4000) for _ in range(200)}
    slots = slots_of(shortest_pack_first(histogram, 2048))
    length = np.concatenate([np.full(n, x) for x, n in histogram.items()])
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    none = np.zeros(len(rank), np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (none, none, length, none, none, rank)], names=["id", "start", "length", "ids_crc32", "doc_tokens", "rank"])
    (out,) = place_pieces(slots)(iter([batch]))
    sequences = defaultdict(list)
    for s, o, n in zip(out.column("sequence_id").to_pylist(), out.column("offset").to_pylist(), length.tolist(), strict=True):
        sequences[s].append((o, n))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 2048


def test_shortest_pack_first():
    from spectraloom.llm.packing import shortest_pack_first, slots_of

    rng = random.Random(1)
    for _ in range(50):
        histogram = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(rng.randint(1, 30))}
        patterns = shortest_pack_first(histogram, 64)
        got: dict[int, int] = defaultdict(int)
        for n, lengths in patterns:
            assert sum(lengths) <= 64
            for x in lengths:
                got[x] += n
        assert got == histogram
        ranges = defaultdict(list)
        slots = slots_of(patterns)
        for length, lo, packs, sequence, offset in slots:
            ranges[length].append((lo, lo + packs * _run(patterns, sequence, offset)))
        for length, own in ranges.items():
            own.sort()
            assert own[0][0] == 0 and own[-1][1] == histogram[length] and all(a[1] == b[0] for a, b in zip(own, own[1:]))
