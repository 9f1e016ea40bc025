"""Tokenizer alignment against the tokenizers' own ids, all token ends in sets, and pairs counted in dictionaries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from spectraloom.llm import alignment
from spectraloom.llm.alignment import Groups, align_tokenizers, byte_letters, narrow, shared_groups, widened
from spectraloom.llm.queries import queries, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute(texts: list[str | None]) -> list[tuple]:
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_letters()
    groups = []
    for t in texts:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        raw = (" " + t).encode() if t else b""
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            groups.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
        cuts = sorted(set(ends_a) & set(ends_b))
        own = [([], []) for _ in cuts]
        for side, ids, ends in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
            at = 0
            for i, e in zip(ids, ends, strict=True):
                own[at][side].append(i)
                at += e == cuts[at]
        groups.append(own)
    links = [Counter((x, y) for p, q in g for x in p for y in q) for g in groups]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for g, c in zip(groups, links, strict=True):
        spelt = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), sum(c.values()), sum(m for (x, y), m in c.items() if held[x, y] == best[x]), sum(m * held[p] for p, m in c.items()), hashlib.sha256(spelt.encode()).hexdigest() if g else ""))
    return out


def texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["the", "Straße", "unbelievably", "x=5", "don't", "naïve", "東京都", "🙂🙂", "<|endoftext|>", "<s>", "1234567", "á", "…", "    indented", "　wide", " hard", "=" * 40, "\x1c", "ﬁne"]
    out: list[str | None] = [None, "", " ", "  ", "\n", " \n \n", "a", "▁", "a ▁b", "x\x00y", "tail  ", "\t\ttab\t x", "=" * 1501, "ab" * 700, "<unk></s>", "\r\nx\r\n", "a b   c", "�", "  two\n   three"]
    for _ in range(60):
        out.append("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", ", ", ""]) for _ in range(rng.randint(1, 60))))
    return [*out, out[20], out[20], None]


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_equals_brute_force(spark, head):
    rows = [(i if i != 30 else None, t, "n", b"") for i, t in enumerate(texts())] + [(1, "copy of an id", "n", b"")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, codes binary").repartition(4)
    got = align_tokenizers(df, A, B, head=head).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = [(r[0], *v) for r, v in zip(rows, brute([r[1] for r in rows]), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 60 and any(r[4] > r[1] for r in want)


def test_groups_are_all_shared_ends():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n_texts, ends, texts_ = int(rng.integers(1, 5)), ([], []), ([0], [0])
        at = 0
        for _ in range(n_texts):
            n = int(rng.integers(0, 60))
            for side in (0, 1):
                some = sorted({*(rng.integers(1, n + 1, int(rng.integers(0, 40))) + at).tolist(), at + n}) if n else []
                ends[side].extend(some)
                texts_[side].append(len(ends[side]))
            at += n
        a, b = np.array(ends[0], np.int64), np.array(ends[1], np.int64)
        first_a, first_b = shared_groups(a, b, np.array(texts_[0]), np.array(texts_[1]))
        shared = sorted(set(ends[0]) & set(ends[1]))
        assert first_a.tolist() == [0, *(ends[0].index(s) + 1 for s in shared)][: len(shared)]
        assert first_b.tolist() == [0, *(ends[1].index(s) + 1 for s in shared)][: len(shared)]


@pytest.mark.parametrize("wide", [0, 5, 10**6])
def test_pairs_of_wide_groups(monkeypatch, wide):
    """Groups are counted token by token or by distinct ids, with equal results; counts need one byte or more."""
    monkeypatch.setattr(alignment, "WIDE", wide)
    rng = np.random.default_rng(1)
    n_a, n_b, text = np.array([1, 300, 2, 1, 400]), np.array([3, 200, 1, 1, 1]), np.array([0, 0, 2, 2, 3])
    ids_a, ids_b = rng.integers(0, 5, n_a.sum()), rng.integers(0, 7, n_b.sum())
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    got = Groups(first_a, first_b, n_a, n_b, text).pairs(ids_a, ids_b, 7)
    want = Counter((int(t), int(x) * 7 + int(y)) for t, p, m, q, n in zip(text, first_a, n_a, first_b, n_b, strict=True) for x in ids_a[p : p + m] for y in ids_b[q : q + n])
    assert {(t, c): n for t, c, n in zip(*(x.tolist() for x in got), strict=True)} == want
    assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == sorted(want)
    for times in ([], [1, 255], [256], [70000, 1], [1 << 40]):
        assert widened(narrow(np.array(times, np.int64)), len(times)).tolist() == times


def test_long_text_without_a_space_and_empty_table(spark):
    rng = random.Random(2)
    long_ = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    df = spark.createDataFrame([(1, long_), (2, "=" * 300_001), (3, "x")], "doc_id long, text string")
    got = sorted(map(tuple, align_tokenizers(df, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()))
    assert [r[1:] for r in got] == brute([long_, "=" * 300_001, "x"])
    assert align_tokenizers(df.limit(0), A, B).count() == 0


def test_registered_query(spark, tmp_path):
    rows = [(i, t, None, "s", 0) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op11_cross_tokenizer_alignment"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == [(i, *v) for i, v in enumerate(brute([t for _, t, *_ in rows]))]
