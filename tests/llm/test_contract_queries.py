"""The registered queries over small tables of odd rows: every contract column against a slow form."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from spectraloom.llm import language_id, quality_classifier
from spectraloom.llm.queries import queries, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHARED = " ".join(f"passage{i * i}" for i in range(60))


def texts() -> list[str | None]:
    rng = random.Random(11)
    words = {"en": ["the", "sun", "over", "old", "town"], "de": ["schön", "und", "ich", "grün", "tal"]}
    out: list[str | None] = [None, "", " \n\t", "42 !?", "Ärger", "two words", "a " * 300 + "\nb\nb\nb"]
    for i in range(60):
        own = words["en" if i % 2 else "de"]
        out.append("\n".join(" ".join(rng.choice(own) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))))
    out += [out[20], out[20], out[21].upper(), f"{out[22]} {SHARED}", f"{SHARED}\n{out[23]}", SHARED + SHARED]
    out += ['x password = "hunter22" TOKEN:abcdef secret=abc', "key AKIA" + "Q7" * 9 + " and AKIASHORT " + "0a" * 14, "api_key: " + "f" * 30, "ü" * 9 + "passwd='geheim99'"]
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(4)
    rows = [(i, t, "en" if i % 2 else "de", "web", len(t or "")) for i, t in enumerate(texts())]
    spark.createDataFrame([(i, t, lang if i % 9 else None, s, n) for i, t, lang, s, n in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    base = rng.normal(size=(12, 32))
    x = (np.repeat(base, 5, axis=0) + rng.normal(size=(60, 32)) * 0.1).astype(np.float32)
    vectors = [(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)] + [(60, None, 0), (61, [0.0] * 32, 0), (62, vectors_nan(x[0]), 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d, {i: t for i, t, *_ in rows}, x


def vectors_nan(row) -> list[float]:
    return [float("nan"), *[float(v) for v in row[1:]]]


def run(spark, tables, name: str) -> list:
    return queries()[name](spark, tables[0]).collect()


def smallest_reachable(near: np.ndarray) -> list[int]:
    label = np.arange(len(near))
    for _ in range(len(near)):
        label = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
    return label.tolist()


def test_op1(spark, tables):
    raw = {i: (t or "").encode() for i, t in tables[1].items()}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for k in range(len(b) - 399):
            seen[b[k : k + 400]] = seen.get(b[k : k + 400], 0) + 1
    got = {r.doc_id: r for r in run(spark, tables, "op1_suffix_array_dedup")}
    assert set(got) == set(raw) and sum(r.n_removed for r in got.values()) > 1000
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()), i


def test_op2(spark, tables):
    u = tables[2].astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = smallest_reachable(near)
    got = {r.vec_id: r for r in run(spark, tables, "op2_embedding_near_dedup")}
    assert len(got) == 63 and near.sum() > 60
    for i in range(60):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), label[i], label[i] == i)
    for i in (60, 61, 62):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_op3(spark, tables):
    got = {r.doc_id: r for r in run(spark, tables, "op3_quality_rules")}
    assert set(got) == set(tables[1])
    for i, t in tables[1].items():
        w = WORD.findall(t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        repeat = {j for k, g in enumerate(grams) if grams.count(g) > 1 for j in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeat), failed)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, i
        assert not (failed and r.kept)


def test_op4(spark, tables):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in run(spark, tables, "op4_sentencepiece")}
    assert set(got) == set(tables[1])
    for i, t in tables[1].items():
        ids = model.encode(t or "")
        assert (got[i].n_tokens, got[i].n_chars) == (len(ids), len(model.decode(ids))), i
        assert got[i].round_trip == (model.decode(ids) == (t or "")), i


RULES = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def test_op5(spark, tables):
    got = {r.doc_id: r for r in run(spark, tables, "op5_secret_scan")}
    assert set(got) == set(tables[1])
    some = 0
    for i, t in tables[1].items():
        spans = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, rule, group, least) in enumerate(RULES) for m in rule.finditer(t or "") if len(m.group(group)) >= least)
        count = [sum(k == j for _, k, _ in spans) for j in range(3)]
        r = got[i]
        assert [r.n_assign, r.n_access, r.n_hex] == count, i
        assert r.base_sha256 == hashlib.sha256(",".join(s for *_, s in spans).encode()).hexdigest(), i
        assert {s for *_, s in spans} <= set(filter(None, r.spans.split(",")))
        some += len(spans)
    assert some >= 6


def test_op6(spark, tables):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = run(spark, tables, "op6_packing")
    ids = {i: [*model.encode(t or "", add_special_tokens=False).ids, 1] for i, t in tables[1].items()}
    for i, own in ids.items():
        mine = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start)
        at = 0
        for r in mine:
            part = np.array(own[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == at and (r.ids_crc32, r.doc_tokens) == (zlib.crc32(part), len(own))
            at += r.length
        assert at == len(own)
    ends: dict[int, int] = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def test_op7_and_op8_columns(spark, tables):
    crc = {i: zlib.crc32(str(i).encode()) for i in tables[1]}
    quality = {r.doc_id: r for r in run(spark, tables, "op7_quality_classifier")}
    language = {r.doc_id: r for r in run(spark, tables, "op8_language_id")}
    assert set(quality) == set(language) == set(tables[1])
    for i, t in tables[1].items():
        q, v = quality[i], language[i]
        assert q.held_out == (crc[i] % 5 == 0) and v.held_out == (crc[i] % 4 == 2)
        assert 0 <= q.score <= 1 and q.predicted == int(q.score >= 0.3) and 0 <= v.score <= 1
        assert (v.lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and v.lang_pred in ("en", "de", "und")


def test_op9(spark, tables):
    got = {r.doc_id: r for r in run(spark, tables, "op9_sharding")}
    assert set(got) == set(tables[1])
    for i, t in tables[1].items():
        raw = (t or "").encode()
        r = got[i]
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
    for shard in range(24):
        slots = sorted(r.slot for r in got.values() if r.shard == shard)
        assert slots == list(range(len(slots)))


def fingerprint(text: str | None) -> int:
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op10(spark, tables):
    ids = sorted(tables[1])
    prints = [fingerprint(tables[1][i]) for i in ids]
    near = np.array([[a != b and (prints[a] ^ prints[b]).bit_count() <= 2 for b in ids] for a in ids])
    label = smallest_reachable(near)
    got = {r.doc_id: r for r in run(spark, tables, "op10_simhash_near_dedup")}
    assert [(got[i].fingerprint, got[i].component_id) for i in ids] == [(f"{prints[i]:016x}", label[i]) for i in ids]


def test_op7_fit_is_the_hinge_optimum():
    """Dual coordinate descent against projected gradient steps on the whole dual."""
    rng = np.random.default_rng(3)
    labels = (np.arange(40) % 3 == 0).astype(int)
    sets = [np.unique(np.r_[rng.integers(0, 30, 8), 30 + 5 * v + rng.integers(0, 8, 3)]) for v in labels]
    model = quality_classifier.fit(sets, labels, 0.3, epochs=3000, beta=1.0)
    y = np.where(labels == 1, 1.0, -1.0)
    counts = np.ones((2, quality_classifier.FEATURES))
    for s, v in zip(sets, labels, strict=True):
        counts[v, s] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    used = np.arange(60)
    x = np.zeros((40, 61))
    for r, s in zip(x, sets, strict=True):
        r[s] = ratio[s] / np.sqrt(len(s))
        r[60] = 1
    bound = len(y) / 2 / np.where(y > 0, (y > 0).sum(), (y < 0).sum())
    k = (x * y[:, None]) @ (x * y[:, None]).T
    alpha = np.zeros(40)
    for _ in range(20000):
        alpha = np.clip(alpha + (1 - k @ alpha) / np.linalg.norm(k, 2), 0, bound)

    def primal(w: np.ndarray) -> float:
        return w @ w / 2 + (bound * np.maximum(0, 1 - y * (x @ w))).sum()

    best = primal(x.T @ (alpha * y))
    mine = np.r_[model.weights[used] / np.where(ratio[used] == 0, 1, ratio[used]), model.bias]
    assert primal(mine) == pytest.approx(best, rel=1e-2)


def test_op8_decoding_is_the_least_weighted_loss():
    rng = np.random.default_rng(6)
    code = language_id.codewords(4)
    trust = rng.random(code.shape)
    trust /= trust.sum(axis=1, keepdims=True)
    model = language_id.Model(list("abcd"), code, rng.normal(size=(20, code.shape[1])), rng.normal(size=code.shape[1]), trust)
    features = rng.random((50, 20))
    best, score, unsure = model.predict(features)
    for f, b, s, u in zip(features, best, score, unsure, strict=True):
        losses = []
        for word, weight in zip(code, trust, strict=True):
            margins = [sum(f[i] * model.weights[i, j] for i in range(20)) + model.bias[j] for j in range(len(word))]
            losses.append(sum(w * max(0.0, 1 - m * c) for w, m, c in zip(weight, margins, word, strict=True)))
        low, second = sorted(losses)[:2]
        assert losses[b] == pytest.approx(low) and u == (second - low < language_id.AMBIGUOUS)
        assert s == pytest.approx(1 / sum(np.exp(-6 * (v - low)) for v in losses))
