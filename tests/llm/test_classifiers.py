"""Language codes and naive Bayes support vectors: held-out accuracy, odd texts, and their parts."""

import random

import numpy as np
import pytest

from spectraloom.llm import language_id, quality_classifier


def word(rng: random.Random, parts: list[str]) -> str:
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))


PARTS = {"en": ["the", "ing", "tion", "sh", "ou"], "de": ["sch", "ung", "ich", "ä", "tz"], "fr": ["eau", "é", "ou", "ent", "que"], "es": ["ción", "ar", "ñ", "os", "que"]}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(word(rng, PARTS[lang]) for _ in range(n))


def test_language(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randint(5, 80)), lang) for i, lang in enumerate(rng.choices(list(PARTS), k=800))]
    docs = spark.createDataFrame([(i, t.upper() if i % 7 == 0 else t, g if i % 50 else None, 1.0) for i, t, g in rows], "doc_id long, text string, lang string, score double")
    held = language_id.held_out("doc_id", 4, 2)
    model = language_id.train(docs.where(~held))
    got = language_id.identify(docs, model, ["doc_id", held.alias("held_out")]).collect()
    truth = {i: g for i, _, g in rows}
    out = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert len(out) > 100 and np.mean(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "123 !!"), (3, "é"), (3, "é")], "doc_id long, text string")
    pred = language_id.identify(odd, model, ["doc_id"]).collect()
    assert len(pred) == 5 and all((r.lang_pred == "und") == (r.doc_id != 3) for r in pred) and all(r.ambiguous for r in pred if r.doc_id != 3)
    none = language_id.identify(odd, language_id.train(docs.limit(0)), ["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.identify(odd.limit(0), model, ["doc_id"]).count() == 0


def test_codewords_differ():
    for n in range(1, 30):
        code = language_id.codewords(n)
        assert len({tuple(c) for c in code}) == n
        if 3 <= n <= 6:
            assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) == 2 ** (n - 2)


def test_trigrams_of_a_text_do_not_depend_on_its_batch():
    rng = random.Random(2)
    texts = [prose(rng, "fr", n).encode() for n in (0, 1, 50, 3000)] + [b"a", b"", "ÉÀ é".encode()]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    together = language_id.trigram_features(raw, offsets)
    for t, row in zip(texts, together, strict=True):
        alone = language_id.trigram_features(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(alone, row)


def test_quality(spark):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        good = rng.random() < 0.8
        t = prose(rng, rng.choice(list(PARTS)), rng.randint(20, 120))
        rows.append((i, t if good else " ".join(w + rng.choice(["***", "!!", "$$$"]) for w in t.split()), int(good)))
    docs = spark.createDataFrame([(i, t, 5.0) for i, t, _ in rows], "doc_id long, text string, score double")
    held = language_id.held_out("doc_id", 5, 0)
    labels = spark.createDataFrame([(i, q if i % 40 else None) for i, _, q in rows if i % 3], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels.where(~held))
    got = quality_classifier.score_quality(docs, model, ["doc_id", held.alias("held_out")]).collect()
    truth = {i: q for i, _, q in rows}
    out = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in got if r.held_out]
    assert len(out) > 80 and np.mean(out) > 0.97
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "x" * 10), (2, "x" * 10)], "doc_id long, text string")
    assert all(0 <= r.score <= 1 for r in quality_classifier.score_quality(odd, model, ["doc_id"]).collect())
    assert quality_classifier.train(docs, labels.limit(0)) is None
    assert {r.score for r in quality_classifier.score_quality(odd, None, ["doc_id"]).collect()} == {0.5}


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 15) + (30 if i % 2 else 0)) for i in range(200)]
    labels = np.arange(200) % 2
    model = quality_classifier.fit(sets, labels, 0.5)
    score = np.array([model.score(s) for s in sets])
    assert ((score > 0.5) == (labels == 1)).mean() > 0.97


def test_gram_set_in_blocks(monkeypatch):
    text = np.frombuffer(bytes(random.Random(5).choices(range(256), k=5000)), np.uint8)
    whole = quality_classifier.gram_set(text)
    monkeypatch.setattr(quality_classifier, "BLOCK", 777)
    assert (quality_classifier.gram_set(text) == whole).all()
    assert len(quality_classifier.gram_set(text[:0])) == 0


@pytest.mark.parametrize("labels", [[1] * 20, [0] * 20])
def test_one_class_only(labels):
    model = quality_classifier.fit([np.arange(5)] * 20, np.array(labels), float(labels[0]))
    assert 0 <= model.score(np.arange(5)) <= 1
