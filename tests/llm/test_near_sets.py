"""Near copies against the similarity of all pairs."""

import random

import pytest

import corpus_pipeline
from spectraloom.llm import near_sets


def shingles(text: str) -> set[str]:
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def slow(texts: list[str]) -> list[int]:
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    while True:
        nxt = [min([label[i]] + [label[j] for j, b in enumerate(sets) if 5 * len(a & b) >= 4 * len(a | b)]) for i, a in enumerate(sets)]
        if nxt == label:
            return label
        label = nxt


@pytest.mark.parametrize("most", [2048, 2])
def test_near_copies_are_those_of_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(near_sets, "MOST", most)
    monkeypatch.setattr(near_sets, "SAMPLE", 2)
    monkeypatch.setattr(near_sets, "LEAST", 3)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    boiler = [word() for _ in range(40)]
    texts = ["", " ", "one", "One", "a b c d e", "a b c d e f"]
    for n in (12, 30, 60, 150, 400):
        for _ in range(6):
            base = [word() for _ in range(n)] + (boiler if rng.random() < 0.5 else [])
            texts.append(" ".join(base))
            for _ in range(6):
                t = list(base)
                for _ in range(rng.randint(0, max(1, n // 30))):
                    i = rng.randrange(len(t))
                    t[i : i + 1] = rng.choice([[word()], [], [t[i], word()]])
                texts.append(" ".join(t))
    wanted = slow(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    found: dict[int, list[int]] = {}
    for r in near_sets.similar_components(docs).collect():
        found.setdefault(r.component, []).append(r.id)
    assert {i: min(g) for g in found.values() for i in g} == dict(enumerate(wanted))
    kept = corpus_pipeline.near_copy_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(wanted)) and len(kept) < 0.6 * len(texts)


def test_rows_of_one_id_are_told_apart_by_their_texts(spark):
    docs = spark.createDataFrame([(7, "k l", "en", "s", 3), (7, "k l", "en", "s", 3), (7, "m n", "en", "s", 3), (9, "k l", "en", "s", 3), (None, "k l", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copy_stage(spark, docs, "")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "k l"), (7, "k l"), (7, "m n")]
    assert corpus_pipeline.near_copy_stage(spark, docs.limit(0), "").count() == 0
