"""The near-copy stage takes operator 10's links as well as those of shingle sets."""

import random

import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

import corpus_pipeline

from .test_simhash import components, slow_fingerprint


def test_fingerprint_links_join_texts_that_shingle_sets_do_not(spark):
    """repeated words weigh in a fingerprint and not in a set, so one text whose repeats are most of it is near another."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(3)]
    texts = [" ".join(base * 200 + [word() for _ in range(12)]) for _ in range(4)] + [" ".join(word() for _ in range(60)) for _ in range(10)]
    label = components(list(range(len(texts))), [slow_fingerprint(t) for t in texts], 2)
    assert len({label[i] for i in range(4)}) == 1 and len(set(label.values())) == 11
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [0, *range(4, 14)]


def test_the_pipeline_runs_it():
    assert dict(corpus_pipeline.STAGES)["simhash_near_dedup"] is corpus_pipeline.simhash_stage
