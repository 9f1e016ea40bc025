"""The pipeline's stages against brute force, each on its own input, and odd inputs."""

import random
import re
from collections import defaultdict

import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

import corpus_pipeline
from spectraloom.llm.common import staged

from .test_classifiers import PARTS, prose
from .test_secret_ledger import slow as slow_secrets
from .test_simhash import components, slow_fingerprint
from .test_substrings import brute, passage_runs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    rng = random.Random(8)
    rows = []
    passage = prose(rng, "en", 120)
    for i in range(160):
        lang = rng.choice(list(PARTS))
        t = prose(rng, lang, rng.randint(60, 150))
        if i % 10 == 0:
            t += f' token = "{rng.getrandbits(128):032x}" ' + prose(rng, lang, 5)
        if i % 13 == 0:
            t += "\n" + passage
        rows.append([i, t, lang if i % 9 else None, f"src{i % 3}", len(t)])
    rows += [[200, rows[7][1], "en", "s", 1], [201, rows[7][1], "en", "s", 1], [202, "", "en", "s", 0], [203, None, None, None, None], [204, "12345 !!!", "en", "s", 9], [None, "the shing tion ou the ing", None, "s", 3]]
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def test_stages(spark):
    docs = documents(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    steps = [staged(docs)]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], "")))
    assert all(s.columns == corpus_pipeline.COLUMNS for s in steps[1:5])
    rows = [s.collect() for s in steps]
    # language: what has no letter goes, what is clean stays
    gone = {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]}
    assert {202, 203, 204} <= gone and len(gone) <= 5
    assert sum(r.lang is None for r in rows[1]) <= 2  # ambiguous ones without a label
    # near copies: the smallest id of each component
    own = [r for r in rows[1] if r.doc_id is not None]
    label = components([r.doc_id for r in own], [slow_fingerprint(r.text) for r in own], 2)
    assert sorted(r.doc_id for r in rows[2] if r.doc_id is not None) == sorted({c for c in label.values()})
    assert sum(r.doc_id is None for r in rows[2]) == 1
    # repeated text
    before = sorted(rows[2], key=lambda r: (r.doc_id is None, r.doc_id))
    passages = passage_runs([r.text for r in before], 51)
    kept = {r.doc_id: b.decode("utf-8", "ignore") for r, b in zip(before, brute([r.text for r in before], 400, passages), strict=True)}
    after = {r.doc_id: r.text for r in rows[3]}
    assert after == {i: t for i, t in kept.items() if t.strip()}
    assert sum(len(r.text) for r in before) > sum(len(t) for t in after.values())
    assert all(r.n_chars == len(r.text) for r in rows[3])
    # secrets
    for r in rows[4]:
        out, at = "", 0
        for s, e, _ in slow_secrets(after[r.doc_id]):
            if s >= at:
                out += after[r.doc_id][at:s] + "[secret]"
            at = max(at, e)
        assert r.text == out + after[r.doc_id][at:]
    assert not any(re.search(r"[0-9a-f]{24}", r.text) for r in rows[4]) and len(rows[4]) == len(rows[3])
    # packing: every document's ids once, sequences without gaps
    tokens = defaultdict(int)
    for r in rows[5]:
        tokens[r.doc_id] += r.length
    assert set(tokens) == set(after)
    assert all(tokens[r.doc_id] == r.doc_tokens for r in rows[5])


def test_run_and_empty(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 100
    documents(spark).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
