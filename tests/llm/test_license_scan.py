"""License scans against slow forms: every run looked for in every template, all chains tried, phrases by a pattern."""

import random
import re

import pytest

from spectraloom.llm.license_scan import COVERED, GAP, LEAST_MATCH, PHRASES, TEMPLATES, LicenseScanner, scan_licenses, words_of
from spectraloom.llm.queries import queries

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def base(text: str | None) -> tuple:
    words = WORDS.findall(lower(text or ""))
    found = [(i, PHRASES[p]) for p in PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    None, "", "  \n", "MIT License", "mit-license MIT\nLICENSE mit licensed", "the Apache License, the GNU General\tPublic\nLicense!", "general public license general public license mit license",
    "Überall MIT_License ist", "licence mit", "mit" + chr(0) + "license", "Licensed under CC BY-NC 4.0.", "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "a" * 300_000, "mit license " * 20_000,
]


def test_base_columns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], "x", 1), (3, TEXTS[3], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, n_words int").repartition(3)
    got = scan_licenses(df).collect()
    want = sorted(((i, *base(t)) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "") and (r.score >= 0.5 or not r.base_labels)
    assert next(r for r in got if r.doc_id == 10).labels == "cc-by-nc"
    assert scan_licenses(df.limit(0)).count() == 0


def scanner(templates, **kw) -> LicenseScanner:
    return LicenseScanner(templates, kw.pop("phrases", PHRASES), kw.pop("least", LEAST_MATCH), kw.pop("gap", GAP), kw.pop("covered", COVERED))


@pytest.mark.parametrize("seed", range(30))
def test_statistics_are_longest_runs(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcde"
    templates = tuple(("t", " ".join(rng.choice(letters) for _ in range(rng.randint(1, 15)))) for _ in range(4))
    s = scanner(templates, phrases={"a b": "x", "b": "y", "a b a": "z"})
    text = [rng.choice(letters + "?") for _ in range(60)]
    text = ["q" if w == "?" else w for w in text]
    runs = {tuple(w[i:j]) for _, t in (*templates, ("", "a b"), ("", "b"), ("", "a b a")) for w in [t.split()] for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    want = [(i, max((n for n in range(1, i + 2) if tuple(text[i + 1 - n : i + 1]) in runs), default=0)) for i in range(60)]
    got = list(s.statistics([w.encode() for w in text]))
    assert [(i, n) for i, _, n in got] == [x for x in want if x[1]]
    for i, v, n in got:  # a state knows all places of its runs
        places = {(t, j + n) for t, (_, x) in enumerate(templates) for w in [x.split()] for j in range(len(w) - n + 1) if w[j : j + n] == text[i + 1 - n : i + 1]}
        assert {p for p in s.automaton.ends[v] if p[0] < 4} == places
    _, found, _ = s.scan(" ".join(text).encode())
    names = {4: ["a", "b"], 5: ["b"], 6: ["a", "b", "a"]}
    assert found == sorted((i, t) for t, p in names.items() for i in range(60) if text[i : i + len(p)] == p)


@pytest.mark.parametrize("seed", range(20))
def test_chains_cover_most(seed):
    """The best covered share of one template against all chains of all maximal matches."""
    rng = random.Random(seed)
    own = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 3)) for _ in range(40)]
    text = [w for w in own for w in ([] if rng.random() < 0.08 else [w, "other"] if rng.random() < 0.08 else [w])]
    s = scanner((("t", " ".join(own)),), phrases={}, least=3, covered=0.0)
    _, _, spans = s.scan(" ".join(["x", "y", *text, "z"]).encode())
    text = ["x", "y", *text, "z"]
    matches = []
    for i in range(len(text)):
        for j in range(len(own)):
            n = 0
            while i + n < len(text) and j + n < len(own) and text[i + n] == own[j + n]:
                n += 1
            if n >= 3 and not (i and j and text[i - 1] == own[j - 1]):
                matches.append((i, i + n, j, j + n))
    best: dict[tuple, int] = {}
    for m in sorted(matches, key=lambda m: m[1]):
        best[m] = m[1] - m[0]
        for p in list(best):
            over = max(0, p[1] - m[0], p[3] - m[2])
            if p != m and p[1] < m[1] and p[3] < m[3] and over < m[1] - m[0] and m[0] - p[1] <= GAP and m[2] - p[3] <= GAP:
                best[m] = max(best[m], best[p] + m[1] - m[0] - over)
    assert max((c for *_, c in spans), default=0.0) == pytest.approx(max(best.values(), default=0) / 40)


def test_notices_with_changes_are_found_and_prose_is_not(spark):
    rng = random.Random(1)
    common = sorted({w.decode() for _, t in TEMPLATES for w in words_of(t)})
    prose = " ".join(rng.choice(common) for _ in range(3000))
    rows = []
    for k, (_, text) in enumerate(TEMPLATES):
        words = text.split()
        if len(words) > 20:
            words[len(words) // 2] = "(c)"
            words.insert(len(words) // 4, "# *")
        rows.append((k, f"{prose}\n{' '.join(words).upper()}\n{prose}"))
    rows.append((len(rows), prose))
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[len(TEMPLATES)].labels == "" and got[len(TEMPLATES)].score == 0
    for k, (label, text) in enumerate(TEMPLATES):
        spans = [x for x in got[k].spans if x.label == label]
        assert label in got[k].labels.split(",") and spans, text
        n = len(words_of(text))
        assert any(abs(x.start - 3000) <= n // 4 and abs(x.stop - 3000 - n) <= n // 4 + 3 for x in spans)


def test_many_notices_in_one_text_are_linear(spark):
    text = "\n".join(f"{TEMPLATES[3][1]} {i}" for i in range(3000))
    r = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(r.spans) == 3000 and r.labels == "apache" and r.score == pytest.approx(1)


def test_registered_query(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op12_license_scan"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got.collect()) == [(i, *base(t)) for i, t in enumerate(TEXTS)]
