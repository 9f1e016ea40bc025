"""Rule measurements against brute force; policies and ablations from the ledger alone."""

import random
import re
from collections import Counter

from spectraloom.llm.quality_rules import POLICIES, RULES, ablations, apply_policy, mask_of, rule_ledger


def measured(text: str | None) -> dict[str, int]:
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "n_exclaims": t.count("!"), "n_digits": sum(c in "0123456789" for c in t),
        "n_capital_words": sum(w == w.upper() and w != w.lower() for w in (w.replace("ß", "s") for w in words)), "n_lines": len(lines), "dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines))),
        "text_chars": len(t), "n_distinct_words": len(set(words)), "n_ellipses": sum(x.endswith(("...", "…")) for x in lines), "n_bullets": sum(x.startswith(("- ", "* ", "• ")) for x in lines),
    }


def texts() -> list[str | None]:
    rng = random.Random(2)
    out: list[str | None] = [None, "", " \n\t ", "one", "Äß ß GROSS aß", "a b c", "a b c a b c a", "x\x0by\x1cz\x85w", "🤔 é\n🤔 é\n", "- a\n* b\n• c\nd...", "A!! B!!\n" * 30]
    for _ in range(60):
        out.append("".join(rng.choice(["ab", "C", "é", "1", "#", "!"]) + rng.choice([" ", "  ", "\n", "\t", " \n"]) for _ in range(rng.randint(0, 200))))
    return out + ["word " * 20_000, " ".join(f"w{i}" for i in range(30_000))]


def test_ledger(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i or None, t, 1, 2) for i, t in rows], "doc_id long, text string, n_words int, fail_bits int")
    ledger = rule_ledger(docs).cache()
    got = {r.doc_id or 0: r.asDict() for r in ledger.collect()}
    for i, t in rows:
        want = measured(t)
        assert {k: got[i][k] for k in want} == want, repr(t)[:80]
        bits = sum(1 << b for b, (_, rule) in enumerate(RULES) if eval(rule, {}, dict(want)))
        assert got[i]["fail_bits"] == bits
    for r in apply_policy(ledger, "v1").collect():
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and r.kept == (not base and not r.fail_bits & mask_of(POLICIES["v1"]))
    table = {(r.policy, r.rule): r for r in ablations(ledger).collect()}
    assert len(table) == sum(map(len, POLICIES.values()))
    for (policy, rule), r in table.items():
        mask, bit = mask_of(POLICIES[policy]), mask_of([rule])
        bits = [g["fail_bits"] for g in got.values()]
        assert (r.n_rows, r.n_kept, r.n_failed, r.n_only) == (len(bits), sum(not b & mask for b in bits), sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits))
    assert rule_ledger(docs.limit(0)).count() == 0
