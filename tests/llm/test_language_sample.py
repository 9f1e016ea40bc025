"""The language model's sample on languages that are mostly copies."""

import random
from collections import Counter

from spectraloom.llm import language_id

from .test_classifiers import prose


def test_copies_count_once_and_no_language_drops_out(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(prose(rng, "en", 30), "en") for _ in range(60)] + [(prose(rng, "de", 30), "de") for _ in range(5)]
    rows += [("the shing tion ou the ing", "en")] * 400
    rows += [(f"mot{i} eau que les", "fr") for i in range(2)] * 300
    rows += [("only copies here", f"x{i}") for i in range(6)] * 50
    taken: Counter = Counter()
    fit = language_id.fit

    def counted(features, labels, names):
        taken.update(names[i] for i in labels)
        return fit(features, labels, names)

    monkeypatch.setattr(language_id, "fit", counted)
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string").repartition(5), per_language=20, most=400)
    assert taken == {"en": 20, "de": 5, "fr": 2} | {f"x{i}": 1 for i in range(6)}
    assert model.languages == sorted(taken)
