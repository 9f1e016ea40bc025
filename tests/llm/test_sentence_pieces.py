"""Piece ids equal the library's own, and decoding gives the text back."""

import random

import numpy as np
import pytest

pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")

ODD = ["", " ", "  ", "   a  b ", "\n", "a\n\nb\n", "\tx\r\n", "日本語🤔 \x00a", "a▁b", "▁", "<s> </s> <0x41>", "é ﬁ", "x" * 300, " " * 40 + "y", "aaaa aaaaaaaa", "é" * 33, "퟿"]


def samples() -> list[str]:
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzéñüß .,'\n\t0189-_日本한🤔"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(200)] + [" ".join(rng.choice(["the", "international", "of", "Größe", "été", "running", "tokens"]) + rng.choice(["", "s", "ing", "..", "%%%"]) for _ in range(60)) for _ in range(50)]


def test_same_ids_as_library():
    from sentencepiece import SentencePieceProcessor

    from spectraloom.llm.sentence_pieces import Encoder

    model, own, texts = SentencePieceProcessor(model_file=MODEL), Encoder(MODEL), samples()
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == model.encode(t), repr(t)
        assert own.table.decode(ids) == model.decode(ids.tolist()) == t.replace("▁", " ")


def test_suffix_array_order():
    from spectraloom.llm.sentence_pieces import PieceTable

    table = PieceTable(MODEL)
    letters = np.array([random.Random(1).randint(0, 3) for _ in range(500)])
    order = table.suffix_array(letters)
    deep = [letters[i : i + table.longest].tolist() for i in order]
    assert deep == sorted(deep) and sorted(order.tolist()) == list(range(500))


def test_spark_round_trip(spark):
    from sentencepiece import SentencePieceProcessor

    from spectraloom.llm.sentence_pieces import decode_pieces, encode_pieces

    model = SentencePieceProcessor(model_file=MODEL)
    texts = [None, *[t for t in samples() if "▁" not in t]]
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts)] + [(3, texts[3], "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = decode_pieces(encode_pieces(docs, MODEL), MODEL, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    assert all(r.decoded == (r.text or "") for r in got)
    ids = {r.text: list(r.ids) for r in encode_pieces(docs, MODEL).collect()}
    assert all(ids[t] == model.encode(t or "") for t in texts)
    assert encode_pieces(docs.limit(0), MODEL).count() == 0


def test_long_texts_without_a_space():
    from sentencepiece import SentencePieceProcessor

    from spectraloom.llm.sentence_pieces import BATCH_CHARS, Encoder

    model, own, rng = SentencePieceProcessor(model_file=MODEL), Encoder(MODEL), random.Random(5)
    texts = ["x" * (BATCH_CHARS + 7), "ab" * 9000 + "xyz" * 6000, "".join(rng.choice("abcdeXYZ0189+/") for _ in range(200_000)), "".join(rng.choice("日本語中文字") for _ in range(60_000))]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == model.encode(t)
