import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import sentence_pieces
from ledgerloom.llm.queries import QUERIES, vocabulary

from messy import empty, table

PATH = vocabulary("piece_bpe_32k.model", "CORPUS_PIECES")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.load(PATH)


def brute(rows, library):
    out = []
    for r in rows:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        digest = lambda data: hashlib.sha256(data).hexdigest()
        out.append((r.doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest(library.decode(ids).encode())))
    return sorted(out, key=str)


def encode(model, text):
    return [i for c in sentence_pieces.chunks(text) for i in model.chunk(c.replace(" ", sentence_pieces.MARK))]


def test_odd_strings_against_the_library(model, library):
    r = random.Random(1)
    letters = " " * 6 + "▁abeiou  \t\n<>/s01é世\U0001f389́ \x00﻿the "
    for _ in range(8000):
        text = "".join(r.choice(letters) for _ in range(r.randrange(30)))
        assert encode(model, text) == library.encode(text), repr(text)
    for text in (" " * 5000, "a" * 5000, "ab" * 3000 + " " * 33 + "x", "世界" * 2000, "".join(chr(r.randrange(32, 0x2FFF)) for _ in range(5000))):
        assert encode(model, text) == library.encode(text)


def test_any_ids_are_decoded_as_the_library_does(model, library):
    r = random.Random(2)
    for _ in range(8000):
        ids = [r.choice([r.randrange(3, 259), r.randrange(259, 32000), 1, 2, 28705, 259]) for _ in range(r.randrange(9))]
        assert model.decode(np.array(ids, int)).decode() == library.decode(ids), ids


@pytest.mark.parametrize("head,block", [(1 << 20, 1 << 24), (50, 5000), (0, 1), (3000, 100_000)])
def test_texts_of_the_table(spark, sf, library, monkeypatch, head, block):
    monkeypatch.setattr(sentence_pieces, "BLOCK", block)
    monkeypatch.setattr(sentence_pieces, "COUNTED", 3 * block)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, sentence_pieces.token_digests(docs, PATH, head).collect()), key=str) == brute(docs.collect(), library)


def test_messy_texts(spark, library):
    docs = table(spark)
    assert sorted(map(tuple, sentence_pieces.token_digests(docs, PATH).collect()), key=str) == brute(docs.collect(), library)
    assert sentence_pieces.token_digests(empty(spark), PATH).count() == 0
    got = {r.doc_id: r for r in sentence_pieces.encode(docs.where("doc_id in (5, 9)"), PATH).collect()}
    assert got[5].ids == [1, 2] and got[5].decoded == "" and got[9].decoded == "One" and got[9].ids == library.encode("One", add_bos=True, add_eos=True)


def test_head_has_the_frequent_chunks(spark):
    docs = spark.createDataFrame([(" ".join(["the"] * 9 + ["end"] * 3 + [f"once{i}"]),) for i in range(50)], "text string").repartition(3)
    model = spark.sparkContext.broadcast(sentence_pieces.load(PATH))
    assert sorted(sentence_pieces.head_of(docs, model, 10).text.to_pylist()) == [" end", " the"]
    assert sentence_pieces.head_of(docs, model, 1).text.to_pylist() == [" the"] and len(sentence_pieces.head_of(docs, model, 0)) == 0


def test_models_that_do_not_fit_are_refused(tmp_path):
    (tmp_path / "m.model").write_bytes(b"no model")
    with pytest.raises(Exception):  # noqa: B017
        sentence_pieces.load(str(tmp_path / "m.model"))


def test_query_is_registered():
    assert "op13_sentencepiece" in QUERIES
