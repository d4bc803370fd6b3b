import hashlib
import random

import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F

from textmill.llm import piece_table

MODEL = path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return piece_table.Vocabulary.load(MODEL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows_equal_the_library(table, odd, library, vocabulary):
    extra = [(20, "ﬁ ½\u0000 日本語 \U0001f600 <s> <0x41>"), (21, " " * 50 + "the" + " " * 17), (22, "\u2581a\u2581 b"), (23, "x" * 5000)]
    rows = [*odd, *extra]
    got = sorted((r.doc_id is None, r.doc_id or 0, *r[1:]) for r in piece_table.round_trip(table(rows), vocabulary).collect())
    coded = [(d, library.encode(t or "", num_threads=1)) for d, t in rows]
    want = sorted(
        (d is None, d or 0, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for d, ids in coded
    )
    assert got == want


def test_random_texts_equal_the_library(library, vocabulary):
    own, back, draw = piece_table.encoder(vocabulary), piece_table.decoder(vocabulary), random.Random(5)
    alphabets = ["ab  \u2581\n", "aeinst ", ["the", "er", "in", " ", "   ", "h"], vocabulary.tokens[259:], "日本語é\U0001f600\u0378x"]
    for k in range(3000):
        text = "".join(draw.choice(alphabets[k % 5]) for _ in range(draw.randint(0, 50)))
        ids = library.encode(text, num_threads=1)
        assert own.ids(text) == ids
        assert back.text(ids) == library.decode(ids)


def test_any_ids_decode_as_the_library_does(spark, library, vocabulary):
    draw = random.Random(6)
    choices = [lambda: draw.randint(0, 2), lambda: draw.randint(3, 258), lambda: 28705, lambda: draw.randint(0, 31999)]
    rows = [[draw.choice(choices)() for _ in range(draw.randint(0, 12))] for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in piece_table.decode(df, vocabulary).collect()}
    assert got == {k: library.decode(ids) for k, ids in enumerate(rows)}


def test_null_and_foreign_ids_have_no_text(spark, vocabulary):
    df = spark.createDataFrame([(1, None), (2, [32000]), (3, [264, None]), (4, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_table.decode(df, vocabulary).collect()} == {1: None, 2: None, 3: None, 4: ""}


def test_little_memory_changes_nothing(vocabulary, monkeypatch):
    words = [f"{a}{b}" for a in ("the", "hein", "tion") for b in range(40)]
    want = piece_table.encoder(vocabulary).ids(" ".join(words * 3))
    monkeypatch.setattr(piece_table, "HELD", 5)
    assert piece_table._Encoder(vocabulary).ids(" ".join(words * 3)) == want


def test_clashing_columns_and_empty_tables(table, vocabulary):
    docs = table([(1, "a b")]).withColumn("ids", F.lit("old"))
    coded = piece_table.encode(docs, vocabulary)
    assert coded.columns == docs.columns and coded.first().ids == [264, 287]
    assert piece_table.round_trip(table([]), vocabulary).collect() == []
    assert piece_table.decode(piece_table.encode(table([]), vocabulary), vocabulary).collect() == []
