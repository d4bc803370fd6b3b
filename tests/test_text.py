import pytest
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.sources import text as files


def apply(docs, column, *texts):
    return [r.out for r in docs(*texts).orderBy("doc_id").select(column(F.col("text")).alias("out")).collect()]


ROUGH = "﻿ a​ \t\r\nb\\nc\\td \x1c\r　 e\x85\n\n  "


def python_clean(text, lowercase=False, remove_special=False):
    for found, put in tx.ARTIFACTS:
        text = text.replace(found, put)
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = "\n".join(line.rstrip() for line in text.split("\n")).strip()
    if lowercase:
        text = text.lower()
    if remove_special:
        text = "".join(c for c in text if c.isalnum() or c in tx.KEPT_PUNCTUATION)
    return text


@pytest.mark.parametrize("lowercase", [False, True])
@pytest.mark.parametrize("special", [False, True])
def test_clean_equals_python(docs, lowercase, special):
    texts = [ROUGH, "", "  ", "Tab\tand @mail#! Ünïcode 漢字 ½ \"quoted\"", "x \n\n  y  \n"]
    options = tx.CleanOptions(lowercase, special)
    got = apply(docs, lambda c: tx.clean(c, options), *texts)
    assert got == [python_clean(t, lowercase, special) for t in texts]


def test_clean_keeps_null_rows_and_is_idempotent(docs):
    once = docs(None, ROUGH).select("doc_id", tx.clean(F.col("text")).alias("text"))
    twice = once.select("doc_id", tx.clean(F.col("text")).alias("text"))
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 2


def test_blank(docs):
    assert apply(docs, tx.is_blank, "", " \n\t　\x1c", " a ", None) == [True, True, False, True]


def test_chunks_equal_the_published_pattern(docs):
    texts = ["I'LL go, it's 12345!!\n\n  two  spaces\t\tend  ", "Café naïve €85.50 世界 мир", "", "\r\n a b"]
    want = [regex.findall(tx.GPT4_CHUNKS, t) for t in texts]
    assert apply(docs, tx.chunks, *texts) == want


def test_ascii_chunks_and_words(docs):
    import re

    text = "it's 12345 naïve, $5 a\x1cb  c"
    plain = r"'(?:s|d|m|t|ll|ve|re)|[a-zA-Z]+|[0-9]{1,3}|[^a-zA-Z0-9\s]|\s+"
    assert apply(docs, tx.ascii_chunks, text) == [re.findall(plain, text)]
    assert apply(docs, tx.word_pieces, "Hi there, you!! naïve") == [["Hi", "there", ",", "you", "!!", "naïve"]]


def test_files(spark, tmp_path):
    (tmp_path / "good.txt").write_bytes("été\r\nline".encode())
    (tmp_path / "bad.txt").write_bytes(b"ab\xffc")
    (tmp_path / "other.md").write_bytes(b"no")
    rows = {r.name: r for r in files.read_folder(spark, str(tmp_path)).collect()}
    assert rows["good"].text == "été\r\nline" and rows["good"].error is None
    assert rows["bad"].text is None and rows["bad"].error
    assert set(rows) == {"good", "bad"}
    assert files.read_whole(spark, str(tmp_path / "good.txt")).first().text == "été\r\nline"
    assert files.read_lenient(spark, str(tmp_path / "bad.txt")).first().text == "abc"
    with pytest.raises(Exception, match="(?i)utf"):
        files.read_whole(spark, str(tmp_path / "bad.txt")).collect()
    with pytest.raises(AnalysisException):
        files.read_whole(spark, str(tmp_path / "missing.txt"))
    latin = tmp_path / "latin.txt"
    latin.write_bytes("é".encode("latin-1"))
    assert files.read_whole(spark, str(latin), "ISO-8859-1").first().text == "é"


def test_sample_lines_sizes(spark):
    lines = spark.range(101).select(F.col("id").alias("line_no"), F.col("id").cast("string").alias("line"))
    sample = files.sample_lines(lines, ["line_no"], 0.1, 7)
    assert sorted(r.rank for r in sample.collect()) == list(range(10))
    head = files.sample_lines(lines, ["line_no"], 0.1, 7, 3)
    assert {r.line for r in head.collect()} <= {r.line for r in sample.collect()}
    assert head.count() == 3
