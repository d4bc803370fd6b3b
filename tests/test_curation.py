"""Filters, duplicates, pages, personal data, special tokens and tuning sets."""

import math
import random
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill.functions import html, personal, tokens
from textmill.functions import text as tx
from textmill.operators import curation
from textmill.plans.catalogue import QUERIES


def column(spark, values, kind, make):
    rows = spark.createDataFrame(list(enumerate(values)), f"k int, v {kind}")
    return [r.out for r in rows.select("k", make(F.col("v")).alias("out")).orderBy("k").collect()]


def test_accents_go_like_their_decomposition(spark):
    texts = ["Peña Ångström naïve ß ø", "é Ấ", "", None]

    def plain(t):
        return t and "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))

    assert column(spark, texts, "string", tx.strip_accents) == [plain(t) for t in texts]


def test_personal_data(spark):
    texts = ["mail a.b@c.org, +1 (743) 555-3824, 10.0.0.1, 4465758382889437 078-05-1120", "year 2024-10-12", "", None]
    assert column(spark, texts, "string", personal.redact) == [
        "mail <email>, <phone_number>, <ip_address>, <card_number> <ssn>", texts[1], "", None,
    ]
    for kind in personal.PATTERNS:
        assert column(spark, texts, "string", lambda c, k=kind: personal.count(c, k)) == [1, 0, 0, None]


def test_pieces_and_padding(spark):
    rows = [[1, 2, 3, 4, 5], [1, 2], [], None]
    assert column(spark, rows, "array<int>", lambda c: tokens.split_long(c, 2)) == [[[1, 2], [3, 4], [5]], [[1, 2]], [], None]
    assert column(spark, rows, "array<int>", lambda c: tokens.pad_left(c, 3, 9)) == [[3, 4, 5], [9, 1, 2], [9, 9, 9], None]
    special = column(spark, rows, "array<int>", lambda c: tokens.with_special(c, 7, 8, 0, 4))
    assert special == [[7, 1, 2, 3, 0, 0, 8], [7, 1, 2, 8], [7, 8], None]
    with pytest.raises(ValueError):
        tokens.split_long(F.col("v"), 0)
    with pytest.raises(ValueError):
        tokens.with_special(F.col("v"), unk=1)


@pytest.mark.parametrize("longest_first", [True, False])
def test_pairs_are_cut_one_token_at_a_time(spark, longest_first):
    sizes = [(n, m) for n in range(0, 9) for m in range(0, 9)]
    rows = spark.createDataFrame([(n, m, list(range(n)), list(range(m))) for n, m in sizes], "n int, m int, a array<int>, b array<int>")
    for length in (0, 1, 5, 6):
        cut = tokens.truncate_pair(F.col("a"), F.col("b"), length, longest_first)
        for r in rows.select("n", "m", cut.alias("c")).collect():
            n, m = r.n, r.m
            while n + m > length:
                if n and (n >= m if longest_first else True):
                    n -= 1
                else:
                    m -= 1
            assert (len(r.c.first), len(r.c.second)) == (n, m)


def test_language_token(spark):
    rows = spark.createDataFrame([(1, "de", [5]), (2, "xx", []), (3, None, [6]), (4, "de", None)], "k int, lang string, ids array<int>")
    out = rows.select("k", tokens.with_language(F.col("ids"), F.col("lang"), {"de": 10}, 11).alias("o")).orderBy("k")
    assert [r.o for r in out.collect()] == [[10, 5], [11], [11, 6], None]


def test_exact_copies(docs):
    kept = curation.drop_exact(docs("a", None, "b", "a", "", None, ""))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4, 5]


def test_repeated_lines(docs):
    out = curation.drop_repeated_lines(docs("x\ny\n\nx", "y", None, "\nz", "z\n\nw", ""))
    assert {r.doc_id: r.text for r in out.collect()} == {0: "x\ny\n", 1: "", 2: None, 3: "\nz", 4: "\nw", 5: ""}


@pytest.mark.parametrize("limit", [0, 1000])
def test_contamination(docs, monkeypatch, limit):
    monkeypatch.setattr(curation, "_BROADCAST_HASHES", limit)
    items = docs("one two three four five", None, "six")
    out = curation.contamination(docs("x ONE two  three\nfour y", "two three four five one", "one two", None, ""), items, 3)
    assert {r.doc_id: r.shared for r in out.collect()} == {0: 2, 1: 2}


@pytest.mark.parametrize("limit", [10, 0])
def test_contamination_counts_repeats_once(docs, monkeypatch, limit):
    monkeypatch.setattr(curation, "_BROADCAST_HASHES", limit)
    out = curation.contamination(docs("a b c a b c a", "a b b"), docs("z a b c a"), 3)
    # a distinct array of structs takes a time that grows with the square of the text
    assert "array_distinct" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.shared for r in out.collect()} == {0: 2}


def test_perplexity_filter_scores_each_row_once(spark, tmp_path):
    rows = [(k, "en", "s", text) for k, text in enumerate(["abab" * 20, "aabb" * 10, "", "z"])]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    out = QUERIES["perplexity_filter"](spark, str(tmp_path))
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.doc_id for r in out.collect()) == [0, 1]


def test_divergence_from_the_corpus(docs):
    texts = ["a a b", "b c", "zz", "", None]
    counts = curation.word_counts(docs(*texts))
    reference = curation.word_counts(docs("a b b c")).groupBy("word").agg(F.sum("n").alias("n"))
    q = Counter("abbc")
    places = 4 + 3 + 1
    want = {}
    for k, t in enumerate(texts):
        own = Counter((t or "").split())
        n = sum(own.values())
        if n:
            want[k] = sum(c / n * math.log(c / n / ((q[w] + 1) / places)) for w, c in own.items())
    got = {r.doc_id: r.divergence for r in curation.divergence(counts, reference).collect()}
    assert got == pytest.approx(want)


def test_pages(spark):
    same = "<p>cookie notice</p>"
    rows = [
        (k, f"http://H.org/{k}", f"<html><script>var a='<p>';</script><nav><a href=x>menu</a></nav>{same}<p>own <b>{k}</b><br>more {k}")
        for k in range(3)
    ] + [(3, "http://other.org/", same), (4, None, None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    out = {r.page_id: (r.host, r.paragraphs, r.text) for r in curation.page_texts(pages).collect()}
    want = {k: ("h.org", 2, f"own {k}\nmore {k}") for k in range(3)}
    assert out == want | {3: ("other.org", 1, "cookie notice"), 4: (None, 0, "")}
    urls = ["https://u@a.B.net:80/x/y?q#z", "no address", None]
    assert column(spark, urls, "string", html.host) == ["a.b.net", "", None]
    assert column(spark, urls, "string", html.path) == ["/x/y", "", None]


def test_instruction_pairs(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (2, 0, "assistant", "b"), (2, 1, "user", None)]
    rows = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    assert [tuple(r) for r in curation.instruction_pairs(rows).collect()] == [(1, 1, "u", "a")]


def test_masked_rows(sequences):
    rng = random.Random(1)
    rows = [[rng.randrange(50) for _ in range(200)], [], None]
    out = curation.masked_rows(sequences(*rows), 0.3, 99, 5).orderBy("doc_id").collect()
    for before, r in zip(rows[0], zip(out[0].input, out[0].labels, strict=True), strict=True):
        assert r in ((before, -100), (99, before))
    assert 30 < sum(x == 99 for x in out[0].input) < 90
    assert out[1].input == [] and out[2].labels is None


def test_funnel(docs):
    steps = [("copies", curation.drop_exact), ("none", lambda df: df.where("doc_id < 0"))]
    out = curation.funnel(docs("ab", "ab", "c"), steps).orderBy("stage").collect()
    assert [tuple(r) for r in out] == [(0, "input", 3, 5), (1, "copies", 2, 3), (2, "none", 0, 0)]
