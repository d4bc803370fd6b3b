import pytest
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.operators import vocabulary as vo
from textmill.plans.catalogue.base import Tables


def test_build_is_in_code_point_order(docs):
    rows = vo.build_vocabulary(docs("hello", "aé漢😀", None)).orderBy("idx").collect()
    assert [r.ch for r in rows] == sorted(set("helloaé漢😀"))
    assert [r.idx for r in rows] == list(range(len(rows)))


def test_encode_drops_unknown_and_keeps_null(docs):
    vocabulary = vo.Vocabulary(tuple("abc]^-\\"))
    out = docs("cab", "axb]-\\^", "", None, "xyz").orderBy("doc_id").select(vocabulary.encode(F.col("text")).alias("e"))
    assert [r.e for r in out.collect()] == [[2, 0, 1], [0, 1, 3, 5, 6, 4], [], None, []]


def test_roundtrip_and_decode_drops_unknown(docs):
    df = docs("héllo 😀 漢字\n")
    vocabulary = vo.Vocabulary.build(df)
    ids = vocabulary.encode(F.col("text"))
    assert df.select(vocabulary.decode(ids).alias("t")).first().t == "héllo 😀 漢字\n"
    odd = F.array(F.lit(-1), F.lit(0), F.lit(999))
    assert df.select(vocabulary.decode(odd).alias("t")).first().t == vocabulary.chars[0]


def test_empty_vocabulary_is_an_error():
    with pytest.raises(ValueError, match="empty"):
        vo.Vocabulary(()).encode(F.lit("a"))
    with pytest.raises(ValueError, match="empty"):
        vo.Vocabulary(()).decode(F.array())


def test_strict(docs):
    vocabulary = vo.Vocabulary(("a", "b"))
    assert docs("ab").select(vocabulary.encode_strict(F.col("text")).alias("e")).first().e == [0, 1]
    with pytest.raises(Exception, match="outside the vocabulary"):
        docs("abc").select(vocabulary.encode_strict(F.col("text"))).collect()


def test_unknowns_info_and_join(docs):
    df = docs("abca", "zz", "", None)
    table = vo.build_vocabulary(docs("abc"))
    assert {(r.ch, r.n) for r in vo.unknown_characters(df, table).collect()} == {("z", 2)}
    info = vo.vocabulary_info(table).first()
    assert (info.vocab_size, info.sample_chars, info.min_idx, info.max_idx) == (3, ["a", "b", "c"], 0, 2)
    empty = vo.vocabulary_info(table.limit(0)).first()
    assert (empty.vocab_size, empty.min_idx, empty.max_idx) == (0, None, None)
    joined = {r.doc_id: r.ids for r in vo.encode_by_join(df, table).collect()}
    assert joined == {0: [0, 1, 2, 0], 1: [], 2: [], 3: None}


def test_a_vocabulary_of_thirty_thousand_characters(docs):
    chars = [chr(p) for p in range(0x20, 0x7600) if p % 2 or p < 0x100]
    chars += [chr(p) for p in range(0x20000, 0x24000)]
    vocabulary = vo.Vocabulary(tuple(chars))
    assert len(vocabulary) > 30_000
    text = "".join(chars[::97]) + chr(0x102) + "a" + chr(0x30000)
    out = docs(text, None).orderBy("doc_id").select(vocabulary.encode(F.col("text")).alias("e")).collect()
    assert out[0].e == [*range(0, len(chars), 97), chars.index("a")] and out[1].e is None


@pytest.mark.parametrize("limit", [0, 100_000])
def test_join_moves_a_documents_distinct_characters_only(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(vo, "_BROADCAST_ROWS", limit)
    # id 0xF6FE has the stand-in U+FEFF, a byte order mark
    table = spark.range(0, 0xFF20).select(F.col("id").cast("int").alias("idx"), tokens.id_to_symbol(F.col("id") + 0x20).alias("ch"))
    text = "".join(tokens.id_to_char(0x20 + k) for k in (0, 1, 0xF6FE, 0xD000)) + chr(0x1F600) + "\x00"
    df = docs(text * 500, "zz", "\x00", "", None)
    rows, joined = [], vo.lookup_join

    def counted(big, *args, **kwargs):
        rows.append(big.count())
        return joined(big, *args, **kwargs)

    monkeypatch.setattr(vo, "lookup_join", counted)
    got = {r.doc_id: r.ids for r in vo.encode_by_join(df, table).collect()}
    assert got == {0: [0, 1, 0xF6FE, 0xD000] * 500, 1: [90, 90], 2: [], 3: [], 4: None}
    assert rows == ([] if limit else [8])


def test_ids_of_arrow_batches_equal_the_expression(spark):
    texts = ["hello \u0000 wörld", "", None, "世界 мир 😀\n\u2028", "a😀b", "\ufeffx\r\n"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    whole = vo.Vocabulary.build(df)
    assert whole.chars == tuple(sorted({c for t in texts for c in t or ""}))
    for known in (whole, vo.Vocabulary(whole.chars[::2]), vo.Vocabulary(tuple(chr(0x3000 + k) for k in range(1 << 15)))):
        both = df.select(known.encode(F.col("text")).alias("a"), known.encode_batches(F.col("text")).cast("array<int>").alias("b")).collect()
        assert all(r.a == r.b for r in both) and len(both) == len(texts)


def test_characters_are_found_without_a_lambda_over_each(spark):
    df = spark.createDataFrame([(1, "abc" * 1000)], "doc_id long, text string")
    plan = vo.build_vocabulary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and [r.ch for r in vo.build_vocabulary(df).collect()] == ["a", "b", "c"]


def test_blocks_and_windows_take_ids_without_a_lambda_over_each(spark, tmp_path):
    rows = [(k, "en", "s", f"text {k} ab") for k in range(5)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    named = Tables(spark, str(tmp_path)).named
    assert "lambda" not in named._jdf.queryExecution().optimizedPlan().toString()
    assert dict(named.dtypes)["ids"] == "array<string>" and named.count() == 5
