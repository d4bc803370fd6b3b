"""Character vocabularies."""

from pyspark.sql import functions as F

from textmill.operators import vocabulary as vo
from textmill.plans.catalogue.base import SQL_ENCODED, SQL_VOCAB, Tables, query, spaced

_IDS_SQL = "array_to_string(ids, ' ') AS ids"


@query("char_vocab", f"WITH {SQL_VOCAB} SELECT idx, ch FROM vocab")
def char_vocab(t: Tables):
    return vo.build_vocabulary(t.documents)


@query("char_encode", f"WITH {SQL_ENCODED} SELECT doc_id, {_IDS_SQL} FROM enc")
def char_encode(t: Tables):
    return t.encoded.select("doc_id", spaced("ids").alias("ids"))


# The vocabulary of the benchmark texts lacks characters that the documents have.
_FOREIGN_SQL = """vocab AS (
  SELECT (row_number() OVER (ORDER BY ch) - 1)::INTEGER AS idx, ch
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM benchmark))"""
_CHARS_SQL = """chars AS (
  SELECT doc_id, unnest(string_split(text, '')) AS ch,
         generate_subscripts(string_split(text, ''), 1) AS pos FROM documents)"""


@query(
    "char_encode_foreign",
    f"""WITH {_FOREIGN_SQL}, {_CHARS_SQL},
    found AS (SELECT doc_id, string_agg(idx::VARCHAR, ' ' ORDER BY pos) AS ids
              FROM chars JOIN vocab USING (ch) GROUP BY doc_id)
    SELECT doc_id, coalesce(ids, '') AS ids FROM documents LEFT JOIN found USING (doc_id)""",
)
def char_encode_foreign(t: Tables):
    vocabulary = vo.Vocabulary.build(t("benchmark"))
    ids = vocabulary.encode(F.col("text"))
    return t.documents.select("doc_id", spaced(ids).alias("ids"))


@query(
    "char_unknowns",
    f"""WITH {_FOREIGN_SQL}, {_CHARS_SQL}
    SELECT ch, count(*) AS n FROM chars ANTI JOIN vocab USING (ch) GROUP BY ch""",
)
def char_unknowns(t: Tables):
    return vo.unknown_characters(t.documents, vo.build_vocabulary(t("benchmark")))


@query("char_encode_strict", f"WITH {SQL_ENCODED} SELECT doc_id, {_IDS_SQL} FROM enc")
def char_encode_strict(t: Tables):
    ids = t.vocabulary.encode_strict(F.col("text"))
    return t.documents.select("doc_id", spaced(ids).alias("ids"))


@query(
    "char_decode",
    f"""WITH {SQL_ENCODED}
    SELECT doc_id, coalesce(string_agg(ch, '' ORDER BY pos), '') AS text FROM (
      SELECT doc_id, unnest(ids) + 1 AS idx, generate_subscripts(ids, 1) AS pos FROM enc)
    LEFT JOIN vocab USING (idx) GROUP BY doc_id""",
)
def char_decode(t: Tables):
    # ids moved up by one: the last one falls out of the vocabulary and is dropped
    moved = F.transform("ids", lambda i: i + 1)
    return t.encoded.select("doc_id", t.vocabulary.decode(moved).alias("text"))


@query(
    "vocab_info",
    f"""WITH {SQL_VOCAB} SELECT count(*) AS vocab_size,
      string_agg(ch, '' ORDER BY idx) FILTER (idx < 20) AS sample_chars,
      min(idx) AS min_idx, max(idx) AS max_idx FROM vocab""",
)
def vocab_info(t: Tables):
    info = vo.vocabulary_info(vo.build_vocabulary(t.documents))
    return info.withColumn("sample_chars", F.array_join("sample_chars", ""))


@query("encode_by_join", f"WITH {SQL_ENCODED} SELECT doc_id, {_IDS_SQL} FROM enc")
def encode_by_join(t: Tables):
    joined = vo.encode_by_join(t.documents, vo.build_vocabulary(t.documents))
    return joined.select("doc_id", spaced("ids").alias("ids"))
