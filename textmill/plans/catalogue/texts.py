"""Cleaning and splitting of text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions import tokens
from textmill.operators import sequences
from textmill.plans.catalogue.base import SQL_GPT4, Tables, query, spaced, sql_bytes, sql_text

# The documents are clean already, so each whole text is roughened first: a byte order mark,
# zero-width characters, Windows and Mac line ends, escapes, and Unicode spaces.
_RAW_SQL = """raw AS (
  SELECT doc_id, chr(65279) || chr(8203) || ' ' || chr(9)
    || replace(text, '. ', '. ' || chr(9) || chr(13) || chr(10))
    || '\\n end\\t ' || chr(13) || chr(8204) || 'mac' || chr(12288) || chr(10) || chr(28) || ' ' AS raw
  FROM documents)"""
_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _raw(t: Tables):
    text = F.concat(
        F.lit("\ufeff\u200b \t"),
        F.replace(F.col("text"), F.lit(". "), F.lit(". \t\r\n")),
        F.lit("\\n end\\t \r\u200cmac\u3000\n\x1c "),
    )
    return t.documents.select("doc_id", text.alias("raw"))


def _sql_artifacts(c: str) -> str:
    for code in (65279, 8203, 8204):
        c = f"replace({c}, chr({code}), '')"
    return f"replace(replace({c}, '\\n', chr(10)), '\\t', chr(9))"


def _sql_newlines(c: str) -> str:
    return f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def _sql_rstrip(c: str) -> str:
    line = f"regexp_replace(l, '{_SPACES}+$', '')"
    return f"array_to_string(list_transform(string_split({c}, chr(10)), lambda l: {line}), chr(10))"


def _sql_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACES}+', ''), '{_SPACES}+$', '')"


def _sql_special(c: str) -> str:
    return f"""regexp_replace({c}, '[^\\p{{L}}\\p{{N}} \\n.,!?;:''"]', '', 'g')"""


def _sql_clean(c: str) -> str:
    return _sql_strip(_sql_rstrip(_sql_newlines(_sql_artifacts(c))))


def _step(name: str, step, sql: str) -> None:
    @query(name, f"WITH {_RAW_SQL} SELECT doc_id, {sql} AS text FROM raw")
    def _(t: Tables):
        return _raw(t).select("doc_id", step(F.col("raw")).alias("text"))


_step("norm_artifacts", tx.fix_artifacts, _sql_artifacts("raw"))
_step("norm_newlines", tx.unify_newlines, _sql_newlines("raw"))
_step("norm_rstrip_lines", tx.rstrip_lines, _sql_rstrip("raw"))
_step("norm_strip", tx.strip, _sql_strip("raw"))
_step("norm_lower", F.lower, "lower(raw)")
_step("norm_special", tx.drop_special, _sql_special("raw"))
_step(
    "norm_full",
    lambda c: tx.clean(c, tx.CleanOptions(lowercase=True, remove_special=True)),
    _sql_special(f"lower({_sql_clean('raw')})"),
)


@query(
    "filter_nonblank",
    """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS kept FROM lines
    WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY doc_id""",
)
def filter_nonblank(t: Tables):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(~tx.is_blank(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("kept"))


_PREFIX = 1_000_000


@query(
    "text_prefix",
    f"""WITH o AS (SELECT doc_id, text, coalesce(sum(length(text)) OVER (
        ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM documents)
    SELECT doc_id, substr(text, 1, {_PREFIX} - before) AS text FROM o WHERE before < {_PREFIX}""",
)
def text_prefix(t: Tables):
    return sequences.corpus_prefix(t.documents.select("doc_id", "text"), _PREFIX)


@query(
    "clean_docs",
    f"WITH {_RAW_SQL} SELECT doc_id, {_sql_clean('raw')} AS text FROM raw",
)
def clean_docs(t: Tables):
    return _raw(t).select("doc_id", tx.clean(F.col("raw")).alias("text"))


@query(
    "concat_by_source",
    """SELECT source, part, string_agg(text, ' ' ORDER BY doc_id) AS text
    FROM (SELECT doc_id, source, text, (coalesce(sum(length(text) + 1) OVER (
            PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
          ), 0) // 1000000)::BIGINT AS part FROM documents WHERE text IS NOT NULL)
    GROUP BY source, part""",
)
def concat_by_source(t: Tables):
    return sequences.concat_texts(t.documents, "source", " ")


def _chunked(name: str, split, pattern: str) -> None:
    @query(
        name,
        f"""SELECT doc_id, len(ch)::INTEGER AS n, array_to_string(ch, '¦') AS chunks
        FROM (SELECT doc_id, regexp_extract_all(text, {sql_text(pattern)}) AS ch FROM documents)""",
    )
    def _(t: Tables):
        found = t.documents.select("doc_id", split(F.col("text")).alias("ch"))
        return found.select(
            "doc_id", F.size("ch").alias("n"), F.array_join("ch", "¦").alias("chunks")
        )


_WORD = r"[\p{L}\p{M}\p{N}_]"
_chunked("pretok_gpt4", tx.chunks, SQL_GPT4)
_chunked(
    "pretok_ascii", tx.ascii_chunks,
    r"'(?:s|d|m|t|ll|ve|re)|[a-zA-Z]+|[0-9]{1,3}|[^a-zA-Z0-9\s]|\s+",
)
_chunked("pretok_words", tx.word_pieces, rf"{_WORD}+|[^\p{{L}}\p{{M}}\p{{N}}_\s]+")


@query(
    "utf8_bytes",
    f"""SELECT doc_id, array_to_string(
      list_transform(string_split({sql_bytes('text')}, ''), lambda c: unicode(c)), ' ') AS ids
    FROM documents""",
)
def utf8_bytes(t: Tables):
    ids: Column = tokens.utf8_ids(F.col("text"))
    return t.documents.select("doc_id", spaced(ids).alias("ids"))
