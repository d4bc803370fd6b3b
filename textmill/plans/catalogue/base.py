"""Registration of queries, table access, and SQL fragments that several checks share."""

from collections.abc import Callable
from functools import cached_property, reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators import bytepair
from textmill.operators.bytepair import Tokenizer
from textmill.operators.vocabulary import Vocabulary
from textmill.sources.storage import cut_lineage, new_folder
from textmill.sources.text import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SEED = 42
WINDOW = 8
MERGES = 256

_tokenizers: dict[tuple[str, str], Tokenizer] = {}


class Tables:
    """The tables of one data folder in one session."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    @cached_property
    def documents(self) -> DataFrame:
        return self("documents")

    @cached_property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary.build(self.documents)

    @cached_property
    def encoded(self) -> DataFrame:
        """(doc_id, lang, source, text, ids) with character ids."""
        ids = self.vocabulary.encode(F.col("text")).alias("ids")
        return self.documents.select("doc_id", "lang", "source", "text", ids)

    @cached_property
    def named(self) -> DataFrame:
        """``encoded`` with each id as text, for work that writes every window of the ids.

        An id is made text once for its row and not once for each window that holds it.
        """
        ids = self.vocabulary.encode_batches(F.col("text")).cast("array<string>").alias("ids")
        return self.documents.select("doc_id", "lang", "source", "text", ids)

    @cached_property
    def stored(self) -> DataFrame:
        """(doc_id, lang, ids) written once, for work that passes over the ids several times."""
        return cut_lineage(self.encoded.select("doc_id", "lang", "ids"), "encoded")

    @property
    def tokenizer(self) -> Tokenizer:
        """The tokenizer trained on the documents, once per session and folder."""
        slot = (self.spark.sparkContext.applicationId, self.folder)
        if slot not in _tokenizers:
            _tokenizers[slot] = bytepair.train(self.documents, bytepair.BYTES + MERGES)
        return _tokenizers[slot]

    @cached_property
    def subwords(self) -> DataFrame:
        """(doc_id, lang, source, text, ids) with byte-pair ids."""
        return bytepair.encode(
            self.documents.select("doc_id", "lang", "source", "text"), self.tokenizer
        )

    def folder_for(self, name: str) -> str:
        return new_folder(self.spark, name)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its check when there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def spaced(ids: Column | str) -> Column:
    """An id array as text, so that results compare as plain values."""
    return F.array_join(ids, " ")


def digest(text: Column) -> Column:
    """A number below 2^32 from a text; sums of it compare large results row by row."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def weighed(ids: str, length: int) -> Column:
    """A sum over arrays of one length in which the value and the place of each id count.

    Written without a lambda: one would end the generated code, and each window's row would
    then carry a copy of its document.
    """
    return F.sum(reduce(add, [F.get(ids, F.lit(i)).cast("long") * (i + 1) for i in range(length)]))


# --- SQL fragments ----------------------------------------------------------------------


def sql_uniform(seed: int, *keys: str) -> str:
    joined = ", ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in keys]])
    return f"(('0x' || substr(md5(concat_ws('|', {joined})), 1, 13))::UBIGINT / 4503599627370496.0)"


def sql_gaussian(seed: int, *keys: str) -> str:
    radius = sql_uniform(seed, *keys, "'r'")
    angle = sql_uniform(seed, *keys, "'a'")
    return f"(sqrt(-2.0 * ln(1.0 - {radius})) * cos(2.0 * pi() * {angle}))"


def sql_weighed(ids: str, start: str, length: int) -> str:
    """The weighed value of the ``length`` ids that begin at a 0-based place."""
    return "(" + " + ".join(f"{ids}[{start} + {k}]::BIGINT * {k}" for k in range(1, length + 1)) + ")"


def sql_digest(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::UBIGINT::BIGINT"


SQL_VOCAB = """vocab AS (
  SELECT (row_number() OVER (ORDER BY ch) - 1)::INTEGER AS idx, ch
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents))"""

SQL_ENCODED = (
    SQL_VOCAB
    + """,
enc AS MATERIALIZED (
  SELECT doc_id, any_value(lang) AS lang, any_value(source) AS source, list(idx ORDER BY pos) AS ids
  FROM (SELECT doc_id, lang, source, unnest(string_split(text, '')) AS ch,
               generate_subscripts(string_split(text, ''), 1) AS pos FROM documents)
  JOIN vocab USING (ch) GROUP BY doc_id)"""
)

# Fixed value: the chunk pattern in the dialect of the check.
# RE2 has no possessive quantifiers and no look-ahead; on these texts, which never have two
# whitespace characters in a row, the plain form matches the same chunks.
SQL_GPT4 = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"""
    r"""| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]|\s+"""
)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_bytes(column: str) -> str:
    """One character per UTF-8 byte, for characters of at most two bytes."""
    return (
        f"array_to_string(list_transform(string_split({column}, ''), lambda c: "
        "CASE WHEN unicode(c) < 128 THEN c "
        "ELSE chr(192 + (unicode(c) >> 6)::INTEGER) || chr(128 + (unicode(c) & 63)::INTEGER) END), '')"
    )


def sql_training(merges: int) -> str:
    """CTEs of a training run: c0.. (chunk, s, n, f) and p0.. (the pair chosen, its count)."""
    parts = [
        f"""occ AS MATERIALIZED (
  SELECT doc_id, unnest(ch) AS chunk, generate_subscripts(ch, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, {sql_text(SQL_GPT4)}) AS ch FROM documents))""",
        f"""c0 AS MATERIALIZED (
  SELECT chunk, {sql_bytes('chunk')} AS s, n, f FROM (
    SELECT chunk, count(*) AS n, min(doc_id * 10000000 + pos) AS f FROM occ GROUP BY chunk))""",
    ]
    for k in range(merges):
        parts.append(
            f"""p{k} AS MATERIALIZED (
  SELECT p, freq FROM (
    SELECT substr(s, i, 2) AS p, sum(n) AS freq, min(f * 100000 + i) AS f
    FROM (SELECT s, n, f, unnest(range(1, length(s))) AS i FROM c{k}) GROUP BY 1)
  ORDER BY freq DESC, f LIMIT 1)"""
        )
        parts.append(
            f"""c{k + 1} AS MATERIALIZED (
  SELECT chunk, replace(s, (SELECT p FROM p{k}), chr({256 + k})) AS s, n, f FROM c{k})"""
        )
    return ",\n".join(parts)


def sql_subwords(merges: int = MERGES) -> str:
    """CTEs that end in bpe(doc_id, s): every document as a string of token symbols."""
    return (
        sql_training(merges)
        + f""",
bpe AS MATERIALIZED (
  SELECT doc_id, string_agg(s, '' ORDER BY pos) AS s
  FROM occ JOIN c{merges} USING (chunk) GROUP BY doc_id)"""
    )


def sql_ids(symbols: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({symbols}, ''), lambda c: unicode(c)), ' ')"
    )
