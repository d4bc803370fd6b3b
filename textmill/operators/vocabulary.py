"""Character vocabularies: building, encoding and decoding."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.functions.text import characters
from textmill.operators.joins import lookup_join
from textmill.sources.storage import cut_lineage, fits

# Vocabulary rows that are broadcast to the characters of the documents.
_BROADCAST_ROWS = 100_000
_CODE_POINTS = 0x110000


def _code_points(texts: pa.Array) -> Iterator[np.ndarray]:
    """The characters of each text, as numbers; none of a null."""
    for text in texts.cast(pa.binary()).to_pylist():
        yield np.frombuffer((text or b"").decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def character_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(ch, n): how often each character occurs. At most one row per Unicode character."""
    return (
        df.select(F.explode(characters(F.col(text))).alias("ch"))
        .groupBy("ch")
        .agg(F.count("*").alias("n"))
    )


def build_vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """(idx, ch): distinct characters in code point order, numbered from 0.

    Each Arrow batch gives its distinct characters and these are made distinct before the sort, so
    the single-task window sees at most as many rows as there are Unicode characters.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.zeros(_CODE_POINTS, bool)
            for points in _code_points(batch.column(0)):
                seen[points] = True
            found = pa.array([chr(x) for x in np.flatnonzero(seen)], pa.string())
            yield pa.RecordBatch.from_arrays([found], ["ch"])

    position = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("ch")) - 1
    found = df.select(F.col(text)).mapInArrow(distinct, "ch string").distinct()
    return found.select(position.cast("int").alias("idx"), "ch")


@dataclass(frozen=True)
class Vocabulary:
    """The characters of a vocabulary table on the driver, for use as constants.

    Bounded by the number of Unicode characters; in practice a few hundred to a few
    thousand. ``encode_by_join`` works from the table and needs no such copy.
    """

    chars: tuple[str, ...]

    @classmethod
    def collect(cls, table: DataFrame) -> "Vocabulary":
        rows = sorted(table.select("idx", "ch").collect())
        if [r.idx for r in rows] != list(range(len(rows))):
            raise ValueError("vocabulary ids must be 0..V-1")
        return cls(tuple(r.ch for r in rows))

    @classmethod
    def build(cls, df: DataFrame, text: str = "text") -> "Vocabulary":
        return cls.collect(build_vocabulary(df, text))

    def __len__(self) -> int:
        return len(self.chars)

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.chars)), "idx int, ch string")

    def _require(self) -> None:
        if not self.chars:
            raise ValueError("vocabulary is empty")

    def known_only(self, text: Column) -> Column:
        """The text without characters that are not in the vocabulary.

        Deleting the vocabulary leaves the row's unknown characters, which are then deleted
        from the text. Both are hash lookups per character, however large the vocabulary.
        """
        unknown = F.translate(text, "".join(self.chars), "")
        return F.call_function("translate", text, unknown, F.lit(""))

    def encode(self, text: Column) -> Column:
        """Character ids as ARRAY<INT>; characters outside the vocabulary are dropped.

        ``translate`` with constant arguments looks each character up in a hash table, so
        the cost does not grow with the vocabulary.
        """
        self._require()
        # moved up by one, as translate() reads U+0000 as "delete"
        stand_ins = "".join(tokens.id_to_char(i + 1) for i in range(len(self.chars)))
        symbols = F.translate(self.known_only(text), "".join(self.chars), stand_ins)
        return F.transform(tokens.symbols_to_ids(symbols), lambda i: i - 1)

    def encode_batches(self, text: Column) -> Column:
        """As ``encode``, by a table in Arrow batches, for work that takes more from each id.

        ARRAY<SHORT> if the ids fit. The ids are made once, where an expression may be repeated in
        the plan, and the columns that follow stay in generated code.
        """
        self._require()
        kind = np.int16 if len(self) < 1 << 15 else np.int32
        ids = np.full(_CODE_POINTS, -1, kind)
        ids[[ord(c) for c in self.chars]] = np.arange(len(self))

        @F.arrow_udf("array<short>" if kind == np.int16 else "array<int>")
        def encoded(texts: pa.Array) -> pa.Array:
            found = [ids[points] for points in _code_points(texts)]
            found = [own if own.min(initial=0) == 0 else own[own >= 0] for own in found]
            ends = np.concatenate([[0], np.cumsum([len(own) for own in found])]).astype(np.int32)
            values = pa.array(np.concatenate([np.zeros(0, kind), *found]))
            return pa.ListArray.from_arrays(pa.array(ends), values, mask=texts.is_null())

        return encoded(text)

    def encode_strict(self, text: Column) -> Column:
        """Like ``encode``, but a character outside the vocabulary fails the job."""
        self._require()
        known = F.length(self.known_only(text)) == F.length(text)
        failed = F.raise_error(F.lit("text has a character outside the vocabulary"))
        return F.when(text.isNull() | known, self.encode(text)).otherwise(
            failed.cast("array<int>")
        )

    def decode(self, ids: Column) -> Column:
        """Text of an id array; ids outside the vocabulary are dropped."""
        self._require()
        return tokens.ids_to_text(ids, [c.encode("utf-8").hex() for c in self.chars])


def unknown_characters(df: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """(ch, n) for characters that a vocabulary lacks."""
    return character_counts(df, text).join(vocabulary.select("ch"), "ch", "left_anti")


def vocabulary_info(vocabulary: DataFrame) -> DataFrame:
    """One row: size, the first 20 characters, smallest and largest id (null when empty)."""
    first = F.array_sort(F.collect_list(F.when(F.col("idx") < 20, F.struct("idx", "ch"))))
    return vocabulary.agg(
        F.count("*").alias("vocab_size"),
        F.transform(first, lambda e: e["ch"]).alias("sample_chars"),
        F.min("idx").alias("min_idx"),
        F.max("idx").alias("max_idx"),
    )


def encode_by_join(
    df: DataFrame, vocabulary: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids): the same encoding from a vocabulary table, for very large vocabularies.

    Only the distinct characters of each document are joined to the table. What they give comes
    back as one row per document, by which its text is translated in place.
    """
    own = F.array_distinct(characters(F.col(text)))
    chars = df.select(key, F.explode(own).alias("ch"))
    # moved up by one, as translate() reads U+0000 as "delete"
    table = cut_lineage(vocabulary.select("ch", tokens.id_to_symbol(F.col("idx") + 1).alias("symbol")), "vocabulary")
    if fits(table, _BROADCAST_ROWS):
        joined = chars.join(F.broadcast(table), "ch")
    else:
        joined = lookup_join(chars, table, ["ch"], [key])
    found = joined.groupBy(key).agg(F.collect_list(F.struct("ch", "symbol")).alias("found"))
    found = found.select(key, *[F.array_join(f"found.{c}", "").alias(n) for c, n in (("ch", "known"), ("symbol", "symbols"))])
    # what is not found has no stand-in and is deleted
    known = F.coalesce("known", F.lit(""))
    unknown = F.call_function("translate", F.col(text), known, F.lit(""))
    symbols = F.call_function("translate", F.col(text), F.concat(known, unknown), F.coalesce("symbols", F.lit("")))
    ids = F.transform(tokens.symbols_to_ids(symbols), lambda i: i - 1)
    return df.select(key, text).join(found, key, "left").select(key, ids.alias("ids"))
