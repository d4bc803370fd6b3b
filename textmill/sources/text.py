"""Reading raw text files."""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.ranking import at, before, cut_keys, hash_rank, with_hash_bucket, without_bucket

_REPLACEMENT = "�"


def _files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def _strict(content: Column, encoding: str) -> Column:
    """Decoded text; bytes that are not in the encoding fail the job."""
    if encoding.lower().replace("-", "") == "utf8":
        return F.validate_utf8(content.cast("string"))
    return F.decode(content, encoding)


def read_whole(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(path, text): each file as one string. A missing path or bad bytes are errors."""
    return _files(spark, path).select("path", _strict(F.col("content"), encoding).alias("text"))


def read_folder(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(name, text, error): every matching file, named by its stem.

    A file that is not UTF-8 gives a null text and a message; the others go on.
    """
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    stem = F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1)
    return _files(spark, folder, pattern).select(
        stem.alias("name"),
        F.when(valid, text).alias("text"),
        F.when(~valid, F.lit("file is not valid UTF-8")).alias("error"),
    )


def read_lenient(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file as one string, without the bytes that cannot be decoded.

    In a file that has such bytes a U+FFFD of its own is dropped too.
    """
    text = F.col("content").cast("string")
    mended = F.replace(F.make_valid_utf8(text), F.lit(_REPLACEMENT), F.lit(""))
    return _files(spark, path).select(
        "path", F.when(F.is_valid_utf8(text), text).otherwise(mended).alias("text")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of one or many files. Large files are split between tasks."""
    return spark.read.option("lineSep", "\n").text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet text dataset, in the tasks that its row groups give."""
    return spark.read.parquet(path)


def lines_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, line)."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def sample_lines(
    lines: DataFrame, keys: list[str], fraction: float, seed: int, first: int | None = None
) -> DataFrame:
    """A random ``int(N * fraction)`` of the lines without replacement, in random order.

    ``rank`` is a line's place in the sample; ``first`` keeps only the head of the sample.
    Only lines of the sample are ranked.
    """
    size = math.floor(lines.count() * fraction)
    if first is not None:
        size = min(size, first)
    drawn = with_hash_bucket(lines, keys, seed)
    order = ["__u", *keys]
    cut = cut_keys(drawn, order, [size])[0]
    sample = without_bucket(drawn.where(before(order, cut) | at(order, cut)))
    return hash_rank(sample, keys, seed, "rank").where(F.col("rank") < size)
