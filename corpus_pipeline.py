"""From raw documents to a training mix, one operator after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
Later stages work on all that their predecessor kept.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontamination, language, line_chunks, mixing, simhash
from textmill.sources.storage import cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.reject_unknown(docs)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the multi-line chunks that stand earlier in the corpus.

    A document that has nothing left goes.
    """
    left = line_chunks.drop_repeated(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix, with ``taken``: the words the mix takes, repeats counted."""
    return mixing.mixed(docs)


STAGES = [
    ("language identification", identify_language),
    ("line deduplication", deduplicate_lines),
    ("near-duplicate documents", deduplicate_documents),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# the language, near-duplicate and decontamination stages have no SQL form
ORACLE_SQL = None
