"""Saved datasets, tokenizers and models, as folders of tables.

A dataset folder holds ``encoded``, ``splits`` (partitioned by split; each row's tokens once,
windows are cut on reading), ``vocab`` and ``metadata``. Missing data or vocabulary is an error; missing metadata is an empty table.
"""

from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.bigram import BigramModel
from textmill.operators.bytepair import Merge, Tokenizer, encode
from textmill.operators.splits import piece_windows

METADATA_SCHEMA = (
    "dataset_name string, config struct<seq_length: int, validation_split: double, "
    "lowercase: boolean, remove_special: boolean, encoding: string>, "
    "vocab_size long, encoded_tokens long, stats map<string, double>"
)


@dataclass(frozen=True)
class DatasetOptions:
    seq_length: int = 128
    validation_split: float = 0.1
    lowercase: bool = False
    remove_special: bool = False
    encoding: str = "utf-8"

    @classmethod
    def from_metadata(cls, metadata: DataFrame) -> "DatasetOptions":
        """The options a dataset was made with."""
        row = metadata.select("config.*").first()
        return cls(**row.asDict()) if row else cls()


class Dataset:
    """Lazy access to a dataset folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self.folder = folder.rstrip("/")

    def save_encoded(self, encoded: DataFrame) -> None:
        encoded.write.mode("overwrite").parquet(f"{self.folder}/encoded")

    def save_splits(self, pieces: DataFrame, length: int) -> None:
        """Write the pieces of ``split_pieces``; windows would be ``length`` times the tokens."""
        sized = pieces.withColumn("seq_length", F.lit(length))
        sized.write.mode("overwrite").partitionBy("split").parquet(f"{self.folder}/splits")

    def save_vocabulary(self, vocabulary: DataFrame) -> None:
        # at most one small row per character
        vocabulary.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/vocab")

    def save_metadata(
        self,
        dataset_name: str,
        options: DatasetOptions,
        vocab_size: int,
        encoded_tokens: int,
        stats: dict[str, float | None],
    ) -> None:
        row = (dataset_name, asdict(options), vocab_size, encoded_tokens, stats)
        table = self._spark.createDataFrame([row], METADATA_SCHEMA)
        table.write.mode("overwrite").json(f"{self.folder}/metadata")

    def encoded(self) -> DataFrame:
        return self._spark.read.parquet(f"{self.folder}/encoded")

    def splits(self) -> DataFrame:
        """(key, start, input, target, split): all windows, cut from the stored pieces as they are read."""
        pieces = self._spark.read.parquet(f"{self.folder}/splits")
        return piece_windows(pieces, F.col("seq_length"), pieces.columns[0])

    def train_and_validation(self) -> tuple[DataFrame, DataFrame]:
        """Two scans, each of which reads one partition folder only."""
        splits = self.splits()
        return (
            splits.where(F.col("split") == "train"),
            splits.where(F.col("split") == "validation"),
        )

    def vocabulary(self) -> DataFrame:
        return self._spark.read.parquet(f"{self.folder}/vocab")

    def metadata(self) -> DataFrame:
        reader = self._spark.read.schema(METADATA_SCHEMA)
        try:
            return reader.json(f"{self.folder}/metadata")
        except AnalysisException:
            return self._spark.createDataFrame([], METADATA_SCHEMA)

    def info(self, ids: str = "ids") -> DataFrame:
        """One row: rows, tokens, bytes as 32-bit ids, and vocabulary size."""
        tokens = F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("long")
        sizes = self.encoded().agg(F.count("*").alias("total_rows"), tokens.alias("total_tokens"))
        vocab = self.vocabulary().agg(F.count("*").alias("n")).scalar()
        return sizes.withColumn("bytes", F.col("total_tokens") * 4).withColumn("vocab_size", vocab)


def save_tokenizer(spark: SparkSession, tokenizer: Tokenizer, folder: str) -> None:
    """Merge list, byte vocabulary and one metadata row. All bounded by the vocabulary size."""
    tokenizer.merges_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/merges")
    tokenizer.vocabulary_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/vocab")
    state = spark.createDataFrame(
        [(len(tokenizer), len(tokenizer.merges), tokenizer.trained, tokenizer.base)],
        "vocab_size int, num_merges int, trained boolean, base array<string>",
    )
    state.write.mode("overwrite").json(f"{folder}/metadata")


def load_tokenizer(spark: SparkSession, folder: str) -> Tokenizer:
    """The saved tokenizer; a missing part is an error."""
    spark.read.parquet(f"{folder}/vocab")
    merges = spark.read.parquet(f"{folder}/merges").orderBy("rank").collect()
    state = spark.read.schema(
        "vocab_size int, num_merges int, trained boolean, base array<string>"
    ).json(f"{folder}/metadata").first()
    return Tokenizer(
        tuple(Merge(r.rank, r.left, r.right, r.new_id, r.freq) for r in merges),
        tuple(state.base) if state.base is not None else None,
        state.trained,
    )


def save_bigram(model: BigramModel, folder: str) -> None:
    """Sparse counts and one metadata row. Probabilities are derived, so they are not stored."""
    model.counts.write.mode("overwrite").parquet(f"{folder}/counts")
    row = [(model.vocab_size, model.smoothing, model.fitted)]
    model.counts.sparkSession.createDataFrame(
        row, "vocab_size int, smoothing double, fitted boolean"
    ).write.mode("overwrite").json(f"{folder}/metadata")


def load_bigram(spark: SparkSession, folder: str) -> BigramModel:
    state = spark.read.schema("vocab_size int, smoothing double, fitted boolean").json(
        f"{folder}/metadata"
    ).first()
    return BigramModel(
        spark.read.parquet(f"{folder}/counts"), state.vocab_size, state.smoothing, state.fitted
    )


def save_tokens_by_file(
    spark: SparkSession, df: DataFrame, tokenizer: Tokenizer, folder: str, group: str = "source"
) -> DataFrame:
    """Encode all files in one job, one output folder per file; (group, tokens) and a total.

    The total is the row with a null group. Each task writes into every group it holds, so
    a file with much of the corpus is written by many tasks.
    """
    encode(df, tokenizer).select("doc_id", group, "ids").write.mode("overwrite").partitionBy(
        group
    ).parquet(folder)
    written = spark.read.parquet(folder)
    return written.rollup(group).agg(
        F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("tokens")
    )

