"""Clean and encode files as they arrive in a folder.

Every step is a stateless projection, so the stream needs no watermark and no state; the
checkpoint only records which files are done, and a restarted stream goes on from there.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textmill.functions.text import CleanOptions, clean
from textmill.operators.bytepair import Tokenizer, encode_text


def read_arrivals(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def table_path(path: str) -> str:
    """The path of a stored table, one file or a folder of files, for ``read_arrivals``.

    A stream reads folders and what a pattern finds, so the path is given as a pattern for itself.
    """
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def clean_and_encode(
    arrivals: DataFrame, tokenizer: Tokenizer, options: CleanOptions = CleanOptions(), text: str = "text"
) -> DataFrame:
    cleaned = arrivals.withColumn(text, clean(F.col(text), options))
    return cleaned.withColumn("ids", encode_text(F.col(text), tokenizer))


def write_available(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, then stop. The file sink writes each file once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(folder)
    )
