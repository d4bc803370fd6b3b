"""Where intermediate tables go.

Work is cut into stages by writing a table to shared storage and reading it back. The
folder is the one the cluster names in ``spark.checkpoint.dir``; every executor can reach
it, so a lost executor costs a re-read and not a recomputation of the whole lineage.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a DataFrame to shared storage and go on from the written table."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the table that ``cut_lineage`` wrote for a DataFrame, once nothing reads it any more.

    Only folders directly under the shared folder are deleted; other tables are left alone.
    """
    spark = df.sparkSession
    root = shared_folder(spark).rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = files.makeQualified(base)
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = files.makeQualified(hadoop.Path(folder))
        if path.getParent() is not None and path.getParent().equals(top):
            files.delete(path, True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows, without counting all of a large one."""
    return df.limit(max_rows + 1).count() <= max_rows
