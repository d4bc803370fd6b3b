"""The local session that tests, checks and the benchmark share."""

import os

from pyspark.sql import SparkSession


def session(cores: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textmill")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", os.environ.get("TEXTMILL_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
