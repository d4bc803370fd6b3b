"""Joins of a large, unevenly keyed table with a lookup table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.sources.storage import cut_lineage


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join to a table with one row per key, when a few keys may hold much of the big side.

    A key is hot when it holds more than 1/P of the rows, with P the shuffle width; there
    are fewer than P such keys, which bounds both what is broadcast and what is copied.
    Rows of hot keys are spread over P salts by the columns ``spread_by``, which must vary
    within a key, and the lookup's hot rows are copied once per salt. All other keys are
    joined as they are. Keys are counted with partial sums, so finding the hot ones does
    not move the rows; a caller that has the counts already passes them as (key, n).
    """
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if counts is None:
        counts = cut_lineage(big.groupBy(*on).agg(F.count("*").alias("n")), "counts")
    total = counts.agg(F.sum("n").alias("n")).scalar()
    hot = counts.where(F.col("n") * parts > total).select(*on, F.lit(True).alias("__hot"))
    # rows with a null key match nothing, so any salt will do for them
    spread = F.coalesce(F.col("__hot"), F.lit(False))
    for key in on:
        spread = spread | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(parts)).cast("int")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
        F.array(F.lit(0))
    )
    left = (
        big.join(F.broadcast(hot), on, "left")
        .withColumn("__salt", F.when(spread, salt).otherwise(F.lit(0)))
        .drop("__hot")
    )
    right = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn("__salt", F.explode(copies))
        .drop("__hot")
    )
    return left.join(right, [*on, "__salt"], how).drop("__salt")
