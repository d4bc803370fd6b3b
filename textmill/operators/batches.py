"""Mini-batches as a column: rows stay where they are and get a batch number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.operators.ranking import hash_rank, ordered_rank


def batch_count(df: DataFrame, batch_size: int, drop_last: bool = False) -> DataFrame:
    """One row: how many batches an epoch has."""
    n = F.count("*")
    whole = F.floor(n / batch_size) if drop_last else F.ceil(n / batch_size)
    return df.agg(whole.cast("long").alias("batches"))


def _number(df: DataFrame, ranked: DataFrame, batch_size: int, drop_last: bool) -> DataFrame:
    batch = F.floor(F.col("__rank") / batch_size).cast("long")
    place = (F.col("__rank") % batch_size).cast("int")
    out = ranked.withColumn("batch_id", batch).withColumn("place", place).drop("__rank")
    if drop_last:
        whole = df.agg(F.floor(F.count("*") / batch_size).alias("n")).scalar()
        out = out.where(F.col("batch_id") < whole)
    return out


def ordered(df: DataFrame, key: str, batch_size: int, drop_last: bool = False) -> DataFrame:
    """Add (batch_id, place) with rows in key order."""
    return _number(df, ordered_rank(df, key, "__rank"), batch_size, drop_last)


def shuffled(
    df: DataFrame, keys: list[str], batch_size: int, seed: int, epoch: int = 0, drop_last: bool = False
) -> DataFrame:
    """Add (batch_id, place) with rows in a random order that differs between epochs.

    An epoch's order depends on the seed and its number, not on the epochs before it.
    """
    drawn = df.withColumn("__epoch", F.lit(epoch))
    ranked = hash_rank(drawn, ["__epoch", *keys], seed, "__rank").drop("__epoch")
    return _number(df, ranked, batch_size, drop_last)


def get_batch(numbered: DataFrame, index: int) -> DataFrame:
    """The rows of one batch; the last one may be short."""
    return numbered.where(F.col("batch_id") == index)


def gather(numbered: DataFrame, columns: list[str]) -> DataFrame:
    """One row per batch with its rows as parallel arrays, in order."""
    rows = F.array_sort(F.collect_list(F.struct("place", *columns)))
    # naming a field of an array of structs gives the array of that field
    return numbered.groupBy("batch_id").agg(rows.alias("rows")).select(
        "batch_id", *[F.col(f"rows.{c}").alias(c) for c in columns]
    )


def pad_batches(
    df: DataFrame, batch: Column, ids: str = "ids", max_length: int | None = None, pad_id: int = 0
) -> DataFrame:
    """Add (batch_id, tokens, mask): each row padded to its batch's longest, or to a length.

    The mask is 1 for tokens and 0 for padding.
    """
    numbered = df.withColumn("batch_id", batch)
    if max_length is not None:
        length: Column = F.lit(max_length)
    else:
        longest = numbered.groupBy("batch_id").agg(F.max(F.size(ids)).alias("__longest"))
        numbered = numbered.join(longest, "batch_id")
        length = F.col("__longest")
    padded = numbered.withColumn("tokens", tokens.pad(F.col(ids), length, pad_id)).withColumn(
        "mask", tokens.attention_mask(F.col(ids), length)
    )
    return padded.drop("__longest")
