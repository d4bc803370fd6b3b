"""Train / validation / test splits. Every split has exact sizes and is repeatable."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.operators.ranking import (
    cut_keys,
    hash_rank,
    key_at_total,
    labelled,
    with_hash_bucket,
    with_order_bucket,
    without_bucket,
)
from textmill.operators.sequences import window_index
from textmill.sources.storage import cut_lineage

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def _check_ratio(ratio: float) -> None:
    if not 0 < ratio < 1:
        raise ValueError("split ratio must be between 0 and 1")


def split_rows(df: DataFrame, key: str, train_ratio: float = 0.9) -> DataFrame:
    """Label rows in key order: the first ``int(N * ratio)`` are train.

    Only the row at the cut is looked for; all rows are then labelled in place. Rows without
    a key are not train.
    """
    keyed = with_order_bucket(df.select(key).where(F.col(key).isNotNull()), key)
    cut = cut_keys(keyed, [key], [math.floor(df.count() * train_ratio)])[0]
    out = labelled(df, [key], [(TRAIN, cut)], VALIDATION)
    return out.withColumn("split", F.when(F.col(key).isNull(), VALIDATION).otherwise(F.col("split")))


def with_train_items(
    df: DataFrame, items: Column, train_ratio: Column, key: str = "doc_id", out: str = "train_items"
) -> DataFrame:
    """Add how many of a row's items come before the corpus-wide cut.

    Rows own ``items`` consecutive places of one long list in key order. Only the row at the
    cut is looked for, among the counts; the rows themselves are labelled in place. Rows without
    a key have no place and are left out.
    """
    keyed = df.where(F.col(key).isNotNull())
    known = F.coalesce(items.cast("long"), F.lit(0).cast("long"))
    sizes = cut_lineage(keyed.select(key, known.alias("__items")), "sizes")
    total = F.coalesce(F.sum("__items"), F.lit(0))
    cut = key_at_total(sizes, key, "__items", sizes.agg(F.floor(total * train_ratio).alias("n")).first().n)
    if cut is None:
        return keyed.withColumn(out, F.lit(0))
    there, left = cut
    kept = F.when(F.col(key) < there, known.cast("int")).when(F.col(key) == there, F.lit(left).cast("int"))
    return keyed.withColumn(out, kept.otherwise(F.lit(0)))


def split_pieces(
    df: DataFrame, length: int, validation_split: float = 0.1, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(key, first, ids, split): the tokens that a row's windows of one split cover, from place ``first``.

    The row at the cut gives two pieces, which share ``length`` tokens; all others give one.
    """
    # int(N * (1 - v)): the ratio is formed first, as a double
    count = tokens.window_count(F.col(ids), length)
    cut = with_train_items(df.select(key, ids), count, F.lit(1 - validation_split), key)
    n = F.col("train_items")
    rest = F.greatest(F.size(ids) - n, F.lit(0))
    pieces = F.array(
        F.struct(
            F.lit(0).alias("first"),
            F.when(n > 0, F.slice(ids, F.lit(1), n + length)).alias("ids"),
            F.lit(TRAIN).alias("split"),
        ),
        F.struct(
            n.alias("first"),
            F.when(rest > length, F.slice(ids, n + 1, rest)).alias("ids"),
            F.lit(VALIDATION).alias("split"),
        ),
    )
    return cut.select(key, F.inline(pieces)).where(F.size("ids") > length)


def piece_windows(pieces: DataFrame, length: Column | int, key: str = "doc_id") -> DataFrame:
    """(key, start, input, target, split): the windows of ``split_pieces``. Narrow, no shuffle."""
    start = F.col("start")
    return window_index(pieces, length, key, "ids", ("first", "split")).select(
        key,
        (F.col("first") + start).alias("start"),
        tokens.block_at(F.col("ids"), start, length).alias("input"),
        F.get(F.col("ids"), start + length).alias("target"),
        "split",
    )


def split_windows(
    df: DataFrame, length: int, validation_split: float = 0.1, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(key, start, input, target, split): windows in corpus order, the last part validation."""
    return piece_windows(split_pieces(df, length, validation_split, key, ids), length, key)


def split_tokens(
    df: DataFrame, train_ratio: float = 0.9, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(key, split, ids): the token stream cut once; the row at the cut gives two pieces.

    Windows built from the pieces cannot cross the cut.
    """
    cut = with_train_items(df.select(key, ids), F.size(ids), F.lit(train_ratio), key)
    n = F.col("train_items")
    pieces = F.array(
        F.struct(F.lit(TRAIN).alias("split"), F.slice(ids, F.lit(1), n).alias("ids")),
        F.struct(
            F.lit(VALIDATION).alias("split"),
            F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0))).alias("ids"),
        ),
    )
    return cut.select(key, F.inline(pieces)).where(F.size("ids") > 0)


def split_random(df: DataFrame, keys: list[str], ratio: float, seed: int) -> DataFrame:
    """Label rows at random: exactly ``int(N * ratio)`` are train.

    The order depends on ``keys``; the labels are given in place, as in ``split_rows``.
    """
    _check_ratio(ratio)
    drawn = with_hash_bucket(df, keys, seed)
    order = ["__u", *keys]
    cut = cut_keys(drawn, order, [math.floor(df.count() * ratio)])[0]
    return without_bucket(labelled(drawn, order, [(TRAIN, cut)], VALIDATION))


def split_three_way(
    df: DataFrame, keys: list[str], ratios: tuple[float, float, float], seed: int
) -> DataFrame:
    """Label rows train / validation / test; the first two are floored, test is the rest."""
    if abs(math.fsum(ratios) - 1.0) >= 1e-6:
        raise ValueError("ratios must sum to 1")
    total = df.count()
    train, validation = (math.floor(total * r) for r in ratios[:2])
    drawn = with_hash_bucket(df, keys, seed)
    order = ["__u", *keys]
    first, second = cut_keys(drawn, order, [train, train + validation])
    return without_bucket(labelled(drawn, order, [(TRAIN, first), (VALIDATION, second)], TEST))


def split_stratified(
    df: DataFrame, label: str, keys: list[str], ratio: float, seed: int
) -> DataFrame:
    """Label rows per class: ``int(n_class * ratio)`` of each class are train.

    Classes are ranked in hash buckets, so one very large class is spread over many tasks.
    """
    _check_ratio(ratio)
    ranked = hash_rank(df, keys, seed, "__rank", [label], "__class_rows")
    train = F.col("__rank") < F.floor(F.col("__class_rows") * F.lit(ratio))
    split = F.when(train, F.lit(TRAIN)).otherwise(F.lit(VALIDATION))
    return ranked.withColumn("split", split).drop("__rank", "__class_rows")
