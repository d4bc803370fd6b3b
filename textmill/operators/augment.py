"""Seeded augmentation of arrays. Each draw depends on the seed, the row key and the position."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.draws import gaussians
from textmill.functions.hashing import below, gaussian, uniform


def add_noise(values: Column, key: str, level: float, seed: int) -> Column:
    """Array + N(0, level) per position."""
    return F.zip_with(values, gaussians(seed, key, values), lambda x, draw: x + draw * level)


def add_noise_scalar(value: Column, key: str, level: float, seed: int) -> Column:
    return value + gaussian(seed, key) * level


def mask(ids: Column, key: str, ratio: float, mask_value: int, seed: int) -> Column:
    """Each position replaced by the mask value with the given probability."""
    hits = below(ratio, seed, key, ids)
    return F.zip_with(ids, hits, lambda x, hit: F.when(hit, F.lit(mask_value)).otherwise(x))


def shuffle_span(ids: Column, key: str, fraction: float, seed: int) -> Column:
    """Shuffle one random run of max(1, int(n * fraction)) positions; the rest stays."""
    n = F.size(ids)
    span = F.greatest(F.lit(1), F.floor(n * F.lit(fraction)).cast("int"))
    # a run as long as the row can only begin at 0
    start = F.floor(uniform(seed, key, F.lit("s")) * F.greatest(n - span, F.lit(1))).cast("int")
    inside = F.transform(
        F.slice(ids, start + 1, span),
        lambda x, i: F.struct(uniform(seed, key, i).alias("u"), i.alias("i"), x.alias("x")),
    )
    shuffled = F.transform(F.array_sort(inside), lambda e: e["x"])
    tail = F.slice(ids, start + span + 1, F.greatest(n - start - span, F.lit(0)))
    return F.when(n > 0, F.concat(F.slice(ids, F.lit(1), start), shuffled, tail)).otherwise(ids)
