"""Per-row arithmetic on ARRAY<DOUBLE> columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.lambdas import let


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def mean(values: Column) -> Column:
    return _total(values) / F.size(values)


def population_std(values: Column) -> Column:
    return let(
        mean(values),
        lambda m: F.sqrt(
            _total(F.transform(values, lambda x: (x - m) * (x - m))) / F.size(values)
        ),
    )


def standardize(values: Column, eps: float = 1e-6) -> Column:
    """(x - mean) / (std + eps) within one vector."""
    facts = F.struct(mean(values).alias("mean"), population_std(values).alias("std"))
    return let(
        facts, lambda f: F.transform(values, lambda x: (x - f["mean"]) / (f["std"] + eps))
    )


def rms_scale(values: Column, eps: float = 1e-6) -> Column:
    """x / sqrt(mean(x^2) + eps) within one vector."""
    power = _total(F.transform(values, lambda x: x * x)) / F.size(values)
    return let(F.sqrt(power + eps), lambda r: F.transform(values, lambda x: x / r))


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x * y))
