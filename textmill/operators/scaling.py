"""Scaling and quantisation: parameters come from one aggregate and join the rows as
scalar subqueries, so there is no join and no second copy of the data."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 1e-8


@dataclass(frozen=True)
class Scaler:
    """Fitted parameters. Made by ``fit_minmax`` or ``fit_zscore``, so never unfitted."""

    shift: Column
    spread: Column

    def transform(self, value: Column) -> Column:
        return (value - self.shift) / (self.spread + EPSILON)

    def inverse(self, value: Column) -> Column:
        # by definition the inverse leaves the epsilon out
        return value * self.spread + self.shift


def fit_minmax(df: DataFrame, column: str) -> Scaler:
    low = df.agg(F.min(column).alias("v")).scalar()
    high = df.agg(F.max(column).alias("v")).scalar()
    return Scaler(low, high - low)


def fit_zscore(df: DataFrame, column: str) -> Scaler:
    return Scaler(
        df.agg(F.avg(column).alias("v")).scalar(),
        df.agg(F.stddev_pop(column).alias("v")).scalar(),
    )


def fit(df: DataFrame, column: str, method: str = "minmax") -> Scaler:
    methods = {"minmax": fit_minmax, "zscore": fit_zscore}
    if method not in methods:
        raise ValueError(f"unknown method {method!r}")
    return methods[method](df, column)


def _round(value: Column) -> Column:
    # half to even; adding 0.0 turns -0.0 into 0.0
    return F.rint(value) + F.lit(0.0)


def quantize_symmetric(df: DataFrame, column: str, bits: int = 8, out: str = "quantized") -> DataFrame:
    """Round an array column to a grid symmetric about 0 that spans the table's largest |x|."""
    largest = F.array_max(F.transform(column, lambda x: F.abs(x.cast("double"))))
    scale = df.agg((F.max(largest) / (2 ** (bits - 1) - 1)).alias("v")).scalar()
    return df.withColumn("__scale", scale).withColumn(
        out, F.transform(column, lambda x: _round(x.cast("double") / F.col("__scale")) * F.col("__scale"))
    ).drop("__scale")


def quantize_asymmetric(df: DataFrame, column: str, bits: int = 8, out: str = "quantized") -> DataFrame:
    """Round an array column to a grid that spans the table's own range, with a zero point."""
    low = F.min(F.array_min(column)).cast("double")
    high = F.max(F.array_max(column)).cast("double")
    ends = df.agg(low.alias("lo"), ((high - low) / (2**bits - 1)).alias("scale"))
    scale = ends.select("scale").scalar()
    zero = ends.select(_round(-F.col("lo") / F.col("scale")).alias("zero")).scalar()
    s, z = F.col("__scale"), F.col("__zero")
    return (
        df.withColumn("__scale", scale)
        .withColumn("__zero", zero)
        .withColumn(
            out, F.transform(column, lambda x: _round(x.cast("double") / s + z) * s - z * s)
        )
        .drop("__scale", "__zero")
    )
