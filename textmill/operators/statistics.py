"""Reports and validation of numeric and token data."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.ranking import weighted_median
from textmill.sources.storage import cut_lineage


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n). Token data has few distinct values, so reports start from this table."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n")
    )


def token_counts(df: DataFrame, ids: str = "ids") -> DataFrame:
    return value_counts(df.select(F.explode(ids).alias("value")), "value")


def basic_report(counts: DataFrame, width: int = 4) -> DataFrame:
    """One row from value counts: size, range, mean, distinct values, megabytes.

    Empty data gives a size of 0 and null statistics.
    """
    n, v = F.col("n"), F.col("value")
    rows = F.coalesce(F.sum(n), F.lit(0))
    return counts.agg(
        rows.alias("rows"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
        (F.sum(v.cast("double") * n) / F.sum(n)).alias("mean_value"),
        F.count("*").alias("unique_values"),
        (rows * width / (1024 * 1024)).alias("memory_mb"),
    )


def _spread(counts: DataFrame) -> DataFrame:
    """One row from value counts: rows, range, mean, population variance, median, distinct.

    The variance takes its mean from a first pass; the difference of two large sums of
    squares would lose digits.
    """
    n, v = F.col("n"), F.col("value").cast("double")
    mean = counts.agg((F.sum(v * n) / F.sum(n)).alias("mean")).scalar()
    return (
        counts.withColumn("__mean", mean)
        .agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min("__mean").alias("mean"),
            (F.sum(n * (v - F.col("__mean")) * (v - F.col("__mean"))) / F.sum(n)).alias("variance"),
            F.count("*").alias("unique_values"),
        )
        .withColumn("std", F.sqrt("variance"))
        .withColumn("median", weighted_median(counts).scalar())
    )


def full_report(df: DataFrame, column: str) -> DataFrame:
    """One row: count, range, mean, exact median, population deviation, distinct values.

    The data is read once, into value counts; everything else comes from those.
    """
    out = _spread(cut_lineage(value_counts(df, column), "counts"))
    return out.withColumn("min", F.col("min").cast("double")).withColumn(
        "max", F.col("max").cast("double")
    )


def approximate_report(df: DataFrame, column: str) -> DataFrame:
    """The same in a single pass, with an approximate median and distinct count."""
    return df.agg(
        F.count(column).alias("rows"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
        F.avg(column).alias("mean"),
        F.percentile_approx(column, 0.5, 10000).cast("double").alias("median"),
        F.stddev_pop(column).alias("std"),
        F.var_pop(column).alias("variance"),
        F.approx_count_distinct(column).alias("unique_values"),
    )


def length_distribution(df: DataFrame, length: Column) -> DataFrame:
    """One row: min, max, mean, exact median and population deviation of row lengths."""
    lengths = df.select(length.cast("long").alias("length"))
    out = _spread(cut_lineage(value_counts(lengths, "length"), "counts"))
    return out.select(
        *[F.col(c).alias(f"{c}_length") for c in ["min", "max", "mean", "median", "std"]]
    )


def _side(df: DataFrame, value: str, name: str) -> DataFrame:
    v = F.col(value).cast("double")
    real = ~F.isnan(v)
    return df.agg(
        F.count("*").alias(f"{name}_rows"),
        F.count_if(F.isnan(v)).alias(f"{name}_nan"),
        F.count_if(F.abs(v) == float("inf")).alias(f"{name}_inf"),
        F.min(F.when(real, v)).alias(f"{name}_min"),
        F.max(F.when(real, v)).alias(f"{name}_max"),
    )


def validate(inputs: DataFrame, targets: DataFrame, input_value: str, target_value: str) -> DataFrame:
    """One row: valid flag, errors and warnings as arrays, and both value ranges."""
    a = _side(inputs, input_value, "input")
    b = _side(targets, target_value, "target")
    both = a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])
    types = [dict(inputs.dtypes)[input_value], dict(targets.dtypes)[target_value]]
    mismatch = F.format_string("Length mismatch: inputs=%d, targets=%d", "input_rows", "target_rows")
    errors = F.array_compact(
        F.array(
            F.when(F.col("input_rows") != F.col("target_rows"), mismatch),
            F.when(F.col("input_nan") > 0, F.lit("NaN values found in inputs")),
            F.when(F.col("target_nan") > 0, F.lit("NaN values found in targets")),
            F.when(F.col("input_inf") > 0, F.lit("Infinite values found in inputs")),
            F.when(F.col("target_inf") > 0, F.lit("Infinite values found in targets")),
        )
    )
    warning = F.lit(f"Dtype mismatch: inputs={types[0]}, targets={types[1]}")
    warnings = F.array(warning) if types[0] != types[1] else F.array().cast("array<string>")
    return both.select(
        (F.size(errors) == 0).alias("valid"),
        errors.alias("errors"),
        warnings.alias("warnings"),
        "input_min", "input_max", "target_min", "target_max",
    )


def require_token_range(df: DataFrame, vocab_size: int, ids: str = "ids") -> DataFrame:
    """Pass rows through; fail the job when an id is below 0 or not below the vocabulary size."""
    bad = F.exists(ids, lambda i: (i < 0) | (i >= vocab_size))
    message = F.lit(f"token ids must be in range [0, {vocab_size})")
    checked = F.when(bad, F.raise_error(message).cast(df.schema[ids].dataType))
    return df.withColumn(ids, checked.otherwise(F.col(ids)))


def token_range_report(df: DataFrame, vocab_size: int, ids: str = "ids") -> DataFrame:
    """One row: smallest and largest id and whether all are inside the vocabulary."""
    spans = df.select(F.array_min(ids).alias("lo"), F.array_max(ids).alias("hi"))
    out = spans.agg(F.min("lo").alias("min_id"), F.max("hi").alias("max_id"))
    inside = (F.col("min_id") >= 0) & (F.col("max_id") < vocab_size)
    return out.withColumn("valid", F.coalesce(inside, F.lit(True)))
