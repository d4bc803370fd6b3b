"""Positions and running totals over a whole table, without sorting it in one task.

A window without PARTITION BY puts every row in one task. Here the rows are first put in
buckets that follow the order; each bucket is summed (one small row per bucket), the bucket
totals are accumulated, and each bucket is then ranked on its own. Buckets are cut so that
each holds about the same number of rows, whatever the keys look like.

A bucket is a function of the row's own key, never of the physical partition, so the two
passes agree even when a lost task is run again somewhere else.
"""

from functools import reduce
from operator import and_, or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.hashing import uniform
from textmill.sources.storage import cut_lineage, fits

_BUCKET = "__bucket"
_KEY = "__key"
_BROADCAST_ROWS = 1_000_000


def _bucket_total(df: DataFrame) -> int:
    """Enough buckets to keep every task of the session's shuffle width busy."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_order_bucket(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """Add a bucket number that grows with a numeric key, with about equal row counts.

    The cut points are approximate quantiles: one narrow pass over the key column that
    returns ``buckets - 1`` numbers to the driver.
    """
    buckets = buckets or _bucket_total(df)
    numeric = df.withColumn(_KEY, F.col(key).cast("double"))
    wanted = [i / buckets for i in range(1, buckets)]
    error = max(0.25 / buckets, 1e-4)
    cuts = numeric.approxQuantile(_KEY, wanted, error) if wanted else []
    if not cuts:  # no rows, or one bucket
        return numeric.withColumn(_BUCKET, F.lit(0)).drop(_KEY)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    bucketed = Bucketizer(
        splits=splits, inputCol=_KEY, outputCol=_BUCKET, handleInvalid="keep"
    ).transform(numeric)
    return bucketed.withColumn(_BUCKET, F.col(_BUCKET).cast("int")).drop(_KEY)


def _accumulate(
    df: DataFrame,
    order: list[Column],
    values: dict[str, Column],
    group: list[str],
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """For each output name, the sum of its value over the rows before each row.

    Expects rows that carry a bucket. Without a group there is one total per bucket, so the
    totals are at most a few thousand rows and are broadcast. With groups there is one per
    (group, bucket), which may be large, so that join is left to the optimizer; its key is
    the bucketed one, so a large group does not meet in one task there either.
    ``totals`` names extra outputs: the sum over the whole group of a value.
    """
    totals = totals or {}
    sums = df.groupBy(*group, _BUCKET).agg(
        *[F.sum(v).alias(f"__total_{out}") for out, v in values.items()]
    )
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = whole.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    # rows without a group are a group too, so the join must match nulls
    carried = sums.select(
        *[F.col(c).alias(f"__on_{c}") for c in (*group, _BUCKET)],
        *[
            F.coalesce(F.sum(f"__total_{out}").over(before), F.lit(0)).alias(f"__before_{out}")
            for out in values
        ],
        *[F.sum(f"__total_{out}").over(whole).alias(name) for name, out in totals.items()],
    )
    inside = W.partitionBy(*group, _BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranked = df.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(out) for out, v in values.items()]
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in (*group, _BUCKET)])
    joined = ranked.join(carried if group else F.broadcast(carried), same)
    for out in values:
        joined = joined.withColumn(out, F.col(out) + F.col(f"__before_{out}"))
    helpers = [f"__on_{c}" for c in (*group, _BUCKET)] + [f"__before_{out}" for out in values]
    return joined.drop(_BUCKET, *helpers)


def running_totals(
    df: DataFrame, key: str, values: dict[str, Column], group: list[str] | None = None
) -> DataFrame:
    """Add, per output name, the sum of a value over all rows with a smaller key.

    ``key`` is a numeric column whose values are distinct within a group. A group that
    holds a large part of the table is spread over the buckets like everything else.
    """
    return _accumulate(with_order_bucket(df, key), [F.col(key)], values, group or [])


def running_total(
    df: DataFrame, key: str, value: Column | str, out: str, group: list[str] | None = None
) -> DataFrame:
    """Add the sum of one value over all rows with a smaller key (of the same group)."""
    value = F.col(value) if isinstance(value, str) else value
    return running_totals(df, key, {out: value}, group)


def ordered_rank(
    df: DataFrame, key: str, out: str = "rank", then: list[str] | None = None
) -> DataFrame:
    """Add the 0-based position of each row in the order of a numeric key.

    Rows with equal keys are told apart by the columns ``then``. Rows with one and the same
    key are ranked in one task, so the key should not hold very many.
    """
    order = [F.col(c) for c in [key, *(then or [])]]
    ranked = _accumulate(with_order_bucket(df, key), order, {out: F.lit(1)}, [])
    return ranked.withColumn(out, F.col(out).cast("long"))


def cut_keys(bucketed: DataFrame, order: list[str], places: list[int]) -> list[Row | None]:
    """For each 0-based place in an order, the order columns of the row there; None past the end.

    ``__equals`` says how many rows before the place have the same order columns.
    ``bucketed`` carries a bucket that follows the order. The buckets are counted (a few
    thousand numbers at most) and only those that hold a place are ranked, so a cut in a very
    large table moves almost none of it.
    """
    counts = bucketed.groupBy(_BUCKET).count().orderBy(F.col(_BUCKET).asc_nulls_first()).collect()
    inside: list[tuple[int, int] | None] = []
    for place in places:
        left, found = max(place, 0), None
        for row in counts:
            if left < row["count"]:
                found = (row[_BUCKET], left)
                break
            left -= row["count"]
        inside.append(found)
    held = sorted({bucket for bucket, _ in filter(None, inside)})
    if not held:
        return [None] * len(places)
    inorder = W.partitionBy(_BUCKET).orderBy(*order)
    rank, smaller = F.row_number().over(inorder) - 1, F.rank().over(inorder) - 1
    ranked = bucketed.where(F.col(_BUCKET).isin(held)).select(
        _BUCKET, *order, rank.alias("__rank"), (rank - smaller).alias("__equals")
    )
    wanted = [(F.col(_BUCKET) == b) & (F.col("__rank") == r) for b, r in filter(None, inside)]
    rows = {(x[_BUCKET], x["__rank"]): x for x in ranked.where(reduce(or_, wanted)).collect()}
    return [rows[at] if at else None for at in inside]


def key_at_total(df: DataFrame, key: str, value: str, wanted: int) -> tuple | None:
    """The key of the row at which the running total reaches ``wanted``, and what it lacked before it.

    None when the whole table has less or ``wanted`` is not positive. Only the bucket that
    holds the row is sorted.
    """
    if wanted <= 0:
        return None
    bucketed = with_order_bucket(df, key)
    lacking = wanted
    for row in bucketed.groupBy(_BUCKET).agg(F.sum(value).alias("total")).orderBy(_BUCKET).collect():
        if lacking <= row.total:
            inside = W.partitionBy(_BUCKET).orderBy(key).rowsBetween(W.unboundedPreceding, W.currentRow)
            summed = bucketed.where(F.col(_BUCKET) == row[_BUCKET]).withColumn("sum", F.sum(value).over(inside))
            there = summed.where(F.col("sum") >= lacking).orderBy("sum", key).first()
            return there[key], lacking - (there["sum"] - there[value])
        lacking -= row.total
    return None


def before(order: list[str], cut: Row | None) -> Column:
    """Whether a row stands before a cut that ``cut_keys`` found; nulls stand first."""
    if cut is None:
        return F.lit(True)
    smaller, same = F.lit(False), F.lit(True)
    for name in order:
        here, there = F.col(name), F.lit(cut[name])
        if cut[name] is not None:
            smaller = smaller | (same & (here.isNull() | (here < there)))
        same = same & here.eqNullSafe(there)
    return smaller


def at(order: list[str], cut: Row | None) -> Column:
    """Whether a row's order columns are those of a cut."""
    if cut is None:
        return F.lit(False)
    return reduce(and_, [F.col(name).eqNullSafe(F.lit(cut[name])) for name in order])


def labelled(
    df: DataFrame, order: list[str], cuts: list[tuple[str, Row | None]], rest: str
) -> DataFrame:
    """Add ``split``: for each (label, cut) in turn, the rows before the cut; the others are ``rest``.

    Labels are given in place. Only rows that equal a cut which divides equal rows are told
    apart, by a hash of all their columns; they should not be very many.
    """

    def split(place: Column | None) -> Column:
        out = None
        for label, cut in cuts:
            first = before(order, cut)
            if place is not None and cut is not None:
                first = first | (at(order, cut) & (place < cut["__equals"]))
            out = F.when(first, label) if out is None else out.when(first, label)
        return out.otherwise(rest)

    divided = [cut for _, cut in cuts if cut is not None and cut["__equals"]]
    if not divided:
        return df.withColumn("split", split(None))
    equal = reduce(or_, [at(order, cut) for cut in divided])
    place = F.row_number().over(W.partitionBy(*order).orderBy(F.xxhash64(*df.columns))) - 1
    few = df.where(equal).withColumn("__place", place).withColumn("split", split(F.col("__place")))
    return df.where(~equal).withColumn("split", split(None)).unionByName(few.drop("__place"))


def with_hash_bucket(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Add ``__u``, a uniform drawn from the keys, and its bucket; even by construction."""
    buckets = _bucket_total(df)
    drawn = df.withColumn("__u", uniform(seed, *keys))
    return drawn.withColumn(_BUCKET, F.floor(F.col("__u") * buckets).cast("int"))


def without_bucket(df: DataFrame) -> DataFrame:
    return df.drop(_BUCKET, "__u")


def rejoin(df: DataFrame, narrow: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a computed narrow table back to the wide rows it was computed from.

    The narrow table is written first, so its row count is known and the expressions below
    it run once. Only a table of few rows is broadcast; then the wide rows do not move.
    """
    written = cut_lineage(narrow, "narrow")
    small = fits(written, _BROADCAST_ROWS)
    return df.join(F.broadcast(written) if small else written, key, how)


def hash_rank(
    df: DataFrame,
    keys: list[str],
    seed: int,
    out: str = "rank",
    group: list[str] | None = None,
    group_rows: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in a seeded random order (of its group).

    The order depends on the keys alone. Buckets are cut from the hash, which is uniform,
    so they are even by construction and no pass is needed to find the cuts. ``group_rows``
    names an extra column with the group's row count.
    """
    drawn = with_hash_bucket(df, keys, seed)
    order = [F.col("__u"), *[F.col(k) for k in keys]]
    totals = {group_rows: out} if group_rows else None
    ranked = _accumulate(drawn, order, {out: F.lit(1)}, group or [], totals)
    return ranked.withColumn(out, F.col(out).cast("long")).drop("__u")


def weighted_median(counts: DataFrame) -> DataFrame:
    """One row with the exact median of a (value, n) table. NaN sorts last.

    ``median`` keeps a map of all distinct values in a single task. This ranks the value
    counts in buckets and keeps only the one or two values at the middle.
    """
    placed = running_total(counts, "value", "n", "before")
    total = counts.agg(F.sum("n").alias("total")).scalar()

    def covers(place: Column) -> Column:
        return (F.col("before") <= place) & (place < F.col("before") + F.col("n"))

    middle = placed.where(covers(F.floor((total - 1) / 2)) | covers(F.floor(total / 2)))
    return middle.agg(F.avg(F.col("value").cast("double")).alias("median"))
