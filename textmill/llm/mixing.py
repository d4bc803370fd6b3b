"""Mixing sources to target weights, in tokens, by DataFrame operations only.

Sizes are numbers of words. Each source's target is its share of the mix by weight, at most
``MAX_EPOCHS`` times its own size; what a source cannot take is shared out again by weight.
That is filling to a common level L with min(limit, L * weight), and the level follows from one
pass over the sources in the order of limit / weight.

Within a source, documents are put in a random order by a hash of the id: ranges of the hash
make buckets of even size, bucket totals are accumulated, and each bucket is ordered on its own,
so a source that holds much of the table is spread like the others. The running total of sizes
says where the budget ends: whole epochs take every document, the last one takes documents up
to the exact budget (the target rounded down) and cuts the document at its end.

Defined results: a null text has size 0 and is taken 0 words of. A null source is a source of
its own and comes last. Rows with equal ids and sizes are interchangeable, so reruns agree; rows without an id have one
key and are ordered by size.
An empty table gives no rows; sources of size 0 have target 0. Only doc_id, text and source
are read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.sources.storage import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
_DIGITS = 4  # buckets are cut from the first four hex digits of the key


def size_of(text: Column) -> Column:
    """The number of words; white space is 0x20 and 0x09-0x0D."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(plain, " "), lambda w: w != "")), F.lit(0)).cast("long")


def order_key(doc_id: str = "doc_id") -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), F.col(doc_id).cast("string")))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size); one small row per source."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * epochs
    own = own.withColumn("weight", weight.cast("long")).withColumn("cap", cap)
    everything = W.partitionBy(F.lit(0))
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    # the level if exactly the sources before this one are at their limit
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))
    own = own.withColumn("level", left / F.sum("weight").over(after))
    reached = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.first(F.when(reached, F.col("level")), ignorenulls=True).over(
        fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    target = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), level * F.col("weight"))
    )
    return own.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of every row."""
    spark = docs.sparkSession
    sizes = cut_lineage(
        docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), order_key().alias("key")), "sizes"
    )
    goals = targets(sizes, weights, share, epochs)
    buckets = max(1, min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 16**_DIGITS))
    number = F.conv(F.substring("key", 1, _DIGITS), 16, 10).cast("long")
    placed = sizes.withColumn("bucket", F.floor(number * buckets / 16**_DIGITS).cast("int"))
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    totals = totals.withColumn("ahead", F.coalesce(F.sum("total").over(ahead), F.lit(0)))
    # one row per source and bucket
    carried = totals.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "ahead", "source_size", "target"
    )
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    own = placed.withColumn(
        "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    joined = own.join(carried, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - whole * F.col("source_size") - F.col("ahead") - F.col("inside")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source"
    )


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws('|', 'mix', doc_id::VARCHAR)) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
  FROM {docs}),
own AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS weight
  FROM sized GROUP BY source),
capped AS (SELECT *, 2 * source_size AS cap FROM own),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
       - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
       / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM capped),
goals AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, (
      SELECT l.level FROM levels l WHERE l.level * l.weight <= l.cap
      ORDER BY l.cap / l.weight, l.source NULLS LAST LIMIT 1) * weight), cap::DOUBLE) AS target
  FROM levels),
ordered AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized),
taken AS (
  SELECT doc_id, size, source_size, target, o.source, ahead, floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN (floor(target)::BIGINT // source_size) ELSE 0 END AS epochs
  FROM ordered o JOIN goals g ON o.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken, source
FROM taken
"""


def mixed(docs: DataFrame) -> DataFrame:
    """The documents the mix takes words of, with ``taken`` (words, repeats counted) added.

    A column named ``taken`` in the input is replaced. Rows with the same id all get the
    largest of what is taken of them.
    """
    own = mix(docs).where(F.col("taken") > 0).groupBy(F.col("doc_id").alias("__id")).agg(F.max("taken").alias("taken"))
    return docs.drop("taken").join(own, F.col("doc_id").eqNullSafe(F.col("__id"))).drop("__id")
