"""Lookup of a value by similarity: a softmax over scores, then a weighted sum."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.vectors import dot
from textmill.operators.joins import lookup_join

# Queries that travel together in one row.
_BLOCK = 256
_BROADCAST_BYTES = 64 << 20


def score(
    queries: DataFrame,
    keys: DataFrame,
    query: str = "query",
    vector: str = "vector",
    value: str = "value",
) -> DataFrame:
    """(query, score, value): the dot product of each query with each key.

    A lookup scores every key for every query by definition. Queries are put in blocks, one row
    each; every key meets every block and scores itself against it, and what follows sums
    inside each task before the shuffle. Blocks are broadcast while their vectors are small;
    beyond that each key is sent once per block, spread over the tasks. Query ids are distinct.
    """
    known = queries.select(query, vector)
    rows, numbers = known.agg(F.count("*"), F.coalesce(F.sum(F.size(vector)), F.lit(0))).first()
    count = max(1, -(-rows // _BLOCK))
    block = F.pmod(F.xxhash64(query), F.lit(count)).cast("int")
    blocks = known.groupBy(block.alias("__block")).agg(
        F.collect_list(F.struct(F.col(query).alias("id"), F.col(vector).alias("v"))).alias("__asked")
    )
    sent = keys.select(value, vector, F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("__block"))
    if 8 * numbers <= _BROADCAST_BYTES:
        met = sent.join(F.broadcast(blocks), "__block")
    else:
        met = lookup_join(sent, blocks, ["__block"], [vector])
    asked = met.withColumn("__q", F.explode("__asked"))
    return asked.select(
        F.col("__q.id").alias(query), dot(F.col("__q.v"), F.col(vector)).alias("score"), value
    )


def softmax_lookup(
    scored: DataFrame, query: str = "query", score: str = "score", value: str = "value"
) -> DataFrame:
    """(query, looked_up): sum of softmax(score) * value per query, from (query, score, value) rows.

    The sums combine before the shuffle and the largest score is joined by a skew-safe
    lookup, so a query with very many keys is not gathered anywhere. Subtracting the
    query's largest score first keeps exp() from overflowing and does not change the result.
    """
    top = scored.groupBy(query).agg(F.max(score).alias("__top"))
    weighted = lookup_join(scored, top, [query], [score, value]).withColumn(
        "__w", F.exp(F.col(score) - F.col("__top"))
    )
    return weighted.groupBy(query).agg(
        (F.sum(F.col("__w") * F.col(value)) / F.sum("__w")).alias("looked_up")
    )
