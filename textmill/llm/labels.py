"""A bounded sample of labelled documents for fitting a classifier, and the held-out rule."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo a number; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(remainder(modulus) == rest, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, rows: int
) -> DataFrame:
    """(place, text, label) of at most about ``rows`` labelled documents, not held out.

    The sample is the first ``rows`` ids by a hash, so it does not depend on how the tables
    are stored. An id with several labels is used with the larger one. The chosen ids are few
    by construction and are broadcast; the documents are read once, in place.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(modulus, rest) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .select("doc_id", "label", F.xxhash64("doc_id").alias("place"))
        .orderBy("place", "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("place", "text", "label")


def fit_in_one_task(
    sample: DataFrame, train: Callable[[pa.Table], bytes]
) -> bytes | None:
    """Train on a bounded sample in one task and bring back the model's bytes; None if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if any(b.num_rows for b in held):
            table = pa.Table.from_batches(held).sort_by([("place", "ascending"), ("text", "ascending")])
            yield pa.RecordBatch.from_arrays([pa.array([train(table)], pa.binary())], ["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0]["model"]) if found else None
