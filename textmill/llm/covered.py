"""Places found to be repeats, brought back to their documents.

A mark is (id, th, start, n): windows start at n places from ``start`` on. ``id`` is the
doc_id, or the largest integer for a null one, which is thus smaller than no other; ``th`` is a
hash of the text, which tells rows of one id apart.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1
MARKS = "id long, th long, start int, n int"
_FIELDS = [("id", np.int64), ("th", np.int64), ("start", np.int32), ("n", np.int32)]


def identified(docs: DataFrame) -> DataFrame:
    """(text, id, th, doc_id)."""
    return docs.select(
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("th"),
        "doc_id",
    )


def packed(values: np.ndarray) -> bytes:
    """An array's bytes, compressed for the shuffle."""
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    tool = zstandard.ZstdDecompressor()
    return [np.frombuffer(tool.decompress(x), kind) for x in column.to_pylist()]


def edges(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns begin to differ from the row before."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def joined_up(owner: np.ndarray, place: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of runs of neighbouring places of one owner."""
    first = edges(owner, place - np.arange(len(place)), *same)
    return first, np.diff(np.append(first, len(place)))


def marks_batch(id_: np.ndarray, th: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    values = (id_, th, start, n)
    return pa.RecordBatch.from_arrays(
        [pa.array(v.astype(t, copy=False)) for v, (_, t) in zip(values, _FIELDS, strict=True)],
        [n for n, _ in _FIELDS],
    )


def with_marks(docs: DataFrame, marks: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """(doc_id, the fields of ``finish``) of every row.

    ``finish`` takes the Arrow texts and, for each, an (n, 2) array of marks or None, and
    returns the columns. Marks are gathered by document, and number less than its windows.
    """
    own = marks.groupBy("id", "th").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    both = identified(docs).join(own, ["id", "th"], "left")

    def run(texts: pa.Array, found: pa.Array) -> pa.Array:
        flat = found.flatten()
        pairs = np.stack([flat.field("start").to_numpy(), flat.field("n").to_numpy()], 1) if len(flat) else np.empty((0, 2), np.int32)
        valid = np.asarray(found.is_valid())
        size = np.where(valid, found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
        ends = np.cumsum(size)
        return finish(texts, [pairs[e - s : e] if s else None for s, e in zip(size.tolist(), ends.tolist(), strict=True)])

    done = F.arrow_udf(run, f"struct<{schema}>")
    # texts without a null, so that the two columns always arrive as plain arrays
    return both.select("doc_id", done(F.coalesce("text", F.lit("")), F.col("marks")).alias("r")).select("doc_id", "r.*")

