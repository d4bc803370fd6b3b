"""Values of sets that can occur in another set, found without moving the sets.

Each task sorts the hashes of its sets and sends them, cut to some bits, as the steps from one to
the next: about two bytes each. Ranges of hashes are merged, and a bitmap of what occurs twice goes
back to the sets. A bit may be set by chance, so what is not marked occurs once, and the rest is to
be counted. The bitmap has at most 2^``MAX_BITS`` bits (64 MB); where more values than that occur
again, more others are marked with them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 20, 29
# Bits of a hash within its range, and bits that tell the ranges apart at most.
_REST, _RANGES = 24, 12
# Hashes that a task holds before it sends them.
_PENDING = 4_000_000
_STEP = 0xFFFF


def _steps(own: np.ndarray, edge: np.ndarray) -> list[bytes]:
    """Sorted hashes as steps of two bytes, for each range that begins at an edge; a longer step is cut."""
    gap = np.diff(own, prepend=own[:1])
    gap[edge] = own[edge] & np.uint64((1 << _REST) - 1)
    long, rest = np.divmod(gap.astype(np.int64), _STEP)
    at = np.cumsum(long) + np.arange(len(own))
    out = np.full(at[-1] + 1, _STEP, np.uint16)
    out[at] = rest
    begin = at[edge] - long[edge]
    return [out[a:b].tobytes() for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(out)], strict=True)]


def _from_steps(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != _STEP]


def repeated(sets: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A bitmap, by the leading ``bits`` bits of a hash, of the hashes of a column of sets that can occur in two sets."""
    total = sets.agg(F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0]
    bits = min(max((8 * total).bit_length(), MIN_BITS), MAX_BITS)
    ranges = min(max(total.bit_length() - 14, 0), _RANGES)
    dropped, finer = np.uint64(64 - ranges - _REST), ranges + _REST - bits  # never below 0

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        own = np.sort(np.concatenate(held))
        part = own >> np.uint64(_REST)
        edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(part[edge].astype(np.int32)), pa.array(_steps(own, edge), pa.binary())], ["part", "steps"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy().view(np.uint64) >> dropped)
            size += len(held[-1])
            if size > _PENDING:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def merged(table: pa.Table) -> pa.Table:
        own = np.sort(np.concatenate([_from_steps(x) for x in table["steps"].to_pylist()]))
        marked = np.zeros(1 << (bits - ranges), bool)
        marked[own[1:][own[1:] == own[:-1]] >> finer] = True
        return pa.table({"part": table["part"][:1], "bits": pa.array([np.packbits(marked, bitorder="little").tobytes()], pa.binary())})

    rows = sets.select(column).mapInArrow(sent, "part int, steps binary").groupBy("part").applyInArrow(merged, "part int, bits binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    each = 1 << (bits - ranges - 3)
    for row in rows.collect():  # at most 2^_RANGES rows
        out[row["part"] * each : (row["part"] + 1) * each] = np.frombuffer(row["bits"], np.uint8)
    return out, bits


def repeats(sets: DataFrame, column: str, share: float) -> DataFrame:
    """(id, n, value): the values that can occur again, of the sets (id, column) in which they are at least the share.

    ``n`` is the size of the whole set.
    """
    marks, bits = repeated(sets, column)
    held = sets.sparkSession.sparkContext.broadcast(marks)
    down = np.uint64(64 - bits)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.columns
            n = own.value_lengths().to_numpy().astype(np.int64)
            values = own.flatten().to_numpy()
            cell = values.view(np.uint64) >> down
            hit = (held.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
            ends = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(n)])]
            enough = np.diff(ends) >= np.ceil(n * share - 1e-9)
            taken = hit & np.repeat(enough, n)
            row = np.repeat(np.arange(len(n)), n)[taken]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)), pa.array(n[row].astype(np.int32)), pa.array(values[taken])], ["id", "n", "value"]
            )

    kind = sets.schema["id"].dataType.simpleString()
    return sets.select("id", column).mapInArrow(kept, f"id {kind}, n int, value long")
