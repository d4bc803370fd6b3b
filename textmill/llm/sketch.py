"""Count-min sketches of hashed windows, merged over all partitions.

Each task counts, for its documents, in how many of them each cell of each sketch row is hit;
the partial counts are merged cell range by cell range. An estimate is the least count over the
rows and is never below the true number of documents, so what is estimated once occurs once.

The only question asked is whether an estimate is 2 or more, so counts saturate at 2 and the
merged sketch keeps one bit for each cell. Its size follows the number of windows up to
``MAX_BITS``: at most ``ROWS * 2**MAX_BITS / 8`` bytes (64 MB) reach the driver and each task.
Beyond that more windows are estimated as repeated and the exact pass has more to do, with the
same result.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 2
MIN_BITS, MAX_BITS = 20, 28
_RANGE = 16  # a range has 2^16 cells, so that a cell is two bytes within its range
_PENDING = 2_000_000
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def bits_for(windows: int) -> int:
    """Cells (as a power of two) for a number of windows: at least two cells for each."""
    return min(max((2 * windows).bit_length(), MIN_BITS), MAX_BITS)


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((h * np.uint64(_ODD[row])) >> np.uint64(64 - bits)).astype(np.uint32)


def build(docs: DataFrame, hashes: Callable, windows: int) -> np.ndarray:
    """Bits (ROWS, cells / 8) from the windows of a text column.

    ``hashes`` takes the Arrow texts of a batch and yields (hash, number of the document).
    """
    bits = bits_for(windows)

    def flush(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for row in range(ROWS):
            own = np.sort(np.concatenate(held[row]))
            part = own >> np.uint32(_RANGE)
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            low = (own & np.uint32((1 << _RANGE) - 1)).astype(np.uint16)
            ends = np.append(edge[1:], len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[edge].astype(np.int32) + np.int32(row << (MAX_BITS - _RANGE))),
                    pa.array([low[a:b].tobytes() for a, b in zip(edge.tolist(), ends.tolist(), strict=True)], pa.binary()),
                ],
                ["part", "hits"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        size = 0
        for batch in batches:
            for h, doc in hashes(batch.column(0)):
                if not len(h):
                    continue
                for row in range(ROWS):
                    # once for each document; a cell of two documents or more counts twice
                    both = np.unique((cells(h, row, bits).astype(np.uint64) << np.uint64(32)) | doc.astype(np.uint64))
                    cell = (both >> np.uint64(32)).astype(np.uint32)
                    third = np.zeros(len(cell), bool)
                    third[2:] = cell[2:] == cell[:-2]
                    held[row].append(cell[~third])
                size += len(h)
                if size > _PENDING:
                    yield from flush(held)
                    held, size = [[] for _ in range(ROWS)], 0
        if size:
            yield from flush(held)

    def merge(table: pa.Table) -> pa.Table:
        found = np.zeros(1 << _RANGE, np.uint8)
        for hits in table.column("hits").to_pylist():
            own = np.frombuffer(hits, np.uint16)
            twice = own[1:][own[1:] == own[:-1]]
            found[own] = np.minimum(found[own] + 1, 2)
            found[twice] = 2
        bitmap = np.packbits(found >= 2, bitorder="little").tobytes()
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([bitmap], pa.binary())})

    merged = (
        docs.select("text").mapInArrow(count, "part int, hits binary").groupBy("part").applyInArrow(merge, "part int, bits binary")
    )
    # at most ROWS * 2^(MAX_BITS - 16) rows of 8 kB
    out = np.zeros((ROWS, 1 << (bits - 3)), np.uint8)
    for r in merged.collect():
        row, part = divmod(r["part"], 1 << (MAX_BITS - _RANGE))
        out[row, part << (_RANGE - 3) : (part + 1) << (_RANGE - 3)] = np.frombuffer(r["bits"], np.uint8)
    return out


def repeated(sketch: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash is estimated to occur in two documents or more."""
    bits = (sketch.shape[1] * 8).bit_length() - 1
    out = np.ones(len(h), bool)
    for row in range(ROWS):
        cell = cells(h, row, bits)
        out &= (sketch[row][cell >> np.uint32(3)] >> (cell & np.uint32(7)).astype(np.uint8)) & 1 == 1
    return out


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
