"""Substring deduplication over windows of 13 words, with a count-min prefilter.

First pass: every task sketches the windows of its documents, and the partition sketches are
merged (``sketch``). Second pass: windows estimated to stand in one document only are dropped;
the estimate is never too low, so no repeat is lost. The others are grouped exactly by 96 bits
of hashes of their word sequence, and a window is a repeat where a smaller doc_id has it too.

Before the shuffle each task settles what it can: of a window in several of its documents only
the one with the smallest id is sent, and the others are repeats already. A window that stands in
a third of all documents thus is one entry for each flush of a task, not for each document.
Windows go to buckets by the smallest hash of their word triples, so neighbours mostly go
together and what comes back are runs of places, not single ones.

Defined results: null and empty texts have no words; their remainder is empty. Texts of fewer
than 13 words lose nothing. A null doc_id is not smaller than any other. Rows with the same id
do not repeat each other. Only doc_id and text are read.
"""

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm import sketch
from textmill.llm.arrays import mix, prefix_sums, range_hash, runs, sequence_hash, smallest, words
from textmill.llm.covered import MARKS, edges, identified, joined_up, marks_batch, packed, unpacked, with_marks
from textmill.sources.storage import cut_lineage

WORDS = 13
_SEEDS = (41, 43)
_PENDING = 1_000_000
_GROUP = 3  # words hashed together to choose a window's bucket


def _windows(data: np.ndarray, offsets: np.ndarray, length: int, seeds: tuple[int, ...]) -> tuple:
    """(rows of the windows, place in the row, hashes for each seed, hashes of the words)."""
    start, end, row = words(data, offsets)
    own = [range_hash(prefix_sums(data, s), start, end, s) for s in seeds]
    found = [sequence_hash(w, length, s) for w, s in zip(own, seeds, strict=True)]
    n = len(found[0])
    at = np.flatnonzero(row[:n] == row[length - 1 :]) if n else np.empty(0, np.int64)
    first = np.searchsorted(row, np.arange(len(offsets) - 1))
    return row[at], at - first[row[at]], [f[at] for f in found], own[0], at


def _hashes(length: int):
    def hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, _, data, offsets in runs(texts):
            row, _, found, _, _ = _windows(data, offsets, length, _SEEDS[:1])
            yield found[0], row

    return hashes


_SENT = "bucket int, ids binary, ths binary, starts binary, lens binary, h binary, g binary, marks binary"


def _send(parts: list[list[np.ndarray]], buckets: int) -> pa.RecordBatch:
    """One row per bucket of the windows that remain to be compared, and of those settled."""
    id_, th, place, bucket, h, g = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((place, th, id_, g, h))
    first = edges(h[order], g[order])
    smallest = np.repeat(id_[order][first], np.diff(np.append(first, len(order))))
    settled = np.zeros(len(order), bool)
    settled[order] = id_[order] > smallest
    out = []
    # back in the order of the texts, runs of neighbours that go to one bucket
    for mask in (~settled, settled):
        at = np.flatnonzero(mask)
        a, n = joined_up(id_[at], place[at].astype(np.int64), th[at], bucket[at])
        out.append((at, a, n))
    (at, a, n), (done, b, m) = out
    own, marked = bucket[at[a]] if len(at) else np.empty(0, np.int32), bucket[done[b]] if len(done) else np.empty(0, np.int32)
    by, by_marked = np.argsort(own, kind="stable"), np.argsort(marked, kind="stable")
    names = np.unique(np.concatenate([own, marked]))
    lo, hi = np.searchsorted(own[by], names), np.searchsorted(own[by], names, "right")
    mlo, mhi = np.searchsorted(marked[by_marked], names), np.searchsorted(marked[by_marked], names, "right")
    columns: list[list] = [[] for _ in range(8)]
    for k, name in enumerate(names.tolist()):
        sel, msel = by[lo[k] : hi[k]], by_marked[mlo[k] : mhi[k]]
        size = n[sel]
        inner = np.repeat(a[sel] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        head, w, mh = at[a[sel]], at[inner], done[b[msel]]
        settled_runs = np.stack([id_[mh], th[mh], place[mh].astype(np.int64), m[msel]])
        row = (name, id_[head], th[head], place[head].astype(np.int32), size.astype(np.int32), h[w], g[w], settled_runs)
        for c, v in zip(columns, row, strict=True):
            c.append(v if isinstance(v, int) else packed(v))
    types = [pa.int32(), *[pa.binary()] * 7]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _SENT_NAMES)


_SENT_NAMES = [x.split()[0] for x in _SENT.split(", ")]


def _compare(table: pa.Table) -> pa.Table:
    """Marks of one bucket: settled ones, and windows that a smaller id has too."""

    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate(unpacked(table.column(name), kind))

    ids, ths, starts = column("ids", np.int64), column("ths", np.int64), column("starts", np.int32)
    lens, h, g = column("lens", np.int32).astype(np.int64), column("h", np.uint64), column("g", np.uint32)
    run = np.repeat(np.arange(len(lens)), lens)
    place = starts[run] + np.arange(len(run)) - (np.cumsum(lens) - lens)[run]
    owner = ids[run]
    order = np.lexsort((owner, g, h))
    first = edges(h[order], g[order])
    smallest = np.repeat(owner[order][first], np.diff(np.append(first, len(order))))
    again = np.zeros(len(order), bool)
    again[order] = owner[order] > smallest
    at = np.flatnonzero(again)
    a, n = joined_up(run[at], place[at])
    head = at[a]
    settled = np.concatenate([x.reshape(4, -1) for x in unpacked(table.column("marks"), np.int64)], axis=1)
    batches = [marks_batch(owner[head], ths[run[head]], place[head], n), marks_batch(*settled)]
    return pa.Table.from_batches(batches)


def repeats(docs: DataFrame, length: int = WORDS) -> DataFrame:
    """Marks (id, th, start, n), in words, of the windows that a smaller doc_id has too."""
    spark = docs.sparkSession
    own = identified(docs).select("text", "id", "th")
    bits = spark.sparkContext.broadcast(sketch.build(own, _hashes(length), sketch.total_bytes(own) // 6))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, ths = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for first, _, data, offsets in runs(batch.column(0)):
                row, place, (h, g), word, at = _windows(data, offsets, length, _SEEDS)
                hit = sketch.repeated(bits.value, h)
                if not hit.any():
                    continue
                low = smallest(sequence_hash(word, _GROUP, 1), length - _GROUP + 1)[at[hit]]
                bucket = (mix(low) % np.uint64(buckets)).astype(np.int32)
                row, place = row[hit], place[hit]
                held.append([ids[first + row], ths[first + row], place, bucket, h[hit], (g[hit] >> np.uint64(32)).astype(np.uint32)])
                size += len(row)
                if size > _PENDING:
                    yield _send(held, buckets)
                    held, size = [], 0
        if held:
            yield _send(held, buckets)

    marks = own.mapInArrow(candidates, _SENT).groupBy("bucket").applyInArrow(_compare, MARKS)
    marks = cut_lineage(marks, "marks")
    bits.destroy()  # the marks are written
    return marks


def _finish(length: int):
    def finish(texts: pa.Array, marks: list) -> pa.Array:
        n_words, n_removed = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        digest = []
        for first, last, data, offsets in runs(texts):
            raw = data.tobytes()
            for row in range(last - first):
                found = raw[offsets[row] : offsets[row + 1]].split()  # ASCII white space only
                own = marks[first + row]
                n_words[first + row] = len(found)
                if own is not None:
                    change = np.zeros(len(found) + 1, np.int64)
                    np.add.at(change, own[:, 0], 1)
                    np.add.at(change, own[:, 0] + own[:, 1] + length - 1, -1)
                    kept = np.cumsum(change[:-1]) == 0
                    n_removed[first + row] = len(found) - int(kept.sum())
                    found = compress(found, kept)
                digest.append(hashlib.sha256(b" ".join(found)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(n_removed), pa.array(digest, pa.string())], ["n_words", "n_removed", "kept_sha256"]
        )

    return finish


def dedup(docs: DataFrame, length: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    return with_marks(docs, repeats(docs, length), _finish(length), "n_words:long,n_removed:long,kept_sha256:string")
