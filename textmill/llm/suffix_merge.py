"""Substring deduplication over bytes by merging shard Burrows-Wheeler transforms.

A byte goes if it is covered by a 50-byte string that also starts in a document with a smaller
doc_id.

1. Anchors. The anchor of a 50-byte window is the 25-byte string in it with the smallest hash
   (the leftmost such); equal windows have equal anchors at the same place. A sketch over all
   partitions (``sketch``) drops windows whose anchor stands in one document only.
2. Shards. Neighbouring windows with one anchor make a snippet, the bytes that they cover. What
   a task has found, by anchor, is a shard. Within a shard equal snippets are sent once, for
   the smallest id; the others are settled, as their windows all stand in a smaller document.
3. Merge. All shards of an anchor meet in one bucket. Equal snippets of different shards are
   joined up likewise. Of the rest, each shard's snippets, closed by an end mark, have their
   Burrows-Wheeler transform. The transforms are merged by iterative interleave refinement:
   the order of the shards' entries is held as a sequence of shard numbers, and each round
   sorts it stably by the transforms' symbols, which orders it by one symbol more. Suffixes are
   not sorted again. A border between two entries that appears in round k says that their
   longest common prefix is k - 1; after 50 rounds the entries between borders are the repeated
   intervals, and a window is a repeat if its interval has a smaller id.

Buckets are merged in portions of about ``PORTION`` entries, whole anchors at a time. A passage
in a third of all documents has one snippet per anchor inside, and different ones only for the
few anchors at its ends.

Defined results: a null text is empty; texts of fewer than 50 bytes lose nothing. A null doc_id
is not smaller than any other. Rows with the same id do not repeat each other. Removal may cut
through a character; the digest is of the remaining bytes. Only doc_id and text are read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm import sketch
from textmill.llm.arrays import mix, prefix_sums, range_hash, runs, smallest
from textmill.llm.covered import MARKS, edges, identified, joined_up, marks_batch, packed, unpacked, with_marks
from textmill.sources.storage import cut_lineage

LENGTH = 50
ANCHOR = 25
PORTION = 500_000
_SEED = 47
_PENDING = 8_000_000  # snippet bytes held by a task
_PLACE = np.uint64(28)  # low bits of a key that hold a place; the rest is the hash compared


def snippets(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """(row, first window, number of windows, anchor hash, sums) of runs of windows of one anchor."""
    empty = np.empty(0, np.int64)
    sums = prefix_sums(data, _SEED)
    n = len(data) - ANCHOR + 1
    if len(data) < LENGTH:
        return empty, empty, empty, np.empty(0, np.uint64), sums
    if len(data) >> int(_PLACE):
        raise ValueError("a text of more than 256 MB")
    at = np.arange(n)
    h = range_hash(sums, at, at + ANCHOR, _SEED)
    key = ((h >> _PLACE) << _PLACE) | at.astype(np.uint64)
    low = smallest(key, LENGTH - ANCHOR + 1)
    anchor = (low & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
    window = at[: len(anchor)]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    window = window[window + LENGTH <= offsets[1:][row]]
    if not len(window):
        return empty, empty, empty, np.empty(0, np.uint64), sums
    first = edges(anchor[window])
    size = np.diff(np.append(first, len(window)))
    start = window[first]
    return row[start], start, size, h[anchor[start]], sums


def _hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, offsets in runs(texts):
        row, _, _, h, _ = snippets(data, offsets)
        yield h, row


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_SENT = "bucket int, ids binary, ths binary, starts binary, lens binary, anchors binary, text binary, marks binary"
_SENT_NAMES = [x.split()[0] for x in _SENT.split(", ")]
_SENT_TYPES = [pa.int32(), *[pa.binary()] * 7]


def _first_of(anchor: np.ndarray, whole: np.ndarray, size: np.ndarray, id_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first of each group of equal snippets in it, the smallest id for each snippet)."""
    order = np.lexsort((id_, size, whole, anchor))
    first = edges(anchor[order], whole[order], size[order])
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(id_[order][first], np.diff(np.append(first, len(order))))
    return order, first, least


def _send(held: list[list[np.ndarray]], texts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    id_, th, start, size, anchor, whole = (np.concatenate(p) for p in zip(*held, strict=True))
    text = np.concatenate(texts)
    begins = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
    least = _first_of(anchor, whole, size, id_)[2]
    bucket = (mix(anchor) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    first = edges(bucket[order])
    columns: list[list] = [[] for _ in _SENT_NAMES]
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        own = order[a:b]
        done = own[id_[own] > least[own]]
        own = own[id_[own] == least[own]]
        settled = np.stack([x[done].astype(np.int64) for x in (id_, th, start, size)])
        values = (id_[own], th[own], start[own].astype(np.int32), size[own].astype(np.int32), anchor[own])
        content = text[_ranges(begins[own], size[own] + LENGTH - 1)]
        columns[0].append(int(bucket[order[a]]))
        for c, v in zip(columns[1:], (*values, content, settled), strict=True):
            c.append(packed(v))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SENT_TYPES, strict=True)], _SENT_NAMES)


# --- merging ----------------------------------------------------------------------------


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank of each key among the distinct ones)."""
    order = np.argsort(key, kind="stable")
    step = np.zeros(len(key), np.int64)
    step[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def transforms(symbol: np.ndarray, following: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """The entries in the suffix order of their shard, shard after shard.

    Strings are closed by an end mark (symbol 0) after which they begin again.
    """
    order, rank = _ranked(shard.astype(np.uint64) << np.uint64(16) | symbol.astype(np.uint64))
    ahead = following
    while int(rank[order[-1]]) + 1 < len(rank):
        order, rank = _ranked(rank.astype(np.uint64) << np.uint64(32) | rank[ahead].astype(np.uint64))
        ahead = ahead[ahead]
    return order


def interleave(bwt: np.ndarray, shard: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge transforms given one after the other, by ``rounds`` refinements.

    Returns the merged order as indices into ``bwt``; for each entry the longest prefix it has
    in common with the one before, up to ``rounds``; and the number of its interval, the
    entries that agree in ``rounds`` symbols.
    """
    z = shard
    block = np.zeros(len(z), np.int32)
    common = np.full(len(z), rounds, np.int32)
    common[0] = 0
    for k in range(rounds):
        place = np.argsort(z, kind="stable")  # the shards' entries, in their own order
        symbol = np.empty_like(bwt)
        symbol[place] = bwt
        order = np.argsort(symbol, kind="stable")
        symbol, source = symbol[order], block[order]
        border = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        common[1:][border & (common[1:] == rounds)] = k
        np.cumsum(border, out=block[1:])
        z = z[order]
    merged = np.empty(len(z), np.int64)
    merged[np.argsort(z, kind="stable")] = np.arange(len(z))
    return merged, common, block


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """Dense numbers in the smallest type: sorting bytes takes one pass."""
    values, dense = np.unique(numbers, return_inverse=True)
    return dense.astype(np.uint8 if len(values) <= 256 else np.uint16 if len(values) <= 65536 else np.uint32)


def _repeats(text: np.ndarray, begin: np.ndarray, size: np.ndarray, id_: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(snippet, window in it) of the windows that a snippet of a smaller id has too."""
    length = size + LENGTH  # its bytes and the end mark
    ends = np.cumsum(length)
    starts = ends - length
    symbol = np.zeros(ends[-1], np.uint16)
    inner = _ranges(starts, length - 1)
    symbol[inner] = text[_ranges(begin, length - 1)].astype(np.uint16) + 1
    following = np.arange(1, ends[-1] + 1)
    following[ends - 1] = starts
    before = np.empty_like(following)
    before[following] = np.arange(len(following))
    owner = np.repeat(np.arange(len(size)), length)
    number = _narrow(shard)
    order = transforms(symbol, following, number[owner])
    merged, _, block = interleave(_narrow(symbol)[before[order]], number[owner][order], LENGTH)
    at = order[merged]  # the text place of each merged entry
    offset = at - starts[owner[at]]
    window = offset < size[owner[at]]
    at, block, offset = at[window], block[window], offset[window]
    first = edges(block)
    least = np.repeat(np.minimum.reduceat(id_[owner[at]], first), np.diff(np.append(first, len(at))))
    again = id_[owner[at]] > least
    return owner[at][again], offset[again]


def _merge(table: pa.Table) -> pa.Table:
    """Marks of one bucket from its shards, one a row."""

    def column(name: str, kind: type) -> np.ndarray:
        return np.concatenate(unpacked(table.column(name), kind))

    ids, ths, starts = column("ids", np.int64), column("ths", np.int64), column("starts", np.int32).astype(np.int64)
    sizes = column("lens", np.int32).astype(np.int64)
    anchors, text = column("anchors", np.uint64), column("text", np.uint8)
    counts = [len(x) for x in unpacked(table.column("ids"), np.int64)]
    shards = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(sizes + LENGTH - 1) - (sizes + LENGTH - 1)
    whole = range_hash(prefix_sums(text, _SEED), begins, begins + sizes + LENGTH - 1, _SEED)
    settled = np.concatenate([x.reshape(4, -1) for x in unpacked(table.column("marks"), np.int64)], axis=1)
    out = [marks_batch(*settled)]
    order, first, least = _first_of(anchors, whole, sizes, ids)
    later = ids > least
    out.append(marks_batch(ids[later], ths[later], starts[later], sizes[later]))
    # one entry for each distinct snippet, in the order of the anchors
    rep = order[first]
    kinds = edges(anchors[rep])
    several = np.repeat(np.diff(np.append(kinds, len(rep))) > 1, np.diff(np.append(kinds, len(rep))))
    # all rows of the smallest id share the fate of the entry
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    members = np.flatnonzero(~later)
    members = members[np.argsort(group[members], kind="stable")]
    lo, hi = np.searchsorted(group[members], np.arange(len(first))), np.searchsorted(group[members], np.arange(len(first)), "right")
    chosen = np.flatnonzero(several)
    if len(chosen):
        weight = np.cumsum(sizes[rep[chosen]] + LENGTH)
        kind = np.cumsum(np.concatenate([[0], anchors[rep[chosen]][1:] != anchors[rep[chosen]][:-1]]))
        portion = (weight // PORTION)[edges(kind)][kind]  # an anchor goes where it begins
        for part in np.split(chosen, edges(portion)[1:]):
            own = rep[part]
            snippet, offset = _repeats(text, begins[own], sizes[own], ids[own], shards[own])
            if not len(snippet):
                continue
            by = np.lexsort((offset, snippet))
            a, n = joined_up(snippet[by], offset[by])
            g, o = part[snippet[by][a]], offset[by][a]
            each = hi[g] - lo[g]
            row = members[_ranges(lo[g], each)]
            out.append(marks_batch(ids[row], ths[row], starts[row] + np.repeat(o, each), np.repeat(n, each)))
    return pa.Table.from_batches(out)


def repeats(docs: DataFrame) -> DataFrame:
    """Marks (id, th, start, n), in bytes, of the windows that a smaller doc_id has too."""
    spark = docs.sparkSession
    own = identified(docs).select("text", "id", "th")
    # about one anchor for every (LENGTH - ANCHOR) / 2 bytes
    anchors = 2 * sketch.total_bytes(own) // (LENGTH - ANCHOR)
    bits = spark.sparkContext.broadcast(sketch.build(own, _hashes, anchors))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, size = [], [], 0
        for batch in batches:
            ids, ths = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for first, _, data, offsets in runs(batch.column(0)):
                row, start, n, anchor, sums = snippets(data, offsets)
                hit = sketch.repeated(bits.value, anchor)
                if not hit.any():
                    continue
                row, start, n, anchor = row[hit], start[hit], n[hit], anchor[hit]
                whole = range_hash(sums, start, start + n + LENGTH - 1, _SEED)
                held.append([ids[first + row], ths[first + row], start - offsets[row], n, anchor, whole])
                texts.append(data[_ranges(start, n + LENGTH - 1)])
                size += len(texts[-1])
                if size > _PENDING:
                    yield _send(held, texts, buckets)
                    held, texts, size = [], [], 0
        if held:
            yield _send(held, texts, buckets)

    marks = cut_lineage(own.mapInArrow(shards, _SENT).groupBy("bucket").applyInArrow(_merge, MARKS), "marks")
    bits.destroy()  # the marks are written
    return marks


def _finish(texts: pa.Array, marks: list) -> pa.Array:
    counts = np.zeros((3, len(texts)), np.int64)
    digest = []
    for first, last, data, offsets in runs(texts):
        for row in range(last - first):
            own, found = data[offsets[row] : offsets[row + 1]], marks[first + row]
            counts[0, first + row] = len(own)
            if found is not None:
                change = np.zeros(len(own) + 1, np.int32)
                np.add.at(change, found[:, 0], 1)
                np.add.at(change, found[:, 0] + found[:, 1] + LENGTH - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                counts[1, first + row] = gone.sum()
                counts[2, first + row] = (gone[1:] & ~gone[:-1]).sum() + gone[0]
                own = own[~gone]
            digest.append(hashlib.sha256(own.tobytes()).hexdigest())
    return pa.StructArray.from_arrays(
        [*[pa.array(c) for c in counts], pa.array(digest, pa.string())], ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    )


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    return with_marks(docs, repeats(docs), _finish, "n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string")
