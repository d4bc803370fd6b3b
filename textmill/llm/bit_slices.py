"""Ranked lexical search with bit-sliced Bloom signatures and exact rescoring.

The index holds, for blocks of documents of like size, a Bloom signature of each document's
terms, stored by slices: one bitmap over the documents of the block for each bit of the
signature. A term sets ``HASHES`` bits, and does so again, as another entry, for each of the
``LEVELS`` that its number of occurrences reaches. Whether the documents of a block can hold a
term so often is the AND of a few slices; it may be wrongly true but never wrongly false.
Signatures have ``BITS`` bits for each entry, so the index grows with the distinct terms.

A document's upper bound for a query is the sum over the terms of the term's weight times the
most that its possible number of occurrences can give in a document of this length; these are
sums of slices weighted by terms. Documents are then searched in two passes over the index:

1. the documents with the highest bounds are scored exactly; the k-th of these scores is a floor
   that the k-th best score of all cannot be below;
2. every document whose bound reaches the floor is scored exactly from its text, so nothing is
   left out that is not proven to rank lower.

Queries are taken in blocks of ``BLOCK_CHARS`` characters, and a block is sent to every task
with its terms' document frequencies, which one pass over the texts counts exactly. Terms are
compared by their bytes, not by a hash.

Defined results: a null text has no terms; a document without terms and a query without terms
are in no result. Rows with the same id and text are ranked each for themselves, and ids that
are null come last among equal scores, for documents and queries alike; repeated queries have
repeated results. Empty tables give no rows. Only doc_id, item_id and text are read.
"""

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.arrays import WORDLIKE, mix, prefix_sums, range_hash, runs, spans
from textmill.sources.storage import cut_lineage, fits

K = 10
BITS, HASHES = 16, 3
LEVELS = (1, 2, 3, 4, 5, 6, 8, 11, 16)
BLOCK_CHARS = 200_000
_CELLS = 1 << 23  # of a block: bits of a signature times documents
_WIDEST = 512  # documents in a block
_SEED = 37
_BROADCAST_KEYS = 1_000_000  # of 16 bytes
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, and (start, end, row, hash) of each term."""
    low = _LOWER[data]
    start, end, row = spans(WORDLIKE[low], offsets)
    return low, start, end, row, range_hash(prefix_sums(low, _SEED), start, end, _SEED)


def _entries(h: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every entry of terms that occur tf times, and the term's place."""
    found = [(mix(h[tf >= level] + np.uint64(level)), np.flatnonzero(tf >= level)) for level in LEVELS]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _bits(entries: np.ndarray, size: int) -> list[np.ndarray]:
    """The bits of each entry in a signature of ``size`` bits, a power of two."""
    second = mix(entries) | np.uint64(1)
    return [((entries + np.uint64(k) * second) % np.uint64(size)).astype(np.int64) for k in range(HASHES)]


# --- the index --------------------------------------------------------------------------

_INDEX = "ids array<long>, hashes array<long>, sizes array<long>, bits long, slices binary"


def build(docs: DataFrame) -> DataFrame:
    """Blocks of documents: ids, hashes of the texts, numbers of terms, and the slices.

    A task keeps the entries of unfinished blocks, one block for each power of two of the
    number of entries.
    """

    def packed(held: list[tuple[int, int, int, np.ndarray]], size: int) -> pa.RecordBatch:
        width = -(-len(held) // 8) * 8
        cells = np.zeros((size, width), bool)
        for place, (*_, entries) in enumerate(held):
            for bits in _bits(entries, size):
                cells[bits, place] = True
        slices = np.packbits(cells, axis=1, bitorder="little").tobytes()
        columns = [pa.array([[h[k] for h in held]], pa.list_(pa.int64())) for k in range(3)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([size], pa.int64()), pa.array([slices], pa.binary())], ["ids", "hashes", "sizes", "bits", "slices"]
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, int, np.ndarray]]] = {}
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, _, data, offsets in runs(batch.column(2)):
                *_, row, h = terms(data, offsets)
                sizes = np.bincount(row, minlength=len(offsets) - 1)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                for place in np.flatnonzero(sizes).tolist():
                    entries = _entries(*np.unique(h[bounds[place] : bounds[place + 1]], return_counts=True))[0]
                    size = BITS << max(len(entries) - 1, 1).bit_length()
                    group = held.setdefault(size, [])
                    group.append((ids[first + place], hashes[first + place], int(sizes[place]), entries))
                    if len(group) >= min(max(_CELLS // size, 8), _WIDEST):
                        yield packed(held.pop(size), size)
        for size, group in held.items():
            yield packed(group, size)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text").mapInArrow(blocks, _INDEX)


# --- queries ------------------------------------------------------------------------------


@dataclass
class Queries:
    """A block of queries: their distinct terms, and the terms of each with repeats counted."""

    texts: list[bytes]  # terms, in the order of their hashes
    hashes: np.ndarray
    rows: np.ndarray  # first to last query that has terms: places of the terms, one after the other
    counts: np.ndarray  # occurrences in the query
    starts: np.ndarray  # of each query in rows
    numbers: list[int]  # of the queries

    @staticmethod
    def parse(items: list[tuple[int, str]]) -> "Queries":
        named: dict[bytes, int] = {}
        rows, counts, starts, numbers = [], [], [], []
        for number, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            low, start, end, _, h = terms(data, np.array([0, len(data)]))
            content = low.tobytes()
            own: dict[bytes, int] = {}
            for a, b, x in zip(start.tolist(), end.tolist(), h.tolist(), strict=True):
                named[content[a:b]] = x
                own[content[a:b]] = own.get(content[a:b], 0) + 1
            if own:
                starts.append(len(rows))
                numbers.append(number)
                rows += own
                counts += own.values()
        texts = sorted(named, key=lambda t: named[t])
        place = {t: k for k, t in enumerate(texts)}
        return Queries(
            texts,
            np.array([named[t] for t in texts], np.uint64),
            np.array([place[t] for t in rows], np.int64),
            np.array(counts, np.int64),
            np.array(starts, np.int64),
            numbers,
        )

    def find(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the words, place among the terms) of each word that is a query term."""
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        hit = np.flatnonzero(self.hashes[at] == h)
        term = at[hit]
        joined = np.frombuffer(b"".join(self.texts), np.uint8)
        ends = np.cumsum([len(t) for t in self.texts])
        length = end[hit] - start[hit]
        same = length == np.diff(ends, prepend=0)[term]
        hit, term, length = hit[same], term[same], length[same]
        if not len(hit):
            return hit, term
        # the bytes of each hit beside the bytes of its term
        first = np.cumsum(length) - length
        step = np.arange(int(length.sum())) - np.repeat(first, length)
        equal = low[np.repeat(start[hit], length) + step] == joined[np.repeat(ends[term] - length, length) + step]
        good = np.logical_and.reduceat(equal, first)
        return hit[good], term[good]


def frequencies(docs: DataFrame, queries: Queries) -> np.ndarray:
    """In how many rows each query term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries.texts), np.int64)
        for batch in batches:
            for _, _, data, offsets in runs(batch.column(0)):
                low, start, end, row, h = terms(data, offsets)
                hit, term = queries.find(low, start, end, h)
                both = np.unique(row[hit] * len(total) + term)
                total += np.bincount(both % len(total), minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    summed = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(queries.texts), np.int64)
    for r in summed.collect():  # at most one row for each term of the block
        out[r.term] = r.n
    return out


def term_weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _part(tf: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What tf occurrences give in a document with the measure m; never above 1,000,000."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _measure(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    if 75 * int(n.max(initial=0)) * documents < 2**62:
        return 25 + (75 * n * documents) // length
    return np.array([25 + (75 * int(x) * documents) // length for x in n], np.int64)


@dataclass
class Search:
    """A block of queries with what is needed to score: w by term, rows and terms of the corpus."""

    queries: Queries
    weight: np.ndarray
    documents: int
    length: int

    def bounds(self, sizes: np.ndarray, bits: int, slices: np.ndarray) -> np.ndarray:
        """Upper bounds (query, document) of a block."""
        m = _measure(sizes, self.documents, self.length)
        # the most that a term can give if its last level reached is this one
        most = [_part(np.minimum(level - 1, sizes), m) for level in LEVELS[1:]] + [_part(sizes, m)]
        held = np.arange(len(self.queries.hashes))
        inside = np.full((len(held), slices.shape[1]), 255, np.uint8)
        out = np.zeros((len(held), len(sizes)), np.float64)
        before = np.zeros(len(sizes), np.int64)
        for level, part in zip(LEVELS, most, strict=True):
            for rows in _bits(mix(self.queries.hashes[held] + np.uint64(level)), bits):
                inside &= slices[rows]
            some = inside.any(axis=1)
            held, inside = held[some], inside[some]
            if not len(held):
                break
            there = np.unpackbits(inside, axis=1, count=len(sizes), bitorder="little")
            out[held] += there * (part - before).astype(np.float64)
            before = part
        q = self.queries
        factor = (q.counts * self.weight[q.rows]).astype(np.float64)
        ends = np.append(q.starts[1:], len(q.rows))
        return np.stack([factor[a:b] @ out[q.rows[a:b]] for a, b in zip(q.starts.tolist(), ends.tolist(), strict=True)])

    def scores(self, term: np.ndarray, n: int) -> np.ndarray:
        """Exact scores of all queries of a document, from its query terms with repeats."""
        tf = np.bincount(term, minlength=len(self.weight))
        m = _measure(np.array([n]), self.documents, self.length)
        part = np.where(tf > 0, _part(tf, m), 0)
        q = self.queries
        return np.add.reduceat(q.counts * self.weight[q.rows] * part[q.rows], q.starts)


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[list, list, np.ndarray, int, np.ndarray]]:
    for ids, hashes, sizes, bits, slices in zip(*[c.to_pylist() for c in batch.columns], strict=True):
        yield ids, hashes, np.array(sizes, np.int64), bits, np.frombuffer(slices, np.uint8).reshape(bits, -1)


_KEY = "doc_id long, th long"


def _highest(index: DataFrame, search: Search, k: int) -> DataFrame:
    """(doc_id, th) of the k documents with the highest bounds for each query."""
    numbers = range(len(search.queries.numbers))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list[tuple]] = [[] for _ in numbers]
        for batch in batches:
            for ids, hashes, sizes, bits, slices in _blocks_of(batch):
                bound = search.bounds(sizes, bits, slices)
                few = min(k, len(sizes))
                places = np.argpartition(-bound, few - 1, axis=1)[:, :few]
                for q in numbers:
                    own = [(float(bound[q, p]), hashes[p], ids[p]) for p in places[q].tolist() if bound[q, p] >= 1]
                    top[q] = heapq.nlargest(k, top[q] + own, key=lambda x: x[:2])
        rows = [(q, *x) for q in numbers for x in top[q]]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "bound", "th", "doc_id"]
        )

    found = index.mapInArrow(best, "query long, bound double, th long, doc_id long")
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("bound"), "th"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("doc_id", "th").distinct()


def _possible(index: DataFrame, search: Search, floors: np.ndarray) -> DataFrame:
    """(doc_id, th) of every document whose bound reaches a query's floor."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, hashes, sizes, bits, slices in _blocks_of(batch):
                kept = np.flatnonzero((search.bounds(sizes, bits, slices) >= floors[:, None]).any(axis=0)).tolist()
                columns = [pa.array([x[p] for p in kept], pa.int64()) for x in (ids, hashes)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th"])

    return index.mapInArrow(reach, _KEY).distinct()


def _scored(docs: DataFrame, keys: DataFrame, search: Search, k: int) -> DataFrame:
    """(query, doc_id, score): the k best rows of each query among the documents of the keys.

    Each task keeps its own k best rows of a query; only these are compared further.
    """
    keys = cut_lineage(keys, "documents").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"))
    few = fits(keys, _BROADCAST_KEYS)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th"))
    texts = docs.join(F.broadcast(keys) if few else keys, same, "left_semi").select("doc_id", "text")
    numbers = search.queries.numbers

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list[tuple]] = [[] for _ in numbers]
        least = np.ones(len(numbers), np.int64)  # a lower score is not among the best of the task
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, data, offsets in runs(batch.column(1)):
                low, start, end, row, h = terms(data, offsets)
                sizes = np.bincount(row, minlength=len(offsets) - 1)
                hit, term = search.queries.find(low, start, end, h)
                edges = np.searchsorted(row[hit], np.arange(len(offsets)))
                for place in np.flatnonzero(np.diff(edges)).tolist():
                    score = search.scores(term[edges[place] : edges[place + 1]], int(sizes[place]))
                    number = ids[first + place]
                    for q in np.flatnonzero(score >= least).tolist():
                        top[q].append((-int(score[q]), number is None, number or 0))
                        if len(top[q]) >= 4 * k:
                            top[q] = heapq.nsmallest(k, top[q])
                            least[q] = max(least[q], -top[q][-1][0])
        rows = [(numbers[q], None if x[1] else x[2], -x[0]) for q in range(len(numbers)) for x in heapq.nsmallest(k, top[q])]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    found = texts.mapInArrow(best, "query long, doc_id long, score long")
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(index: DataFrame, docs: DataFrame, search: Search, k: int) -> DataFrame:
    """(query, rank, doc_id, score) of one block of queries."""
    seeds = _scored(docs, _highest(index, search, 2 * k), search, k)
    floors = np.ones(len(search.queries.numbers))
    place = {number: p for p, number in enumerate(search.queries.numbers)}
    for r in seeds.where(F.col("rank") == k).collect():  # at most one row for each query of the block
        floors[place[r["query"]]] = max(r.score, 1)
    return _scored(docs, _possible(index, search, floors), search, k).select("query", "rank", "doc_id", "score")


def _query_blocks(items: DataFrame) -> Iterator[list[tuple[int, int | None, str]]]:
    """(number, item_id, text) of the queries, in blocks; the driver holds one block at a time."""
    block, size = [], 0
    for number, r in enumerate(items.where(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator()):
        block.append((number, r.item_id, r.text))
        size += len(r.text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents for each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    index = cut_lineage(build(docs), "signatures")
    lengths = index.select(F.explode("sizes").alias("n")).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    results = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not lengths[0]:
        return results
    for block in _query_blocks(items):
        queries = Queries.parse([(number, text) for number, _, text in block])
        if not queries.numbers:
            continue
        weight = term_weights(frequencies(docs, queries), lengths[0])
        found = search_block(index, docs, Search(queries, weight, *lengths), k)
        named = spark.createDataFrame([(number, item) for number, item, _ in block], "query long, item_id long")
        found = found.join(F.broadcast(named), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")
        results = results.unionByName(cut_lineage(found, "ranked"))
    return results


SEARCH_SQL = r"""
WITH words AS (
  SELECT row, doc_id, unnest(w) AS term, len(w) AS n FROM (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents)),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM words GROUP BY ALL),
corpus AS (SELECT count(DISTINCT row) AS documents, count(*) AS length FROM words),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term, documents),
asked AS (
  SELECT item, item_id, term, count(*) AS q FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT item, item_id, row, doc_id,
         sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * documents) // length)))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term), corpus GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
