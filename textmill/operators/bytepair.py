"""Byte-pair encoding: training, encoding, decoding and quality reports.

Training works on the table of *distinct* chunks with their counts. Equal chunks are merged
alike, so counting each once and weighting by its count gives the same pair frequencies as
counting every occurrence, on a table that grows far slower than the corpus.

In reports on pairs a chunk is a string with one character per token (see ``functions.tokens``):
merging a pair is a ``replace``, which goes left to right without overlap, as the merge is defined.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from textmill.functions import tokens
from textmill.functions.text import GPT4_CHUNKS, chunks, is_blank
from textmill.operators.joins import lookup_join
from textmill.operators.pair_training import PLACE_BITS, Merge, learn
from textmill.operators.ranking import ordered_rank
from textmill.sources.storage import cut_lineage

BYTES = 256

# Longer chunks are merged one by one.
_LONG = 256
# Chunks that are merged together, if they are not of one row, and whose ids are laid out at a time.
_STRETCH = 1_000_000
# Stretches of a task whose distinct chunks are written together by ``encode_by_chunk``.
_TOGETHER = 4
_NO_MERGE = np.iinfo(np.int32).max
# Pairs of symbols for which a table of all of them is kept.
_TABLE = 1 << 22
# A row has fewer chunks than this.
_ROW_SPAN = 10_000_000_000
# A string has fewer characters than 2 to this power, so a row has fewer chunks.
_POS_BITS = 31


@dataclass(frozen=True)
class Tokenizer:
    """A trained merge list. Small (one entry per vocabulary item), so it lives on the driver.

    ``base`` holds the text of each starting symbol; None means the 256 byte values.
    """

    merges: tuple[Merge, ...] = ()
    base: tuple[str, ...] | None = None
    trained: bool = True
    _hex: list[str] = field(default_factory=list, compare=False, repr=False)

    @property
    def base_size(self) -> int:
        return BYTES if self.base is None else len(self.base)

    def __len__(self) -> int:
        return self.base_size + len(self.merges)

    def first(self, merges: int) -> "Tokenizer":
        """The tokenizer that training would have given with fewer merges."""
        return Tokenizer(self.merges[:merges], self.base, self.trained)

    def hex_table(self) -> list[str]:
        """Bytes of each token id, as hex text."""
        if not self._hex:
            if self.base is None:
                self._hex.extend(f"{b:02x}" for b in range(BYTES))
            else:
                self._hex.extend(c.encode("utf-8").hex() for c in self.base)
            for m in self.merges:
                self._hex.append(self._hex[m.left] + self._hex[m.right])
        return self._hex

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(m.rank, m.left, m.right, m.new_id, m.freq) for m in self.merges]
        return spark.createDataFrame(
            rows, "rank int, left int, right int, new_id int, freq long"
        )

    def vocabulary_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray.fromhex(h)) for i, h in enumerate(self.hex_table())]
        return spark.createDataFrame(rows, "id int, bytes binary")

    @classmethod
    def from_merges_table(cls, merges: DataFrame) -> "Tokenizer":
        rows = merges.orderBy("rank").collect()
        return cls(tuple(Merge(r.rank, r.left, r.right, r.new_id, r.freq) for r in rows))

    def require_trained(self) -> None:
        if not self.trained:
            raise RuntimeError("tokenizer must be trained first")

    def info(self, spark: SparkSession) -> DataFrame:
        """One row: sizes and state."""
        row = (len(self), len(self.merges), self.trained, self.base_size, len(self.merges))
        return spark.createDataFrame(
            [row],
            "vocab_size int, num_merges int, trained boolean, "
            "base_vocab_size int, merged_tokens int",
        )


UNTRAINED = Tokenizer(trained=False)


# --- chunks and pairs -------------------------------------------------------------------


def _first_key(df: DataFrame, key: str) -> int | None:
    """The least key, if (key - least, place in the row) fits one long for every row; else None."""
    if df.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return None
    low, high = df.agg(F.min(key), F.max(key)).first()
    return low if low is not None and high - low < 1 << (63 - _POS_BITS) else None


def distinct_chunks(
    df: DataFrame, key: str = "doc_id", text: str = "text", pattern: str = GPT4_CHUNKS, low: int | None = None
) -> DataFrame:
    """(chunk, n, doc, pos): each distinct chunk, its count, and where it first occurs.

    The place is aggregated as one number (row key, then place in the row). A minimum over
    structs cannot live in a hash table and would sort every chunk of the corpus. Places are
    longs if ``low``, the least key, is given (see ``_first_key``), and else decimals, which are slower.
    """
    found = df.select(F.col(key).alias("doc"), F.posexplode(chunks(F.col(text), pattern)).alias("pos", "chunk"))
    if low is not None:
        place = F.shiftleft(F.col("doc").cast("long") - F.lit(low).cast("long"), _POS_BITS) + F.col("pos")
        doc = F.shiftright("first", _POS_BITS) + F.lit(low).cast("long")
        pos = F.col("first").bitwiseAND(F.lit((1 << _POS_BITS) - 1).cast("long"))
    else:
        span = F.lit(_ROW_SPAN).cast("decimal(11,0)")
        place = (F.col("doc").cast("decimal(19,0)") * span + F.col("pos")).cast("decimal(38,0)")
        doc, pos = F.floor(F.col("first") / span), F.pmod("first", span)
    first = found.groupBy("chunk").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    return first.select("chunk", "n", doc.cast("long").alias("doc"), pos.cast("int").alias("pos"))


def symbol_table(chunk_table: DataFrame) -> DataFrame:
    """(symbols, n, first): chunks as byte-symbol strings; single bytes have no pairs.

    ``first`` becomes the chunk's number in order of first occurrence. As a plain number it
    keeps the pair aggregation in a hash table; a minimum over structs would need a sort.
    """
    return ordered_rank(chunk_table, "doc", "first", ["pos"]).select(
        tokens.utf8_symbols(F.col("chunk")).alias("symbols"), "n", "first"
    ).where(F.length("symbols") > 1)


def pair_counts(symbols: DataFrame) -> DataFrame:
    """(pair, freq, first): overlapping neighbour pairs with their weighted frequency.

    ``first`` is the earliest place of the pair in corpus order: the number of the chunk,
    then the place inside it. Identical chunks hold the pair at the same place, so the
    first occurrence of a distinct chunk is enough.
    """
    pairs = symbols.select(
        "n", "first", F.posexplode(tokens.pairs_of(F.col("symbols"))).alias("at", "pair")
    )
    place = F.shiftleft("first", PLACE_BITS) + F.col("at")
    return pairs.groupBy("pair").agg(F.sum("n").alias("freq"), F.min(place).alias("first"))


def best_pairs(counts: DataFrame, limit: int = 1) -> DataFrame:
    """The most frequent pairs; of equals, the one seen first in the corpus."""
    return counts.orderBy(F.desc("freq"), F.asc("first")).limit(limit)


def apply_merge(symbols: Column, left: int, right: int, new_id: int) -> Column:
    pair = tokens.id_to_char(left) + tokens.id_to_char(right)
    return F.replace(symbols, F.lit(pair), F.lit(tokens.id_to_char(new_id)))


def train(
    df: DataFrame,
    vocab_size: int,
    key: str = "doc_id",
    text: str = "text",
    pattern: str = GPT4_CHUNKS,
) -> Tokenizer:
    """Learn a byte-level tokenizer of ``vocab_size`` tokens (fewer when pairs run out)."""
    if vocab_size < BYTES:
        raise ValueError(f"vocab_size must be >= {BYTES}, got {vocab_size}")
    usable = df.where(~is_blank(F.col(text)))
    if usable.limit(1).count() == 0:
        raise ValueError("training text cannot be empty")
    chunk_table = cut_lineage(distinct_chunks(usable, key, text, pattern, _first_key(df, key)), "chunks")
    symbols = symbol_table(chunk_table)
    return Tokenizer(tuple(learn(symbols, vocab_size - BYTES, BYTES)))


def train_characters(
    df: DataFrame, vocabulary: Sequence[str], merge_count: int, key: str = "doc_id", text: str = "text"
) -> Tokenizer:
    """The same training with whole words as chunks and characters as starting symbols."""
    base = tuple(vocabulary)
    stand_ins = "".join(tokens.id_to_char(i + 1) for i in range(len(base)))
    found = cut_lineage(distinct_chunks(df, key, text, r"\S+", _first_key(df, key)), "chunks")
    words = found.select(
        F.translate("chunk", "".join(base), stand_ins).alias("symbols"), "n", "doc", "pos"
    )
    symbols = ordered_rank(words, "doc", "first", ["pos"]).select("symbols", "n", "first")
    symbols = symbols.where(F.length("symbols") > 1)
    # symbols are moved up by one (translate() reads U+0000 as "delete"); move ids back
    learned = learn(symbols, merge_count, len(base) + 1)
    merges = [Merge(m.rank, m.left - 1, m.right - 1, m.new_id - 1, m.freq) for m in learned]
    return Tokenizer(tuple(merges), base)


# --- encoding and decoding --------------------------------------------------------------


def merge_chunk(ids: list[int], ranks: dict[tuple[int, int], int], first_id: int) -> list[int]:
    """Merge one chunk: always the lowest-ranked pair there is, the leftmost of equals.

    A heap holds the places of known pairs, so the cost follows the chunk's length and not
    the number of merges.
    """
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(pairwise(ids)) if pair in ranks]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or ranks.get((ids[i], ids[j])) != rank:
            continue  # one of the two has been merged since
        ids[i], ids[j] = first_id + rank, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < n and (ids[left], ids[right]) in ranks:
                heappush(heap, (ranks[ids[left], ids[right]], left))
    return [i for i in ids if i >= 0]


class _Ranks:
    """Merges in rank order, for looking up many pairs together."""

    def __init__(self, merges: Sequence[Merge]) -> None:
        self.of = {(m.left, m.right): k for k, m in enumerate(merges)}
        self.first_id = merges[0].new_id if merges else 0
        self._ids = 1 + max((m.new_id for m in merges), default=0)
        codes = np.array([m.left * self._ids + m.right for m in merges], np.int64)
        self._rank = np.argsort(codes).astype(np.int32)
        self._codes = codes[self._rank]
        self._table = None
        if self._ids**2 <= _TABLE:
            self._table = np.full(self._ids**2, _NO_MERGE, np.int32)
            self._table[self._codes] = self._rank

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self._codes):
            return np.full(len(left), _NO_MERGE, np.int32)
        codes = left.astype(np.int64) * self._ids + right
        if self._table is not None:
            return self._table[codes]
        near = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
        return np.where(self._codes[near] == codes, self._rank[near], np.int32(_NO_MERGE))


def merge_chunks(ids: np.ndarray, size: np.ndarray, ranks: _Ranks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Many chunks, which lie one after the other, merged as by ``merge_chunk``: (ids, start, size).

    Each round merges the lowest-ranked pair of every chunk wherever it stands in it, as a merge
    makes pairs of higher rank only. Chunks without such a pair are put aside, in any order.
    """
    given = size
    start, size = np.zeros(len(given), np.int64), np.zeros(len(given), np.int64)
    aside: list[np.ndarray] = []
    done = 0

    def put_aside(own: np.ndarray, lengths: np.ndarray, found: np.ndarray) -> None:
        nonlocal done
        start[own], size[own] = done + np.cumsum(lengths) - lengths, lengths
        aside.append(found)
        done += len(found)

    short = given <= _LONG
    ends = np.cumsum(given)
    for k in np.flatnonzero(~short):
        found = merge_chunk(ids[ends[k] - given[k] : ends[k]].tolist(), ranks.of, ranks.first_id)
        put_aside(np.array([k]), np.array([len(found)]), np.array(found, np.int32))
    ids = ids[np.repeat(short, given)]
    own = np.flatnonzero(short & (given > 0))
    lengths = given[own]
    rank = np.full(len(ids), _NO_MERGE, np.int32)
    rank[:-1] = ranks.look_up(ids[:-1], ids[1:])
    rank[np.cumsum(lengths) - 1] = _NO_MERGE
    while len(ids):
        least = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        open_ = least != _NO_MERGE
        if not open_.all():
            stay = np.repeat(open_, lengths)
            put_aside(own[~open_], lengths[~open_], ids[~stay])
            ids, rank = ids[stay], rank[stay]
            own, lengths, least = own[open_], lengths[open_], least[open_]
            if not len(ids):
                break
        chunk = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        hit = np.flatnonzero(rank == least[chunk])
        # in a run of equal symbols every other pair is merged
        new = np.concatenate([[True], np.diff(hit) != 1])
        run = np.flatnonzero(new)
        hit = hit[(np.arange(len(hit)) - run[np.cumsum(new) - 1]) % 2 == 0]
        ids[hit] = ranks.first_id + rank[hit]
        kept = np.ones(len(ids), bool)
        kept[hit + 1] = False
        ids, rank = ids[kept], rank[kept]
        lengths = lengths - np.bincount(chunk[hit], minlength=len(lengths))
        # the pairs on both sides of a merged one are looked up again
        last = np.zeros(len(ids), bool)
        last[np.cumsum(lengths) - 1] = True
        at = hit - np.arange(len(hit))
        at = np.concatenate([at, at[at > 0] - 1])
        rank[at] = _NO_MERGE
        at = at[~last[at]]
        rank[at] = ranks.look_up(ids[at], ids[at + 1])
    return np.concatenate([np.zeros(0, np.int32), *aside]), start, size


def _laid_out(book: np.ndarray, start: np.ndarray, size: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """The ids of chunks in a given order."""
    out = np.empty(int(size[chunk].sum()), np.int32)
    done = 0
    for k in range(0, len(chunk), _STRETCH):
        some = chunk[k : k + _STRETCH]
        ends = np.cumsum(size[some])
        at = np.repeat(start[some] - ends + size[some], size[some]) + np.arange(ends[-1])
        out[done : done + len(at)] = book[at]
        done += len(at)
    return out


def _stretches(rows: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring rows that begin within the same ``_STRETCH`` chunks, so that working memory
    does not follow the size of an Arrow batch."""
    size = rows.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(size) - size) // _STRETCH)) + 1
    for low, high in pairwise([0, *cuts.tolist(), len(rows)]):
        yield rows.slice(low, high - low)


def _distinct(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, size, chunk, stops) of lists of chunks: the bytes and sizes of the distinct ones, which
    of them each chunk is, and where each row's chunks end, after a 0."""
    found = rows.flatten().dictionary_encode()
    texts = found.dictionary.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    place = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[place[0] : place[-1]] if place[-1] else np.zeros(0, np.uint8)
    stops = np.concatenate([[0], np.cumsum(rows.value_lengths().fill_null(0).to_numpy().astype(np.int64))])
    return raw.astype(np.int32), np.diff(place), found.indices.to_numpy(), stops


def _chunk_ids(tokenizer: Tokenizer) -> Callable[..., Column]:
    """ARRAY<STRING> of chunks -> ARRAY<INT> of the ids of all of them.

    The distinct chunks of a stretch of rows are merged together; nothing is kept for the next one.
    """
    ranks = _Ranks(tokenizer.merges)

    def some(rows: pa.Array) -> pa.Array:
        raw, size, chunk, stops = _distinct(rows)
        book, start, size = merge_chunks(raw, size, ranks)
        ends = np.concatenate([[0], np.cumsum(size[chunk])])
        ids = _laid_out(book, start, size, chunk)
        return pa.ListArray.from_arrays(pa.array(ends[stops].astype(np.int32)), pa.array(ids), mask=rows.is_null())

    @F.arrow_udf("array<int>")
    def encoded(rows: pa.Array) -> pa.Array:
        return pa.concat_arrays([some(x) for x in _stretches(rows)])

    return encoded


def _token_counts(tokenizer: Tokenizer, merges: Sequence[int]) -> Callable[..., Column]:
    """ARRAY<STRING> of chunks -> ARRAY<LONG>: their tokens with each of several growing numbers of merges."""
    steps = [_Ranks(tokenizer.merges[low:high]) for low, high in pairwise([0, *merges])]

    def some(rows: pa.Array) -> pa.Array:
        ids, size, chunk, stops = _distinct(rows)
        totals = []
        for ranks in steps:
            book, start, size = merge_chunks(ids, size, ranks)
            ids = _laid_out(book, start, size, np.arange(len(size)))
            ends = np.concatenate([[0], np.cumsum(size[chunk])])[stops]
            totals.append(np.diff(ends))
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(steps))
        return pa.ListArray.from_arrays(offsets, pa.array(np.stack(totals, 1).ravel()), mask=rows.is_null())

    @F.arrow_udf("array<long>")
    def counted(rows: pa.Array) -> pa.Array:
        return pa.concat_arrays([some(x) for x in _stretches(rows)])

    return counted


def encode_text(text: Column, tokenizer: Tokenizer, pattern: str = GPT4_CHUNKS) -> Column:
    """Token ids as ARRAY<INT>, in one projection: no shuffle, whatever the corpus size."""
    tokenizer.require_trained()
    return _chunk_ids(tokenizer)(chunks(text, pattern))


def encode(
    df: DataFrame,
    tokenizer: Tokenizer,
    text: str = "text",
    out: str = "ids",
) -> DataFrame:
    """Add token ids to each row."""
    return df.withColumn(out, encode_text(F.col(text), tokenizer))


def encode_by_chunk(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str = "doc_id",
    text: str = "text",
    out: str = "ids",
    keep_text: bool = True,
) -> DataFrame:
    """Encode each distinct chunk of the corpus once and put the results back in order.

    ``encode`` needs no shuffle; this moves the distinct chunks of each stretch of rows, and for
    every chunk its number among them. Other columns travel along, so a caller that does not
    need the text any more says so. Rows that share a key get the chunks of all of them, by place,
    and these rows move every chunk.
    """
    tokenizer.require_trained()
    order = [c for c in df.columns if c != text or keep_text]
    kept = [c for c in order if c != out]
    rows = df.select(*kept, chunks(F.col(text)).alias("__chunks"))
    several = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    several = cut_lineage(several.select(key), "keys")
    empty = F.array().cast("array<int>")
    if several.isEmpty():
        encoded = _encoded_by_stretch(rows, tokenizer)
    else:
        encoded = _encoded_by_stretch(rows.join(several, key, "left_anti").select(rows.columns), tokenizer)
        shared = rows.join(several, key, "left_semi")
        placed = _encoded_by_place(shared, tokenizer, key)
        shared = shared.withColumn("__there", F.col("__chunks").isNotNull()).drop("__chunks").join(placed, key, "left")
        encoded = encoded.unionByName(shared.select(*kept, F.when(F.col("__there"), F.coalesce("__ids", empty)).alias("__ids")))
    # a row without a key has no chunks of its own
    ids = F.when(F.col(key).isNull() & F.col("__ids").isNotNull(), empty).otherwise(F.col("__ids"))
    return encoded.withColumn(out, ids).select(*order, *([] if out in order else [out]))


def _encoded_by_place(rows: DataFrame, tokenizer: Tokenizer, key: str) -> DataFrame:
    """(key, __ids) of rows with ``__chunks``: the chunks of all rows of a key, by place."""
    placed = rows.select(key, F.posexplode("__chunks").alias("pos", "chunk"))
    counted = cut_lineage(placed.groupBy("chunk").agg(F.count("*").alias("n")), "chunks")
    book = counted.select("chunk", _chunk_ids(tokenizer)(F.array("chunk")).alias("chunk_ids"))
    pieces = lookup_join(placed, book, ["chunk"], [key, "pos"], counts=counted)
    joined = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "chunk_ids"))).alias("pieces"))
    return joined.select(key, F.flatten(F.col("pieces.chunk_ids")).alias("__ids"))


def _packed(codes: np.ndarray, values: int) -> bytes:
    """Numbers below ``values``, all first bytes of them first."""
    width = ((values - 1).bit_length() + 7) // 8
    return pa.compress(codes.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes, count: int, values: int) -> np.ndarray:
    width = ((values - 1).bit_length() + 7) // 8
    planes = np.zeros((count, 4), np.uint8)
    planes[:, :width] = np.frombuffer(pa.decompress(raw, count * width, "zstd"), np.uint8).reshape(width, count).T
    return planes.view(np.uint32).ravel()


def _encoded_by_stretch(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Rows with ``__ids`` in place of ``__chunks``, the last column, row by row."""
    names = rows.columns[:-1]
    kept = rows.select(*names).schema

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # written once, so the numbers need only be different
        first, done = TaskContext.get().partitionId() << 32, 0

        def stretch(held: list[tuple[pa.Array, pa.Array]]) -> pa.RecordBatch:
            own, some = (pa.concat_arrays(x) for x in zip(*held, strict=True))
            found = some.flatten().dictionary_encode()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (own, some.value_lengths(), found.dictionary)]
            codes = pa.array([_packed(found.indices.to_numpy(), len(found.dictionary))], pa.binary())
            columns = [pa.array([first + done], pa.int64()), *lists, codes]
            return pa.RecordBatch.from_arrays(columns, ["stretch", "rows", "sizes", "book", "codes"])

        held, size = [], 0
        for batch in batches:
            own, at = pa.StructArray.from_arrays(batch.columns[:-1], names), 0
            for some in _stretches(batch.columns[-1]):
                held.append((own.slice(at, len(some)), some))
                at, size = at + len(some), size + len(some.flatten())
                if size > _TOGETHER * _STRETCH:
                    yield stretch(held)
                    held, size, done = [], 0, done + 1
        if held:
            yield stretch(held)

    stretches = f"stretch long, rows array<{kept.simpleString()}>, sizes array<int>, book array<string>, codes binary"
    stretches = cut_lineage(rows.mapInArrow(numbered, stretches), "stretches")
    found = stretches.select("stretch", F.posexplode("book").alias("code", "chunk"))
    counted = cut_lineage(found.groupBy("chunk").agg(F.count("*").alias("n")), "chunks")
    book = counted.select("chunk", _chunk_ids(tokenizer)(F.array("chunk")).alias("chunk_ids"))
    pieces = lookup_join(found, book, ["chunk"], ["stretch", "code"], counts=counted)
    books = pieces.groupBy("stretch").agg(F.array_sort(F.collect_list(F.struct("code", "chunk_ids"))).alias("book"))
    books = books.select("stretch", F.col("book.chunk_ids").alias("book"))

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, sizes, codes, ids in zip(*batch.columns, strict=True):
                ids = ids.values if ids.is_valid else pa.array([], pa.list_(pa.int32()))
                size = ids.value_lengths().to_numpy().astype(np.int64)
                stops = np.concatenate([[0], np.cumsum(sizes.values.fill_null(0).to_numpy().astype(np.int64))])
                chunk = _unpacked(codes.as_py(), stops[-1], len(ids)) if stops[-1] else np.zeros(0, np.uint32)
                ends = np.concatenate([[0], np.cumsum(size[chunk])])
                laid = _laid_out(ids.flatten().to_numpy(), np.cumsum(size) - size, size, chunk)
                lists = pa.ListArray.from_arrays(
                    pa.array(ends[stops].astype(np.int32)), pa.array(laid), mask=sizes.values.is_null()
                )
                yield pa.RecordBatch.from_arrays([*own.values.flatten(), lists], [*names, "__ids"])

    both = stretches.select("stretch", "rows", "sizes", "codes").join(books, "stretch", "left")
    out = StructType([*kept, StructField("__ids", ArrayType(IntegerType()))])
    return both.select("rows", "sizes", "codes", "book").mapInArrow(laid_out, out)


def encode_distinct(
    df: DataFrame,
    tokenizer: Tokenizer,
    key: str = "doc_id",
    text: str = "text",
    out: str = "ids",
) -> DataFrame:
    """Encode each distinct text once and give every copy the result.

    Copies are matched by digest. Copies of one text may make up much of the table; their
    digest is then a hot key, which the join spreads by the row's own key.
    """
    named = df.withColumn("__digest", F.sha2(F.col(text), 256))
    distinct = named.where(F.col(text).isNotNull()).select("__digest", text).distinct()
    encoded = distinct.select("__digest", encode_text(F.col(text), tokenizer).alias(out))
    return lookup_join(named, encoded, ["__digest"], [key], "left").drop("__digest")


def encode_safe(text: Column, tokenizer: Tokenizer, default: Column | None = None) -> Column:
    """Ids; an empty array for a blank text; the default when there is no tokenizer or text."""
    empty = F.array().cast("array<int>")
    fallback = empty if default is None else default
    if not tokenizer.trained:
        return fallback
    ids = F.coalesce(encode_text(text, tokenizer), fallback)
    return F.when(text.isNotNull() & is_blank(text), empty).otherwise(ids)


def decode(ids: Column, tokenizer: Tokenizer) -> Column:
    """Text of an id array; unknown ids are skipped and malformed UTF-8 becomes U+FFFD."""
    tokenizer.require_trained()
    return tokens.ids_to_text(ids, tokenizer.hex_table())


# --- reports ----------------------------------------------------------------------------


def compression(df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
    """One row: characters, tokens, percent saved and characters per token."""
    totals = df.agg(
        F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("total_characters"),
        F.coalesce(F.sum(F.size(ids)), F.lit(0)).cast("long").alias("total_tokens"),
    )
    return with_compression(totals, "total_characters", "total_tokens")


def with_compression(df: DataFrame, chars: str, tokens_: str) -> DataFrame:
    c, t = F.col(chars), F.col(tokens_)
    return df.withColumn(
        "compression_ratio", F.when(c > 0, (1 - t / c) * 100).otherwise(F.lit(0.0))
    ).withColumn("avg_chars_per_token", F.when(t > 0, c / t).otherwise(F.lit(0.0)))


def compare_sizes(
    df: DataFrame, tokenizer: Tokenizer, vocab_sizes: Sequence[int], text: str = "text"
) -> DataFrame:
    """One row per target size: actual size, merges, tokens and compression.

    A tokenizer is trained once, to the largest size: its first merges are the smaller
    tokenizers. All sizes are counted in one pass over the texts.
    """
    sizes = sorted(vocab_sizes)
    merges = [min(size - tokenizer.base_size, len(tokenizer.merges)) for size in sizes]
    steps = list(zip(sizes, merges, range(len(sizes)), strict=True))
    counted = df.select(
        F.length(text).alias("chars"), _token_counts(tokenizer, merges)(chunks(F.col(text))).alias("t")
    )
    totals = counted.agg(
        F.sum("chars").alias("chars"), *[F.sum(F.get("t", F.lit(i))).alias(f"t{i}") for _, _, i in steps]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(size).alias("target_vocab"),
                F.lit(tokenizer.base_size + upto).alias("actual_vocab"),
                F.lit(upto).alias("merges"),
                F.col(f"t{i}").alias("tokens"),
            )
            for size, upto, i in steps
        ]
    )
    exploded = totals.select("chars", F.inline(rows))
    share = F.when(F.col("chars") > 0, (1 - F.col("tokens") / F.col("chars")) * 100)
    return exploded.withColumn("compression", F.coalesce(share, F.lit(0.0)))


def roundtrip(df: DataFrame, tokenizer: Tokenizer, text: str = "text", ids: str = "ids") -> DataFrame:
    """Rows with the decoded text and whether it equals the original."""
    decoded = df.withColumn("decoded", decode(F.col(ids), tokenizer))
    return decoded.withColumn("ok", F.col("decoded").eqNullSafe(F.col(text)))


def roundtrip_report(checked: DataFrame) -> DataFrame:
    """One row: texts, successes, failures and success rate (0 when there are no texts)."""
    totals = checked.agg(
        F.count("*").alias("total"),
        F.count_if("ok").alias("successes"),
        F.count_if(~F.col("ok")).alias("failures"),
    )
    rate = F.when(F.col("total") > 0, F.col("successes") / F.col("total")).otherwise(F.lit(0.0))
    return totals.withColumn("success_rate", rate)


def roundtrip_failures(checked: DataFrame, text: str = "text") -> DataFrame:
    """The failing rows with both lengths."""
    return checked.where(~F.col("ok")).withColumn(
        "original_len", F.length(text)
    ).withColumn("decoded_len", F.length("decoded"))


def token_footprint(
    df: DataFrame, batch: Column, batch_size: int, ids: str = "ids", width: int = 8
) -> DataFrame:
    """One row: tokens, bytes as one tensor, and bytes of the largest padded batch."""
    per_batch = df.groupBy(batch.alias("batch_id")).agg(
        F.sum(F.size(ids)).alias("tokens"), F.max(F.size(ids)).alias("longest")
    )
    return per_batch.agg(
        F.sum("tokens").cast("long").alias("num_tokens"),
        (F.sum("tokens") * width).cast("long").alias("token_tensor_bytes"),
        (F.max("longest").cast("long") * batch_size * width).alias("batch_bytes"),
    )
