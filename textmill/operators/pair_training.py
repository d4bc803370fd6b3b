"""Learning byte-pair merges from a table of distinct chunks, with running pair counts.

The chunks are written once in blocks: all symbols of some hundred thousand chunks in one array,
with a mark after each chunk. The counts of all pairs are taken once. From then on each job looks
for the chunks that can hold one of the newest pairs, merges and counts again in those alone, and
sends the differences, which the driver adds to its counts. A job may take
several merges, as many as are certain to come next in this order (``independent_prefix``).

The driver keeps the ``KEPT`` most frequent pairs and the frequency that no other pair exceeds.
Pairs of old symbols only become rarer, and pairs with a new symbol are sent whole, so the kept
counts are exact; when none of them is sure to be ahead of the others, all pairs are counted
anew.

Equal frequencies are decided by the place where a pair first occurs: the number of the chunk,
then the place in its characters, which no merge changes. A place holds as long as the pair's
count does. Places of pairs that have become rarer are asked for where they matter.

Merges pile up on the written blocks, which are replaced when the pile is high.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.sources.storage import cut_lineage, remove

# Pairs that are looked through for the next merges.
CANDIDATES = 256
# Merges that may pile up on the blocks before they are written again.
PENDING = 48
# Pairs that the driver keeps counts of.
KEPT = 200_000
# Symbols in a block.
BLOCK = 1_000_000
# A chunk has fewer than 2^27 symbols and there are fewer than 2^36 distinct chunks.
PLACE_BITS = 27
_END = -1
_BLOCKS = "symbols binary, n binary, first binary"
_SHIFT = np.int64(32)

Pair = tuple[int, int]


@dataclass(frozen=True)
class Merge:
    rank: int
    left: int
    right: int
    new_id: int
    freq: int


@dataclass(frozen=True)
class Candidate:
    pair: Pair
    freq: int


# --- which merges are certain ---------------------------------------------------------------


def independent_prefix(candidates: list, room: int) -> list:
    """The longest head of a ranked pair list that can be merged in one go.

    Taking pairs one at a time would choose exactly these, in this order, when
    * no two of them share a symbol, so merging one leaves the count of the others alone;
    * no pair that a merge creates can overtake a later one. Merging (a, b) creates pairs
      (x, ab) and (ab, y), which occur at most as often as (x, a) and (b, y) do now; so it
      is enough that every pair (x, a) and (b, y) is rarer than the later pair.
    The list is ordered by frequency and has all pairs as frequent as its last one.
    """
    chosen: list = []
    for row in candidates:
        if len(chosen) == room:
            break
        left, right = row.pair
        if not chosen:
            chosen.append(row)
            if left == right:
                break
            continue
        if left == right:
            break
        used = {s for c in chosen for s in c.pair}
        if left in used or right in used:
            break
        heads = {c.pair[0] for c in chosen}
        tails = {c.pair[1] for c in chosen}
        rivals = (
            other
            for other in candidates
            if other.freq >= row.freq and other.pair not in {c.pair for c in chosen}
        )
        if any(o.pair[1] in heads or o.pair[0] in tails for o in rivals):
            break
        chosen.append(row)
    return chosen


# --- blocks -----------------------------------------------------------------------------


def _points(texts: list[str]) -> np.ndarray:
    """The ids of symbol strings, with a mark after each."""
    mark = tokens.id_to_char(tokens.MAX_TOKEN_ID)
    ids = np.frombuffer((mark.join(texts) + mark).encode("utf-32-le"), np.uint32).astype(np.int64)
    out = np.where(ids < 0xD800, ids, ids - 0x800)
    out[out == tokens.MAX_TOKEN_ID] = _END
    return out.astype(np.int32)


def _packed(symbols: np.ndarray, n: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([x.tobytes()], pa.binary()) for x in (symbols, n, first)]
    return pa.RecordBatch.from_arrays(columns, ["symbols", "n", "first"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    # an Arrow batch may hold many blocks; one is copied at a time
    for batch in batches:
        for s, n, first in zip(*batch.columns, strict=True):
            yield np.frombuffer(s.as_buffer(), np.int32), *(np.frombuffer(x.as_buffer(), np.int64) for x in (n, first))


def blocks(symbols: DataFrame) -> DataFrame:
    """Blocks of a (symbols, n, first) table, over all cores."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = _points(batch.column(0).to_pylist())
            held.append((ids, *(batch.column(k).to_numpy().astype(np.int64) for k in (1, 2))))
            size += len(ids)
            if size >= BLOCK:
                yield _packed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield _packed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    parts = symbols.sparkSession.sparkContext.defaultParallelism
    spread = symbols.select("symbols", F.col("n").cast("long"), F.col("first").cast("long")).repartition(parts, "symbols")
    return cut_lineage(spread.mapInArrow(gather, _BLOCKS), "blocks")


def merged(symbols: np.ndarray, merges: list[Merge]) -> np.ndarray:
    """The symbols after merges in rank order, each from left to right."""
    for m in merges:
        symbols, _ = _merged_once(symbols, m)
    return symbols


def _hits(symbols: np.ndarray, left: int, right: int) -> np.ndarray:
    hit = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right))
    if left == right and len(hit) > 1:
        # in a run of equal symbols every other pair is merged
        new = np.concatenate([[True], np.diff(hit) != 1])
        run = np.flatnonzero(new)
        hit = hit[(np.arange(len(hit)) - run[np.cumsum(new) - 1]) % 2 == 0]
    return hit


def _merged_once(symbols: np.ndarray, m: Merge) -> tuple[np.ndarray, np.ndarray]:
    hit = _hits(symbols, m.left, m.right)
    if not len(hit):
        return symbols, hit
    kept = np.ones(len(symbols), bool)
    kept[hit + 1] = False
    out = symbols.copy()
    out[hit] = m.new_id
    return out[kept], hit


def _codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair as one number, place of its first symbol) of all neighbours in a chunk."""
    at = np.flatnonzero((symbols[:-1] != _END) & (symbols[1:] != _END))
    return (symbols[at].astype(np.int64) << _SHIFT) | symbols[at + 1], at


def _places(symbols: np.ndarray, at: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunk, place in corpus order) of symbols; ``sizes`` has the characters of each symbol."""
    end = symbols == _END
    before = np.cumsum(np.where(end, 0, sizes[symbols])) - np.where(end, 0, sizes[symbols])
    chunk = np.cumsum(end) - end
    start = np.concatenate([[0], np.flatnonzero(end)[:-1] + 1])
    own = chunk[at]
    return own, (first[own] << np.int64(PLACE_BITS)) | (before[at] - before[start[own]])


def _summed(codes: np.ndarray, n: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum and the least place of each pair."""
    if not len(codes):
        return codes, n, place
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[edge], np.add.reduceat(n[order], edge), np.minimum.reduceat(place[order], edge)


def _counted(
    symbols: np.ndarray, n: np.ndarray, first: np.ndarray, sizes: np.ndarray, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, count, first place) of a block, or of some of its chunks."""
    if inside is not None:
        end = symbols == _END
        own = inside[np.cumsum(end) - end]
        symbols, n, first = symbols[own], n[inside], first[inside]
    codes, at = _codes(symbols)
    if not len(at):
        return codes, codes, codes
    chunk, place = _places(symbols, at, first, sizes)
    return _summed(codes, n[chunk], place)


_COUNTS = "pair long, n long, first long"


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pair", "n", "first"])


def _together(counts: DataFrame) -> DataFrame:
    return counts.groupBy("pair").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def _sizes(merges: list[Merge], first_id: int) -> np.ndarray:
    """How many characters each symbol stands for."""
    out = np.ones(first_id + len(merges), np.int64)
    for m in merges:
        out[m.new_id] = out[m.left] + out[m.right]
    return out


def _all_counts(table: DataFrame, pending: list[Merge], sizes: np.ndarray) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, n, first in _unpacked(batches):
            yield _batch(*_counted(merged(symbols, pending), n, first, sizes))

    return _together(table.mapInArrow(count, _COUNTS))


def _written(pairs: list[Pair], pending: list[Merge]) -> list[np.ndarray]:
    """The symbols of pairs as they stand in the blocks, where the pending merges are not yet done."""
    parts: dict[int, list[int]] = {}
    for m in pending:
        parts[m.new_id] = parts.get(m.left, [m.left]) + parts.get(m.right, [m.right])
    return [np.array(parts.get(a, [a]) + parts.get(b, [b]), np.int32) for a, b in pairs]


def _with(symbols: np.ndarray, n: np.ndarray, first: np.ndarray, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chunks of a block that hold one of some sequences of symbols.

    A pair stands only where the symbols it is made of do, so merges are carried out in these alone.
    """
    found = []
    for pattern in patterns:
        hit = np.flatnonzero((symbols[:-1] == pattern[0]) & (symbols[1:] == pattern[1]))
        for k in range(2, len(pattern)):
            hit = hit[hit < len(symbols) - k]
            hit = hit[symbols[hit + k] == pattern[k]]
        found.append(hit)
    ends = np.flatnonzero(symbols == _END)
    inside = np.zeros(len(ends), bool)
    inside[np.searchsorted(ends, np.concatenate(found))] = True
    own = np.flatnonzero(inside)
    if len(own) == len(ends):
        return symbols, n, first
    starts = np.concatenate([[0], ends[:-1] + 1])[own]
    lengths = ends[own] + 1 - starts
    stops = np.cumsum(lengths)
    at = np.repeat(starts - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)
    return symbols[at], n[own], first[own]


def _differences(table: DataFrame, pending: list[Merge], fresh: list[Merge], sizes: np.ndarray) -> DataFrame:
    """(pair, n, first): what the fresh merges change in the counts, and the places of pairs with
    a new symbol. Chunks without one of the pairs are neither merged nor counted."""
    patterns = _written([(m.left, m.right) for m in fresh], pending)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, n, first in _unpacked(batches):
            symbols, n, first = _with(symbols, n, first, patterns)
            if not len(n):
                continue
            before = after = merged(symbols, pending)
            touched = np.zeros(len(n), bool)
            for m in fresh:
                ends = np.flatnonzero(after == _END)
                after, hit = _merged_once(after, m)
                touched[np.searchsorted(ends, hit)] = True
            if not touched.any():
                continue
            old, new = (_counted(x, n, first, sizes, touched) for x in (before, after))
            codes, change, place = _summed(
                np.concatenate([old[0], new[0]]), np.concatenate([-old[1], new[1]]), np.concatenate([old[2], new[2]])
            )
            yield _batch(codes[change != 0], change[change != 0], place[change != 0])

    return _together(table.mapInArrow(differ, _COUNTS))


def _first_places(table: DataFrame, pending: list[Merge], sizes: np.ndarray, pairs: list[int]) -> dict[int, int]:
    """Where each of the pairs first occurs."""
    wanted = np.array(sorted(pairs), np.int64)
    patterns = _written([_pair(p) for p in pairs], pending)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, n, first in _unpacked(batches):
            if len(patterns) <= PENDING:
                symbols, _, first = _with(symbols, n, first, patterns)
            if not len(symbols):
                continue
            symbols = merged(symbols, pending)
            codes, at = _codes(symbols)
            near = np.searchsorted(wanted, codes)
            near[near == len(wanted)] = 0
            own = wanted[near] == codes
            if own.any():
                place = _places(symbols, at[own], first, sizes)[1]
                yield _batch(*_summed(codes[own], np.ones(len(place), np.int64), place))

    return {r.pair: r.first for r in _together(table.mapInArrow(look, _COUNTS)).collect()}


# --- learning ---------------------------------------------------------------------------


def _pair(code: int) -> Pair:
    return code >> 32, code & 0xFFFFFFFF


class _Counts:
    """The counts of the most frequent pairs. Pairs that are not kept have at most ``floor``, and
    those that have it come after the pairs in ``level`` in corpus order."""

    def __init__(self, counted: DataFrame):
        rows = counted.orderBy(F.desc("n"), "first").limit(KEPT + 1).collect()
        self.floor = rows[-1].n if len(rows) > KEPT else 0
        self.n = {r.pair: r.n for r in rows[:KEPT]}
        self.level = {r.pair for r in rows[:KEPT] if r.n == self.floor}
        self.place = {r.pair: r.first for r in rows[:KEPT]}

    def add(self, differences: DataFrame, oldest_new: int) -> None:
        for r in differences.collect():
            new = max(_pair(r.pair)) >= oldest_new
            # a pair of old symbols that is not kept has become rarer still
            if not new and r.pair not in self.n:
                continue
            self.level.discard(r.pair)
            self.place.pop(r.pair, None)
            n = self.n.pop(r.pair, 0) + r.n
            if n > self.floor:
                self.n[r.pair] = n
                if new:
                    self.place[r.pair] = r.first
            elif n == self.floor and self.level:
                # its place among those of the same count is not known
                self.n = {p: k for p, k in self.n.items() if p not in self.level}
                self.level = set()
        if len(self.n) > 2 * KEPT:
            self.floor = sorted(self.n.values(), reverse=True)[KEPT]
            self.n = {p: n for p, n in self.n.items() if n > self.floor}
            self.level = set()

    def best(self) -> list[tuple[int, int]]:
        """(pair, n) of the most frequent ones, with all that are as frequent as the last."""
        if not self.n:
            return []
        values = np.fromiter(self.n.values(), np.int64, len(self.n))
        least = int(np.partition(values, -CANDIDATES)[-CANDIDATES]) if len(values) > CANDIDATES else 1
        return sorted(((p, n) for p, n in self.n.items() if n >= least), key=lambda x: -x[1])

    def certain(self, room: int, ask) -> list[Candidate]:
        """The next merges. ``ask`` gives the places of pairs; only those of the most frequent
        ones are asked for, and a later group of equals without places ends the list."""
        best = self.best()
        top = [p for p, n in best if n == best[0][1]]
        unknown = [p for p in top if p not in self.place]
        if len(top) > 1 and unknown:
            self.place |= ask(unknown)
        best.sort(key=lambda x: (-x[1], self.place.get(x[0], 0)))
        chosen = independent_prefix([Candidate(_pair(p), n) for p, n in best], room)
        equals = Counter(n for _, n in best)
        unsure = {n for p, n in best if equals[n] > 1 and p not in self.place and n != best[0][1]}
        for k, row in enumerate(chosen):
            if row.freq in unsure or (k and row.freq == self.floor):
                return chosen[:k]
        return chosen


def learn(symbols: DataFrame, merge_count: int, first_id: int) -> list[Merge]:
    """The first ``merge_count`` merges over a (symbols, n, first) table; fewer if pairs run out."""
    table = blocks(symbols)
    merges: list[Merge] = []
    pending: list[Merge] = []
    sizes = _sizes(merges, first_id)
    counts = _Counts(_all_counts(table, pending, sizes))
    while len(merges) < merge_count:
        if not counts.n:
            if not counts.floor:
                break
            counts = _Counts(_all_counts(table, pending, sizes))
            continue
        found = counts.certain(merge_count - len(merges), lambda pairs: _first_places(table, pending, sizes, pairs))
        fresh = [Merge(len(merges) + k, *c.pair, first_id + len(merges) + k, c.freq) for k, c in enumerate(found)]
        merges += fresh
        sizes = _sizes(merges, first_id)
        if len(merges) < merge_count:
            counts.add(_differences(table, pending, fresh, sizes), fresh[0].new_id)
        pending = pending + fresh
        if len(pending) > PENDING:
            table, pending = _rewritten(table, pending), []
    remove(table)
    return merges


def _rewritten(table: DataFrame, pending: list[Merge]) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, n, first in _unpacked(batches):
            yield _packed(merged(symbols, pending), n, first)

    new = cut_lineage(table.mapInArrow(apply, _BLOCKS), "blocks")
    remove(table)
    return new
