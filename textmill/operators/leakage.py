"""Overlap between two splits.

Shared runs of tokens are found without sending each run. Of the shorter runs inside a run, the one
with the least hash (its minimizer) is the same wherever the run occurs. Neighbouring runs mostly
have the same one, so they travel together as one stretch of tokens, to the bucket of that hash;
there the stretches are cut into runs again, and the runs of both sides are compared by 64-bit hashes.
"""

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

# Buckets of minimizers. A bucket is compared at a time, so it bounds what a task holds.
_BUCKETS = 1 << 11
# Tokens that a task gathers before it sends their stretches.
_GATHERED = 1 << 20
# Runs in a stretch: one token said over and over would be one stretch without end.
_STRETCH = 64
# Runs of one bucket that are taken in before equal ones are put together.
_PENDING = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shared_values(train: DataFrame, validation: DataFrame, column: str) -> DataFrame:
    """One row: whether the two sides share values, how many distinct ones, and a message."""
    shared = train.select(column).intersect(validation.select(column))
    found = shared.agg(F.count("*").alias("duplicates_found"))
    n = F.col("duplicates_found")
    return found.select(
        (n > 0).alias("has_leakage"),
        n,
        F.when(n > 0, F.format_string("Found %d duplicate values between splits", n)).alias("warning"),
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = x.astype(np.uint64) + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _over(x: np.ndarray, length: int, join: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> np.ndarray:
    """``join`` over each ``length`` neighbours, in a number of steps that is a logarithm of it.

    ``join`` gets what it made of the neighbours before and of ``n`` ones after them.
    """
    out, done, power, n = None, 0, x, 1
    while True:
        if length & n:
            out = power if out is None else join(out[: len(out) - n], power[done : done + len(out) - n], n)
            done += n
        if 2 * n > length:
            return out
        power = join(power[:-n], power[n:], n)
        n *= 2


def _hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` tokens that begin at each place."""
    if len(tokens) < length:
        return np.empty(0, np.uint64)

    def join(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        return a * np.uint64(pow(int(_ODD), n, 1 << 64)) + b

    return _mixed(_over(_mixed(tokens), length, join))


def _stretches(tokens: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, runs, bucket) of the stretches of all rows; ``ends`` is where each row ends."""
    inner = (length + 1) // 2
    starts = len(tokens) - length + 1
    if starts < 1:
        return (np.empty(0, np.int64),) * 3
    least = _over(_hashes(tokens, inner), length - inner + 1, lambda a, b, n: np.minimum(a, b))
    # the last places of a row begin no whole run
    whole = np.ones(len(tokens), bool)
    # (a shorter row also takes places of the rows before it, which do not begin one either)
    for k in range(1, length):
        whole[ends[ends >= k] - k] = False
    place = np.flatnonzero(whole[:starts])
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    if not len(place):
        return (np.empty(0, np.int64),) * 3
    new = np.ones(len(place), bool)
    new[1:] = (least[place[1:]] != least[place[:-1]]) | (np.diff(row[place]) != 0)
    head = np.flatnonzero(new)
    since = np.arange(len(place)) - head[np.cumsum(new) - 1]
    head = np.flatnonzero(since % _STRETCH == 0)
    runs = np.diff(np.concatenate([head, [len(place)]]))
    first = place[head]
    return first, runs, (least[first] >> np.uint64(8)).astype(np.int64) % _BUCKETS


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of pieces, one piece after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _narrow(tokens: np.ndarray) -> np.ndarray:
    """The tokens in as few bytes as hold them all."""
    for kind in (np.uint8, np.uint16):
        if not len(tokens) or (tokens.min() >= 0 and tokens.max() <= np.iinfo(kind).max):
            return tokens.astype(kind)
    return tokens.astype(np.int32)


def _sender(length: int, schema: pa.Schema, asked: bool):
    """Rows (bucket, asked, keys, sizes, tokens): the different stretches of some rows by bucket."""

    def send(rows: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys = pa.concat_arrays([k for k, _, _ in rows])
        tokens = np.concatenate([t for _, t, _ in rows])
        ends = np.cumsum(np.concatenate([n for _, _, n in rows]))
        first, runs, bucket = _stretches(tokens, ends, length)
        if not len(first):
            return
        sizes = runs + length - 1
        row = np.searchsorted(ends, first, side="right")
        # equal stretches of the side that is looked up go once, of the other once for each row
        hashes = _hashes(tokens, length)
        ahead, behind = hashes[first], hashes[first + runs - 1]
        order = np.lexsort((row if asked else first, behind, ahead, runs, bucket))
        same = np.ones(len(order) - 1, bool)
        for x in (bucket, runs, ahead, behind, *([row] if asked else [])):
            same &= x[order[1:]] == x[order[:-1]]
        # what begins and ends alike but is longer than one run may differ in between
        inner = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(hashes))])
        within = inner[first + runs] - inner[first]
        same &= within[order[1:]] == within[order[:-1]]
        order = order[np.concatenate([[True], ~same])]
        first, sizes, row, bucket = first[order], sizes[order], row[order], bucket[order]
        text = _narrow(tokens)[_gathered(first, sizes)]
        edge = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0]))
        stops = np.concatenate([edge, [len(bucket)]])
        marks = np.concatenate([[0], np.cumsum(sizes)])[stops]
        own = keys.take(pa.array(row)) if asked else keys.slice(0, 0)
        width = text.itemsize
        raw, counts = text.tobytes(), sizes.astype(np.int32).tobytes()
        columns = [
            pa.array(bucket[edge].astype(np.int32)),
            pa.array(np.full(len(edge), int(asked), np.int32)),
            pa.ListArray.from_arrays(pa.array((stops if asked else stops * 0).astype(np.int32)), own),
            pa.array(np.full(len(edge), width, np.int32)),
            pa.array([counts[4 * a : 4 * b] for a, b in zip(stops[:-1], stops[1:], strict=True)], pa.binary()),
            pa.array([raw[width * a : width * b] for a, b in zip(marks[:-1], marks[1:], strict=True)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema.names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            ids = batch.column(1)
            # a missing token is one of its own
            tokens = ids.flatten().fill_null(-1).to_numpy()
            sizes = ids.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            ends = np.cumsum(sizes)
            # rows go on in lots of about as many tokens, whatever the batch holds
            cuts = np.flatnonzero(np.diff((size + ends) // _GATHERED)) + 1
            for begin, end in pairwise([0, *cuts, len(sizes)]):
                some = slice(begin, end)
                if begin == end:
                    continue
                lot = tokens[ends[begin] - sizes[begin] : ends[end - 1]]
                held.append((batch.column(0)[some], lot, sizes[some]))
                size += len(lot)
                if size >= _GATHERED:
                    yield from send(held)
                    held, size = [], 0
        if held:
            yield from send(held)

    return gather


def _comparer(length: int, names: list[str]):
    """(key, shared) of each bucket, from its rows in order of bucket, those looked up first."""

    def unpacked(rows: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, stretch) of each run."""
        kind = {1: np.uint8, 2: np.uint16, 4: np.int32}[width]
        sizes = np.frombuffer(b"".join(rows.column(4).to_pylist()), np.int32).astype(np.int64)
        hashes = _hashes(np.frombuffer(b"".join(rows.column(5).to_pylist()), kind), length)
        runs = sizes - length + 1
        return hashes[_gathered(np.cumsum(sizes) - sizes, runs)], np.repeat(np.arange(len(sizes)), runs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        known, fresh, held = np.empty(0, np.uint64), [], 0
        asked: list[tuple[np.ndarray, pa.Array]] = []

        def together() -> np.ndarray:
            return np.unique(np.concatenate([known, *fresh])) if fresh else known

        def found() -> Iterator[pa.RecordBatch]:
            if not asked:
                return
            keys = pa.concat_arrays([k for _, k in asked]).dictionary_encode(null_encoding="encode")
            hashes = np.concatenate([h for h, _ in asked])
            own = keys.indices.to_numpy()
            order = np.lexsort((own, hashes))
            hashes, own = hashes[order], own[order]
            new = np.ones(len(own), bool)
            new[1:] = (np.diff(own) != 0) | (hashes[1:] != hashes[:-1])
            n = np.bincount(own[new], minlength=len(keys.dictionary))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(some)), pa.array(n[some])], names)

        for batch in batches:
            kinds = np.stack([batch.column(k).to_numpy() for k in (0, 1, 3)])
            edges = np.flatnonzero(np.concatenate([[True], (np.diff(kinds) != 0).any(0)])) if batch.num_rows else []
            for begin, end in pairwise([*edges, batch.num_rows]):
                here, is_asked, width = kinds[:, begin].tolist()
                rows = batch.slice(begin, end - begin)
                if here != bucket:
                    yield from found()
                    bucket, known, fresh, held, asked = here, known[:0], [], 0, []
                hashes, stretch = unpacked(rows, width)
                if not is_asked:
                    fresh.append(hashes)
                    held += len(hashes)
                    if held >= max(_PENDING, len(known)):
                        known, fresh, held = together(), [], 0
                    continue
                known, fresh, held = together(), [], 0
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = known[at] == hashes
                    if hit.any():
                        asked.append((hashes[hit], rows.column(2).flatten().take(pa.array(stretch[hit]))))
        yield from found()

    return compare


def shared_runs(
    train: DataFrame, validation: DataFrame, length: int, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(key, shared): validation rows and how many of their distinct runs occur in train.

    Rows share a run of at least ``length`` tokens exactly when they share one of exactly
    that many. Runs are equal when their buckets and 64-bit hashes are.
    """
    kind = validation.schema[key].dataType
    fields = [("bucket", IntegerType()), ("asked", IntegerType()), ("keys", ArrayType(kind))]
    fields += [("width", IntegerType()), ("sizes", BinaryType()), ("tokens", BinaryType())]
    schema = StructType([StructField(n, k) for n, k in fields])
    names = pa.schema([pa.field(n, pa.null()) for n, _ in fields])
    sent = [
        side.select(key, F.col(ids).cast("array<int>").alias(ids)).mapInArrow(_sender(length, names, asked), schema)
        for side, asked in ((train, False), (validation, True))
    ]
    rows = sent[0].unionAll(sent[1]).repartition("bucket").sortWithinPartitions("bucket", "asked")
    counts = StructType([StructField(key, kind), StructField("shared", LongType())])
    found = rows.mapInArrow(_comparer(length, [key, "shared"]), counts)
    return found.groupBy(key).agg(F.sum("shared").alias("shared"))
