"""Texts of an Arrow batch as byte and code-point arrays, cut into words, with vectorised hashes.

Everything here works on one batch inside a task. Batches are taken in runs of rows of about
``RUN_BYTES``, so that the temporary arrays of a task stay small whatever the batch size.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20
U64 = np.uint64


def runs(text: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them). A null text is empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = pc.fill_null(text.cast(pa.large_string()), "")
    if not len(text):
        return
    _, places, content = text.buffers()
    offsets = np.frombuffer(places, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(text):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(text))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
# ASCII letters and digits, and every byte of a longer character
WORDLIKE = byte_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of true bytes; runs do not cross rows."""
    n = len(inside)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words between the characters 0x20 and 0x09-0x0D."""
    return spans(~SPACE[data], offsets)


# --- hashing ----------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of SplitMix64: a bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=8)
def _base(seed: int) -> tuple[np.ndarray, int]:
    """A random value for each byte and an odd base, from a seed."""
    drawn = mix(np.arange(1, 258, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    return drawn[:256], int(drawn[256]) | 1


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(max(n, 1), U64)
    done, step = 1, base
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * U64(step)
        done, step = done + take, step * step % 2**64
    return out


_power_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the seed's base and of its inverse, at least n of each."""
    held = _power_cache.get(seed)
    if held is None or len(held[0]) < n:
        base = _base(seed)[1]
        size = max(n, RUN_BYTES + 4096)
        held = (_powers(base, size), _powers(pow(base, -1, 2**64), size))
        if n <= 4 * RUN_BYTES:
            _power_cache[seed] = held
    return held


def prefix_sums(data: np.ndarray, seed: int) -> np.ndarray:
    """Sums from which the hash of any byte range follows."""
    up = powers(seed, len(data) + 1)[0]
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_base(seed)[0][data] * up[: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the bytes in each range; equal bytes have equal hashes."""
    down = powers(seed, len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


def sequence_hash(items: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of every ``length`` neighbouring items; one for each place where they fit."""
    n = max(len(items) - length + 1, 0)
    out = np.zeros(n, U64)
    base = U64(_base(seed)[1])
    for k in range(length):
        out = out * base + items[k : k + n]
    return mix(out + U64(seed))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values; one for each place where they fit."""
    if len(values) < width:
        return values[:0]
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


# --- characters -------------------------------------------------------------------------


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the rows' offsets among them."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=counts[1:])
    first = data[at].astype(np.uint32)
    if len(at) == len(data):
        return first, counts[offsets]
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    tail = [(padded[at + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3)]
    two = ((first & 0x1F) << 6) | tail[0]
    three = ((first & 0x0F) << 12) | (tail[0] << 6) | tail[1]
    four = ((first & 0x07) << 18) | (tail[0] << 12) | (tail[1] << 6) | tail[2]
    points = np.select([first < 0xC0, first < 0xE0, first < 0xF0], [first, two, three], four)
    return np.minimum(points, 0x10FFFF), counts[offsets]


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point the lower-case letter, or a space where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each row's values; rows may be empty."""
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
