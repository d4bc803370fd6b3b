"""Draws for every position of an array: ``hashing.uniform`` of (key, position), in Arrow batches.

The hash is MD5 of a short text, which fits one block of 64 bytes, so all positions of a batch go
through its 64 steps together.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 56  # bytes of a block before the length
_ROWS = 1 << 14
_SINES = [int(abs(math.sin(i + 1)) * 2**32) & 0xFFFFFFFF for i in range(64)]
_TURNS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _first_digits(words: list[np.ndarray | None], rows: int) -> np.ndarray:
    """The first 13 hex digits of the MD5 of blocks, given as 16 columns (None: zeros)."""
    a, b, c, d = (np.full(rows, x, np.uint32) for x in _START)
    f, low = np.empty(rows, np.uint32), np.empty(rows, np.uint32)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            at = i
            np.bitwise_xor(c, d, out=f); f &= b; f ^= d  # noqa: E702
        elif kind == 1:
            at = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f); f &= d; f ^= c  # noqa: E702
        elif kind == 2:
            at = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f); f ^= d  # noqa: E702
        else:
            at = 7 * i % 16
            np.bitwise_not(d, out=f); f |= b; f ^= c  # noqa: E702
        f += a
        f += np.uint32(_SINES[i])
        if words[at] is not None:
            f += words[at]
        turn = _TURNS[kind][i % 4]
        np.right_shift(f, np.uint32(32 - turn), out=low)
        f <<= np.uint32(turn)
        f |= low
        f += b
        a, b, c, d, f = d, f, b, c, a
    a, b = (a + np.uint32(_START[0])).byteswap(), (b + np.uint32(_START[1])).byteswap()
    return (a.astype(np.uint64) << np.uint64(20)) | (b >> np.uint32(12))


def numbers(heads: list[str], sizes: np.ndarray, tail: str = "") -> np.ndarray:
    """The first 13 hex digits of md5(head + position + tail) as numbers, for all positions of all rows."""
    ends, raw, end = np.cumsum(sizes), [h.encode() for h in heads], tail.encode()
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    lengths = np.array([len(h) for h in raw], np.int64)
    # a position has ten digits at most, and one byte marks the end
    short = lengths + 10 + len(end) + 1 <= _BLOCK
    for i in np.flatnonzero(~short & (sizes > 0)):
        each = (int(hashlib.md5(b"%b%d%b" % (raw[i], k, end)).hexdigest()[:13], 16) for k in range(sizes[i]))
        out[ends[i] - sizes[i] : ends[i]] = np.fromiter(each, np.uint64, sizes[i])
    blocks = np.zeros((len(raw), _BLOCK), np.uint8)
    for i in np.flatnonzero(short):
        blocks[i, : lengths[i]] = np.frombuffer(raw[i], np.uint8)
    for begin in range(0, len(out), _ROWS):
        place = np.arange(begin, min(begin + _ROWS, len(out)))
        row = np.searchsorted(ends, place, side="right")
        own = short[row]
        place, row = place[own], row[own]
        if not len(row):
            continue
        position = place - (ends[row] - sizes[row])
        digits = np.searchsorted(10 ** np.arange(1, 10), position, side="right") + 1
        text = blocks[row]
        flat, at = text.reshape(-1), np.arange(len(row)) * _BLOCK + lengths[row]
        for k in range(int(digits.max())):
            some = digits > k
            flat[at[some] + digits[some] - 1 - k] = 48 + position[some] // 10**k % 10
        at += digits
        for k, byte in enumerate(end + b"\x80"):
            flat[at + k] = byte
        words = text.view("<u4")
        columns = [np.ascontiguousarray(words[:, j]) for j in range(_BLOCK // 4)]
        columns = [c if c.any() else None for c in columns]
        columns += [((lengths[row] + digits + len(end)) * 8).astype(np.uint32), None]
        out[place] = _first_digits(columns, len(row))
    return out


def _head(seed: int, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(""))


def _over_positions(kind: str, draw) -> "Column":
    """An array of draws, one for each position of the array in the second column."""

    @F.arrow_udf(f"array<{kind}>")
    def drawn(heads: pa.Array, values: pa.Array) -> pa.Array:
        # the array itself is sent, as its size bounds that of a batch
        sizes = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = pa.array(draw(heads.to_pylist(), sizes))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, found, mask=values.is_null())

    return drawn


def uniforms(seed: int, key: Column | str, values: Column | str) -> Column:
    """Per position of an array, ``uniform(seed, key, position)``."""
    draw = _over_positions("double", lambda heads, sizes: numbers(heads, sizes) / 2.0**52)
    return draw(_head(seed, key), values)


def are_below(limit: int, seed: int, key: Column | str, values: Column | str) -> Column:
    """Per position of an array, whether the 52 bits of ``uniform`` are below a number."""
    draw = _over_positions("boolean", lambda heads, sizes: numbers(heads, sizes) < np.uint64(limit))
    return draw(_head(seed, key), values)


def gaussians(seed: int, key: Column | str, values: Column | str) -> Column:
    """Per position of an array, ``gaussian(seed, key, position)``."""

    def draw(heads: list[str], sizes: np.ndarray) -> np.ndarray:
        radius = np.sqrt(-2.0 * np.log(1.0 - numbers(heads, sizes, "|r") / 2.0**52))
        return radius * np.cos(2.0 * np.pi * (numbers(heads, sizes, "|a") / 2.0**52))

    return _over_positions("double", draw)(_head(seed, key), values)
