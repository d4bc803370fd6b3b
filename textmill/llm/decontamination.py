"""Benchmark decontamination by canonical templates.

Words are stripped of outer punctuation and lower-cased. Numbers, names and units become typed
placeholders, whose words are kept aside as slot values:

* a number is made of digits with signs and separators,
* a unit is a word of ``UNITS`` after a number, and
* a name is a capitalised word that does not begin a sentence or a line.

Every run of ``WINDOW`` tokens of a benchmark item is hashed as a template; an item that is
shorter is one window of its own length. The words themselves are hashed beside the templates,
lower-cased and without regard to slots, so copies match whatever their capitals, line ends and
numbers. Documents' windows are hashed the same way and joined on the hash. A matched window is
aligned with its place in the item. On an alignment, a document's value stands for an item's
value if it does so at more than half of its places; a window is consistent if each of its slots
has the item's own value or one that stands for it.

A document is contaminated by an item if one alignment has at least ``MIN_WINDOWS`` windows with
the item's own words (all, if the item has fewer), or as many consistent template windows that
are more than half of those matched. A question asked again with other numbers or names matches;
a text that merely has numbers in the same places, but not the same ones twice, does not.

The benchmark's window hashes are sent to the tasks as one sorted array if there are at most
``MAX_SENT`` of them (8 bytes each), so that only matching windows leave the scan; with more,
all windows of the documents are joined by a shuffle. The result is the same.

Defined results: null and empty texts have no window and match nothing, on either side. Rows
with a null id are left out, as no pair could name them. Repeated rows give one pair. Items
without three tokens cannot be told from chance and match nothing. Only doc_id, item_id and
text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrays import (
    WORDLIKE,
    byte_table,
    code_points,
    letter_table,
    prefix_sums,
    range_hash,
    runs,
    sequence_hash,
    words,
)
from textmill.sources.storage import cut_lineage, fits

WINDOW = 8
MIN_TOKENS = 3
MIN_LITERALS = 3
MIN_WINDOWS = 3
MAX_SENT = 2_000_000
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec seconds min minutes h hours days weeks "
    "months years meters metres kilometers kilometres miles feet inches grams kilograms pounds "
    "liters litres dollars euros cents percent degrees mph kmh"
).split()
_SEED = 31
_PLAIN = 1 << 32  # added to the seed of windows without placeholders
_FOLDED = (("ß", "ss"), ("ς", "σ"))  # letters whose capitals are lowered to others
_NUMERIC = byte_table(b"0123456789.,:/%$+-")
_DIGIT = byte_table(b"0123456789")
_STOP = byte_table(b".!?:")
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (3, 5, 7))


def _word_hashes(names: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    start, end, _ = words(data, np.array([0, len(data)]))
    return np.sort(range_hash(prefix_sums(data, _SEED), start, end, _SEED))


def tokens(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row, code, value, is a slot) of the canonical tokens, a run of rows at a time."""
    units = _word_hashes(UNITS)
    for first, last, data, offsets in runs(text):
        part = text.slice(first, last - first)
        lowered = pc.utf8_lower(pc.fill_null(part.cast(pa.large_string()), ""))
        for letter, folded in _FOLDED:
            lowered = pc.replace_substring(lowered, letter, folded)
        low = next(runs(lowered, 1 << 62))
        start, end, row = words(data, offsets)
        low_start, low_end, _ = words(low[2], low[3])
        # the core of each lower-cased word, from its first to its last letter or digit
        wordlike = np.flatnonzero(WORDLIKE[low[2]])
        a, b = np.searchsorted(wordlike, low_start), np.searchsorted(wordlike, low_end)
        solid = b > a
        a, b = wordlike[a[solid]], wordlike[b[solid] - 1] + 1
        value = range_hash(prefix_sums(low[2], _SEED), a, b, _SEED)
        plain = np.zeros(len(low[2]) + 1, np.int64)
        np.cumsum(~_NUMERIC[low[2]], out=plain[1:])
        number = (plain[b] == plain[a]) & _DIGIT[low[2][a]]
        # capitals are looked for in the text as it was
        points, _ = code_points(data, offsets)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        letter = letter_table()[points]
        capital = np.zeros(len(data), bool)
        capital[lead] = (letter != 32) & (letter != points)
        capitals, breaks = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
        np.cumsum(capital, out=capitals[1:])
        np.cumsum(data == 10, out=breaks[1:])
        opens = np.ones(len(start), bool)
        if len(start) > 1:
            opens[1:] = (row[1:] != row[:-1]) | _STOP[data[end[:-1] - 1]] | (breaks[start[1:]] > breaks[end[:-1]])
        original = np.flatnonzero(WORDLIKE[data])
        at = np.searchsorted(original, start)
        head = original[np.minimum(at, max(len(original) - 1, 0))] if len(original) else start
        name = (~opens & capital[head] & (capitals[end] - capitals[start] == 1) & (end - head > 1))[solid]
        row = row[solid]
        unit = np.zeros(len(value), bool)
        unit[1:] = number[:-1] & (row[1:] == row[:-1]) & np.isin(value[1:], units)
        code = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
        yield first, row, code, value, number | unit | name


def _windows(row: np.ndarray, code: np.ndarray, slot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the windows that stay in a row and have enough literal words."""
    h = sequence_hash(code, length, length)
    if not len(h):
        return h, np.empty(0, np.int64)
    slots = np.zeros(len(slot) + 1, np.int64)
    np.cumsum(slot, out=slots[1:])
    literals = length - (slots[length:] - slots[:-length])
    at = np.flatnonzero((row[length - 1 :] == row[: len(h)]) & (literals >= min(MIN_LITERALS, length - 1)))
    return h[at], at


def _plain_windows(row: np.ndarray, value: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the windows of the words themselves that stay in a row."""
    h = sequence_hash(value, length, length + _PLAIN)
    at = np.flatnonzero(row[length - 1 :] == row[: len(h)]) if len(h) else np.empty(0, np.int64)
    return h[at], at


_FIELDS = [
    ("id", pa.int64()),
    ("h", pa.int64()),
    ("place", pa.int32()),
    ("length", pa.int32()),
    ("total", pa.int32()),
    ("usable", pa.int32()),
    ("slots", pa.list_(pa.int64())),
]
_SCHEMA = "id long, h long, place int, length int, total int, usable int, slots array<long>"


def _emit(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[] for _ in _FIELDS]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], [n for n, _ in _FIELDS]
    )


def _listed(ids: np.ndarray, row, value, slot, length: int, h, at, totals, usable) -> list[tuple]:
    """A row for each window, its slot values by their place in the window (null: literal; none for a plain window)."""
    begins = np.searchsorted(row, row[at])
    out = []
    for x, p, b in zip(h.view(np.int64).tolist(), at.tolist(), begins.tolist(), strict=True):
        own = slice(p, p + length)
        slots = []
        if slot is not None:
            slots = [v if s else None for v, s in zip(value[own].view(np.int64).tolist(), slot[own].tolist(), strict=True)]
        out.append((int(ids[row[p]]), x, p - b, length, int(totals[row[p]]), int(usable[row[p]]), slots))
    return out


def _item_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, row, code, value, slot in tokens(batch.column(1)):
            own = ids[first:]
            size = np.bincount(row, minlength=int(row[-1]) + 1 if len(row) else 0)
            totals = np.maximum(size - WINDOW + 1, 1)
            # the first word of an item may be a name where the item is quoted inside a sentence
            heads = np.searchsorted(row, np.arange(len(size)))
            variants = [(code, slot)]
            if len(row):
                as_name, named = code.copy(), slot.copy()
                heads = heads[size > 0]
                as_name[heads], named[heads] = _NAME, True
                variants.append((as_name, named))
            held = []
            template = np.zeros(len(row), bool)
            for length in {WINDOW, *size[(size >= MIN_TOKENS) & (size < WINDOW)].tolist()}:
                for k, (codes, slots) in enumerate([*variants, (value, None)]):
                    h, at = _plain_windows(row, value, length) if slots is None else _windows(row, codes, slots, length)
                    whole = (size[row[at]] >= WINDOW) if length == WINDOW else (size[row[at]] == length)
                    if slots is not None:
                        if k:
                            whole &= np.isin(at, heads)
                        template[at[whole]] = True
                    held.append((slots, length, h[whole], at[whole]))
            # places whose window can match with other slot values
            usable = np.bincount(row[template], minlength=len(size))
            found = []
            for slots, length, h, at in held:
                found += _listed(own, row, value, slots, length, h, at, totals, usable)
            yield _emit(found)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(id, h, place, length, total, usable, slots) of the items' windows.

    total is the number of an item's places, and usable of those with a template window.
    """
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct()
    return cut_lineage(items.mapInArrow(_item_task, _SCHEMA), "items")


def _document_windows(docs: DataFrame, lengths: list[int], wanted: np.ndarray | None) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, row, code, value, slot in tokens(batch.column(1)):
                none = np.zeros(int(row[-1]) + 1 if len(row) else 0, np.int64)
                for length in lengths:
                    for slots in (slot, None):
                        h, at = _plain_windows(row, value, length) if slots is None else _windows(row, code, slots, length)
                        if wanted is not None:
                            where = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                            hit = wanted[where] == h
                            h, at = h[hit], at[hit]
                        if len(h):
                            yield _emit(_listed(ids[first:], row, value, slots, length, h, at, none, none))

    own = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return own.mapInArrow(task, _SCHEMA)


def _judge(windows: list[dict], total: int, usable: int) -> tuple[bool, int, bool]:
    """(contaminated, consistent windows, all verbatim) of the matched windows of one alignment."""
    votes: dict[int, dict[int, set[int]]] = {}
    listed = []
    for w in windows:
        own = [(w["place"] + k, a, b) for k, (a, b) in enumerate(zip(w["slots"], w["values"])) if a is not None]
        listed.append((w["place"], own))
        for at, a, b in own:
            votes.setdefault(a, {}).setdefault(b, set()).add(at)
    # a value stands for the item's if it does so at more than half of the places
    stands = set()
    for a, found in votes.items():
        places = len(set().union(*found.values()))
        stands |= {(a, b) for b, at in found.items() if 2 * len(at) > places}
    verbatim = {p for p, own in listed if all(a == b for _, a, b in own)}
    good = verbatim | {p for p, own in listed if all(a == b or (a, b) in stands for _, a, b in own)}
    n = len({p for p, _ in listed})
    copied = len(verbatim) >= min(MIN_WINDOWS, total)
    asked_again = 0 < usable and len(good) >= min(MIN_WINDOWS, usable) and 2 * len(good) > n
    return copied or asked_again, len(good), len(verbatim) == n


def _judged(windows: pa.Array, total: pa.Array, usable: pa.Array) -> pa.Array:
    rows = zip(windows.to_pylist(), total.to_pylist(), usable.to_pylist(), strict=True)
    columns = list(zip(*(_judge(*r) for r in rows), strict=True)) or [[], [], []]
    kinds = (pa.bool_(), pa.int64(), pa.bool_())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["bad", "n", "verbatim"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, verbatim): the contaminated pairs.

    ``n_windows`` is the most consistent windows on one alignment, ``item_windows`` the item's
    places, and ``verbatim`` says whether all matched windows there have the item's own words.
    """
    items = benchmark_windows(benchmark)
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most WINDOW
    wanted = None
    if fits(items, MAX_SENT):
        wanted = items.select("h").distinct().toPandas()["h"].to_numpy(np.int64).view(np.uint64)
        wanted = np.sort(wanted) if len(wanted) else np.zeros(1, np.uint64)
    found = _document_windows(docs, lengths, wanted).select(
        F.col("id").alias("doc_id"), "h", F.col("place").alias("at"), F.col("slots").alias("values")
    )
    lines = items.withColumnRenamed("id", "item_id")
    few = wanted is not None
    pairs = found.join(F.broadcast(lines) if few else lines, "h").withColumn("shift", F.col("at") - F.col("place"))
    aligned = pairs.groupBy("doc_id", "item_id", "shift").agg(
        F.count_distinct("place").alias("n_windows"),
        F.max("total").alias("total"),
        F.max("usable").alias("usable"),
        F.collect_set(F.struct("place", "slots", "values")).alias("windows"),
    )
    least = F.least(F.lit(MIN_WINDOWS), F.col("total"), F.when(F.col("usable") > 0, F.col("usable")))
    judge = F.arrow_udf(_judged, "struct<bad:boolean,n:long,verbatim:boolean>")
    judged = aligned.where(F.col("n_windows") >= least).select(
        "doc_id", "item_id", "total", judge("windows", "total", "usable").alias("r")
    )
    return (
        judged.where("r.bad")
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("r.n").alias("n_windows"),
            F.max("total").cast("long").alias("item_windows"),
            F.bool_or("r.verbatim").alias("verbatim"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that no item contaminates, with the columns they came with."""
    bad = cut_lineage(contamination(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


