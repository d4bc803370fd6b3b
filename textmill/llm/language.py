"""Language identification by rank-order profiles of character n-grams.

Each language is described by its most frequent 1-, 2- and 3-grams in order. A document's own
most frequent n-grams are compared with each profile: the out-of-place distance adds up how
far each n-gram's place in the document is from its place in the profile, and counts the full
profile length for an n-gram that the profile does not have. The nearest profile wins.

Letters are lower-cased, everything else separates words, and words are padded with one space.
An n-gram of up to three code points fits in one 63-bit key, so n-grams are never confused.

Defined results: a text that is null or has no letter is ``und`` with score 0. N-grams that
are equally frequent are ordered by code point, and equally near languages by name, so reruns
agree. Documents with a null or empty ``lang`` are not learned from. With nothing to learn
from, every document is ``und``. Repeated rows each get their own result. Only the named
columns are read; other columns pass through ``identify`` untouched.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.arrays import code_points, letter_table, runs
from textmill.sources.storage import cut_lineage

UNKNOWN = "und"
PROFILE = 400
HELD_OUT = 2
LEAST = 0.55
_BITS = np.uint64(21)
_SPACE = 32
_PENDING = 1_000_000


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT, F.lit(False))


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with single spaces between words and around each row."""
    points, at = code_points(data, offsets)
    rows = len(at) - 1
    size = np.diff(at)
    # two spaces for each row: one before it and one after it
    out = np.full(len(points) + 2 * rows, _SPACE, np.uint32)
    row_of = np.repeat(np.arange(rows), size)
    out[np.arange(len(points)) + 2 * row_of + 1] = letter_table()[points]
    starts = np.concatenate([at + 2 * np.arange(rows + 1)])
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != _SPACE) | (out[:-1] != _SPACE)
    keep[starts[:-1]] = True
    counts = np.zeros(len(out) + 1, np.int64)
    np.cumsum(keep, out=counts[1:])
    return out[keep], counts[starts]


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1, 2, 3: the keys of all n-grams and the rows' offsets among them."""
    letters, at = _letters(data, offsets)
    out = []
    wide = letters.astype(np.uint64)
    last = np.zeros(len(letters), bool)
    last[at[1:][at[1:] > at[:-1]] - 1] = True  # the last place of a row
    space = letters == _SPACE
    ok1 = ~space
    ok2 = np.zeros(len(letters), bool)
    ok2[:-1] = ~last[:-1] & ~(space[:-1] & space[1:])
    ok3 = np.zeros(len(letters), bool)
    ok3[:-2] = ~last[:-2] & ~last[1:-1] & ~space[1:-1]
    two, three = wide.copy(), wide.copy()
    two[:-1] = (wide[:-1] << _BITS) | wide[1:]
    three[:-2] = (wide[:-2] << (_BITS + _BITS)) | (wide[1:-1] << _BITS) | wide[2:]
    for keys, ok in ((wide, ok1), (two, ok2), (three, ok3)):
        counts = np.zeros(len(ok) + 1, np.int64)
        np.cumsum(ok, out=counts[1:])
        out.append((keys[ok], counts[at]))
    return out


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[edge], np.diff(np.append(edge, len(keys)))


def _merge(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n), summed within the task as far as memory is bounded."""

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            keys, n = _merge(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                ["lang", "gram", "n"],
            )

    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        codes = batch.column(1).dictionary_encode()
        names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
        for first, last, data, offsets in runs(batch.column(0)):
            grams = _grams(data, offsets)
            for k in np.unique(code[first:last]):
                mine = code[first:last] == k
                keys = np.concatenate([g[np.repeat(mine, np.diff(at))] for g, at in grams])
                found = _counted(keys)
                held.setdefault(names[k], []).append(found)
                size += len(found[0])
            if size > _PENDING:
                held = {lang: [_merge(found)] for lang, found in held.items()}
                size = sum(len(f[0][0]) for f in held.values())
                if size > _PENDING // 2:
                    yield from flush(held)
                    held, size = {}, 0
    yield from flush(held)


@dataclass(frozen=True)
class Profiles:
    """The languages' n-grams in order: bounded by the number of languages times ``PROFILE``."""

    languages: list[str]
    grams: np.ndarray  # sorted keys of all profiles
    ranks: np.ndarray  # (keys + 1, languages); the last row is for a gram no profile has


def learn(docs: DataFrame, size: int = PROFILE, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from the rows given; the counts are taken over all of them.

    Counts are summed in the tasks, then by (language, n-gram); only each language's ``size``
    most frequent n-grams reach the driver.
    """
    rows = docs.where(F.col(lang).isNotNull() & (F.col(lang) != "")).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = rows.mapInArrow(_count_task, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    best = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size).collect()
    languages = sorted({r["lang"] for r in top})
    grams = np.array(sorted({r["gram"] for r in top}), np.int64).view(np.uint64)
    ranks = np.full((len(grams) + 1, max(len(languages), 1)), size, np.int32)
    for r in top:
        ranks[np.searchsorted(grams, np.uint64(r["gram"])), languages.index(r["lang"])] = r["rank"] - 1
    return Profiles(languages, grams, ranks)


def _nearest(profiles: Profiles, size: int, keys: np.ndarray) -> tuple[int, float]:
    found, n = _counted(keys)
    place = (np.int64(len(keys)) - n) << np.int64(32) | np.arange(len(n))
    if len(place) > size:
        place = np.partition(place, size - 1)[:size]
    mine = found[np.sort(place) & np.int64(0xFFFFFFFF)]
    at = np.minimum(np.searchsorted(profiles.grams, mine), len(profiles.grams) - 1)
    at = np.where(profiles.grams[at] == mine, at, len(profiles.grams))
    ranks = profiles.ranks[at]
    away = np.where(ranks == size, size, np.abs(ranks - np.arange(len(mine))[:, None])).sum(0)
    best = int(np.argmin(away))
    return best, 1.0 - float(away[best]) / (size * len(mine))


def identify(docs: DataFrame, profiles: Profiles, out: str = "language", size: int = PROFILE, text: str = "text") -> DataFrame:
    """Add the struct column ``out`` (lang_pred, score) to any table with a text column."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        names: list[str] = [UNKNOWN] * len(texts)
        score = np.zeros(len(texts))
        if profiles.languages:
            for first, last, data, offsets in runs(texts):
                grams = _grams(data, offsets)
                for row in range(last - first):
                    keys = np.concatenate([g[at[row] : at[row + 1]] for g, at in grams])
                    if len(keys):
                        best, score[first + row] = _nearest(profiles, size, keys)
                        names[first + row] = profiles.languages[best]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return docs.withColumn(out, predict(F.col(text)))


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learned from those not held out."""
    docs = docs.select("doc_id", "text", "lang")
    profiles = learn(docs.where(~is_held_out()))
    return identify(docs.drop("lang"), profiles).select(
        "doc_id", is_held_out().alias("held_out"), "language.lang_pred", "language.score"
    )


def least_scores(told: DataFrame, column: str) -> dict[str, float]:
    """For each language the score below which a text is taken for none.

    It is ``LEAST`` times the median score of all rows that are marked with the language and
    told to be in it, so it follows the corpus and stray texts hardly move it. One number for
    each language reaches the driver.
    """
    told = told.select("lang", F.col(f"{column}.lang_pred").alias("told"), F.col(f"{column}.score").alias("score"))
    middle = told.where("told = lang").groupBy("told").agg(F.percentile_approx("score", 0.5, 10_000).alias("middle"))
    return {r["told"]: LEAST * r["middle"] for r in middle.collect()}


def reject_unknown(docs: DataFrame) -> DataFrame:
    """The rows whose language could be told, with the columns they came with.

    A document is rejected if it has no letter, or if its distance to the nearest profile is so
    large that its score is below the least score of that language (``least_scores``). With
    nothing to learn from, all are.
    """
    profiles = learn(docs.where(~is_held_out()))
    column = "__language"
    while column in docs.columns:
        column += "_"
    told = cut_lineage(identify(docs, profiles, column), "languages")
    least = least_scores(told, column)
    lang, score = F.col(f"{column}.lang_pred"), F.col(f"{column}.score")
    kept = reduce(or_, [(lang == name) & (score >= low) for name, low in sorted(least.items())], F.lit(False))
    return told.where(kept).drop(column)
