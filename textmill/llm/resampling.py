"""Drawing documents that look like a target set: importance weights, and an exact cut-off by medians.

Features are single words and pairs of neighbouring words, hashed by crc32 into ``BUCKETS``. A
bucket's gain is the logarithm of how much more often the target has it than the corpus, both
smoothed by one; a document's weight is the mean gain of its features. A Gumbel noise drawn from
the id is added, so that taking the highest scores draws without replacement in proportion to
the weights. Bucket counts are two arrays of ``BUCKETS`` numbers whatever the corpus, and each
document is scored by looking its features up in the array of gains.

The cut-off is found without sorting the corpus. The scored rows are written; in each round
every partition names the median of its keys that are still in question and how many they are.
The median of these medians, weighted by those numbers, has at least a quarter of the keys in
question on either side, so counting the keys above and below it discards a quarter or more for
certain. The same pass that counts takes the medians of both sides, so a round is one pass over
two narrow columns, and only a few numbers for each partition reach the driver. When the pivot
is the wanted key itself, the rounds end. Only the rows above the cut-off are sorted, in ranges.

Keys are the score, then the smaller id; rows with the same score and id are interchangeable.

Defined results: a null or wordless text has no features and the weight 0, and is not drawn as
it has fewer than ``MIN_WORDS`` words. A null id hashes like an empty one and comes after
others of its score. Repeated rows each take part. With no rows for the target every bucket's
gain follows the corpus alone. An empty table gives no rows. Only doc_id and text are read.
"""

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.ranking import ordered_rank
from textmill.sources.storage import cut_lineage

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LAST = 2**63 - 1  # the place of a null id


def buckets_of(text: str | None) -> tuple[np.ndarray, int]:
    """The bucket of every feature, and the number of words. Only A-Z are lower-cased."""
    words = _WORD.findall(text.encode().lower()) if text else []
    single = list(map(crc32, words))
    spaced = map(crc32, [b" "] * max(len(words) - 1, 0), single)
    pairs = list(map(crc32, words[1:], spaced))
    return np.array(single + pairs, np.int64) % BUCKETS, len(words)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of a text column are in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(buckets_of(text.as_py())[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    summed = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():  # at most one row for each bucket
        out[row.bucket] = row.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """A whole number for each bucket."""
    t_all, s_all = float(target.sum() + BUCKETS), float(corpus.sum() + BUCKETS)
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for t, s in zip(target.tolist(), corpus.tolist(), strict=True)],
        np.int64,
    )


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    digits = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found, words = buckets_of(text.as_py())
                rows.append((words, len(found), int(gain[found].sum()) // max(len(found), 1)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    own = docs.select(F.col("doc_id").cast("long"), "text")
    found = own.mapInArrow(measure, "doc_id long, n_words long, n_features long, weight long")
    return found.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


# --- the cut-off --------------------------------------------------------------------------

Key = tuple[int, int]  # (score, id): a higher score first, then a smaller id


def _above(score: np.ndarray, number: np.ndarray, key: Key) -> np.ndarray:
    return (score > key[0]) | ((score == key[0]) & (number < key[1]))


def _same(score: np.ndarray, number: np.ndarray, key: Key) -> np.ndarray:
    return (score == key[0]) & (number == key[1])


def _median(score: np.ndarray, number: np.ndarray) -> list[int]:
    """The key in the middle of the order; zeros where there is none."""
    if not len(score):
        return [0, 0]
    order = np.lexsort((number, -score))
    at = order[(len(order) - 1) // 2]
    return [int(score[at]), int(number[at])]


_FIELDS = ["same", "n_above", "above_score", "above_id", "n_below", "below_score", "below_id"]


def _round(keys: DataFrame, high: Key | None, low: Key | None, pivot: Key | None) -> list[tuple]:
    """For each partition: keys between the bounds that equal the pivot, and number and median of
    those above and below it. Without a pivot all are below it."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            score, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            inside = np.ones(len(score), bool)
            if high is not None:
                inside &= ~(_above(score, number, high) | _same(score, number, high))
            if low is not None:
                inside &= _above(score, number, low)
            held.append((score[inside], number[inside]))
        if not held:
            return
        score, number = (np.concatenate(x) for x in zip(*held, strict=True))
        if not len(score):
            return
        above = _above(score, number, pivot) if pivot else np.zeros(len(score), bool)
        same = _same(score, number, pivot) if pivot else above
        below = ~(above | same)
        row = [int(same.sum())]
        for side in (above, below):
            row += [int(side.sum()), *_median(score[side], number[side])]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], _FIELDS)

    return [tuple(r) for r in keys.mapInArrow(look, ", ".join(f"{f} long" for f in _FIELDS)).collect()]


def _weighted_median(medians: list[tuple[int, Key]]) -> Key:
    """The key at which half of the total weight is reached, from the top."""
    inorder = sorted(medians, key=lambda m: (-m[1][0], m[1][1]))
    total, passed = sum(n for n, _ in inorder), 0
    for n, key in inorder:
        passed += n
        if 2 * passed >= total:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, wanted: int) -> tuple[Key, int] | None:
    """The key of row number ``wanted`` (from 1) from the top of (score, number), and how many
    rows are above it. None if there are fewer rows or none is wanted. ``keys`` should be a
    written table, as it is read in several rounds; whenever less than an eighth of its rows
    is in question, these are written as the table of the next rounds."""
    high: Key | None = None  # keys in question are strictly between the bounds
    low: Key | None = None
    certain = 0  # rows that are above all keys in question
    pivot: Key | None = None
    size = None
    if wanted < 1:
        return None
    while True:
        found = _round(keys, high, low, pivot)
        above = [(r[1], (r[2], r[3])) for r in found if r[1]]
        below = [(r[4], (r[5], r[6])) for r in found if r[4]]
        n_above, n_same = sum(n for n, _ in above), sum(r[0] for r in found)
        if pivot is not None and wanted <= certain + n_above:
            low, rest = pivot, above
        elif pivot is not None and wanted <= certain + n_above + n_same:
            return pivot, certain + n_above
        else:
            certain += n_above + n_same
            high, rest = pivot, below
        if not rest:
            return None
        left = sum(n for n, _ in rest)
        if size is not None and 8 * left < size:
            keys = cut_lineage(keys.where(_between(high, low)), "keys")
        if size is None or 8 * left < size:
            size = left
        pivot = _weighted_median(rest)


def _between(high: Key | None, low: Key | None) -> Column:
    score, number = F.col("score"), F.col("number")
    inside = F.lit(True)
    if high is not None:
        inside &= (score < high[0]) | ((score == high[0]) & (number > high[1]))
    if low is not None:
        inside &= (score > low[0]) | ((score == low[0]) & (number < low[1]))
    return inside


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank``, 1 for the highest score, to the drawn rows of a written table; null to others.

    Drawn are ``percent`` hundredths, rounded down, of the rows with at least ``min_words`` words.
    """
    able = F.col("n_words") >= min_words
    number = F.coalesce("doc_id", F.lit(_LAST))
    wanted = percent * scored.where(able).count() // 100
    cut = cutoff(scored.where(able).select("score", number.alias("number")), wanted)
    if cut is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    (score, last), _ = cut
    chosen = able & ((F.col("score") > score) | ((F.col("score") == score) & (number <= last)))
    winners = scored.where(chosen)
    # a number that follows the key, so that ranges are even also where very many scores are equal
    first, final = winners.agg(F.min("doc_id"), F.max("doc_id")).first()
    along = (F.col("doc_id").cast("double") - (first or 0)) / (2.0 * ((final or 0) - (first or 0) + 1))
    winners = winners.withColumns({"__along": F.coalesce(along, F.lit(0.75)) - F.col("score"), "__number": number})
    ranked = ordered_rank(winners.withColumn("__down", -F.col("score")), "__along", "rank", ["__down", "__number"])
    ranked = ranked.drop("__along", "__down", "__number")
    # rows that equal the last one may be more than are wanted
    rank = F.when(F.col("rank") < wanted, F.col("rank") + 1)
    rest = scored.where(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row."""
    gain = gains(bucket_counts(target), bucket_counts(docs))
    scored = cut_lineage(weigh(docs, gain), "weights")
    return draw(scored, percent, min_words).select("doc_id", "n_features", "weight", "score", "rank")


RESAMPLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
wanted AS (
  SELECT regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
features AS (
  SELECT row, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM sized),
target AS (
  SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM wanted),
steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS step),
names AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM features UNION SELECT f FROM target)),
coded AS (
  SELECT f, xor(4294967295, list_reduce(
           list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c // 256, step[xor(c % 256, b) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
  FROM names, steps),
corpus_buckets AS (SELECT bucket, count(*) AS s FROM features JOIN coded USING (f) GROUP BY bucket),
target_buckets AS (SELECT bucket, count(*) AS t FROM target JOIN coded USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM features) + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM corpus_buckets LEFT JOIN target_buckets USING (bucket)),
weights AS (
  SELECT row, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
  FROM features JOIN coded USING (f) JOIN gain USING (bucket) GROUP BY row),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5)::DOUBLE
           / 4294967296)))::BIGINT AS score
  FROM sized LEFT JOIN weights USING (row)),
able AS (
  SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_words >= 20),
drawn AS (SELECT * FROM able WHERE rank <= 25 * (SELECT count(*) FROM able) // 100)
SELECT s.doc_id, n_features, weight, s.score::BIGINT AS score, d.rank::BIGINT AS rank
FROM scored s LEFT JOIN drawn d ON s.doc_id = d.doc_id
"""
