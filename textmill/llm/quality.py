"""Quality scores from supervised subword embeddings.

A document is the average of the learned vectors of its features: hashed words, a mark for a
word that repeats the one before it, and hashed character 3- to 5-grams inside words (with the
neighbouring blanks as marks). A softmax over
the average gives the class. Vectors and output weights are trained together by stochastic
gradient descent in numpy, with a rate that falls linearly to zero.

The output is linear in the average, so for scoring each feature's vector is first reduced to
one number, the difference of its two class scores. What is broadcast is this table of
``2 ** BITS`` floats, whatever the data.

Fitting uses at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of the id, with their
whole texts; scoring covers every document and every character.

Defined results: a null or empty text, or one of whitespace only, has no feature and gets the
score of the bias alone. With no labels, or labels of one class, the score is the share of
label 1 in the sample (0.5 with no sample). Null labels and labels other than 0 and 1 are not
used. Repeated rows each get a row. Columns other than those named are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrays import code_points, prefix_sums, range_hash, row_sums, runs, words
from textmill.llm.labels import fit_in_one_task, held_out, training_sample

BITS = 17
DIM = 16
EPOCHS = 6
RATE = 0.5
SCALE = 100.0  # the vectors' rate, as a multiple of the output's
TRAIN_ROWS = 6000
THRESHOLD = 0.3
_SEED = 11
_REPEATED = 0  # the bucket of the feature "the same word again"
_SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.uint32)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of (bucket of each feature, the rows' offsets among them): words, then n-grams."""
    start, end, row = words(data, offsets)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    word = range_hash(prefix_sums(data, _SEED), start, end, _SEED)
    out = [(_bucket(word), bounds)]
    # a word that repeats the one before it is a feature of its own, whatever the word is
    again = np.flatnonzero((word[1:] == word[:-1]) & (row[1:] == row[:-1])) + 1
    out.append((np.full(len(again), _REPEATED, np.uint32), np.searchsorted(row[again], np.arange(len(offsets)))))
    points, at = code_points(data, offsets)
    n = len(points)
    blank = points <= 32
    blank[blank] = np.isin(points[blank], _SPACES)
    points = np.where(blank, np.uint32(32), points).astype(np.uint64)
    blanks = np.zeros(n + 1, np.int64)
    np.cumsum(blank, out=blanks[1:])
    last = np.repeat(at[1:], np.diff(at))  # where each character's row ends
    h = points.copy()
    for length in range(2, 6):
        room = max(n - length + 1, 0)
        h = h[:room] * _ODD[0] + points[length - 1 : length - 1 + room]
        if length < 3:
            continue
        place = np.arange(room)
        ok = (place + length <= last[:room]) & (blanks[place + length - 1] == blanks[place + 1])
        kept = np.zeros(n + 1, np.int64)
        np.cumsum(ok, out=kept[1 : room + 1])
        kept[room + 1 :] = kept[room]
        mixed = (h[ok] ^ (h[ok] >> np.uint64(29))) * _ODD[length - 3]
        out.append((_bucket(mixed), kept[at]))
    return out


def _examples(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for _, _, data, offsets in runs(table.column("text")):
        groups = features(data, offsets)
        for r in range(len(offsets) - 1):
            ids = np.concatenate([f[at[r] : at[r + 1]] for f, at in groups])
            ids, n = np.unique(ids, return_counts=True)
            out.append((ids, (n / max(n.sum(), 1)).astype(np.float32)))
    return out


def train(table: pa.Table) -> bytes:
    """The bias and, for each bucket, the difference of the class scores, as float32 bytes."""
    label = table.column("label").to_numpy()
    examples = _examples(table)
    draw = np.random.default_rng(_SEED)
    vectors = (draw.random((1 << BITS, DIM), np.float32) - 0.5) / DIM
    out = np.zeros((DIM, 2), np.float32)
    bias = np.zeros(2, np.float32)
    if label.min() == label.max():
        share = float(label[0])
        table_of = np.zeros(1 + (1 << BITS), np.float32)
        table_of[0] = 20.0 if share else -20.0
        return table_of.tobytes()
    total, done = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for k in draw.permutation(len(examples)):
            rate = np.float32(RATE * (1 - done / total))
            done += 1
            ids, share = examples[k]
            if not len(ids):
                continue
            mean = share @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[k]] -= 1  # the gradient of the loss in z
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * p
            # with the plain gradient the vectors hardly move in a few thousand examples
            vectors[ids] -= (rate * SCALE * share)[:, None] * back
    difference = vectors @ (out[:, 1] - out[:, 0])
    return np.concatenate([[bias[1] - bias[0]], difference]).astype(np.float32).tobytes()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, rest: int = 0, rows: int = TRAIN_ROWS) -> np.ndarray:
    """The scoring table. ``rows`` bounds the sample that it is fitted on."""
    model = fit_in_one_task(training_sample(docs, labels, label, modulus, rest, rows), train)
    return np.zeros(1 + (1 << BITS), np.float32) if model is None else np.frombuffer(model, np.float32)


def score(docs: DataFrame, model: np.ndarray, out: str = "score", text: str = "text") -> DataFrame:
    """Add the probability of label 1 as the column ``out``."""

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        z = np.zeros(len(texts))
        for first, last, data, offsets in runs(texts):
            total, n = np.zeros(last - first), np.zeros(last - first)
            for ids, at in features(data, offsets):
                total += row_sums(model[1:][ids], at)
                n += np.diff(at)
            z[first:last] = total / np.maximum(n, 1)
        z = np.clip(z + model[0], -500, 500)
        return pa.array(1 / (1 + np.exp(-z)))

    return docs.withColumn(out, probability(F.col(text)))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
