"""Toxicity scores from logistic regression trained by FTRL-proximal.

Features are hashed word n-grams (one to three words) and skip-grams (two words with one or
two words between them), each counted once per document. FTRL-proximal keeps for every
coordinate its own learning rate and an L1 threshold, so most weights stay exactly zero; the
model that is broadcast is the short list of the others.

Words are runs of letters and digits, lower-cased; other characters separate them.

Fitting uses at most ``TRAIN_ROWS`` labelled documents, chosen by a hash of the id, with their
whole texts; scoring covers every document and every word.

Defined results: a null text or one without a word gets the score of the bias alone. With no
labels every score is 0.5. Null labels and labels other than 0 and 1 are not used. Repeated
rows each get a row. Columns other than those named are not read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrays import WORDLIKE, mix, prefix_sums, range_hash, runs, spans
from textmill.llm.labels import fit_in_one_task, held_out, training_sample

BITS = 20
ALPHA, BETA, L1, L2 = 0.5, 1.0, 12.0, 0.1
EPOCHS = 6
TRAIN_ROWS = 8000
THRESHOLD = 0.3
_SEED = 23
# (distances of the words from the first, one odd multiplier for each)
_SHAPES = (((0,), 1), ((0, 1), 2), ((0, 1, 2), 3), ((0, 2), 4), ((0, 3), 5))


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each shape: the bucket of every occurrence and its row."""
    start, end, row = spans(WORDLIKE[data], offsets)
    word = range_hash(prefix_sums(data, _SEED), start, end, _SEED)
    out = []
    for places, shape in _SHAPES:
        n = max(len(word) - places[-1], 0)
        h = np.full(n, shape, np.uint64)
        for k in places:
            h = h * np.uint64(0x9E3779B97F4A7C15) + word[k : k + n]
        inside = row[:n] == row[places[-1] : places[-1] + n]
        out.append(((mix(h[inside]) >> np.uint64(64 - BITS)).astype(np.int64), row[:n][inside]))
    return out


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def _examples(table: pa.Table) -> list[np.ndarray]:
    out = []
    for _, _, data, offsets in runs(lowered(table.column("text").combine_chunks())):
        ids, rows = (np.concatenate(x) for x in zip(*features(data, offsets), strict=True))
        keys = np.unique((rows << BITS) | ids)
        bounds = np.searchsorted(keys, np.arange(len(offsets)) << BITS)
        out += [keys[a:b] & ((1 << BITS) - 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * L1 - z
    return np.where(np.abs(z) > L1, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)


def train(table: pa.Table) -> bytes:
    """The bias, then (bucket, weight) of each weight that is not zero, as float64 bytes."""
    label = table.column("label").to_numpy()
    examples = _examples(table)
    size = (1 << BITS) + 1  # the last coordinate is the bias
    z, n = np.zeros(size), np.zeros(size)
    draw = np.random.default_rng(_SEED)
    for _ in range(EPOCHS):
        for k in draw.permutation(len(examples)):
            ids = np.append(examples[k], size - 1)
            w = _weights(z[ids], n[ids])
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label[k]
            step = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / ALPHA
            z[ids] += g - step * w
            n[ids] += g * g
    w = _weights(z, n)
    kept = np.flatnonzero(w[:-1])
    return np.concatenate([[w[-1]], kept, w[kept]]).tobytes()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, rest: int = 2, rows: int = TRAIN_ROWS) -> np.ndarray:
    """The sparse model. ``rows`` bounds the sample that it is fitted on."""
    model = fit_in_one_task(training_sample(docs, labels, label, modulus, rest, rows), train)
    return np.zeros(1) if model is None else np.frombuffer(model, np.float64)


def score(docs: DataFrame, model: np.ndarray, out: str = "score", text: str = "text") -> DataFrame:
    """Add the probability of label 1 as the column ``out``."""
    count = (len(model) - 1) // 2
    bias, kept, weight = float(model[0]), model[1 : 1 + count].astype(np.int64), model[1 + count :]

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        table = np.zeros(1 << BITS)
        table[kept] = weight
        z = np.full(len(texts), bias)
        for first, last, data, offsets in runs(lowered(texts)):
            hits = []
            for ids, rows in features(data, offsets):
                used = table[ids] != 0
                hits.append((rows[used] << BITS) | ids[used])
            keys = np.unique(np.concatenate(hits))  # each feature counts once in a document
            z[first:last] += np.bincount(keys >> BITS, table[keys & ((1 << BITS) - 1)], last - first)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return docs.withColumn(out, probability(F.col(text)))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
