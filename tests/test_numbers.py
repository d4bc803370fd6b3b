import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions import vectors
from textmill.operators import attention_lookup, scaling, splits, statistics
from textmill.plans import dataset
from textmill.sources.store import Dataset, DatasetOptions


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


@pytest.mark.parametrize("n", [1, 2, 9, 100])
def test_report_equals_numpy(spark, n):
    values = np.random.default_rng(n).normal(5, 3, n).round(1)
    row = statistics.full_report(numbers(spark, values), "v").first()
    want = [values.min(), values.max(), values.mean(), np.median(values), values.std(), values.var()]
    got = [row["min"], row["max"], row["mean"], row["median"], row["std"], row["variance"]]
    assert np.allclose(got, want)
    assert row.unique_values == len(np.unique(values)) and row.rows == n


def test_empty_report(spark):
    row = statistics.basic_report(statistics.value_counts(numbers(spark, []), "v")).first()
    assert row.rows == 0 and row.min_value is None and row.mean_value is None


def test_lengths(sequences):
    row = statistics.length_distribution(sequences([1], [1, 2], [1] * 6), F.size("ids")).first()
    assert (row.min_length, row.max_length, row.mean_length, row.median_length) == (1, 6, 3.0, 2.0)
    assert math.isclose(row.std_length, np.std([1, 2, 6]))


def test_validate(spark):
    good, bad = numbers(spark, [1, 2]), numbers(spark, [float("nan"), float("inf"), 1])
    ok = statistics.validate(good, good, "v", "v").first()
    assert ok.valid and ok.errors == [] and ok.warnings == [] and (ok.input_min, ok.input_max) == (1.0, 2.0)
    worse = statistics.validate(good, bad, "v", "v").first()
    assert not worse.valid and worse.errors == [
        "Length mismatch: inputs=2, targets=3", "NaN values found in targets", "Infinite values found in targets",
    ]


def test_token_range(sequences):
    assert statistics.token_range_report(sequences([0, 4]), 5).first().valid
    assert not statistics.token_range_report(sequences([0, 5]), 5).first().valid
    with pytest.raises(Exception, match="must be in range"):
        statistics.require_token_range(sequences([0, 5]), 5).collect()


@pytest.mark.parametrize("method", ["minmax", "zscore"])
def test_scaling(spark, method):
    values = [3.0, 7.0, 11.0]
    df = numbers(spark, values)
    scaler = scaling.fit(df, "v", method)
    out = df.select("v", scaler.transform(F.col("v")).alias("s")).select("v", "s", scaler.inverse(F.col("s")).alias("r"))
    x = np.array(values)
    want = (x - 3) / (8 + 1e-8) if method == "minmax" else (x - x.mean()) / (x.std() + 1e-8)
    rows = sorted(out.collect())
    assert np.allclose([r.s for r in rows], want)
    assert np.allclose([r.r for r in rows], values)
    with pytest.raises(ValueError):
        scaling.fit(df, "v", "other")


def test_quantisation(spark):
    data = np.array([[-1.0, 0.5, 0.25], [0.1, -0.004, 2.0]])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(data)], "i int, v array<double>")
    scale = 2.0 / 127
    got = [r.quantized for r in scaling.quantize_symmetric(df, "v").orderBy("i").collect()]
    assert np.allclose(got, np.rint(data / scale) * scale)
    scale = 3.0 / 255
    zero = round(1.0 / scale)
    got = [r.quantized for r in scaling.quantize_asymmetric(df, "v").orderBy("i").collect()]
    assert np.allclose(got, np.rint(data / scale + zero) * scale - zero * scale)


def test_vectors(spark):
    x = np.array([1.0, 2.0, 4.0, 9.0])
    row = spark.createDataFrame([(x.tolist(),)], "v array<double>").select(
        vectors.standardize(F.col("v")).alias("s"), vectors.rms_scale(F.col("v")).alias("r")
    ).first()
    assert np.allclose(row.s, (x - x.mean()) / (x.std() + 1e-6))
    assert np.allclose(row.r, x / np.sqrt((x * x).mean() + 1e-6))


def test_softmax_lookup_example(spark):
    rows = [("q", 1.0, 2000.0), ("q", 0.6, 2500.0), ("q", 0.5, 1000.0), ("hot", 900.0, 1.0)]
    df = spark.createDataFrame(rows, "query string, score double, value double")
    got = {r["query"]: r.looked_up for r in attention_lookup.softmax_lookup(df).collect()}
    assert abs(got["q"] - 1880.7) < 0.5 and got["hot"] == 1.0


def test_scores(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "query int, vector array<double>")
    keys = spark.createDataFrame([([2.0, 4.0], 7.0)], "vector array<double>, value double")
    got = sorted(tuple(r) for r in attention_lookup.score(queries, keys).collect())
    assert got == [(1, 2.0, 7.0), (2, 3.0, 7.0)]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_scores_of_many_queries(spark, monkeypatch, limit):
    monkeypatch.setattr(attention_lookup, "_BROADCAST_BYTES", limit)
    queries = spark.range(1200).select(F.col("id").alias("query"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    keys = spark.createDataFrame([([2.0, 4.0], 7.0), ([0.0, 1.0], 8.0)], "vector array<double>, value double")
    got = sorted(tuple(r) for r in attention_lookup.score(queries, keys).collect())
    assert got == sorted([(k, 2.0 * k + 4.0, 7.0) for k in range(1200)] + [(k, 1.0, 8.0) for k in range(1200)])
    assert attention_lookup.score(queries.limit(0), keys).count() == 0


def test_dataset_folder(spark, docs, tmp_path):
    texts = ["  hello world \r\n", "abc", "x" * 40]
    options = DatasetOptions(seq_length=5, validation_split=0.25)
    row = dataset.process(docs(*texts), str(tmp_path / "d"), "small", options).first()
    clean = [t.strip() for t in texts]
    windows = [t[i : i + 6] for t in clean for i in range(len(t) - 5)]
    chars = sorted(set("".join(clean)))
    flat = [chars.index(c) for w in windows for c in w[:5]]
    assert row.total_sequences == len(windows) and row.train_sequences == int(len(windows) * 0.75)
    assert (row.inputs_rows, row.inputs_min_value, row.inputs_max_value) == (len(flat), min(flat), max(flat))
    assert math.isclose(row.inputs_mean_value, np.mean(flat))
    assert row.inputs_unique_values == len(set(flat)) and row.vocab_size == len(chars)
    assert row.targets_rows == len(windows) and row.text_length == sum(map(len, clean))
    saved = Dataset(spark, str(tmp_path / "d"))
    train, validation = saved.train_and_validation()
    assert (train.count(), validation.count()) == (row.train_sequences, row.validation_sequences)
    assert DatasetOptions.from_metadata(saved.metadata()) == options
    assert saved.info().first().total_tokens == sum(map(len, clean))
    empty = Dataset(spark, str(tmp_path / "none"))
    assert empty.metadata().count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        empty.encoded()


def test_dataset_shorter_than_a_window(docs, tmp_path):
    row = dataset.process(docs("abc"), str(tmp_path / "d"), "short", DatasetOptions(seq_length=50)).first()
    assert row.total_sequences == 0 and row.inputs_min_value is None and row.inputs_rows == 0


def test_splits_are_stored_once_and_read_as_windows(spark, sequences, tmp_path):
    rows = sequences(list(range(40)), [7], list(range(100, 130)), None, list(range(50)))
    saved = Dataset(spark, str(tmp_path / "d"))
    saved.save_splits(splits.split_pieces(rows, 4, 0.3), 4)
    # a row for each document and one more for the one at the cut, not one for each window
    assert spark.read.parquet(str(tmp_path / "d/splits")).count() == 4
    ids = {r.doc_id: r.ids for r in rows.collect() if r.ids}
    windows = [(k, i, v[i : i + 4], v[i + 4]) for k, v in sorted(ids.items()) for i in range(len(v) - 4)]
    cut = int(len(windows) * 0.7)
    for part, want in zip(saved.train_and_validation(), (windows[:cut], windows[cut:])):
        got = part.select("doc_id", "start", "input", "target").orderBy("doc_id", "start").collect()
        assert [tuple(r) for r in got] == want
