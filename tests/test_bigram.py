import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textmill.operators import bigram as bg
from textmill.operators.joins import lookup_join
from textmill.sources import store

S = 1e-6


def table(df):
    return {(r.prev, r.next): r for r in df.collect()}


def test_counts_and_probabilities(spark, sequences):
    model = bg.fit(sequences([0, 1, 2, 1, 2, 3, 4]), 5)
    probs = table(bg.probabilities(model))
    assert probs[1, 2].n == 2
    assert math.isclose(probs[1, 2].p, (2 + S) / (2 + 5 * S))
    row = {r.next: r.p for r in bg.next_distribution(model, spark, 1).collect()}
    assert math.isclose(sum(row.values()), 1.0) and max(row, key=row.get) == 2
    unseen = [r.p for r in bg.next_distribution(model, spark, 4).collect()]
    assert all(math.isclose(p, 0.2) for p in unseen)
    with pytest.raises(ValueError):
        bg.next_distribution(model, spark, 5)


def test_bad_input(sequences):
    with pytest.raises(ValueError):
        bg.fit(sequences([0, 1]), 0)
    for ids in ([0, 5], [-1, 0]):
        with pytest.raises(ValueError, match="must be in range"):
            bg.fit(sequences(ids), 5)


@pytest.mark.parametrize("small", [True, False])
def test_scores(sequences, monkeypatch, small):
    if not small:
        monkeypatch.setattr(bg, "_BROADCAST_ROWS", 0)
    model = bg.fit(sequences([0, 1, 2, 3, 0, 1]), 4)
    rows = sequences([0, 1, 2], [3], [], [0, 9], [2, 0], None)
    got = {r.doc_id: r for r in bg.perplexity(bg.log_probability(rows, model)).collect()}
    want = math.log((2 + S) / (2 + 4 * S)) + math.log((1 + S) / (1 + 4 * S))
    assert math.isclose(got[0].log_prob, want) and math.isclose(got[0].perplexity, math.exp(-want / 2))
    assert got[1].log_prob == 0 and math.isnan(got[1].perplexity)
    assert got[2].log_prob == 0 and got[5].log_prob == 0
    assert got[3].log_prob == -math.inf and got[3].perplexity == math.inf
    assert math.isclose(got[4].log_prob, math.log(S / (1 + 4 * S)))


def test_no_smoothing_and_not_fitted(sequences):
    model = bg.fit(sequences([0, 1, 2, 0, 1]), 4, 0.0)
    got = {r.doc_id: r.log_prob for r in bg.log_probability(sequences([0, 1, 2], [1, 0], [3, 3]), model).collect()}
    assert got == {0: 0.0, 1: -math.inf, 2: -math.inf}
    empty = bg.fit(sequences([3]), 4)
    assert not empty.fitted
    assert math.isclose(bg.log_probability(sequences([0, 1, 2]), empty).first().log_prob, -2 * math.log(4))


def dense(model, temperature=1.0):
    n = {(r.prev, r.next): r.n for r in model.counts.collect()}
    v, s = model.vocab_size, model.smoothing
    rows = {}
    for a in range(v):
        total = sum(n.get((a, b), 0) for b in range(v))
        p = [(n.get((a, b), 0) + s) / (total + s * v) for b in range(v)]
        w = [math.exp(math.log(x + 1e-20) / temperature) for x in p]
        rows[a] = [x / sum(w) for x in w]
    return rows


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("temperature", [1.0, 0.5])
def test_top_k_equals_dense(spark, sequences, k, temperature):
    model = bg.fit(sequences([0, 1, 2, 1, 2, 3, 1, 1, 5, 0, 4]), 6, 0.01)
    got = table(bg.top_k(model, spark, k, temperature))
    for a, row in dense(model, temperature).items():
        best = sorted(range(6), key=lambda b: (-row[b], b))[:k]
        total = sum(row[b] for b in best)
        assert {b for p, b in got if p == a} == set(best)
        assert all(math.isclose(got[a, b].p, row[b] / total, rel_tol=1e-9) for b in best)


@pytest.mark.parametrize("threshold", [0.3, 0.9, 1.0])
@pytest.mark.parametrize("temperature", [1.0, 2.0])
def test_top_p_equals_dense(spark, sequences, threshold, temperature):
    model = bg.fit(sequences([0, 1, 2, 1, 2, 3, 1, 1, 5, 0, 4]), 7, 0.01)
    got = table(bg.top_p(model, spark, threshold, temperature))
    for a, row in dense(model, temperature).items():
        order, cum, best = sorted(range(7), key=lambda b: (-row[b], b)), 0.0, []
        for b in order:
            if cum >= threshold - 1e-12:
                break
            best.append(b)
            cum += row[b]
        mine = {b for p, b in got if p == a}
        assert mine == set(best) or (threshold == 1.0 and set(best) <= mine)
        assert math.isclose(sum(got[a, b].p for b in mine), 1.0)


def test_sampling(spark, sequences):
    model = bg.fit(sequences([0, 1, 2, 3, 0, 1, 0, 2]), 4)
    starts = spark.range(2000).select("id", F.lit(0).alias("start"))
    rows = bg.sample(starts, model, 3, 11, "id").collect()
    assert len(rows) == 2000 and all(len(r.ids) == 3 and r.ids[0] == 0 for r in rows)
    assert all(0 <= i < 4 for r in rows for i in r.ids)
    second = Counter(r.ids[1] for r in rows)
    assert abs(second[1] / 2000 - 2 / 3) < 0.05 and abs(second[2] / 2000 - 1 / 3) < 0.05
    again = bg.sample(starts.repartition(3), model, 3, 11, "id").collect()
    assert sorted(rows) == sorted(again)
    with pytest.raises(ValueError):
        bg.sample(starts, model, 0, 1, "id")


def test_long_walk_and_arguments(spark, sequences):
    model = bg.fit(sequences([0, 1, 2, 3, 0, 1, 0, 2]), 4)
    starts = spark.range(3).select("id", F.lit(0).alias("start"))
    rows = bg.sample_from(starts, bg.top_k(model, spark, 1), 40, 1, "id").collect()
    assert {tuple(r.ids[:5]) for r in rows} == {(0, 1, 0, 1, 0)} and len(rows[0].ids) == 40
    for bad in (lambda: bg.top_k(model, spark, 0), lambda: bg.top_p(model, spark, 0.0), lambda: bg.reshaped(model, 0)):
        with pytest.raises(ValueError):
            bad()


def test_save_and_load(spark, sequences, tmp_path):
    model = bg.fit(sequences([0, 1, 2, 3, 4, 5, 0, 1]), 6)
    store.save_bigram(model, str(tmp_path / "m"))
    loaded = store.load_bigram(spark, str(tmp_path / "m"))
    assert (loaded.vocab_size, loaded.smoothing, loaded.fitted) == (6, S, True)
    assert table(bg.probabilities(loaded)) == table(bg.probabilities(model))


def test_lookup_join_with_a_hot_key(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    lookup = spark.createDataFrame([(7, "hot"), (3, "three")], "k long, name string")
    got = Counter(r.name for r in lookup_join(big, lookup, ["k"], ["id"], "left").collect())
    want = Counter({7: "hot", 3: "three"}.get(r.k) for r in big.collect())
    assert got == want
    assert lookup_join(big, lookup, ["k"], ["id"], "left_semi").count() == want["hot"] + want["three"]


def test_sampling_refuses_a_start_outside_the_vocabulary(spark, sequences):
    model = bg.fit(sequences([0, 1, 2, 3]), 4)
    starts = spark.createDataFrame([(1, 99)], "doc_id long, start int")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bg.sample(starts, model, 4, 1).collect()
