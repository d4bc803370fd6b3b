import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from textmill.llm import resampling


def slow_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [crc32(f.encode()) % 10000 for f in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]], len(words)


def slow_resample(rows, target):
    corpus = [slow_features(t) for _, t in rows]
    s, t = [0] * 10000, [0] * 10000
    for found, _ in corpus:
        for b in found:
            s[b] += 1
    for text in target:
        for b in slow_features(text)[0]:
            t[b] += 1
    all_s, all_t = sum(s) + 10000, sum(t) + 10000
    out = []
    for (d, _), (found, n) in zip(rows, corpus, strict=True):
        own = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in found]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([d, len(found), weight, score, n])
    able = sorted((-r[3], r[0] is None, r[0] or 0, k) for k, r in enumerate(out) if r[4] >= 20)
    rank = {k[-1]: i for i, k in enumerate(able[: 25 * len(able) // 100], 1)}
    return [(*r[:4], rank.get(k)) for k, r in enumerate(out)]


def in_order(rows):
    return sorted([tuple(r) for r in rows], key=lambda r: tuple((x is None, x or 0) for x in r))


def test_rows_equal_brute_force(table, odd, words):
    rows = [*odd, *((100 + k, " ".join(words(k, 25))) for k in range(30)), (200, "A" * 20), (201, "é-É_x " * 30)]
    target = [" ".join(words(k, 30)) for k in range(5)] + [None, "", "Ab ab"]
    bench = table(list(enumerate(target))).withColumnRenamed("doc_id", "item_id")
    got = in_order(resampling.resample(table(rows), bench).collect())
    assert got == in_order(slow_resample(rows, target))


def test_repeated_rows_across_the_cut(table, words):
    rows = [(7, " ".join(words(1, 30)))] * 40
    got = resampling.resample(table(rows), table([(0, "a")])).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 40


@pytest.mark.parametrize("spread", [3, 10**6])
def test_cutoff_is_the_row_in_place(spark, spread):
    draw = random.Random(spread)
    rows = [(draw.randint(-spread, spread), k) for k in range(3000)]
    inorder = sorted(rows, key=lambda r: (-r[0], r[1]))
    for parts in (1, 7):
        keys = spark.createDataFrame(rows, "score long, number long").repartition(parts).cache()
        for wanted in (1, 2, 750, 1500, 2999, 3000):
            assert resampling.cutoff(keys, wanted) == (inorder[wanted - 1], wanted - 1)
        assert resampling.cutoff(keys, 3001) is None and resampling.cutoff(keys, 0) is None


def test_uneven_partitions_and_order_within_them(spark):
    rows = [(k // 100, k) for k in range(2000)]  # each partition holds a range of the order
    keys = spark.createDataFrame(rows, "score long, number long").withColumn("p", F.least(F.lit(3), F.floor(F.col("number") / 50)))
    keys = keys.repartition(4, "p").drop("p")
    inorder = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert resampling.cutoff(keys, 500) == (inorder[499], 499)


def test_empty_tables(table):
    assert resampling.resample(table([]), table([(1, "a b")])).collect() == []
    got = resampling.resample(table([(1, None), (2, "a b")]), table([])).collect()
    assert in_order((r.doc_id, r.n_features, r["rank"]) for r in got) == [(1, 0, None), (2, 3, None)]
