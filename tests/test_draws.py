import hashlib

import numpy as np
from pyspark.sql import functions as F

from textmill.functions import draws
from textmill.functions.hashing import gaussian, uniform
from textmill.operators import augment


def test_numbers_are_those_of_md5():
    heads, sizes = ["42|7|", "42|" + "x" * 60 + "|", "", "1|é|", "2|y|"], np.array([12_001, 3, 130, 11, 0])
    want = [
        int(hashlib.md5(f"{h}{i}|r".encode()).hexdigest()[:13], 16) for h, n in zip(heads, sizes) for i in range(n)
    ]
    assert draws.numbers(heads, sizes, "|r").tolist() == want
    assert draws.numbers([], np.zeros(0, np.int64)).tolist() == []


def test_arrays_of_draws_equal_single_draws(sequences):
    df = sequences([5] * 1200, [], None, [1, None, 3])
    ids = F.col("ids")
    got = df.select(
        draws.uniforms(9, "doc_id", ids).alias("a"),
        F.transform(ids, lambda _, i: uniform(9, "doc_id", i)).alias("b"),
        draws.gaussians(9, "doc_id", ids).alias("c"),
        F.transform(ids, lambda _, i: gaussian(9, "doc_id", i)).alias("d"),
    ).collect()
    for row in got:
        assert row.a == row.b
        assert (row.c is None) == (row.d is None) and np.allclose(row.c or [], row.d or [], rtol=1e-12, atol=1e-12)


def test_noise_and_mask_draw_in_batches_not_in_lambdas(sequences):
    df = sequences([1, 2, None, 4], None, [])
    masked = augment.mask(F.col("ids"), "doc_id", 0.5, -1, 3)
    noisy = df.select("doc_id", augment.add_noise(masked, "doc_id", 0.1, 3).alias("n"))
    plan = noisy._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan
    want = df.select(
        "doc_id",
        F.transform(
            "ids",
            lambda x, i: F.when(uniform(3, "doc_id", i) < 0.5, F.lit(-1)).otherwise(x) + gaussian(3, "doc_id", i) * 0.1,
        ).alias("n"),
    )
    a, b = ({r.doc_id: r.n for r in rows.collect()} for rows in (noisy, want))
    assert a[1] is b[1] is None and a[2] == b[2] == []
    assert [x is None for x in a[0]] == [x is None for x in b[0]]
    assert all(x is None or abs(x - y) < 1e-12 for x, y in zip(a[0], b[0]))
