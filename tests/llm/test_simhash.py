import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from textmill.llm import simhash


def slow_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(own[k : k + 3]) for k in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    root = list(range(len(prints)))
    for _ in prints:
        for i, j in combinations(range(len(prints)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[i] = root[j] = min(root[i], root[j])
    return root


def test_rows_equal_brute_force(table, odd):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(table(odd)).collect()))
    prints = [slow_print(t) for _, t in odd]
    root = slow_components(prints)
    ids = {r: min(d for (d, _), q in zip(odd, root, strict=True) if q == r and d is not None) for r in root}
    want = sorted((d is None, d or 0, f"{p:016x}", ids[r]) for (d, _), p, r in zip(odd, prints, root, strict=True))
    assert got == want


def test_every_pair_within_the_radius_agrees_under_a_mask():
    masks = [m & (2**64 - 1) for m in simhash.covering_masks()]
    for bits in combinations(range(64), 3):
        difference = sum(1 << b for b in bits)
        assert any(not m & difference for m in masks)


def test_split_buckets_keep_the_components(spark):
    draw = np.random.default_rng(1)
    chain, x = [], 0x0123456789ABCDEF
    for _ in range(300):  # a chain of small steps, and noise
        x ^= sum(1 << int(b) for b in draw.choice(20, 2, replace=False))
        chain.append(x)
    prints = sorted({*chain, *(int(v) for v in draw.integers(0, 2**63, 100))})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for bucket in (4096, 8):
        rooted = {r.node: r.root for r in simhash.components(simhash.links(df, bucket)).collect()}
        want = slow_components(prints)
        groups = {}
        for p, w in zip(prints, want, strict=True):
            groups.setdefault(w, set()).add(rooted.get(p, p))
        assert all(len(g) == 1 for g in groups.values())
        assert len({rooted.get(p, p) for p in prints}) == len(groups)


def test_keep_first_keeps_columns_and_one_of_each_group(table, odd):
    docs = table(odd)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    heads = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert kept.where(F.col("doc_id").isNotNull()).count() == heads
    assert simhash.near_duplicates(table([])).collect() == []
