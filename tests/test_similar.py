import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import repeats, similar
from textmill.operators.components import components
from textmill.sources.storage import cut_lineage, remove, shared_folder


def slow_set(text, words=5):
    own = (text or "").lower().split()
    return frozenset(" ".join(own[k : k + words]) for k in range(max(len(own) - words + 1, 1))) if own else None


def slow_near(texts, t=0.8):
    sets = {k: slow_set(x) for k, x in texts.items()}
    first = {}
    for k in sorted(sets):
        first.setdefault(sets[k], k)
    heads = {k: s for k, s in sets.items() if s and first[s] == k}
    near = {(a, b) for a, b in combinations(sorted(heads), 2) if len(heads[a] & heads[b]) / len(heads[a] | heads[b]) >= t}
    return {k: first[s] if s else k for k, s in sets.items()}, near


def slow_roots(nodes, links):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    out = {0: None, 1: "", 2: " \t", 3: "One two", 4: "one  TWO", 5: "one two three"}
    for group in range(6):
        base = [draw.choice(words) for _ in range(draw.randint(40, 90))]
        for _ in range(12):
            own = list(base)
            for _ in range(draw.randint(0, 1)):
                own[draw.randrange(len(own))] = draw.choice(words)
            out[len(out)] = " ".join(own[draw.randint(0, 2) :])
    shared = [draw.choice(words) for _ in range(30)]  # a passage that many different texts have
    for _ in range(40):
        out[len(out)] = " ".join([*shared, *(draw.choice(words) for _ in range(draw.randint(3, 60)))])
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_near_classes_and_groups_equal_brute_force(spark, texts, monkeypatch, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    classes, near = slow_near(texts)
    assert len(near) > 50
    members, pairs = similar.near_classes(docs)
    assert {(r.a, r.b) for r in pairs.collect()} == near and pairs.count() == len(near)
    assert {r.id: r.class_id for r in members.collect()} == classes
    roots = slow_roots(set(classes.values()), near)
    degree = {c: sum(c in pair for pair in near) for c in classes.values()}
    got = {r.id: (r.class_id, r.n_links, r.group_id) for r in similar.near_groups(docs).collect()}
    assert got == {k: (c, degree[c], roots[c]) for k, c in classes.items()}
    kept = {r.doc_id for r in similar.drop_near(docs).collect()}
    assert kept == set(roots[c] for c in classes.values())


def test_exact_thresholds(spark):
    # 35 and 28 shingles in common: 0.8 * 35 is a little above 28 as a float
    base = [f"x{k}" for k in range(39)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:32])), (3, " ".join(base[:31]))], "doc_id long, text string")
    assert {(r.a, r.b) for r in similar.near_classes(docs)[1].collect()} == {(1, 2), (2, 3)}


def test_minhash_finds_what_the_exact_join_finds(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, sets = similar.shingle_classes(docs)
    exact = {(r.a, r.b) for r in similar.near_sets(sets).collect()}
    found = {(r.a, r.b) for r in similar.near_sets_minhash(sets).collect()}
    assert found <= exact and len(found) >= 0.9 * len(exact)
    assert similar.chance(0.8) > 0.99


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert similar.near_groups(docs).collect() == [] and similar.drop_near(docs).collect() == []


def test_chains_stars_and_noise(spark):
    draw = random.Random(9)
    order = list(range(1000))
    draw.shuffle(order)
    links = list(zip(order, order[1:])) + [(2000, 2001 + k) for k in range(300)] + [(5000, 5000)]
    links += [(6000 + draw.randint(0, 200), 6000 + draw.randint(0, 200)) for _ in range(120)]
    df = spark.createDataFrame(links + links[:5], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    want = {}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {n: find(n) for n in list(parent)}
    assert got == want
    assert components(df.limit(0)).collect() == []


def test_only_tables_of_the_shared_folder_are_removed(spark, tmp_path):
    written = cut_lineage(spark.range(3).toDF("x"), "gone")
    path = written.inputFiles()[0]
    assert shared_folder(spark).rstrip("/").rsplit("/", 1)[-1] in path
    remove(written)
    spark.catalog.refreshByPath(shared_folder(spark))
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    spark.range(3).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    remove(kept)
    assert kept.count() == 3


def test_near_vectors(spark):
    draw = np.random.default_rng(4)
    base = draw.standard_normal((40, 16))
    rows = [v + 0.25 * draw.standard_normal(16) for v in base for _ in range(6)]
    rows += [rows[0], rows[0] * 2, np.zeros(16)]
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)] + [(999, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    unit = np.array([v / np.linalg.norm(v) for v in rows[:-1]])
    cosines = unit @ unit.T
    want = {(a, b) for a, b in combinations(range(len(unit)), 2) if cosines[a, b] >= 0.9 and b != 240}
    got = {(r.a, r.b) for r in similar.near_vectors(df).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 100
    assert similar.near_vectors(df.limit(0)).collect() == []


def test_planes_follow_the_rows():
    few, many = similar.planes_for(1000, 0.9, 0.95), similar.planes_for(10**9, 0.9, 0.95)
    assert few[0] < many[0] and few[1] < many[1]
    for planes, tables in (few, many):
        same = (1 - np.arccos(0.9) / np.pi) ** planes
        assert 1 - (1 - same) ** tables >= 0.95


def test_near_vectors_are_verified_in_their_buckets(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = np.repeat(rng.standard_normal((6, 12)), 50, axis=0) + rng.standard_normal((300, 12)) * 0.01
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id long, embedding array<double>")

    def moved(*_):
        raise AssertionError("vectors move once for each candidate")

    monkeypatch.setattr(similar, "_beside", moved)
    whole = {(r.a, r.b): r.cosine for r in similar.near_vectors(df).collect()}
    # buckets of several chunks
    monkeypatch.setattr(similar, "_CHUNK", 8)
    assert whole == {(r.a, r.b): r.cosine for r in similar.near_vectors(df).collect()}
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if a // 50 == b // 50}
    assert set(whole) <= want and len(whole) > 0.95 * len(want)


def test_rows_to_pair_are_computed_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def value(k):
        made.add(1)
        return k // 2

    pairs = similar.pairs_by_value(spark.range(10).select("id", value("id").alias("value")))
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(k, k + 1) for k in range(0, 10, 2)]
    assert made.value == 10


@pytest.mark.parametrize("block", [256, 3])
def test_minhash_pairs_have_all_rows_of_equal_sets(spark, monkeypatch, block):
    monkeypatch.setattr(similar, "BLOCK", block)
    draw = random.Random(7)
    words = [f"w{k}" for k in range(500)]
    out = {0: None, 1: "", 2: " ", 3: ""}
    for copies in (1, 2, 9, 20):
        base = [draw.choice(words) for _ in range(200)]
        for text in (base, [*base, "one"], [*base, "more", "two"]):  # far above the threshold, so found for certain
            for k in range(copies):
                out[len(out)] = " ".join(text).upper() if k % 2 else " ".join(text)
    sets = {k: slow_set(x) for k, x in out.items() if slow_set(x)}
    want = {(a, b): (len(sets[a] & sets[b]), len(sets[a] & sets[b]) / len(sets[a] | sets[b])) for a, b in combinations(sorted(sets), 2)}
    want = {pair: x for pair, x in want.items() if x[1] >= 0.8}
    docs = spark.createDataFrame(list(out.items()), "doc_id long, text string")
    got = similar.near_rows_minhash(docs).collect()
    assert {(r.a, r.b): (r.common, r.similarity) for r in got} == want and len(got) == len(want) > 2000


@pytest.mark.parametrize(("chunk", "block"), [(1024, 256), (16, 3)])
def test_near_vector_rows_are_all_pairs_at_the_cosine(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(similar, "_CHUNK", chunk)
    monkeypatch.setattr(similar, "BLOCK", block)
    draw = np.random.default_rng(8)
    base = draw.standard_normal((40, 24))
    rows = [v + 0.33 * draw.standard_normal(24) for v in base for _ in range(12)]  # many pairs just at the cosine
    rows += [rows[0]] * 10 + [rows[1] * 2] * 3 + [np.zeros(24)] * 2
    rows = [v.astype(np.float32) for v in rows]
    data = [(k, [float(x) for x in v]) for k, v in enumerate(rows)] + [(9000, None), (9001, [float("nan")] * 24), (9002, [float("nan")] * 24)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    unit = np.array([v / np.linalg.norm(v) if v.any() else v for v in np.array(rows, float)])
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.9, 1)), strict=True)}
    got = similar.near_vector_rows(df).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want) > 500
    assert all(abs(r.cosine - unit[r.a] @ unit[r.b]) < 1e-12 for r in got)
    near = {(r.a, r.b) for r in similar.near_vectors(df).collect()}
    assert {(a, b) for a, b in near} <= want
    part = {(r.a, r.b) for r in similar.near_vectors(df, recall=0.9).collect()}
    assert part <= near and len(part) > 0.8 * len(near)
    assert similar.near_vector_rows(df.limit(0)).collect() == []


def test_values_that_occur_in_two_sets_are_marked(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PENDING", 700)
    draw = np.random.default_rng(12)
    pool = draw.integers(-(2**63), 2**63 - 1, 4000)
    sets = {k: sorted({int(x) for x in draw.choice(pool, draw.integers(1, 60))}) for k in range(150)}
    sets |= {500: sets[3], 501: [-1, 0, 1], 502: [-(2**63), 2**63 - 1]}
    df = spark.createDataFrame(list(sets.items()), "id long, s array<long>").repartition(5)
    counts = Counter(x for own in sets.values() for x in own)
    found = {}
    for r in repeats.repeats(df, "s", 0.0).collect():
        assert r.n == len(sets[r.id])
        found.setdefault(r.id, []).append(r.value)
    for k, own in sets.items():
        again = {x for x in own if counts[x] > 1}
        assert again <= set(found.get(k, [])) <= set(own) and len(found.get(k, [])) == len(set(found.get(k, [])))
    marked = sum(map(len, found.values()))
    assert marked < 1.05 * sum(counts[x] > 1 for own in sets.values() for x in own)
    few = {r.id for r in repeats.repeats(df, "s", 0.9).collect()}
    assert 500 in few and 501 not in few and few < set(found)
    assert repeats.repeats(df.limit(0), "s", 0.9).collect() == []


def test_only_sets_that_can_be_near_are_taken_apart(spark, texts, monkeypatch):
    draw = random.Random(13)
    rows = dict(texts) | {1000 + k: " ".join(f"x{draw.randrange(10**9)}" for _ in range(200)) for k in range(100)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    moved, join = [], similar.lookup_join

    def spied(big, lookup, on, *rest, **named):
        moved.append((on, big.count(), lookup.count()))
        return join(big, lookup, on, *rest, **named)

    monkeypatch.setattr(similar, "lookup_join", spied)
    _, pairs = similar.near_classes(docs)
    assert {(r.a, r.b) for r in pairs.collect()} == slow_near(texts)[1]
    assert sum(n for on, n, _ in moved if on == ["value"]) < 10_000  # the others have about 20,000
    assert all(n < 100 for on, _, n in moved if on in (["a"], ["b"]))
