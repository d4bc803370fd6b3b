"""Operators 2 and 9 against brute force."""

import hashlib

from textmill.llm import sketch, sketch_windows, suffix_merge


def brute(rows, units, length, join):
    first = {}
    for doc, text in rows:
        own = units(text or "")
        for k in range(len(own) - length + 1):
            key = tuple(own[k : k + length])
            first[key] = min(first.get(key, 1 << 62), 1 << 62 if doc is None else doc)
    out = []
    for doc, text in rows:
        own = units(text or "")
        gone = [False] * len(own)
        for k in range(len(own) - length + 1):
            if first[tuple(own[k : k + length])] < (1 << 63 if doc is None else doc):
                gone[k : k + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = hashlib.sha256(join(x for x, g in zip(own, gone, strict=True) if not g)).hexdigest()
        out.append((doc, len(own), sum(gone), spans, kept))
    return out


def key(row):
    return tuple(str(x) for x in row)


def test_words_equal_brute_force(table, odd):
    got = [tuple(r) for r in sketch_windows.dedup(table(odd)).collect()]
    want = [(d, n, g, k) for d, n, g, _, k in brute(odd, lambda t: t.encode().split(), 13, b" ".join)]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_bytes_equal_brute_force(table, odd):
    got = [tuple(r) for r in suffix_merge.dedup(table(odd)).collect()]
    want = brute(odd, lambda t: list(t.encode()), 50, bytes)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_small_flushes_and_a_full_sketch_give_the_same(table, odd, monkeypatch):
    # every cell is hit: all windows are compared exactly, from many shards
    want = sorted((tuple(r) for r in suffix_merge.dedup(table(odd)).collect()), key=key)
    monkeypatch.setattr(sketch, "bits_for", lambda n: 20)
    monkeypatch.setattr(sketch, "repeated", lambda bits, h: h == h)
    assert sorted((tuple(r) for r in suffix_merge.dedup(table(odd)).collect()), key=key) == want


def test_empty_table(table):
    assert sketch_windows.dedup(table([])).collect() == []
    assert suffix_merge.dedup(table([])).collect() == []


def test_interleave_orders_suffixes_and_finds_common_prefixes():
    import numpy as np

    texts = [b"banana", b"bananas", b"ananas", b"nab"]
    shard_of = [0, 0, 1, 2]
    symbol, following, owner, at = [], [], [], 0
    for k, t in enumerate(texts):
        symbol += [x + 1 for x in t] + [0]
        following += [*range(at + 1, at + len(t) + 1), at]
        owner += [shard_of[k]] * (len(t) + 1)
        at += len(t) + 1
    symbol, following, owner = np.array(symbol, np.uint16), np.array(following), np.array(owner, np.uint8)
    before = np.empty_like(following)
    before[following] = np.arange(at)
    order = suffix_merge.transforms(symbol, following, owner)
    merged, common, block = suffix_merge.interleave(symbol[before[order]], owner[order], 4)

    def prefix(p):
        out = []
        for _ in range(4):
            out.append(int(symbol[p]))
            p = following[p]
        return out

    found = [prefix(p) for p in order[merged]]
    assert found == sorted(found)
    for k in range(1, len(found)):
        same = next((i for i in range(4) if found[k][i] != found[k - 1][i]), 4)
        assert common[k] == same and (block[k] == block[k - 1]) == (same == 4)
