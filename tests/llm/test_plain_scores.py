"""Operators 4, 5 and 8 computed plainly, text by text, from the same weights or profiles."""

import math
import random
import re
from collections import Counter

import pytest

from textmill.llm import arrays, language, quality, toxicity

M64 = 2**64 - 1


def slow_mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def slow_hash(content, seed):
    drawn, base = arrays._base(seed)
    total = sum(int(drawn[b]) * pow(base, k, 2**64) for k, b in enumerate(content))
    return slow_mix((total + len(content)) & M64)


@pytest.fixture
def texts(odd, words):
    long = " ".join(words(9, 60_000))  # beyond one run of rows
    rows = [(d, t) for d, t in odd if d is not None]
    return [*rows, (50, long), (51, "same same same\n\nsame"), (52, "Éa b 日本 x"), (53, "a" * 3000), (54, "aa bb cc aa"), (55, "b a")]


@pytest.fixture
def labels(spark, texts):
    ids = sorted({d for d, _ in texts})
    return spark.createDataFrame([(d, k % 2, (k + 1) % 2) for k, d in enumerate(ids)], "doc_id long, quality int, toxic int")


def slow_toxic(text, model):
    count = (len(model) - 1) // 2
    weight = dict(zip(model[1 : 1 + count].astype(int).tolist(), model[1 + count :].tolist(), strict=True))
    own = [slow_hash(w.encode(), 23) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())]
    found = set()
    for places, shape in ((0,), 1), ((0, 1), 2), ((0, 1, 2), 3), ((0, 2), 4), ((0, 3), 5):
        for k in range(len(own) - places[-1]):
            h = shape
            for p in places:
                h = (h * 0x9E3779B97F4A7C15 + own[k + p]) & M64
            found.add(slow_mix(h) >> 44)
    return 1 / (1 + math.exp(-(model[0] + sum(weight.get(b, 0.0) for b in found))))


def slow_quality(text, model):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = [slow_hash(w.encode(), 11) >> 47 for w in own]
    found += [0 for a, b in zip(own, own[1:]) if a == b]
    points = [32 if c in " \t\n\x0b\x0c\r" else ord(c) for c in text or ""]
    odd = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    for n in (3, 4, 5):
        for k in range(len(points) - n + 1):
            gram = points[k : k + n]
            if 32 not in gram[1:-1]:
                h = 0
                for p in gram:
                    h = (h * odd[0] + p) & M64
                found.append((((h ^ (h >> 29)) * odd[n - 3]) & M64) >> 47)
    return 1 / (1 + math.exp(-(sum(float(model[1 + b]) for b in found) / max(len(found), 1) + float(model[0]))))


@pytest.mark.parametrize(("module", "slow"), [(quality, slow_quality), (toxicity, slow_toxic)])
def test_scores_equal_the_plain_sums(table, texts, labels, module, slow):
    docs = table(texts)
    model = module.fit(docs, labels)
    got = sorted((r.doc_id, r.score) for r in module.scored(docs, labels).collect())
    want = sorted((d, slow(t, model)) for d, t in texts)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-7)


def slow_grams(text):
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    padded = f" {' '.join(letters.split(' '))} "
    padded = re.sub(" +", " ", padded)
    out = Counter()
    if padded.strip(" "):
        for n in (1, 2, 3):
            for k in range(len(padded) - n + 1):
                gram = padded[k : k + n]
                if gram == " " or (n == 3 and gram[1] == " "):
                    continue
                out[gram] += 1
    return out


def slow_order(counts, size):
    def key(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return value

    return sorted(counts, key=lambda g: (-counts[g], key(g)))[:size]


@pytest.mark.parametrize("size", [20, language.PROFILE])
def test_languages_by_the_definition_of_the_distance(table, texts, size):
    draw = random.Random(2)
    rows = [(d, t, draw.choice(["en", "de", "", None]), "s") for d, t in texts]
    rows += [(100, "aa bb", "t1", "s"), (101, "aa bb", "t2", "s"), (102, "aa", None, None)]  # equally near profiles
    learned = {}
    for _, text, lang, _ in rows:
        if lang:
            learned.setdefault(lang, Counter()).update(slow_grams(text))
    profiles = {lang: {g: k for k, g in enumerate(slow_order(c, size))} for lang, c in sorted(learned.items())}
    docs = table(rows)
    told = language.identify(docs.drop("lang"), language.learn(docs, size), "out", size).select("doc_id", "text", "out.*")
    for r in told.collect():
        own = slow_order(slow_grams(r.text), size)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        away = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(away, key=lambda lang: (away[lang], lang))
        assert r.lang_pred == best and r.score == pytest.approx(1 - away[best] / (size * len(own)), abs=1e-12)
