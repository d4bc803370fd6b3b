"""Operators 4, 5 and 8: held-out accuracy and odd inputs."""

import random

import pytest

from textmill.llm import language, quality, toxicity


@pytest.fixture
def labelled(spark, table):
    draw = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        bad = k % 3 == 0
        own = [draw.choice(["tree", "water", "stone", "bird", "cloud", "river"]) for _ in range(40)]
        if bad:
            own[draw.randrange(40)] = "moron"
            own = [w + "%%%" for w in own]
        rows.append((k, " ".join(own)))
        labels.append((k, int(not bad), int(bad)))
    rows += [(900, None), (901, ""), (902, " \n"), (None, "tree"), (5, rows[5][1])]
    labels += [(900, 1, 0), (None, 1, 1), (901, None, None), (6, 7, 9)]
    return table(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_and_toxicity(labelled):
    docs, labels = labelled
    truth = {r.doc_id: r for r in labels.collect() if r.doc_id is not None and r.doc_id < 400 and r.quality in (0, 1)}
    for module, name in ((quality, "quality"), (toxicity, "toxic")):
        rows = module.scored(docs, labels).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        unseen = [r for r in rows if r.held_out and r.doc_id in truth]
        assert len(unseen) > 50 and all(r.predicted == truth[r.doc_id][name] for r in unseen)


def test_no_labels_and_one_class(spark, table, labelled):
    docs, labels = labelled
    for module, name in ((quality, "quality"), (toxicity, "toxic")):
        assert {r.score for r in module.scored(docs, labels.limit(0)).collect()} == {0.5}
        assert module.scored(docs.limit(0), labels).collect() == []
    one = module.scored(docs, labels.where("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in one if r.doc_id is not None and r.doc_id < 400)


def test_language(table):
    draw = random.Random(5)
    vocabulary = {"aa": ["alpha", "beta", "gamma"], "bb": ["ärger", "übel", "größe"], "cc": ["один", "два", "три"]}
    rows = [
        (k, " ".join(draw.choice(vocabulary[lang]) for _ in range(20)), lang, "s")
        for k, lang in enumerate(list(vocabulary) * 40)
    ]
    rows += [(500, None, "aa", "s"), (501, "", None, None), (502, "12 !? 3", "bb", "s"), (503, "ALPHA Beta", None, None)]
    got = {r.doc_id: r for r in language.identified(table(rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[k].lang_pred == lang for k, _, lang, _ in rows[:120])
    assert [got[k].lang_pred for k in (500, 501, 502, 503)] == ["und", "und", "und", "aa"]
    assert [got[k].score for k in (500, 501, 502)] == [0, 0, 0]
    docs = table(rows)
    kept = language.reject_unknown(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    junk = [(600 + k, "".join(draw.choice("qwzxjk;17 ") for _ in range(60 + 90 * k)), None, None) for k in range(4)]
    kept = {r.doc_id for r in language.reject_unknown(table([*rows, *junk])).collect()}
    assert kept == {r[0] for r in rows} - {500, 501, 502}
    assert language.reject_unknown(table([])).collect() == []
    assert language.identified(table([])).collect() == []
    assert {r.lang_pred for r in language.identified(table([(1, "abc", None, None)])).collect()} == {"und"}
