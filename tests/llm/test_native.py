"""Operators 6, 7 and 10, and operator 1."""

import random
import re
from collections import Counter

import duckdb

from textmill.llm import decontamination, line_chunks, mixing, outliers


def test_base_counts_equal_brute_force(table, odd):
    rows = [*odd, (20, "a b c a b c"), (21, "x#y | %\nl1\nl1\n \n\n l1\n"), (22, "a a a a")]
    got = sorted(tuple(str(x) for x in r[:7]) for r in outliers.rules(table(rows)).collect())
    want = []
    for doc, text in rows:
        text = text or ""
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = list(zip(own, own[1:], own[2:], strict=False))
        counts = Counter(grams)
        covered = {k + i for k, g in enumerate(grams) if counts[g] > 1 for i in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        row = (doc, len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)
        want.append(tuple(str(x) for x in row))
    assert got == sorted(want)


def test_outliers_go_and_others_stay(table, words):
    rows = [(k, " ".join(words(k, 80 + k % 50)), "en" if k % 4 else None, "hot" if k % 3 else "s") for k in range(300)]
    rows += [(1000 + k, " ".join(w + "%%%%%%" for w in words(k, 90)), "en", "hot") for k in range(20)]
    rows += [(2000 + k, " ".join(words(7, 90)), "en", "hot") for k in range(100)]  # copies
    rows += [(3000, " ".join(words(8, 90)), "rare", "rare")]
    got = {r.doc_id: r.kept for r in outliers.rules(table(rows)).collect()}
    assert all(got[d] == (not 1000 <= d < 2000) for d in got) and len(got) == len(rows)
    assert outliers.rules(table([])).collect() == []


def test_chunks_join_up_and_repeats_go(table, spark):
    draw = random.Random(1)
    passage = [f"line {draw.random()}" for _ in range(40)]
    rows = [(k, "\n".join([*(f"own {draw.random()}" for _ in range(k)), *passage, f"end {k}"])) for k in range(1, 6)]
    rows += [(10, None), (11, ""), (12, "\n\n\n"), (None, rows[0][1]), (3, rows[2][1]), (13, "one\ntwo")]
    docs = table(rows)
    joined = docs.select("text", line_chunks.line_array(docs.text).alias("c")).collect()
    assert all(r.text is None or "\n".join(r.c) == r.text for r in joined)
    left = line_chunks.dedup(docs)
    assert left.columns == docs.columns and left.count() == len(rows)
    seen = Counter(line for r in left.collect() if r.text for line in r.text.split("\n"))
    assert all(seen[x] == 1 for x in passage)
    assert all(seen[f"end {k}"] >= 1 for k in range(2, 6))
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[10] is None and texts[11] == "" and texts[12] == "\n\n\n" and texts[13] == "one\ntwo"
    assert line_chunks.dedup(docs, detail=True).count() == len(rows)
    assert line_chunks.dedup(table([])).count() == 0


def test_repeated_lines_or_words_alone_make_an_outlier(table, words):
    def lined(own, n=8):
        return "\n".join(" ".join(own[k : k + n]) for k in range(0, len(own), n))

    rows = [(k, lined(words(k, 80 + k % 40))) for k in range(300)]
    # one line again in a text of few lines is not extreme
    rows += [(500 + k, "\n".join([lined(words(k + 500, 90), 30), " ".join(words(k + 500, 8))])) for k in range(3)]
    rows += [(1000 + k, "\n".join(f"{w}\nabcde\nbcde" for w in words(k + 1000, 30))) for k in range(3)]
    for k in range(3):
        own, twice = words(k + 2000, 50), words(k + 3000, 24)
        rows.append((2000 + k, lined([*twice, *own, *twice])))
    got = {r.doc_id: r for r in outliers.rules(table(rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[d].n_dup_lines == 58 and got[d].n_repeat_words == 0 for d in range(1000, 1003))
    assert all(got[d].n_dup_lines == 0 and got[d].n_repeat_words == 48 for d in range(2000, 2003))
    assert not any(got[d].kept for d in got if d >= 1000)
    assert sum(r.kept for d, r in got.items() if d < 300) >= 297 and all(got[d].kept for d in range(500, 503))


def test_repeated_passages_of_any_length_go_whole(table, monkeypatch):
    draw = random.Random(3)
    lines = lambda n: [f"line {draw.random()}" for _ in range(n)]
    passages = {n: lines(n) for n in range(2, 16)}
    rows = [(n, "\n".join([*lines(2), "", *p, "", *lines(2)])) for n, p in passages.items()]
    own = {n: (lines(2), lines(2)) for n in passages}
    rows += [(100 + n, "\n".join([*own[n][0], *p[:2], "", *p[2:], *own[n][1]])) for n, p in passages.items()]
    rows += [(200 + n, "\n".join([*own[n][1], "\n", *p, *own[n][0]])) for n, p in passages.items()]
    single = rows[0][1].split("\n")[0]
    rows += [(300, "\n".join(["before", single, "after"])), (301, "same\nsame\nsame\nsame")]
    texts = {r.doc_id: r.text for r in line_chunks.dedup(table(rows)).collect()}
    assert all(texts[d] == t for d, t in rows if d < 100 or d == 300)
    for n, p in passages.items():
        # a blank line parts the copy: behind it nothing, one line that is alone, or a passage is left
        assert texts[100 + n].split("\n") == [*own[n][0], *([""] if n < 4 else []), *(p[2:] if n == 3 else []), *own[n][1]]
        assert texts[200 + n].strip() == ""
    seen = Counter(line for t in texts.values() for line in t.split("\n") if line)
    assert set(seen) == {line for _, t in rows for line in t.split("\n") if line.strip()} and seen["same"] == 1
    kept = {r.doc_id for r in line_chunks.drop_repeated(table(rows)).collect()}
    assert kept == {d for d, _ in rows if not 200 <= d < 300}
    monkeypatch.setattr(line_chunks, "_BROADCAST_HASHES", 0)
    again = table([*rows, (None, rows[0][1]), (2, rows[0][1])])
    shuffled = {r.doc_id: r.text for r in line_chunks.dedup(again).collect()}
    assert shuffled == texts | {None: rows[0][1], 2: ""}


def test_mixing_equals_sql_and_meets_targets(table, odd):
    draw = random.Random(2)
    rows = [(d, t, "en", draw.choice(["a", "b", None])) for d, t in odd]
    rows += [(None, "w " * k, "en", "c") for k in range(4)]
    rows += [(100 + k, "w " * draw.randint(0, 30), "en", "b" if k % 3 else "c") for k in range(200)]
    rows += [(900, None, "en", "empty"), (901, "", "en", "empty")]
    docs = table(rows)
    got = mixing.mix(docs).toPandas().astype({"doc_id": "Int64"})
    documents = docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})  # (read by the SQL)
    want = duckdb.sql(mixing.MIX_SQL.format(docs="documents")).df()[list(got.columns)].astype({"doc_id": "Int64"})
    assert documents.doc_id.isna().any()
    order = ["doc_id", "size", "taken"]
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (got, want))
    a["source"], b["source"] = a.source.fillna("-"), b.source.fillna("-")
    assert a.astype(str).equals(b.astype(str))
    assert (got.taken <= 2 * got["size"]).all()
    per = a.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((per.target - per.taken).between(0, 1)).all()
    assert mixing.mix(table([])).collect() == []
    assert mixing.mixed(docs).columns == [c for c in docs.columns if c != "taken"] + ["taken"]


def _slow_lines(rows):
    """By definition: lines of a pair that stands earlier go, with the blank lines before them."""
    out, seen = {}, set()
    for d, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[d] = None
            continue
        units, held = [], []
        for line in text.split("\n"):
            held.append(line)
            if re.search(r"[^\x20\x09-\x0D]", line):
                units.append(held)
                held = []
        gone = set()
        for k in range(len(units) - 1):
            pair = "\n".join([units[k][-1], *units[k + 1]])
            if pair in seen:
                gone |= {k, k + 1}
            seen.add(pair)
        left = [line for k, u in enumerate(units) if k not in gone for line in u]
        out[d] = "\n".join([*left, *held])
    return out


def _line_rows(seed, n):
    draw = random.Random(seed)
    passages = [[draw.choice(["", "a", f"p{k}{j}", f"q{j}", " \t"]) for j in range(k + 2)] for k in range(14)]
    rows = [(0, None), (1, ""), (2, "\n \n"), (3, "x"), (4, "x\n"), (5, "x\ny"), (6, "x\ny\n\n"), (7, "x\n\ny")]
    for d in range(10, 10 + n):
        lines = []
        for _ in range(draw.randint(1, 5)):
            passage = draw.choice(passages)
            first = draw.randrange(len(passage))
            lines += passage[first : draw.randint(first, len(passage))] if draw.random() < 0.4 else passage
            lines += [f"own {d} {draw.random()}" for _ in range(draw.randint(0, 2))]
        rows.append((d, "\n".join(lines)))
    return rows


def test_lines_equal_brute_force_and_sql(spark, table, monkeypatch):
    rows = _line_rows(8, 150)
    docs = table(rows)
    got = {r.doc_id: r for r in line_chunks.dedup(docs, detail=True).collect()}
    want = _slow_lines(rows)
    assert {d: r.text for d, r in got.items()} == want
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841  (read by the SQL)
    sql = duckdb.sql(line_chunks.LINES_SQL.format(docs="documents")).fetchall()
    assert {tuple(r) for r in got.values()} == {tuple(r) for r in sql}
    monkeypatch.setattr(line_chunks, "_BROADCAST_HASHES", 0)
    assert {r.doc_id: r.text for r in line_chunks.dedup(docs).collect()} == want


def test_chunks_are_cut_alike_after_a_shift(table):
    draw = random.Random(4)
    passage = [f"line {draw.random()}" for _ in range(60)]
    rows = [(k, "\n".join([*(f"own {draw.random()}" for _ in range(k)), *passage])) for k in range(4)]
    found = line_chunks._units(table(rows), line_chunks._chunks).collect()
    assert all(r.n >= 2 for r in found)
    shared = Counter(r.h for r in found)
    # all chunks but the one at the border of the passage
    assert all(sum(shared[r.h] == 4 for r in found if r.doc_id == k) >= len([r for r in found if r.doc_id == k]) - k - 1 for k in range(4))
    assert 10 < sum(n == 4 for n in shared.values()) < 30
    within = line_chunks._units(table(rows[:1]), line_chunks._pairs).collect()
    starts = {r.place for r in found if r.doc_id == 0}
    assert len(within) == 59
    assert all(r.within in starts and r.within <= r.place for r in within if r.within >= 0)
    assert all((r.within < 0) == (r.place + 1 in starts) for r in within)


QUESTION = "Tom has 12 apples and buys 7 kg of pears, then Tom gives 12 plums away to friends nearby"


def test_templates(spark, table):
    benchmark = spark.createDataFrame(
        [(1, QUESTION), (2, None), (3, ""), (4, "what is 5 plus"), (5, "no"), (1, QUESTION), (None, "x y z u")],
        "item_id long, text string",
    )
    filler = "Once there was a long and quiet day near the sea"
    again = "Ann has 31 apples and buys 9 lb of pears, then Ann gives 31 plums away to friends nearby"
    broken = "Ann has 31 apples and buys 9 lb of pears, then Bob gives 44 plums away to friends nearby"
    rows = [
        (1, f"{filler}. {QUESTION}. {filler}"), (2, f"{filler}. {again}. {filler}"), (3, f"{filler}. {broken}. {filler}"),
        (4, filler), (5, None), (6, ""), (7, "so what is 8 plus two"), (None, QUESTION), (1, f"{filler}. {QUESTION}. {filler}"),
        (8, QUESTION.upper()), (9, "… " + QUESTION.replace(" ", "%%% ")),
    ]
    docs = table(rows)
    got = {(r.doc_id, r.item_id): r.verbatim for r in decontamination.contamination(docs, benchmark).collect()}
    assert got[1, 1] is True and got[2, 1] is False and (9, 1) in got
    assert not any(d in (3, 4, 5, 6) for d, _ in got)
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {3, 4, 5, 6, None}
    assert decontamination.contamination(table([]), benchmark).collect() == []
    assert decontamination.contamination(docs, benchmark.limit(0)).collect() == []


def _pairs(spark, table, items, texts):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontamination.contamination(table(list(enumerate(texts))), benchmark).collect()}


def test_one_altered_slot_does_not_clear_a_copy(spark, table, words):
    a, b = (" ".join(words(s, 20)) for s in (1, 2))
    item = f"on a day Tom met 12 men {a} and then Tom met 12 men {b} before Tom left with 5 apples and 3 pears"
    texts = [
        item.replace("then Tom", "then Tim"), item.replace("and then Tom met 12", "and then Tom met 13"),
        item.replace("5 apples", "4 apples").replace("3 pears", "4 pears"),
        item.replace("Tom", "Ann").replace("met 12", "met 77").replace("then Ann met 77", "then Ann met 78"),
    ]
    assert _pairs(spark, table, [item], [*texts, "on a day Tom met 12 men and left"]) == {(k, 0) for k in range(4)}


def test_items_of_few_words_or_many_slots_match(spark, table):
    items = ["What is 17 + 25?", "from 1 2 3 4 5 6 and so", "see 1 2 3 4 5 6 7 8 9 10 11 12 13", "red 4 5 6 7 8 9 old green house"]
    texts = [f"I ask you. {t} Thanks" for t in items] + ["red 9 8 7 6 5 4 old green house"]
    assert _pairs(spark, table, items, texts) >= {(k, k) for k in range(4)} | {(4, 3)}
    assert _pairs(spark, table, items, ["what is 18 + 25?", "see 2 2 3 4 6 6 7", "red 4 5 6"]) == set()


def test_capitals_and_line_ends_do_not_hide_a_copy(spark, table):
    item = "Once Anna went from Paris to the Große Straße with Otto and then with Emil home to Rome and Anna was glad"
    texts = [item.upper(), item.lower(), item.title(), item.replace(" ", "\n"), "\n".join(re.findall(r"\S+ \S+ ?\S*", item))]
    assert _pairs(spark, table, [item], [*texts, "Once Anna went home"]) == {(k, 0) for k in range(5)}


def test_templates_without_the_sent_array(spark, table, monkeypatch):
    benchmark = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    docs = table([(1, "A day. " + QUESTION), (2, "nothing of the kind")])
    want = decontamination.contamination(docs, benchmark).collect()
    monkeypatch.setattr(decontamination, "MAX_SENT", 0)
    assert decontamination.contamination(docs, benchmark).collect() == want and len(want) == 1
