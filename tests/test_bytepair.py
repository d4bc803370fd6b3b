from collections import Counter

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textmill.functions.text import GPT4_CHUNKS, chunks
from textmill.operators import bytepair as bp
from textmill.operators import pair_training
from textmill.sources import store

FOX = [
    "The quick brown fox jumps over the lazy dog. ",
    "Tokenization splits text into tokens, tokens into bytes!",
    "Café résumé naïve: $99.99 or €85.50, 世界 мир aaaa aaa",
]


def train_in_memory(texts, merges):
    """The definition, on lists: most frequent pair first, the earlier one of equals."""
    seqs = [list(c.encode()) for t in texts for c in regex.findall(GPT4_CHUNKS, t)]
    learned = []
    for k in range(merges):
        counts = Counter()
        for s in seqs:
            counts.update(zip(s, s[1:]))
        if not counts:
            break
        pair = max(counts, key=counts.get)
        learned.append((*pair, counts[pair]))
        merged = []
        for s in seqs:
            out, i = [], 0
            while i < len(s):
                if tuple(s[i : i + 2]) == pair:
                    out.append(256 + k)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            merged.append(out)
        seqs = merged
    return learned, seqs


@pytest.fixture(scope="module")
def tokenizer(spark):
    df = spark.createDataFrame(list(enumerate(FOX)), "doc_id long, text string")
    return bp.train(df, 300)


def test_training_equals_the_definition(tokenizer):
    learned, _ = train_in_memory(FOX, 44)
    assert [(m.left, m.right, m.freq) for m in tokenizer.merges] == learned
    assert [m.new_id for m in tokenizer.merges] == list(range(256, 256 + len(learned)))


def test_training_runs_out_of_pairs(docs):
    learned, _ = train_in_memory(["hello hello world"], 44)
    trained = bp.train(docs("hello hello world"), 300)
    assert [(m.left, m.right, m.freq) for m in trained.merges] == learned
    assert len(trained) == 256 + len(learned) < 300


def test_overlapping_pairs_are_counted(docs):
    symbols = bp.symbol_table(bp.distinct_chunks(docs("aaa bbb ccc")))
    freq = {r.pair: r.freq for r in bp.pair_counts(symbols).collect()}
    assert freq["aa"] == 2 and freq[" b"] == 1


def test_bounds_and_errors(docs):
    with pytest.raises(ValueError, match=">= 256"):
        bp.train(docs("a"), 100)
    for blank in ("", "   \n\t  "):
        with pytest.raises(ValueError, match="cannot be empty"):
            bp.train(docs(blank), 300)
    with pytest.raises(RuntimeError, match="must be trained"):
        bp.encode_text(F.lit("x"), bp.UNTRAINED)
    with pytest.raises(RuntimeError, match="must be trained"):
        bp.decode(F.array(F.lit(1)), bp.UNTRAINED)
    untrained = bp.train(docs("some text"), 256)
    assert untrained.trained and len(untrained) == 256


TEXTS = ["hello world", "Hello! @#$% 123", "Café naïve", "Email: test@example.com (123)", "", "世界 мир 😀", "hello " * 2000]


def test_roundtrip_both_ways_of_encoding(docs, tokenizer):
    df = docs(*TEXTS, None)
    a = {r.doc_id: r.ids for r in bp.encode(df, tokenizer).collect()}
    b = {r.doc_id: r.ids for r in bp.encode_by_chunk(df, tokenizer).collect()}
    c = {r.doc_id: r.ids for r in bp.encode_distinct(df, tokenizer).collect()}
    assert a == b == c
    assert a[4] == [] and a[len(TEXTS)] is None
    encoded = bp.encode(docs(*TEXTS), tokenizer)
    assert dict(encoded.dtypes)["ids"] == "array<int>"
    checked = bp.roundtrip(encoded, tokenizer)
    report = bp.roundtrip_report(checked).first()
    assert (report.total, report.successes, report.failures, report.success_rate) == (len(TEXTS), len(TEXTS), 0, 1.0)
    assert bp.roundtrip_failures(checked).count() == 0


@pytest.mark.parametrize("stretch", [7, 1_000_000])
def test_encoding_by_chunk_moves_distinct_chunks_of_stretches(spark, tokenizer, monkeypatch, stretch):
    monkeypatch.setattr(bp, "_STRETCH", stretch)
    rows = [(k, f"s{k}", TEXTS[k % len(TEXTS)] * 20 if k % 9 else None) for k in range(60)]
    df = spark.createDataFrame([*rows, (None, "x", "hello"), (None, None, None)], "doc_id long, source string, text string").repartition(3)
    moved, join = [], bp.lookup_join
    monkeypatch.setattr(bp, "lookup_join", lambda big, *rest, **named: moved.append(big.count()) or join(big, *rest, **named))
    found = bp.encode_by_chunk(df, tokenizer)
    assert found.columns == ["doc_id", "source", "text", "ids"] and dict(found.dtypes)["ids"] == "array<int>"
    got = {r.doc_id: (r.source, r.text, r.ids) for r in found.where("doc_id IS NOT NULL").collect()}
    want = {r.doc_id: (r.source, r.text, r.ids) for r in bp.encode(df.where("doc_id IS NOT NULL"), tokenizer).collect()}
    assert got == want and sorted(r.ids is None for r in found.where("doc_id IS NULL").collect()) == [False, True]
    chunk_count = df.select(F.explode(chunks(F.col("text")))).count()
    assert sum(moved) < chunk_count / (10 if stretch > 7 else 1)
    narrow = bp.encode_by_chunk(df, tokenizer, keep_text=False)
    assert narrow.columns == ["doc_id", "source", "ids"]
    assert {r.doc_id: r.ids for r in narrow.where("doc_id IS NOT NULL").collect()} == {k: v[2] for k, v in want.items()}


def test_rows_of_one_key_get_the_chunks_of_all_by_place(spark, tokenizer):
    df = spark.createDataFrame([(1, "hello world"), (1, "hello world"), (1, None), (2, "other")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.ids) for r in bp.encode_by_chunk(df, tokenizer).collect()), key=str)
    a, b = ([r.ids for r in bp.encode(spark.createDataFrame([(x,)], "text string"), tokenizer).collect()][0] for x in ("hello", " world"))
    other = bp.encode(spark.createDataFrame([("other",)], "text string"), tokenizer).first().ids
    assert got == sorted([(1, "hello world", a + a + b + b)] * 2 + [(1, None, None), (2, "other", other)], key=str)


def test_encode_equals_training_sequences(docs, tokenizer):
    _, seqs = train_in_memory(FOX, 44)
    encoded = bp.encode(docs(*FOX), tokenizer).orderBy("doc_id").collect()
    assert [i for r in encoded for i in r.ids] == [i for s in seqs for i in s]


def test_decode_skips_unknown_and_mends_bytes(docs, tokenizer):
    ids = F.array(*[F.lit(i) for i in (72, 10000, 105, 0xE4, 33, -1)])
    assert docs("x").select(bp.decode(ids, tokenizer).alias("t")).first().t == "Hi�!"
    assert docs("x").select(bp.decode(F.array().cast("array<int>"), tokenizer).alias("t")).first().t == ""


def test_safe_encoding(docs, tokenizer):
    df = docs("a b", "  ", None).orderBy("doc_id")
    default = F.array(F.lit(-1))
    got = [r.e for r in df.select(bp.encode_safe(F.col("text"), tokenizer, default).alias("e")).collect()]
    assert got[1] == [] and got[2] == [-1] and len(got[0]) >= 2
    assert df.select(bp.encode_safe(F.col("text"), bp.UNTRAINED).alias("e")).first().e == []


def test_smaller_tokenizer_is_a_prefix(docs, tokenizer):
    small = bp.train(docs(*FOX), 270)
    assert small.merges == tokenizer.first(14).merges
    rows = bp.compare_sizes(docs(*FOX), tokenizer, [256, 270, 300]).collect()
    direct = [sum(len(r.ids) for r in bp.encode(docs(*FOX), tokenizer.first(n)).collect()) for n in (0, 14, 44)]
    assert [r.tokens for r in rows] == direct


def test_sizes_are_counted_by_distinct_chunks(docs, tokenizer):
    texts = [*FOX, None, "", "a" * 300 + " " + "the fox " * 50]
    table = bp.compare_sizes(docs(*texts), tokenizer, [300, 256, 257, 270, 400])
    direct = [
        sum(len(r.ids or []) for r in bp.encode(docs(*texts), tokenizer.first(n)).collect()) for n in (0, 1, 14, 44, 44)
    ]
    rows = table.collect()
    assert [(r.target_vocab, r.actual_vocab, r.tokens) for r in rows] == list(
        zip([256, 257, 270, 300, 400], [256, 257, 270, 300, 300], direct, strict=True)
    )
    # the texts are not rewritten once for each merge
    assert "replace(" not in table._jdf.queryExecution().toString().lower()
    assert [r.tokens for r in bp.compare_sizes(docs(None), tokenizer, [256, 300]).collect()] == [None, None]


def test_compression_guards_empty_input(docs, tokenizer):
    row = bp.compression(bp.encode(docs(""), tokenizer)).first()
    assert (row.total_characters, row.total_tokens, row.compression_ratio, row.avg_chars_per_token) == (0, 0, 0, 0)


def test_character_level_example(docs):
    words = ["bat", "cat", "cap", "sap", "map", "fap"]
    trained = bp.train_characters(docs(*words), sorted(set("".join(words))), 1)
    first = trained.merges[0]
    assert (trained.base[first.left], trained.base[first.right], first.freq) == ("a", "p", 4)
    assert first.new_id == len(trained.base)


def test_save_and_load(spark, docs, tokenizer, tmp_path):
    folder = str(tmp_path / "tok")
    store.save_tokenizer(spark, tokenizer, folder)
    loaded = store.load_tokenizer(spark, folder)
    assert loaded == tokenizer
    assert loaded.info(spark).first() == tokenizer.info(spark).first()
    with pytest.raises(AnalysisException):
        store.load_tokenizer(spark, str(tmp_path / "none"))


def test_certain_merges_only():
    class Row:
        def __init__(self, pair, freq):
            self.pair, self.freq = pair, freq

    # cd may follow ab at once; in the second list (x, a) could become (x, ab) and overtake
    assert len(pair_training.independent_prefix([Row("ab", 9), Row("cd", 5), Row("xa", 4)], 9)) == 2
    assert len(pair_training.independent_prefix([Row("ab", 9), Row("cd", 5), Row("xa", 5)], 9)) == 1
    assert len(pair_training.independent_prefix([Row("ab", 9), Row("bc", 5)], 9)) == 1
    assert len(pair_training.independent_prefix([Row("aa", 9), Row("bc", 5)], 9)) == 1


def test_many_merges_fold_and_batches(docs):
    text = " ".join(f"{a}{b}{c}" for a in "abcd" for b in "efgh" for c in "ijkl" for _ in range(1 + (ord(a) * ord(c)) % 3))
    learned, _ = train_in_memory([text], 90)
    trained = bp.train(docs(text), 256 + 90)
    assert [(m.left, m.right, m.freq) for m in trained.merges] == learned


def test_training_at_vocabulary_1000_equals_the_definition(spark, docs):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh é", k=rng.randint(2, 12))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(6)]
    learned, seqs = train_in_memory(texts, 744)
    trained = bp.train(docs(*texts), 1000)
    assert [(m.left, m.right, m.freq) for m in trained.merges] == learned
    got = {r.doc_id: r.ids for r in bp.encode(docs(*texts), trained).collect()}
    assert [x for k in sorted(got) for x in got[k]] == [x for s in seqs for x in s]


@pytest.mark.parametrize("kept", [3, 40])
def test_few_kept_counts_change_nothing(docs, monkeypatch, kept):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcd", k=rng.randint(2, 9))) for _ in range(60)]
    text = " ".join(rng.choices(words, weights=range(1, 61), k=900))
    learned, _ = train_in_memory([text], 60)
    monkeypatch.setattr(pair_training, "KEPT", kept)
    monkeypatch.setattr(pair_training, "CANDIDATES", 8)
    monkeypatch.setattr(pair_training, "PENDING", 5)
    monkeypatch.setattr(pair_training, "BLOCK", 100)
    assert [(m.left, m.right, m.freq) for m in bp.train(docs(text), 316).merges] == learned


def test_more_tied_pairs_than_candidates(docs):
    # 400 two-letter words that occur once each: every pair is as frequent as the others
    texts = [" ".join(chr(0x4E00 + 2 * k) for k in range(400))]
    learned, _ = train_in_memory(texts, 30)
    assert [(m.left, m.right, m.freq) for m in bp.train(docs(*texts), 286).merges] == learned


@given(st.lists(st.integers(0, 3), max_size=30), st.integers(0, 8))
@settings(max_examples=200, deadline=None)
def test_merging_a_chunk_follows_the_ranks(ids, merges):
    rng = random.Random(merges)
    known: list[tuple[int, int]] = []
    for k in range(merges):
        pair = (rng.randrange(4 + k), rng.randrange(4 + k))
        if pair not in known:
            known.append(pair)
    want = list(ids)
    for rank, pair in enumerate(known):
        out, i = [], 0
        while i < len(want):
            hit = tuple(want[i : i + 2]) == pair
            out.append(4 + rank if hit else want[i])
            i += 2 if hit else 1
        want = out
    # a merge may only use ids that are older than its own
    if all(max(p) < 4 + r for r, p in enumerate(known)):
        assert bp.merge_chunk(list(ids), {p: r for r, p in enumerate(known)}, 4) == want


@pytest.mark.parametrize("table", [0, 1 << 22])
def test_many_chunks_are_merged_as_one_by_one(monkeypatch, table):
    monkeypatch.setattr(bp, "_LONG", 40)
    monkeypatch.setattr(bp, "_TABLE", table)
    monkeypatch.setattr(bp, "_STRETCH", 100)
    draw = np.random.default_rng(7)
    merges, known = [], set()
    while len(merges) < 30:
        left, right = (int(x) for x in draw.integers(0, 4 + len(merges), 2))
        if (left, right) not in known:
            known.add((left, right))
            merges.append(pair_training.Merge(len(merges), left, right, 4 + len(merges), 0))
    chunks = [draw.integers(0, 4, n).tolist() for n in (*draw.integers(0, 30, 400), 200, 1, 0, 41)]
    chunks += [[k] * n for k in range(4) for n in (2, 3, 4, 5, 39)]
    symbols = np.array([x for c in chunks for x in c], np.int32)
    for some in (merges, merges[:1], []):
        ranks = bp._Ranks(some)
        book, start, size = bp.merge_chunks(symbols, np.array([len(c) for c in chunks]), ranks)
        got = [book[s : s + n].tolist() for s, n in zip(start, size, strict=True)]
        assert got == [bp.merge_chunk(list(c), ranks.of, 4) for c in chunks]
        order = draw.permutation(len(chunks))
        assert bp._laid_out(book, start, size, order).tolist() == [x for k in order for x in got[k]]
    assert [len(x) for x in bp.merge_chunks(symbols[:0], np.zeros(0, np.int64), ranks)] == [0, 0, 0]


def test_working_memory_follows_the_stretch_and_not_the_batch(tokenizer, monkeypatch):
    rows = pa.array([[f"{k}", " the", "fox"] * (k % 4) if k % 7 else None for k in range(300)])
    encode, count = bp._chunk_ids(tokenizer).func, bp._token_counts(tokenizer, [0, 44]).func
    whole = encode(rows).to_pylist()
    counts = [None if r is None else [sum(len(c) for c in r), len(i)] for r, i in zip(rows.to_pylist(), whole, strict=True)]
    assert count(rows).to_pylist() == counts
    seen, merge = [], bp.merge_chunks
    monkeypatch.setattr(bp, "_STRETCH", 20)
    monkeypatch.setattr(bp, "merge_chunks", lambda ids, size, ranks: seen.append(len(size)) or merge(ids, size, ranks))
    assert encode(rows).to_pylist() == whole and count(rows).to_pylist() == counts
    assert len(seen) > 20 and max(seen) <= 20 + 9
    assert encode(rows[:0]).to_pylist() == [] and encode(rows[:1]).to_pylist() == [None]


def test_blocks_of_a_batch_are_copied_one_at_a_time():
    made = [pair_training._packed(np.arange(10_000, dtype=np.int32), np.arange(k), np.arange(2)) for k in range(50)]
    batch = pa.Table.from_batches(made).combine_chunks().to_batches()[0]
    tracemalloc.start()
    for k, (symbols, n, first) in enumerate(pair_training._unpacked(iter([batch]))):
        assert len(symbols) == 10_000 and n.tolist() == list(range(k)) and first.tolist() == [0, 1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * 40_000


def test_a_task_keeps_no_chunks_between_batches(tokenizer):
    encode = bp._chunk_ids(tokenizer).func
    def kept(f):
        return [x for c in f.__closure__ or () for x in ([c.cell_contents] + (kept(c.cell_contents) if callable(c.cell_contents) else []))]

    held = kept(encode)
    texts = [regex.findall(GPT4_CHUNKS, t) for t in FOX]
    ids = encode(pa.array([texts[0], None, [], texts[2]])).to_pylist()
    flat = [i for row in ids if row for i in row]
    assert ids[1] is None and ids[2] == [] and flat == encode(pa.array([texts[0], texts[2]])).flatten().to_pylist()
    assert held and held == kept(encode) and not any(isinstance(x, dict) for x in held)


def test_pairs_are_looked_for_where_their_symbols_stand():
    draw = np.random.default_rng(5)
    chunks = [list(draw.integers(0, 5, draw.integers(1, 9))) for _ in range(400)]
    symbols = np.concatenate([np.array([*c, pair_training._END], np.int32) for c in chunks])
    n, first = np.arange(1, 401), np.arange(400)
    merges = [(0, 1), (2, 2), (6, 5), (7, 3)]
    pending = [pair_training.Merge(k, *pair, 5 + k, 0) for k, pair in enumerate(merges)]
    done = pair_training.merged(symbols, pending)
    for pair in [(8, 0), (7, 4), (5, 5), (3, 3), (4, 8)]:
        patterns = pair_training._written([pair], pending)
        some, own_n, own_first = pair_training._with(symbols, n, first, patterns)
        ends = np.flatnonzero(done == pair_training._END)
        hold = set(np.searchsorted(ends, pair_training._hits(done, *pair)))
        assert hold <= set(own_first) and (own_n == own_first + 1).all()
        assert [x for k in own_first for x in (*chunks[k], pair_training._END)] == list(some)
        # chunks without the symbols in a row are left out
        text = bytes(patterns[0].tolist())
        assert list(own_first) == [k for k, c in enumerate(chunks) if text in bytes(int(x) for x in c)]


def test_places_as_longs_and_as_decimals(spark):
    rows = [(7, "b a a"), (-3, "a c"), (2**40, "c d"), (None, "e a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bp._first_key(df, "doc_id") is None
    near = df.where("doc_id < 100 or doc_id is null")
    low = bp._first_key(near, "doc_id")
    assert low == -3
    as_longs = bp.distinct_chunks(near, low=low)
    assert dict(as_longs.dtypes) == dict(bp.distinct_chunks(near).dtypes)
    assert sorted(map(str, as_longs.collect())) == sorted(map(str, bp.distinct_chunks(near).collect()))
    assert "decimal" not in as_longs._jdf.queryExecution().toString()
