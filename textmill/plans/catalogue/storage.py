"""Sources and sinks: written to a fresh folder of shared storage and read back."""

from pyspark.sql import functions as F

from textmill.operators import bigram as bg
from textmill.operators import bytepair as bp
from textmill.operators import splits
from textmill.operators import vocabulary as vo
from textmill.plans import dataset
from textmill.plans.catalogue.base import (
    MERGES,
    SEED,
    SQL_ENCODED,
    SQL_VOCAB,
    WINDOW,
    Tables,
    digest,
    query,
    spaced,
    sql_digest,
    sql_ids,
    sql_subwords,
    sql_training,
    sql_uniform,
    sql_weighed,
    weighed,
)
from textmill.sources import store, text
from textmill.streaming import arrivals

_LINES_SQL = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"""


def _text_folder(t: Tables) -> str:
    """The documents as text files, one task's rows to a file."""
    folder = t.folder_for("text")
    t.documents.select("text").write.text(folder)
    return folder


def _totals(files):
    # every row ends in a line break, so the file's pieces are its lines and an empty end
    lines = files.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return lines.groupBy(F.lit("all").alias("files")).agg(
        F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"),
        F.sum(digest(F.col("line"))).alias("digest"),
    )


_TOTALS_SQL = f"""WITH {_LINES_SQL} SELECT 'all' AS files, count(*) AS lines,
  sum(length(line))::BIGINT AS chars, sum({sql_digest('line')})::BIGINT AS digest FROM lines WHERE line <> ''"""


@query("src_text_whole", _TOTALS_SQL)
def src_text_whole(t: Tables):
    return _totals(text.read_whole(t.spark, _text_folder(t)))


@query("src_text_dir", _TOTALS_SQL)
def src_text_dir(t: Tables):
    files = text.read_folder(t.spark, _text_folder(t))
    return _totals(files.where(F.col("error").isNull()))


@query("src_text_lines", _TOTALS_SQL)
def src_text_lines(t: Tables):
    lines = text.read_lines(t.spark, _text_folder(t))
    return _totals(lines.select(F.col("value").alias("text")))


@query("src_text_lenient", _TOTALS_SQL)
def src_text_lenient(t: Tables):
    # the same files with a stray byte at the head of every document, which is dropped again
    folder = t.folder_for("damaged")
    damaged = F.concat(F.unhex(F.lit("FF")).cast("string"), F.col("text"))
    t.documents.select(damaged.alias("text")).write.text(folder)
    return _totals(text.read_lenient(t.spark, folder))


@query("src_parquet", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_parquet(t: Tables):
    return text.read_table(t.spark, f"{t.folder}/documents.parquet")


_FRACTION = 0.1


@query(
    "sample_lines",
    f"""WITH {_LINES_SQL}, r AS (SELECT *, row_number() OVER (
        ORDER BY {sql_uniform(SEED, 'doc_id', 'line_no')}, doc_id, line_no) - 1 AS rank FROM lines)
    SELECT rank, line FROM r WHERE rank < floor((SELECT count(*) FROM lines) * {_FRACTION}::DOUBLE)
      AND rank < 200""",
)
def sample_lines(t: Tables):
    # a sampling operator: 200 lines of a random tenth
    lines = text.lines_of(t.documents)
    sample = text.sample_lines(lines, ["doc_id", "line_no"], _FRACTION, SEED, 200)
    return sample.select("rank", "line")


@query("sink_encoded", f"WITH {SQL_ENCODED} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM enc")
def sink_encoded(t: Tables):
    saved = store.Dataset(t.spark, t.folder_for("encoded"))
    saved.save_encoded(t.encoded.select("doc_id", "ids"))
    return saved.encoded().select("doc_id", spaced("ids").alias("ids"))


_SPLIT_SQL = f"""places AS (
  SELECT doc_id, ids, greatest(len(ids) - {WINDOW}, 0) AS n, coalesce(sum(greatest(len(ids) - {WINDOW}, 0)) OVER (
    ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM enc),
w AS (SELECT doc_id, ids, before, unnest(range(0, n)) AS i FROM places),
s AS (SELECT CASE WHEN before + i < floor((SELECT sum(n) FROM places) * (1 - 0.1::DOUBLE))
    THEN 'train' ELSE 'validation' END AS split, doc_id, i, {sql_weighed('ids', 'i', WINDOW)} AS input, ids[i + {WINDOW} + 1] AS target FROM w)"""


def _saved_splits(t: Tables) -> store.Dataset:
    saved = store.Dataset(t.spark, t.folder_for("splits"))
    saved.save_splits(splits.split_pieces(t.encoded, WINDOW, 0.1), WINDOW)
    return saved


@query(
    "sink_splits",
    f"""WITH {SQL_ENCODED}, {_SPLIT_SQL} SELECT split, doc_id, count(*) AS windows,
      sum(target)::BIGINT AS target_sum, sum(input)::BIGINT AS input_sum FROM s GROUP BY split, doc_id""",
)
def sink_splits(t: Tables):
    return _saved_splits(t).splits().groupBy("split", "doc_id").agg(
        F.count("*").alias("windows"), F.sum("target").alias("target_sum"), weighed("input", WINDOW).alias("input_sum")
    )


@query(
    "load_train_val",
    f"""WITH {SQL_ENCODED}, {_SPLIT_SQL} SELECT split, count(*) AS windows, count(DISTINCT doc_id) AS documents,
      sum(i)::BIGINT AS start_sum, sum(target)::BIGINT AS target_sum, sum(input)::BIGINT AS input_sum
    FROM s GROUP BY split""",
)
def load_train_val(t: Tables):
    train, validation = _saved_splits(t).train_and_validation()
    summary = [
        F.count("*").alias("windows"), F.countDistinct("doc_id").alias("documents"),
        F.sum("start").alias("start_sum"), F.sum("target").alias("target_sum"),
        weighed("input", WINDOW).alias("input_sum"),
    ]
    return train.groupBy("split").agg(*summary).unionByName(validation.groupBy("split").agg(*summary))


@query("sink_vocab", f"WITH {SQL_VOCAB} SELECT idx, ch FROM vocab")
def sink_vocab(t: Tables):
    saved = store.Dataset(t.spark, t.folder_for("vocab"))
    saved.save_vocabulary(vo.build_vocabulary(t.documents))
    return saved.vocabulary()


@query(
    "sink_metadata",
    f"""WITH {SQL_VOCAB} SELECT 'documents' AS dataset_name, 16 AS seq_length, 0.1::DOUBLE AS validation_split,
      false AS lowercase, false AS remove_special, 'utf-8' AS encoding, (SELECT count(*) FROM vocab) AS vocab_size,
      sum(length(text))::BIGINT AS encoded_tokens, sum(length(text))::DOUBLE AS text_length FROM documents""",
)
def sink_metadata(t: Tables):
    folder = t.folder_for("dataset")
    dataset.process(t.documents, folder, "documents", store.DatasetOptions(seq_length=16))
    metadata = store.Dataset(t.spark, folder).metadata()
    return metadata.select(
        "dataset_name", "config.*", "vocab_size", "encoded_tokens",
        F.col("stats")["text_length"].alias("text_length"),
    )


@query(
    "load_dataset",
    f"""WITH {SQL_ENCODED} SELECT doc_id, len(ids)::INTEGER AS tokens,
      list_sum(ids)::BIGINT AS id_sum, (SELECT count(*) FROM vocab) AS vocab_size FROM enc""",
)
def load_dataset(t: Tables):
    folder = t.folder_for("dataset")
    dataset.process(t.documents, folder, "documents", store.DatasetOptions(seq_length=16))
    saved = store.Dataset(t.spark, folder)
    size = saved.metadata().select("vocab_size").scalar()
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda a, i: a + i)
    return saved.encoded().select(
        "doc_id", F.size("ids").alias("tokens"), total.alias("id_sum"), size.alias("vocab_size")
    )


@query(
    "dataset_info",
    f"""WITH {SQL_VOCAB} SELECT count(*) AS total_rows, sum(length(text))::BIGINT AS total_tokens,
      (sum(length(text)) * 4)::BIGINT AS bytes, (SELECT count(*) FROM vocab) AS vocab_size FROM documents""",
)
def dataset_info(t: Tables):
    saved = store.Dataset(t.spark, t.folder_for("info"))
    saved.save_encoded(t.encoded.select("doc_id", "ids"))
    saved.save_vocabulary(t.vocabulary.to_table(t.spark))
    return saved.info()


_MERGES_SQL = " UNION ALL ".join(
    f"""SELECT {k} AS rank, unicode(substr(p, 1, 1)) AS "left", unicode(substr(p, 2, 1)) AS "right",
    {256 + k} AS new_id, freq::BIGINT AS freq FROM p{k}"""
    for k in range(MERGES)
)


@query("sink_tokenizer", f"WITH {sql_training(MERGES)} {_MERGES_SQL}")
def sink_tokenizer(t: Tables):
    folder = t.folder_for("tokenizer")
    store.save_tokenizer(t.spark, t.tokenizer, folder)
    return store.load_tokenizer(t.spark, folder).merges_table(t.spark)


@query("sink_tokens", f"WITH {sql_subwords()} SELECT doc_id, {sql_ids('s')} AS ids FROM bpe")
def sink_tokens(t: Tables):
    saved = store.Dataset(t.spark, t.folder_for("tokens"))
    saved.save_encoded(t.subwords.select("doc_id", "ids"))
    return saved.encoded().select("doc_id", spaced("ids").alias("ids"))


@query("decode_from_table", "SELECT doc_id, text FROM documents")
def decode_from_table(t: Tables):
    saved = store.Dataset(t.spark, t.folder_for("tokens"))
    saved.save_encoded(t.subwords.select("doc_id", "ids"))
    return saved.encoded().select("doc_id", bp.decode(F.col("ids"), t.tokenizer).alias("text"))


@query(
    "tokenize_corpus",
    f"""WITH {sql_subwords()} SELECT source, sum(length(s))::BIGINT AS tokens
    FROM bpe JOIN documents USING (doc_id) GROUP BY ROLLUP (source)""",
)
def tokenize_corpus(t: Tables):
    docs = t.documents.select("doc_id", "source", "text")
    return store.save_tokens_by_file(t.spark, docs, t.tokenizer, t.folder_for("corpus"))


@query(
    "sink_bigram",
    f"""WITH {SQL_ENCODED}, pairs AS (SELECT ids[i] AS prev, ids[i + 1] AS next
      FROM (SELECT ids, unnest(range(1, len(ids))) AS i FROM enc)),
    counts AS (SELECT prev, next, count(*) AS n FROM pairs GROUP BY ALL)
    SELECT prev, next, n, round((n + 1e-6::DOUBLE) / (sum(n) OVER (PARTITION BY prev)
      + 1e-6::DOUBLE * (SELECT count(*) FROM vocab)), 9) AS p FROM counts""",
)
def sink_bigram(t: Tables):
    folder = t.folder_for("bigram")
    store.save_bigram(bg.fit(t.encoded, len(t.vocabulary)), folder)
    loaded = store.load_bigram(t.spark, folder)
    return bg.probabilities(loaded).withColumn("p", F.round("p", 9))


@query("stream_clean_encode", f"WITH {sql_subwords()} SELECT doc_id, {sql_ids('s')} AS ids FROM bpe")
def stream_clean_encode(t: Tables):
    tokenizer = t.tokenizer
    schema = t("documents").schema
    out = t.folder_for("stream")
    arriving = arrivals.read_arrivals(t.spark, arrivals.table_path(f"{t.folder}/documents.parquet"), schema, "*")
    encoded = arrivals.clean_and_encode(arriving, tokenizer).select("doc_id", "ids")
    arrivals.write_available(encoded, out, t.folder_for("stream-state")).awaitTermination()
    return t.spark.read.parquet(out).select("doc_id", spaced("ids").alias("ids"))
