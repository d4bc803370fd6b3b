"""Byte-pair encoding."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.operators import batches
from textmill.operators import bytepair as bp
from textmill.plans.catalogue.base import (
    MERGES,
    SQL_GPT4,
    Tables,
    query,
    spaced,
    sql_bytes,
    sql_ids,
    sql_subwords,
    sql_text,
    sql_training,
)

_TRAINED = sql_training(MERGES)
_ENCODED = sql_subwords()


def _pair_ids(df: DataFrame) -> DataFrame:
    ids = tokens.symbols_to_ids(F.col("pair"))
    return df.select(
        F.get(ids, F.lit(0)).alias("left"), F.get(ids, F.lit(1)).alias("right"), "freq"
    )


@query(
    "bpe_pair_freq",
    f"""WITH {sql_training(0)} SELECT unicode(substr(p, 1, 1)) AS "left",
      unicode(substr(p, 2, 1)) AS "right", sum(n)::BIGINT AS freq
    FROM (SELECT substr(s, unnest(range(1, length(s))), 2) AS p, n FROM c0) GROUP BY 1, 2""",
)
def bpe_pair_freq(t: Tables):
    return _pair_ids(bp.pair_counts(bp.symbol_table(bp.distinct_chunks(t.documents))))


@query(
    "bpe_best_pair",
    f"""WITH {sql_training(1)} SELECT unicode(substr(p, 1, 1)) AS "left",
      unicode(substr(p, 2, 1)) AS "right", freq::BIGINT AS freq FROM p0""",
)
def bpe_best_pair(t: Tables):
    symbols = bp.symbol_table(bp.distinct_chunks(t.documents))
    return _pair_ids(bp.best_pairs(bp.pair_counts(symbols)))


@query(
    "bpe_merge_once",
    f"WITH {sql_training(1)} SELECT chunk, {sql_ids('s')} AS ids, n FROM c1 WHERE chunk <> ''",
)
def bpe_merge_once(t: Tables):
    chunk_table = bp.distinct_chunks(t.documents)
    first = bp.train(t.documents, bp.BYTES + 1).merges[0]
    merged = bp.apply_merge(
        tokens.utf8_symbols(F.col("chunk")), first.left, first.right, first.new_id
    )
    return chunk_table.select("chunk", spaced(tokens.symbols_to_ids(merged)).alias("ids"), "n")


@query(
    "bpe_train",
    f"WITH {_TRAINED} "
    + " UNION ALL ".join(
        f"""SELECT {k} AS rank, unicode(substr(p, 1, 1)) AS "left", unicode(substr(p, 2, 1)) AS "right",
        {256 + k} AS new_id, freq::BIGINT AS freq FROM p{k}"""
        for k in range(MERGES)
    ),
)
def bpe_train(t: Tables):
    return bp.train(t.documents, bp.BYTES + MERGES).merges_table(t.spark)


@query("bpe_encode", f"WITH {_ENCODED} SELECT doc_id, {sql_ids('s')} AS ids FROM bpe")
def bpe_encode(t: Tables):
    return t.subwords.select("doc_id", spaced("ids").alias("ids"))


@query("bpe_encode_by_chunk", f"WITH {_ENCODED} SELECT doc_id, {sql_ids('s')} AS ids FROM bpe")
def bpe_encode_by_chunk(t: Tables):
    encoded = bp.encode_by_chunk(t.documents.select("doc_id", "text"), t.tokenizer, keep_text=False)
    return encoded.select("doc_id", spaced("ids").alias("ids"))


def _sql_encode_texts(table: str, key: str) -> str:
    """The tokenizer of the documents applied to another table's texts."""
    symbols = sql_bytes("chunk")
    for k in range(MERGES):
        symbols = f"replace({symbols}, (SELECT p FROM p{k}), chr({256 + k}))"
    return f"""WITH {_TRAINED},
    other AS (SELECT {key}, unnest(ch) AS chunk, generate_subscripts(ch, 1) AS pos FROM (
      SELECT {key}, regexp_extract_all(text, {sql_text(SQL_GPT4)}) AS ch FROM {table})),
    done AS (SELECT chunk, {symbols} AS s FROM (SELECT DISTINCT chunk FROM other))
    SELECT {key}, {sql_ids("string_agg(s, '' ORDER BY pos)")} AS ids
    FROM other JOIN done USING (chunk) GROUP BY ALL"""


@query("bpe_encode_batch", _sql_encode_texts("conversations", "conv_id, turn"))
def bpe_encode_batch(t: Tables):
    texts = t("conversations")
    return texts.select(
        "conv_id", "turn", spaced(bp.encode_text(F.col("text"), t.tokenizer)).alias("ids")
    )


@query("bpe_decode", "SELECT doc_id, text FROM documents")
def bpe_decode(t: Tables):
    # an id that the vocabulary lacks is put in front and skipped by the decoder
    ids = F.concat(F.array(F.lit(999_999)), F.col("ids"))
    return t.subwords.select("doc_id", bp.decode(ids, t.tokenizer).alias("text"))


@query(
    "bpe_info",
    f"""WITH {_TRAINED}, m AS (SELECT count(*) AS n FROM ("""
    + " UNION ALL ".join(f"SELECT p FROM p{k}" for k in range(MERGES))
    + """))
    SELECT (256 + n)::INTEGER AS vocab_size, n::INTEGER AS num_merges, true AS trained,
      256 AS base_vocab_size, n::INTEGER AS merged_tokens FROM m""",
)
def bpe_info(t: Tables):
    return t.tokenizer.info(t.spark)


_CHAR_MERGES = 64


def _sql_character_training() -> str:
    # symbols here are the characters themselves; new ones are private-use characters
    parts = [
        r"""occ AS (
  SELECT doc_id, unnest(ch) AS chunk, generate_subscripts(ch, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS ch FROM documents))""",
        """c0 AS MATERIALIZED (
  SELECT chunk AS s, count(*) AS n, min(doc_id * 10000000 + pos) AS f FROM occ GROUP BY chunk)""",
    ]
    for k in range(_CHAR_MERGES):
        parts.append(
            f"""p{k} AS MATERIALIZED (
  SELECT p, freq FROM (
    SELECT substr(s, i, 2) AS p, sum(n) AS freq, min(f * 100000 + i) AS f
    FROM (SELECT s, n, f, unnest(range(1, length(s))) AS i FROM c{k}) GROUP BY 1)
  ORDER BY freq DESC, f LIMIT 1)"""
        )
        parts.append(
            f"""c{k + 1} AS MATERIALIZED (
  SELECT replace(s, (SELECT p FROM p{k}), chr({57344 + k})) AS s, n, f FROM c{k})"""
        )
    return ",\n".join(parts)


def _sql_expand() -> str:
    text = "p"
    for k in reversed(range(_CHAR_MERGES)):
        text = f"replace({text}, chr({57344 + k}), (SELECT p FROM p{k}))"
    return text


@query(
    "bpe_char_level",
    f"WITH {_sql_character_training()} "
    + " UNION ALL ".join(
        f"SELECT {k} AS rank, {_sql_expand()} AS token, freq::BIGINT AS freq FROM p{k}"
        for k in range(_CHAR_MERGES)
    ),
)
def bpe_char_level(t: Tables):
    trained = bp.train_characters(t.documents, t.vocabulary.chars, _CHAR_MERGES)
    table = trained.hex_table()
    rows = [(m.rank, bytes.fromhex(table[m.new_id]).decode(), m.freq) for m in trained.merges]
    return t.spark.createDataFrame(rows, "rank int, token string, freq long")


@query(
    "bpe_compression",
    f"""WITH {_ENCODED}, x AS (
      SELECT sum(length(text))::BIGINT AS c, sum(length(s))::BIGINT AS k
      FROM bpe JOIN documents USING (doc_id))
    SELECT c AS total_characters, k AS total_tokens,
      round((1 - k / c) * 100, 6) AS compression_ratio, round(c / k, 6) AS avg_chars_per_token FROM x""",
)
def bpe_compression(t: Tables):
    return bp.compression(t.subwords).select(
        "total_characters", "total_tokens",
        F.round("compression_ratio", 6).alias("compression_ratio"),
        F.round("avg_chars_per_token", 6).alias("avg_chars_per_token"),
    )


@query(
    "bpe_compression_texts",
    f"""WITH {_ENCODED} SELECT doc_id, length(text)::INTEGER AS characters, length(s)::INTEGER AS tokens,
      round((1 - length(s) / length(text)) * 100, 6) AS compression_ratio,
      round(length(text) / length(s), 6) AS avg_chars_per_token
    FROM bpe JOIN documents USING (doc_id)""",
)
def bpe_compression_texts(t: Tables):
    sized = t.subwords.select(
        "doc_id", F.length("text").alias("characters"), F.size("ids").alias("tokens")
    )
    out = bp.with_compression(sized, "characters", "tokens")
    return out.select(
        "doc_id", "characters", "tokens",
        F.round("compression_ratio", 6).alias("compression_ratio"),
        F.round("avg_chars_per_token", 6).alias("avg_chars_per_token"),
    )


_SWEEP = [256, 288, 320, 384]


@query(
    "bpe_vocab_sweep",
    f"WITH {_TRAINED}, chars AS (SELECT sum(length(text)) AS c FROM documents) "
    + " UNION ALL ".join(
        f"""SELECT {v} AS target_vocab, {v} AS actual_vocab, {v - 256} AS merges,
        sum(n * length(s))::BIGINT AS tokens,
        round((1 - sum(n * length(s)) / (SELECT c FROM chars)) * 100, 6) AS compression FROM c{v - 256}"""
        for v in _SWEEP
    ),
)
def bpe_vocab_sweep(t: Tables):
    rows = bp.compare_sizes(t.documents, t.tokenizer, _SWEEP)
    return rows.select(
        "target_vocab", "actual_vocab", "merges", "tokens", F.round("compression", 6).alias("compression")
    )


@query(
    "bpe_roundtrip",
    "SELECT count(*) AS total, count(*) AS successes, 0::BIGINT AS failures, 1.0::DOUBLE AS success_rate "
    "FROM documents",
)
def bpe_roundtrip(t: Tables):
    return bp.roundtrip_report(bp.roundtrip(t.subwords, t.tokenizer))


_SIZE = 16
_PADDED_SQL = f"""padded AS (
  SELECT doc_id, doc_id // {_SIZE} AS batch_id, string_split({sql_ids('s')}, ' ') AS ids,
    max(length(s)) OVER (PARTITION BY doc_id // {_SIZE}) AS longest FROM bpe)"""


@query(
    "pad_batch",
    f"""WITH {_ENCODED}, {_PADDED_SQL}
    SELECT doc_id, batch_id::BIGINT AS batch_id,
      array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda i: '0')), ' ') AS tokens,
      repeat('1', len(ids)) || repeat('0', longest - len(ids)) AS mask FROM padded""",
)
def pad_batch(t: Tables):
    batch = F.floor(F.col("doc_id") / _SIZE).cast("long")
    padded = batches.pad_batches(t.subwords, batch)
    return padded.select(
        "doc_id", "batch_id", spaced("tokens").alias("tokens"), F.array_join("mask", "").alias("mask")
    )


@query(
    "pad_batch_fixed",
    f"""WITH {_ENCODED}, x AS (SELECT doc_id, string_split({sql_ids('s')}, ' ')[1:512] AS ids FROM bpe)
    SELECT doc_id,
      array_to_string(list_concat(ids, list_transform(range(512 - len(ids)), lambda i: '0')), ' ') AS tokens,
      repeat('1', len(ids)) || repeat('0', 512 - len(ids)) AS mask FROM x""",
)
def pad_batch_fixed(t: Tables):
    padded = batches.pad_batches(t.subwords, F.lit(0), max_length=512)
    return padded.select(
        "doc_id", spaced("tokens").alias("tokens"), F.array_join("mask", "").alias("mask")
    )


@query("encode_distinct", f"WITH {_ENCODED} SELECT doc_id, {sql_ids('s')} AS ids FROM bpe")
def encode_distinct(t: Tables):
    encoded = bp.encode_distinct(t.documents.select("doc_id", "text"), t.tokenizer)
    return encoded.select("doc_id", spaced("ids").alias("ids"))


@query(
    "encode_safe",
    f"""WITH {_ENCODED} SELECT doc_id, 0 AS variant, {sql_ids('s')} AS ids FROM bpe
    UNION ALL SELECT doc_id, 1, '' FROM documents
    UNION ALL SELECT doc_id, 2, '-1' FROM documents""",
)
def encode_safe(t: Tables):
    # each text as it is, a blank one (empty result) and a missing one (the default)
    variants = F.array(F.col("text"), F.lit(" \n\t "), F.lit(None).cast("string"))
    texts = t.documents.select("doc_id", F.posexplode(variants).alias("variant", "text"))
    ids = bp.encode_safe(F.col("text"), t.tokenizer, F.array(F.lit(-1)))
    return texts.select("doc_id", "variant", spaced(ids).alias("ids"))


@query(
    "token_footprint",
    f"""WITH {_ENCODED}, b AS (
      SELECT doc_id // {_SIZE} AS batch_id, sum(length(s)) AS k, max(length(s)) AS longest FROM bpe GROUP BY 1)
    SELECT sum(k)::BIGINT AS num_tokens, (sum(k) * 8)::BIGINT AS token_tensor_bytes,
      (max(longest) * {_SIZE} * 8)::BIGINT AS batch_bytes FROM b""",
)
def token_footprint(t: Tables):
    return bp.token_footprint(t.subwords, F.floor(F.col("doc_id") / _SIZE), _SIZE)


@query(
    "truncate",
    f"""WITH {_ENCODED} SELECT doc_id, array_to_string(string_split({sql_ids('s')}, ' ')[1:64], ' ') AS ids FROM bpe""",
)
def truncate(t: Tables):
    return t.subwords.select("doc_id", spaced(tokens.truncate(F.col("ids"), 64)).alias("ids"))


@query(
    "crop_context",
    f"""WITH {_ENCODED} SELECT doc_id, array_to_string(string_split({sql_ids('s')}, ' ')[-64:], ' ') AS ids FROM bpe""",
)
def crop_context(t: Tables):
    return t.subwords.select("doc_id", spaced(tokens.crop_last(F.col("ids"), 64)).alias("ids"))
