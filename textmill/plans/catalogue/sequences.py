"""Windows, blocks, samples, splits and batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.operators import batches, leakage, sequences, splits
from textmill.plans.catalogue.base import (
    SEED,
    SQL_ENCODED,
    WINDOW,
    Tables,
    digest,
    query,
    spaced,
    sql_digest,
    sql_uniform,
    sql_weighed,
    weighed,
)

# Windows multiply the data by their length. These queries build every window of every
# text and return, per document, their number and the sum of a digest of each.
_L = WINDOW


def _sql_leads(first: int, last: int) -> str:
    """The tokens ``first`` to ``last`` places on, joined by spaces."""
    return "concat_ws(' ', " + ", ".join(f"x{k}" for k in range(first, last + 1)) + ")"


def _sql_toks(last: int) -> str:
    columns = ", ".join(f"lead(x0, {k}) OVER w AS x{k}" for k in range(1, last + 1))
    return f"""toks AS (
  SELECT doc_id, unnest(ids) AS x0, generate_subscripts(ids, 1) - 1 AS i FROM enc),
leads AS (SELECT doc_id, i, x0, {columns} FROM toks WINDOW w AS (PARTITION BY doc_id ORDER BY i))"""


_LEADS_SQL = _sql_toks(_L)


@query(
    "seq_windows",
    f"""WITH {SQL_ENCODED}, {_LEADS_SQL}
    SELECT doc_id, count(*) AS windows, sum({sql_digest(
        f"i || '|' || {_sql_leads(0, _L - 1)} || '|' || x{_L}"
    )})::BIGINT AS digest FROM leads WHERE x{_L} IS NOT NULL GROUP BY doc_id""",
)
def seq_windows(t: Tables):
    out = sequences.windows(t.named, _L)
    row = F.concat_ws("|", "start", F.concat_ws(" ", "input"), "target")
    return out.groupBy("doc_id").agg(
        F.count("*").alias("windows"), F.sum(digest(row)).alias("digest")
    )


@query(
    "seq_blocks",
    f"""WITH {SQL_ENCODED}, {_LEADS_SQL}
    SELECT doc_id, count(*) AS blocks, sum({sql_digest(
        f"i || '|' || {_sql_leads(0, _L - 1)} || '|' || {_sql_leads(1, _L)}"
    )})::BIGINT AS digest FROM leads WHERE x{_L} IS NOT NULL GROUP BY doc_id""",
)
def seq_blocks(t: Tables):
    out = sequences.blocks(t.named, _L)
    row = F.concat_ws("|", "start", F.concat_ws(" ", "x"), F.concat_ws(" ", "y"))
    return out.groupBy("doc_id").agg(
        F.count("*").alias("blocks"), F.sum(digest(row)).alias("digest")
    )


@query(
    "seq_count",
    f"""SELECT doc_id, greatest(length(text) - {_L}, 0)::INTEGER AS blocks FROM documents""",
)
def seq_count(t: Tables):
    return sequences.with_block_count(t.encoded, _L).select("doc_id", "blocks")


_PLACES = f"""places AS (
  SELECT doc_id, ids, greatest(len(ids) - {_L}, 0) AS n,
    coalesce(sum(greatest(len(ids) - {_L}, 0)) OVER (
      ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM enc)"""


@query(
    "sample_blocks",
    f"""WITH {SQL_ENCODED}, {_PLACES},
    draws AS (SELECT doc_id AS draw,
      floor({sql_uniform(SEED, 'doc_id')} * (SELECT sum(n) FROM places))::BIGINT AS point FROM documents)
    SELECT draw, doc_id, (point - before)::INTEGER AS start,
      array_to_string(ids[point - before + 1 : point - before + {_L}], ' ') AS x,
      array_to_string(ids[point - before + 2 : point - before + {_L} + 1], ' ') AS y
    FROM draws JOIN places ON point >= before AND point < before + n""",
)
def sample_blocks(t: Tables):
    draws = t("documents").select(F.col("doc_id").alias("draw"))
    out = sequences.sample_blocks(draws, t.encoded, _L, SEED)
    return out.select("draw", "doc_id", "start", spaced("x").alias("x"), spaced("y").alias("y"))


@query(
    "sample_blocks_norepl",
    f"""WITH {SQL_ENCODED}, s AS (
      SELECT doc_id, ids, unnest(range(0, greatest(len(ids) - {_L}, 0))) AS start FROM enc),
    picked AS (SELECT *, {sql_uniform(SEED, 'doc_id', 'start')} AS u FROM s
               ORDER BY u, doc_id, start LIMIT 640)
    SELECT doc_id, start::INTEGER AS start,
      array_to_string(ids[start + 1 : start + {_L}], ' ') AS x,
      array_to_string(ids[start + 2 : start + {_L} + 1], ' ') AS y FROM picked""",
)
def sample_blocks_norepl(t: Tables):
    # a sampling operator: 10 batches of 64
    out = sequences.sample_blocks_once(t.encoded, _L, 640, SEED)
    return out.select("doc_id", "start", spaced("x").alias("x"), spaced("y").alias("y"))


_BLOCK = 256


@query(
    "pack_blocks",
    f"""WITH {SQL_ENCODED}, stream AS (
      SELECT doc_id, unnest(list_append(ids, (SELECT count(*) FROM vocab)::INTEGER)) AS tok,
             generate_subscripts(list_append(ids, 0), 1) AS pos FROM enc),
    placed AS (SELECT tok, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM stream)
    SELECT place // {_BLOCK} AS block_id, string_agg(tok::VARCHAR, ' ' ORDER BY place) AS tokens
    FROM placed GROUP BY 1""",
)
def pack_blocks(t: Tables):
    separator = len(t.vocabulary)
    packed = sequences.pack(t.encoded.select("doc_id", "ids"), _BLOCK, separator)
    return packed.select("block_id", spaced("tokens").alias("tokens"))


@query(
    "causal_prefix_mean",
    """SELECT event_id, user_id, round(avg(value) OVER (
      PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 10) AS prefix_mean FROM events""",
)
def causal_prefix_mean(t: Tables):
    events = t("events").select("event_id", "user_id", "value")
    out = sequences.causal_prefix_mean(events, "user_id", "event_id", "value")
    return out.select("event_id", "user_id", F.round("prefix_mean", 10).alias("prefix_mean"))


@query(
    "adjacent_pairs",
    f"""WITH {SQL_ENCODED}, p AS (
      SELECT doc_id, ids, unnest(range(1, len(ids))) AS i FROM enc)
    SELECT doc_id, count(*) AS pairs, sum({sql_digest("ids[i] || '|' || ids[i + 1]")})::BIGINT AS digest
    FROM p GROUP BY doc_id""",
)
def adjacent_pairs(t: Tables):
    out = t.encoded.select("doc_id", F.inline(tokens.adjacent_pairs(F.col("ids"))))
    return out.groupBy("doc_id").agg(
        F.count("*").alias("pairs"), F.sum(digest(F.concat_ws("|", "prev", "next"))).alias("digest")
    )


# --- splits -----------------------------------------------------------------------------


@query(
    "split_contiguous",
    f"""WITH {SQL_ENCODED}, {_PLACES},
    w AS (SELECT doc_id, ids, before, unnest(range(0, n)) AS i FROM places),
    s AS (SELECT doc_id, CASE WHEN before + i < floor((SELECT sum(n) FROM places) * (1 - 0.1::DOUBLE))
        THEN 'train' ELSE 'validation' END AS split, i, {sql_weighed('ids', 'i', _L)} AS input, ids[i + {_L} + 1] AS target FROM w)
    SELECT doc_id, split, count(*) AS windows, min(i)::INTEGER AS first_start, max(i)::INTEGER AS last_start,
      sum(target)::BIGINT AS target_sum, sum(input)::BIGINT AS input_sum FROM s GROUP BY doc_id, split""",
)
def split_contiguous(t: Tables):
    out = splits.split_windows(t.encoded, _L, 0.1)
    return out.groupBy("doc_id", "split").agg(
        F.count("*").alias("windows"),
        F.min("start").alias("first_start"),
        F.max("start").alias("last_start"),
        F.sum("target").alias("target_sum"),
        weighed("input", _L).alias("input_sum"),
    )


@query(
    "split_tokens",
    f"""WITH {SQL_ENCODED}, o AS (
      SELECT doc_id, ids, len(ids) AS n, coalesce(sum(len(ids)) OVER (
        ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM enc),
    c AS (SELECT *, greatest(0, least(n, floor((SELECT sum(n) FROM o) * 0.9::DOUBLE) - before))::INTEGER AS k FROM o)
    SELECT doc_id, 'train' AS split, array_to_string(ids[1 : k], ' ') AS ids FROM c WHERE k > 0
    UNION ALL SELECT doc_id, 'validation', array_to_string(ids[k + 1 :], ' ') FROM c WHERE k < n""",
)
def split_tokens(t: Tables):
    return splits.split_tokens(t.encoded).select("doc_id", "split", spaced("ids").alias("ids"))


@query(
    "split_rows",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <=
      floor((SELECT count(*) FROM orders) * 0.9::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM orders""",
)
def split_rows(t: Tables):
    return splits.split_rows(t("orders").select("o_orderkey"), "o_orderkey", 0.9)


def _sql_order(*keys: str, seed: int = SEED) -> str:
    return f"ORDER BY {sql_uniform(seed, *keys)}, {', '.join(keys)}"


@query(
    "split_random",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN row_number() OVER ({_sql_order('l_orderkey', 'l_linenumber')})
      <= floor((SELECT count(*) FROM lineitem) * 0.8::DOUBLE) THEN 'train' ELSE 'validation' END AS split
    FROM lineitem""",
)
def split_random(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    return splits.split_random(t("lineitem").select(*keys), keys, 0.8, SEED)


@query(
    "split_three_way",
    f"""WITH r AS (SELECT doc_id, row_number() OVER ({_sql_order('doc_id')}) - 1 AS k,
        (SELECT count(*) FROM documents) AS n FROM documents)
    SELECT doc_id, CASE WHEN k < floor(n * 0.7::DOUBLE) THEN 'train'
      WHEN k < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM r""",
)
def split_three_way(t: Tables):
    return splits.split_three_way(t("documents").select("doc_id"), ["doc_id"], (0.7, 0.15, 0.15), SEED)


@query(
    "split_stratified",
    f"""SELECT event_id, event_type, CASE WHEN
      row_number() OVER (PARTITION BY event_type {_sql_order('event_id')}) <=
      floor(count(*) OVER (PARTITION BY event_type) * 0.8::DOUBLE)
      THEN 'train' ELSE 'validation' END AS split FROM events""",
)
def split_stratified(t: Tables):
    rows = t("events").select("event_id", "event_type")
    return splits.split_stratified(rows, "event_type", ["event_id"], 0.8, SEED)


# --- batches ----------------------------------------------------------------------------

_B = 32


@query(
    "batch_ordered",
    f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders)
    SELECT o_orderkey, k // {_B} AS batch_id, (k % {_B})::INTEGER AS place FROM r
    WHERE k // {_B} < (SELECT count(*) FROM orders) // {_B}""",
)
def batch_ordered(t: Tables):
    return batches.ordered(t("orders").select("o_orderkey"), "o_orderkey", _B, drop_last=True)


@query(
    "batch_shuffled",
    f"""WITH r AS (SELECT doc_id, row_number() OVER (
        ORDER BY {sql_uniform(SEED, '3', 'doc_id')}, doc_id) - 1 AS k FROM documents)
    SELECT doc_id, k // {_B} AS batch_id, (k % {_B})::INTEGER AS place FROM r""",
)
def batch_shuffled(t: Tables):
    return batches.shuffled(t("documents").select("doc_id"), ["doc_id"], _B, SEED, epoch=3)


@query(
    "batch_count",
    f"""SELECT (count(*) // {_B})::BIGINT AS dropped, ceil(count(*) / {_B})::BIGINT AS kept FROM orders""",
)
def batch_count(t: Tables):
    orders = t("orders")
    kept = batches.batch_count(orders, _B).scalar()
    return batches.batch_count(orders, _B, drop_last=True).select(
        F.col("batches").alias("dropped"), kept.alias("kept")
    )


@query(
    "batch_get",
    f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents)
    SELECT doc_id, (k % {_B})::INTEGER AS place FROM r WHERE k // {_B} = 5""",
)
def batch_get(t: Tables):
    numbered = batches.ordered(t("documents").select("doc_id"), "doc_id", _B)
    return batches.get_batch(numbered, 5).select("doc_id", "place")


@query(
    "batch_arrays",
    f"""WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders)
    SELECT k // {_B} AS batch_id, string_agg(o_orderkey::VARCHAR, ' ' ORDER BY k) AS inputs,
      string_agg(o_custkey::VARCHAR, ' ' ORDER BY k) AS targets FROM r GROUP BY 1""",
)
def batch_arrays(t: Tables):
    rows = t("orders").select("o_orderkey", "o_custkey")
    gathered = batches.gather(batches.ordered(rows, "o_orderkey", _B), ["o_orderkey", "o_custkey"])
    return gathered.select(
        "batch_id", spaced("o_orderkey").alias("inputs"), spaced("o_custkey").alias("targets")
    )


# --- overlap between splits -------------------------------------------------------------


@query(
    "leakage_values",
    f"""WITH s AS (SELECT value, row_number() OVER ({_sql_order('event_id')}) <=
        floor((SELECT count(*) FROM events) * 0.8::DOUBLE) AS train FROM events),
    x AS (SELECT count(*) AS n FROM (SELECT DISTINCT value FROM s WHERE train
          INTERSECT SELECT DISTINCT value FROM s WHERE NOT train))
    SELECT n > 0 AS has_leakage, n AS duplicates_found,
      'Found ' || n || ' duplicate values between splits' AS warning FROM x""",
)
def leakage_values(t: Tables):
    rows = splits.split_random(t("events").select("event_id", "value"), ["event_id"], 0.8, SEED)
    return leakage.shared_values(_part(rows, "train"), _part(rows, "validation"), "value")


def _part(rows: DataFrame, split: str) -> DataFrame:
    return rows.where(F.col("split") == split)


_RUN = 24


@query(
    "leakage_ngrams",
    f"""WITH {SQL_ENCODED}, {_sql_toks(_RUN - 1)},
    s AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) <=
        floor((SELECT count(*) FROM enc) * 0.9::DOUBLE) AS train FROM enc),
    g AS MATERIALIZED (SELECT DISTINCT doc_id, train, {_sql_leads(0, _RUN - 1)} AS run
      FROM leads JOIN s USING (doc_id) WHERE x{_RUN - 1} IS NOT NULL)
    SELECT doc_id, count(*) AS shared FROM g
    WHERE NOT train AND run IN (SELECT run FROM g WHERE train) GROUP BY doc_id""",
)
def leakage_ngrams(t: Tables):
    rows = splits.split_rows(t.encoded.select("doc_id", "ids"), "doc_id", 0.9)
    return leakage.shared_runs(_part(rows, "train"), _part(rows, "validation"), _RUN)
