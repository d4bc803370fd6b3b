"""The counted bigram model on character ids."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators import bigram as bg
from textmill.operators import splits
from textmill.plans.catalogue.base import (
    SEED,
    SQL_ENCODED,
    Tables,
    query,
    spaced,
    sql_uniform,
)

_S = 1e-6
_SQL_COUNTS = (
    SQL_ENCODED
    + """,
v AS (SELECT count(*) AS v FROM vocab),
pairs AS (SELECT doc_id, ids[i] AS prev, ids[i + 1] AS next
  FROM (SELECT doc_id, ids, unnest(range(1, len(ids))) AS i FROM enc)),
counts AS MATERIALIZED (SELECT prev, next, count(*) AS n FROM pairs GROUP BY ALL),
sums AS (SELECT prev, sum(n) AS row_sum FROM counts GROUP BY prev)"""
)
_SQL_P = f"(n + {_S}::DOUBLE) / (row_sum + {_S}::DOUBLE * v)"
_SQL_PROBS = _SQL_COUNTS + f""",
probs AS MATERIALIZED (SELECT prev, next, n, {_SQL_P} AS p FROM counts JOIN sums USING (prev), v)"""
_SQL_SCORED = _SQL_PROBS + """,
scored AS (SELECT doc_id, count(*) AS transitions, sum(ln(p)) AS log_prob
  FROM pairs JOIN probs USING (prev, next) GROUP BY doc_id)"""


def _model(t: Tables) -> bg.BigramModel:
    return bg.fit(t.encoded.select("doc_id", "ids"), len(t.vocabulary), _S)


def _scored(t: Tables) -> DataFrame:
    return bg.log_probability(t.stored, bg.fit(t.stored, len(t.vocabulary), _S))


@query("bigram_counts", f"WITH {_SQL_COUNTS} SELECT prev, next, n FROM counts")
def bigram_counts(t: Tables):
    return bg.count_pairs(t.encoded)


@query("bigram_probs", f"WITH {_SQL_PROBS} SELECT prev, next, n, round(p, 9) AS p FROM probs")
def bigram_probs(t: Tables):
    return bg.probabilities(_model(t)).withColumn("p", F.round("p", 9))


@query(
    "bigram_next",
    f"""WITH {_SQL_COUNTS}, e AS (SELECT idx FROM vocab WHERE ch = 'e')
    SELECT idx AS next, round((coalesce(n, 0) + {_S}::DOUBLE) /
      ((SELECT row_sum FROM sums WHERE prev = (FROM e)) + {_S}::DOUBLE * v), 12) AS p
    FROM vocab LEFT JOIN (SELECT next AS idx, n FROM counts WHERE prev = (FROM e)) USING (idx), v""",
)
def bigram_next(t: Tables):
    out = bg.next_distribution(_model(t), t.spark, t.vocabulary.chars.index("e"))
    return out.withColumn("p", F.round("p", 12))


@query(
    "bigram_logprob",
    f"""WITH {_SQL_SCORED} SELECT doc_id, coalesce(transitions, 0)::INTEGER AS transitions,
      round(coalesce(log_prob, 0), 4) AS log_prob FROM documents LEFT JOIN scored USING (doc_id)""",
)
def bigram_logprob(t: Tables):
    return _scored(t).select("doc_id", "transitions", F.round("log_prob", 4).alias("log_prob"))


@query(
    "bigram_perplexity",
    f"""WITH {_SQL_SCORED} SELECT doc_id, round(exp(-log_prob / transitions), 6) AS perplexity
    FROM documents LEFT JOIN scored USING (doc_id)""",
)
def bigram_perplexity(t: Tables):
    return bg.perplexity(_scored(t)).select("doc_id", F.round("perplexity", 6).alias("perplexity"))


LANGUAGE_PERPLEXITY_SQL = f"""WITH {_SQL_SCORED}
    SELECT lang, count(*) AS documents, round(avg(exp(-log_prob / transitions)), 6) AS mean_perplexity,
      round(exp(-sum(log_prob) / sum(transitions)), 6) AS corpus_perplexity
    FROM documents JOIN scored USING (doc_id) GROUP BY lang"""


@query("bigram_perplexity_by_language", LANGUAGE_PERPLEXITY_SQL)
def bigram_perplexity_by_language(t: Tables):
    scored = bg.perplexity(_scored(t)).where(F.col("transitions") > 0)
    return scored.groupBy("lang").agg(
        F.count("*").alias("documents"),
        F.round(F.avg("perplexity"), 6).alias("mean_perplexity"),
        F.round(F.exp(-F.sum("log_prob") / F.sum("transitions")), 6).alias("corpus_perplexity"),
    )


@query(
    "bigram_cross_entropy",
    f"""WITH {SQL_ENCODED},
    v AS (SELECT count(*) AS v FROM vocab),
    s AS (SELECT doc_id, ids, CASE WHEN row_number() OVER (ORDER BY doc_id) <=
      floor((SELECT count(*) FROM enc) * 0.9::DOUBLE) THEN 'train' ELSE 'validation' END AS split FROM enc),
    pairs AS MATERIALIZED (SELECT split, ids[i] AS prev, ids[i + 1] AS next
      FROM (SELECT split, ids, unnest(range(1, len(ids))) AS i FROM s)),
    counts AS (SELECT prev, next, count(*) AS n FROM pairs WHERE split = 'train' GROUP BY ALL),
    sums AS (SELECT prev, sum(n) AS row_sum FROM counts GROUP BY prev)
    SELECT split, count(*) AS transitions,
      round(-avg(ln((coalesce(n, 0) + {_S}::DOUBLE) / (coalesce(row_sum, 0) + {_S}::DOUBLE * v))), 6) AS cross_entropy
    FROM pairs LEFT JOIN counts USING (prev, next) LEFT JOIN sums USING (prev), v GROUP BY split""",
)
def bigram_cross_entropy(t: Tables):
    rows = splits.split_rows(t.stored.select("doc_id", "ids"), "doc_id", 0.9)
    model = bg.fit(rows.where(F.col("split") == "train"), len(t.vocabulary), _S)
    out = bg.cross_entropy(bg.log_probability(rows, model), "split")
    return out.withColumn("cross_entropy", F.round("cross_entropy", 6))


_T = 0.7
_SQL_RESHAPED = _SQL_PROBS + f""",
dense AS (SELECT a.idx AS prev, b.idx AS next,
    (coalesce(n, 0) + {_S}::DOUBLE) / (coalesce(row_sum, 0) + {_S}::DOUBLE * v) AS p
  FROM vocab a CROSS JOIN vocab b CROSS JOIN v
  LEFT JOIN counts ON counts.prev = a.idx AND counts.next = b.idx LEFT JOIN sums ON sums.prev = a.idx),
hot AS MATERIALIZED (SELECT prev, next, exp(l - max(l) OVER (PARTITION BY prev)) AS w
  FROM (SELECT prev, next, ln(p + 1e-20) / {_T} AS l FROM dense)),
reshaped AS MATERIALIZED (SELECT prev, next, w / sum(w) OVER (PARTITION BY prev) AS p FROM hot)"""


@query(
    "bigram_temperature",
    f"""WITH {_SQL_RESHAPED} SELECT prev, next, round(p, 9) AS p
    FROM reshaped SEMI JOIN counts USING (prev, next)""",
)
def bigram_temperature(t: Tables):
    return bg.reshaped(_model(t), _T).select("prev", "next", F.round("p", 9).alias("p"))


# --- sampling: one sequence per document, from its first character ------------------------

_LENGTH = 12
_K = 5
_P = 0.9


def _starts(t: Tables) -> DataFrame:
    first = t.vocabulary.encode(F.substring("text", 1, 1))
    return t.documents.where(F.length("text") > 0).select(
        "doc_id", F.get(first, F.lit(0)).alias("start")
    )


_SQL_START = "w0 AS (SELECT doc_id, ids[1] AS prev, [ids[1]] AS seq FROM enc)"


def _sql_walk_counts() -> str:
    parts = [
        """cdf AS MATERIALIZED (SELECT prev, next, n,
  sum(n) OVER (PARTITION BY prev ORDER BY next ROWS UNBOUNDED PRECEDING) AS cum FROM counts)""",
        _SQL_START,
    ]
    for k in range(1, _LENGTH):
        mix, cnt, uni = (sql_uniform(SEED, "doc_id", f"'{c}{k}'") for c in "mcu")
        parts.append(
            f"""d{k} AS (SELECT doc_id, prev, seq, coalesce(row_sum, 0) AS rs,
    {mix} < coalesce(row_sum, 0) / (coalesce(row_sum, 0) + {_S}::DOUBLE * v) AS counted,
    floor({cnt} * coalesce(row_sum, 0)) AS point, floor({uni} * v)::INTEGER AS anything
  FROM w{k - 1} LEFT JOIN sums USING (prev), v)"""
        )
        parts.append(
            f"""w{k} AS MATERIALIZED (SELECT doc_id, tok AS prev, list_append(seq, tok) AS seq FROM (
    SELECT doc_id, seq, CASE WHEN counted THEN next ELSE anything END AS tok
    FROM d{k} LEFT JOIN cdf ON cdf.prev = d{k}.prev AND point >= cum - n AND point < cum))"""
        )
    return ",\n".join(parts)


def _sql_walk_table(candidates: str) -> str:
    parts = [
        f"""cdf AS MATERIALIZED (SELECT prev, next, cum, coalesce(lag(cum) OVER (PARTITION BY prev ORDER BY next), 0) AS lo,
  max(cum) OVER (PARTITION BY prev) AS total FROM (SELECT prev, next,
    sum(p) OVER (PARTITION BY prev ORDER BY next ROWS UNBOUNDED PRECEDING) AS cum FROM {candidates}))""",
        _SQL_START,
    ]
    for k in range(1, _LENGTH):
        draw = sql_uniform(SEED, "doc_id", f"'c{k}'")
        parts.append(
            f"""w{k} AS MATERIALIZED (SELECT doc_id, next AS prev, list_append(seq, next) AS seq FROM (
    SELECT *, {draw} AS u FROM w{k - 1}) d JOIN cdf ON cdf.prev = d.prev AND u * total >= lo AND u * total < cum)"""
        )
    return ",\n".join(parts)


_LAST = f"w{_LENGTH - 1}"
_SQL_SEQ = f"SELECT doc_id, array_to_string(seq, ' ') AS ids FROM {_LAST}"
_SQL_TOP_K = f"""topk AS (SELECT prev, next, p / sum(p) OVER (PARTITION BY prev) AS p FROM (
  SELECT *, row_number() OVER (PARTITION BY prev ORDER BY p DESC, next) AS r FROM reshaped) WHERE r <= {_K})"""
_SQL_DENSE = _SQL_RESHAPED.replace(f"/ {_T}", "/ 1.0")
_SQL_TOP_P = f"""topp AS (SELECT prev, next, p / sum(p) OVER (PARTITION BY prev) AS p FROM (
  SELECT *, sum(p) OVER (PARTITION BY prev ORDER BY p DESC, next ROWS UNBOUNDED PRECEDING) AS cum FROM dense)
  WHERE cum - p < {_P})"""


@query("bigram_sample", f"WITH {_SQL_COUNTS}, {_sql_walk_counts()} {_SQL_SEQ}")
def bigram_sample(t: Tables):
    return bg.sample(_starts(t), _model(t), _LENGTH, SEED).select("doc_id", spaced("ids").alias("ids"))


@query(
    "bigram_topk_table",
    f"WITH {_SQL_RESHAPED}, {_SQL_TOP_K} SELECT prev, next, round(p, 9) AS p FROM topk",
)
def bigram_topk_table(t: Tables):
    return bg.top_k(_model(t), t.spark, _K, _T).withColumn("p", F.round("p", 9))


@query("bigram_topk", f"WITH {_SQL_RESHAPED}, {_SQL_TOP_K}, {_sql_walk_table('topk')} {_SQL_SEQ}")
def bigram_topk(t: Tables):
    table = bg.top_k(_model(t), t.spark, _K, _T)
    return bg.sample_from(_starts(t), table, _LENGTH, SEED).select("doc_id", spaced("ids").alias("ids"))


@query(
    "bigram_topp_table",
    f"WITH {_SQL_DENSE}, {_SQL_TOP_P} SELECT prev, next, round(p, 9) AS p FROM topp",
)
def bigram_topp_table(t: Tables):
    return bg.top_p(_model(t), t.spark, _P).withColumn("p", F.round("p", 9))


@query("bigram_topp", f"WITH {_SQL_DENSE}, {_SQL_TOP_P}, {_sql_walk_table('topp')} {_SQL_SEQ}")
def bigram_topp(t: Tables):
    table = bg.top_p(_model(t), t.spark, _P)
    return bg.sample_from(_starts(t), table, _LENGTH, SEED).select("doc_id", spaced("ids").alias("ids"))


@query(
    "bigram_generate_text",
    f"""WITH {_SQL_COUNTS}, {_sql_walk_counts()},
    g AS (SELECT doc_id, unnest(seq) AS idx, generate_subscripts(seq, 1) AS pos FROM {_LAST})
    SELECT doc_id, string_agg(ch, '' ORDER BY pos) AS text FROM g JOIN vocab USING (idx) GROUP BY doc_id""",
)
def bigram_generate_text(t: Tables):
    out = bg.sample(_starts(t), _model(t), _LENGTH, SEED)
    return out.select("doc_id", t.vocabulary.decode(F.col("ids")).alias("text"))
