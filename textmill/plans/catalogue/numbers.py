"""Reports, validation, scaling, augmentation and quantisation."""

from pyspark.sql import functions as F

from textmill.functions import vectors
from textmill.operators import attention_lookup, augment, nearest, scaling, statistics
from textmill.plans import dataset
from textmill.plans.catalogue.base import (
    SEED,
    SQL_ENCODED,
    Tables,
    query,
    spaced,
    sql_gaussian,
    sql_uniform,
)
from textmill.sources.storage import cut_lineage
from textmill.sources.store import DatasetOptions


@query(
    "report_basic",
    f"""WITH {SQL_ENCODED}, v AS (SELECT unnest(ids) AS x FROM enc)
    SELECT count(*) AS rows, min(x) AS min_value, max(x) AS max_value, round(avg(x), 6) AS mean_value,
      count(DISTINCT x) AS unique_values, round(count(*) * 4 / 1048576, 6) AS memory_mb FROM v""",
)
def report_basic(t: Tables):
    out = statistics.basic_report(statistics.token_counts(t.encoded))
    return out.withColumn("mean_value", F.round("mean_value", 6)).withColumn(
        "memory_mb", F.round("memory_mb", 6)
    )


@query(
    "report_stats",
    """SELECT count(value) AS rows, round(min(value), 6) AS min, round(max(value), 6) AS max,
      round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(var_pop(value), 6) AS variance,
      round(median(value), 6) AS median, count(DISTINCT value) AS unique_values FROM events""",
)
def report_stats(t: Tables):
    out = statistics.full_report(t("events").select("value"), "value")
    floats = ["min", "max", "mean", "std", "variance", "median"]
    return out.withColumns({c: F.round(c, 6) for c in floats})


@query(
    "report_stats_prices",
    """WITH v AS (SELECT l_extendedprice::DOUBLE AS value FROM lineitem)
    SELECT count(value) AS rows, round(min(value), 4) AS min, round(max(value), 4) AS max,
      round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std,
      round(median(value), 4) AS median, count(DISTINCT value) AS unique_values FROM v""",
)
def report_stats_prices(t: Tables):
    prices = t("lineitem").select(F.col("l_extendedprice").cast("double").alias("value"))
    out = statistics.full_report(prices, "value").drop("variance")
    return out.withColumns({c: F.round(c, 4) for c in ["min", "max", "mean", "std", "median"]})


@query(
    "report_stats_approximate",
    """SELECT count(value) AS rows, round(min(value), 6) AS min, round(max(value), 6) AS max,
      round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(var_pop(value), 6) AS variance,
      true AS median_near, true AS unique_values_near FROM events""",
)
def report_stats_approximate(t: Tables):
    """The approximate values as flags: the median's rank within 1% of the rows of the middle,
    the distinct values within 15%, which is three standard errors of the sketch."""
    values = t("events").select("value").where(F.col("value").isNotNull())
    out = cut_lineage(statistics.approximate_report(values, "value"), "report")
    median = out.select("median").scalar()
    facts = values.agg(
        F.count_distinct("value").alias("distinct"),
        F.avg((F.col("value") < median).cast("double")).alias("below"),
        F.avg((F.col("value") <= median).cast("double")).alias("upto"),
    )
    floats = ["min", "max", "mean", "std", "variance"]
    return out.withColumns({c: F.round(c, 6) for c in floats}).select(
        "rows",
        *floats,
        ((facts.select("below").scalar() <= 0.51) & (facts.select("upto").scalar() >= 0.49)).alias("median_near"),
        (F.abs(F.col("unique_values") / facts.select("distinct").scalar() - 1) <= 0.15).alias("unique_values_near"),
    )


@query(
    "length_distribution",
    """WITH l AS (SELECT length(text) AS n FROM documents)
    SELECT min(n) AS min_length, max(n) AS max_length, round(avg(n), 6) AS mean_length,
      round(median(n), 6) AS median_length, round(stddev_pop(n), 6) AS std_length FROM l""",
)
def length_distribution(t: Tables):
    out = statistics.length_distribution(t.encoded, F.size("ids"))
    return out.withColumns(
        {c: F.round(c, 6) for c in ["mean_length", "median_length", "std_length"]}
    )


# Values with planted faults: errors become NaN and signups infinity.
_FAULTY_SQL = """(SELECT event_id, CASE event_type WHEN 'error' THEN 'nan'::DOUBLE
  WHEN 'signup' THEN 'inf'::DOUBLE ELSE value END AS value FROM events)"""


@query(
    "validate_pairs",
    f"""WITH i AS (SELECT count(*) AS n, min(value) FILTER (NOT isnan(value)) AS lo,
        max(value) FILTER (NOT isnan(value)) AS hi FROM {_FAULTY_SQL}),
    l AS (SELECT count(*) AS n, min(label)::DOUBLE AS lo, max(label)::DOUBLE AS hi FROM embeddings)
    SELECT false AS valid, 'Length mismatch: inputs=' || i.n || ', targets=' || l.n ||
      '; NaN values found in inputs; Infinite values found in inputs' AS errors,
      'Dtype mismatch: inputs=double, targets=int' AS warnings,
      i.lo AS input_min, i.hi AS input_max, l.lo AS target_min, l.hi AS target_max FROM i, l""",
)
def validate_pairs(t: Tables):
    value = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "signup", F.lit(float("inf")))
        .otherwise(F.col("value"))
    )
    inputs = t("events").select(value.alias("value"))
    out = statistics.validate(inputs, t("embeddings").select("label"), "value", "label")
    return out.withColumn("errors", F.array_join("errors", "; ")).withColumn(
        "warnings", F.array_join("warnings", "; ")
    )


@query(
    "validate_token_range",
    f"""WITH {SQL_ENCODED}, v AS (SELECT unnest(ids) AS x FROM enc)
    SELECT min(x) AS min_id, max(x) AS max_id, max(x) < (SELECT count(*) FROM vocab) AS valid FROM v""",
)
def validate_token_range(t: Tables):
    size = len(t.vocabulary)
    checked = statistics.require_token_range(t.encoded, size)
    return statistics.token_range_report(checked, size)


def _scaling(name: str, method: str, shift: str, spread: str) -> None:
    @query(
        name,
        f"""WITH f AS (SELECT {shift} AS a, {spread} AS s FROM events)
        SELECT event_id, round((value - a) / (s + 1e-8), 6) AS scaled,
          round((value - a) / (s + 1e-8) * s + a, 6) AS restored FROM events, f""",
    )
    def _(t: Tables):
        events = t("events").select("event_id", "value")
        scaler = scaling.fit(events, "value", method)
        scaled = scaler.transform(F.col("value"))
        return events.select(
            "event_id",
            F.round(scaled, 6).alias("scaled"),
            F.round(scaler.inverse(scaled), 6).alias("restored"),
        )


_scaling("scale_minmax", "minmax", "min(value)", "(max(value) - min(value))")
_scaling("scale_zscore", "zscore", "avg(value)", "stddev_pop(value)")


@query(
    "augment_noise",
    f"""SELECT event_id, round(value + {sql_gaussian(SEED, 'event_id')} * 0.01, 6) AS noisy FROM events""",
)
def augment_noise(t: Tables):
    noisy = augment.add_noise_scalar(F.col("value"), "event_id", 0.01, SEED)
    return t("events").select("event_id", F.round(noisy, 6).alias("noisy"))


_MASKED_SQL = f"""masked AS (
  SELECT doc_id, pos, CASE WHEN {sql_uniform(SEED, 'doc_id', 'pos')} < 0.15 THEN -1 ELSE x END AS x
  FROM (SELECT doc_id, unnest(ids) AS x, generate_subscripts(ids, 1) - 1 AS pos FROM enc))"""


@query(
    "augment_mask",
    f"""WITH {SQL_ENCODED}, {_MASKED_SQL}
    SELECT doc_id, string_agg(x::VARCHAR, ' ' ORDER BY pos) AS ids FROM masked GROUP BY doc_id""",
)
def augment_mask(t: Tables):
    masked = augment.mask(F.col("ids"), "doc_id", 0.15, -1, SEED)
    return t.encoded.select("doc_id", spaced(masked).alias("ids"))


@query(
    "augment_shuffle",
    f"""WITH {SQL_ENCODED},
    d AS (SELECT doc_id, ids, len(ids) AS n, greatest(1, floor(len(ids) * 0.1::DOUBLE))::INTEGER AS span FROM enc),
    s AS (SELECT *, floor({sql_uniform(SEED, 'doc_id', "'s'")} * greatest(n - span, 1))::INTEGER AS start FROM d),
    r AS (SELECT doc_id, ids[start + 1 + i] AS x, i, {sql_uniform(SEED, 'doc_id', 'i')} AS u
          FROM (SELECT *, unnest(range(0, span)) AS i FROM s)),
    m AS (SELECT doc_id, list(x ORDER BY u, i) AS mid FROM r GROUP BY doc_id)
    SELECT doc_id, array_to_string(list_concat(list_concat(ids[1 : start], mid), ids[start + span + 1 :]), ' ') AS ids
    FROM s JOIN m USING (doc_id)""",
)
def augment_shuffle(t: Tables):
    shuffled = augment.shuffle_span(F.col("ids"), "doc_id", 0.1, SEED)
    return t.encoded.select("doc_id", spaced(shuffled).alias("ids"))


@query(
    "augment_chain",
    f"""WITH {SQL_ENCODED}, {_MASKED_SQL}
    SELECT doc_id, round(sum(x + {sql_gaussian(SEED, 'doc_id', 'pos')} * 0.02), 3) AS total,
      round(min(x + {sql_gaussian(SEED, 'doc_id', 'pos')} * 0.02), 6) AS lowest FROM masked GROUP BY doc_id""",
)
def augment_chain(t: Tables):
    masked = augment.mask(F.col("ids"), "doc_id", 0.15, -1, SEED)
    noisy = augment.add_noise(masked, "doc_id", 0.02, SEED)
    total = F.aggregate("noisy", F.lit(0.0), lambda a, x: a + x)
    return t.encoded.select("doc_id", noisy.alias("noisy")).select(
        "doc_id", F.round(total, 3).alias("total"), F.round(F.array_min("noisy"), 6).alias("lowest")
    )


def _summary(df):
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.abs(x))
    return df.select(
        "vec_id",
        F.round(total, 5).alias("total"),
        F.round(F.get("v", F.lit(0)), 6).alias("first"),
        F.round(F.array_max("v"), 6).alias("largest"),
        F.round(F.array_min("v"), 6).alias("smallest"),
    )


_SUMMARY_SQL = """SELECT vec_id, round(list_sum(list_transform(v, lambda x: abs(x))), 5) AS total,
  round(v[1], 6) AS first, round(list_max(v), 6) AS largest, round(list_min(v), 6) AS smallest FROM q"""
_E_SQL = "e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS d FROM embeddings)"


@query(
    "quant_symmetric",
    f"""WITH {_E_SQL}, f AS (
      SELECT max(list_max(list_transform(d, lambda x: abs(x)))) / 127 AS s FROM e),
    q AS (SELECT vec_id, list_transform(d, lambda x: (round_even(x / s, 0) + 0.0) * s) AS v FROM e, f)
    {_SUMMARY_SQL}""",
)
def quant_symmetric(t: Tables):
    return _summary(scaling.quantize_symmetric(t("embeddings"), "embedding", 8, "v"))


@query(
    "quant_asymmetric",
    f"""WITH {_E_SQL}, r AS (SELECT min(list_min(d)) AS lo, max(list_max(d)) AS hi FROM e),
    f AS (SELECT (hi - lo) / 255 AS s, round_even(-lo / ((hi - lo) / 255), 0) AS z FROM r),
    q AS (SELECT vec_id, list_transform(d, lambda x: round_even(x / s + z, 0) * s - z * s) AS v FROM e, f)
    {_SUMMARY_SQL}""",
)
def quant_asymmetric(t: Tables):
    return _summary(scaling.quantize_asymmetric(t("embeddings"), "embedding", 8, "v"))


def _doubles(t: Tables):
    vector = F.transform("embedding", lambda x: x.cast("double"))
    return t("embeddings").select("vec_id", vector.alias("d"))


@query(
    "vector_standardize",
    f"""WITH {_E_SQL}, m AS (SELECT vec_id, d, list_sum(d) / len(d) AS mu FROM e),
    s AS (SELECT *, sqrt(list_sum(list_transform(d, lambda x: (x - mu) * (x - mu))) / len(d)) AS sd FROM m),
    q AS (SELECT vec_id, list_transform(d, lambda x: (x - mu) / (sd + 1e-6)) AS v FROM s)
    {_SUMMARY_SQL}""",
)
def vector_standardize(t: Tables):
    return _summary(_doubles(t).select("vec_id", vectors.standardize(F.col("d")).alias("v")))


@query(
    "vector_rms",
    f"""WITH {_E_SQL}, m AS (
      SELECT vec_id, d, sqrt(list_sum(list_transform(d, lambda x: x * x)) / len(d) + 1e-6) AS rms FROM e),
    q AS (SELECT vec_id, list_transform(d, lambda x: x / rms) AS v FROM m)
    {_SUMMARY_SQL}""",
)
def vector_rms(t: Tables):
    return _summary(_doubles(t).select("vec_id", vectors.rms_scale(F.col("d")).alias("v")))


@query(
    "softmax_lookup",
    f"""WITH {_E_SQL}, c AS (
      SELECT label AS query, i, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
    k AS (SELECT vec_id, label, unnest(d) AS x, generate_subscripts(d, 1) AS i FROM e JOIN embeddings USING (vec_id)),
    s AS (SELECT query, vec_id, label, sum(c.x * k.x) AS score FROM c JOIN k USING (i) GROUP BY ALL),
    w AS (SELECT query, label, exp(score - max(score) OVER (PARTITION BY query)) AS w FROM s)
    SELECT query, round(sum(w * label) / sum(w), 6) AS looked_up FROM w GROUP BY query""",
)
def softmax_lookup(t: Tables):
    # queries: the mean vector of each label; every embedding is a key, its label the value
    parts = t("embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy(F.col("label").alias("query"), "i").agg(F.avg("x").alias("x"))
    queries = means.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("q"))
    queries = queries.select("query", F.transform("q", lambda e: e["x"]).alias("vector"))
    keys = t("embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
        F.col("label").cast("double").alias("value"),
    )
    scored = attention_lookup.score(queries, keys)
    return attention_lookup.softmax_lookup(scored).withColumn("looked_up", F.round("looked_up", 6))


_TOP_SQL = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
    s AS (SELECT q.vec_id AS query, k.vec_id AS key, k.label AS value, list_dot_product(q.x, k.x) AS score
      FROM v q, v k WHERE q.vec_id % 20 = 0),
    t AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key)::INTEGER AS rank
      FROM s QUALIFY rank <= 10)"""


def _top_keys(t: Tables):
    keys = t("embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("vector"), F.col("label").cast("double").alias("value")
    )
    queries = t("embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return nearest.top_keys(queries, keys, 10)


@query("lookup_topk", f"WITH {_TOP_SQL} SELECT query, rank, key, round(score, 6) AS score FROM t")
def lookup_topk(t: Tables):
    return _top_keys(t).select("query", "rank", "key", F.round("score", 6).alias("score"))


@query(
    "softmax_lookup_topk",
    f"""WITH {_TOP_SQL}, w AS (SELECT query, value, exp(score - max(score) OVER (PARTITION BY query)) AS w FROM t)
    SELECT query, round(sum(w * value) / sum(w), 6) AS looked_up FROM w GROUP BY query""",
)
def softmax_lookup_topk(t: Tables):
    found = _top_keys(t).select("query", "score", "value")
    return attention_lookup.softmax_lookup(found).withColumn("looked_up", F.round("looked_up", 6))


_OPTIONS = DatasetOptions(seq_length=16)
_LEN = _OPTIONS.seq_length
_WINDOWS_SQL = f"""toks AS (
  SELECT doc_id, unnest(ids) AS x0, generate_subscripts(ids, 1) AS i FROM enc),
w AS MATERIALIZED (SELECT x0, {", ".join(f"lead(x0, {k}) OVER o AS x{k}" for k in range(1, _LEN + 1))}
  FROM toks WINDOW o AS (PARTITION BY doc_id ORDER BY i) QUALIFY x{_LEN} IS NOT NULL),
inputs AS ({" UNION ALL ".join(f"SELECT x{k} AS x FROM w" for k in range(_LEN))}),
targets AS (SELECT x{_LEN} AS x FROM w)"""


def _sql_report(name: str) -> str:
    return f"""{name}_r AS (SELECT count(*) AS {name}_rows, min(x) AS {name}_min_value,
      max(x) AS {name}_max_value, round(avg(x), 6) AS {name}_mean_value,
      count(DISTINCT x) AS {name}_unique_values, round(count(*) * 4 / 1048576, 6) AS {name}_memory_mb FROM {name})"""


@query(
    "dataset_summary",
    f"""WITH {SQL_ENCODED}, {_WINDOWS_SQL}, {_sql_report('inputs')}, {_sql_report('targets')},
    n AS (SELECT count(*) AS total FROM w)
    SELECT inputs_r.*, targets_r.*, (SELECT count(*) FROM vocab)::INTEGER AS vocab_size,
      (SELECT sum(length(text)) FROM documents)::BIGINT AS text_length, total AS total_sequences,
      floor(total * (1 - 0.1::DOUBLE))::BIGINT AS train_sequences,
      (total - floor(total * (1 - 0.1::DOUBLE)))::BIGINT AS validation_sequences FROM inputs_r, targets_r, n""",
)
def dataset_summary(t: Tables):
    out = dataset.process(t.documents, t.folder_for("dataset"), "documents", _OPTIONS)
    rounded = [c for c in out.columns if c.endswith(("mean_value", "memory_mb"))]
    return out.withColumns({c: F.round(c, 6) for c in rounded})
