"""Filters, duplicates, web pages, personal data, special tokens and tuning sets."""

from pyspark.sql import functions as F

from textmill.functions import html, personal, tokens
from textmill.functions import text as tx
from textmill.operators import bigram as bg
from textmill.operators import curation, similar, splits
from textmill.plans.catalogue.base import (
    SEED, SQL_ENCODED, Tables, query, spaced, sql_text, sql_uniform,
)
from textmill.plans.catalogue.bigrams import _S, _SQL_SCORED
from textmill.plans.catalogue.texts import _sql_clean
from textmill.sources.storage import cut_lineage

_LANGUAGES = ["de", "en"]
_IN = ", ".join(sql_text(x) for x in _LANGUAGES)
_WORDS = r"[^\x20\x09-\x0D]+"


# --- text -------------------------------------------------------------------------------


@query("norm_accents", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def norm_accents(t: Tables):
    return t.documents.select("doc_id", tx.strip_accents(F.col("text")).alias("text"))


# digits that the documents do not have are put around them, as a number of each kind
_PERSONAL_SQL = "'078-05-1120 and 4111 1111 1111 1111, ' || text || ' a.b+c@d-e.org'"


def _with_numbers(t: Tables):
    text = F.concat(
        F.lit("078-05-1120 and 4111 1111 1111 1111, "), F.col("text"), F.lit(" a.b+c@d-e.org")
    )
    return t.documents.select("doc_id", text.alias("text"))


@query(
    "pii_detect",
    "SELECT doc_id, "
    + ", ".join(f"len(regexp_extract_all(text, {sql_text(p)}))::INTEGER AS {k}" for k, (p, _) in personal.PATTERNS.items())
    + f" FROM (SELECT doc_id, {_PERSONAL_SQL} AS text FROM documents)",
)
def pii_detect(t: Tables):
    return _with_numbers(t).select(
        "doc_id", *[personal.count(F.col("text"), kind).alias(kind) for kind in personal.PATTERNS]
    )


def _sql_redacted(c: str) -> str:
    for pattern, tag in personal.PATTERNS.values():
        c = f"regexp_replace({c}, {sql_text(pattern)}, {sql_text(tag)}, 'g')"
    return c


@query("pii_redact", f"SELECT doc_id, {_sql_redacted(_PERSONAL_SQL)} AS text FROM documents")
def pii_redact(t: Tables):
    return _with_numbers(t).select("doc_id", personal.redact(F.col("text")).alias("text"))


# --- filters ----------------------------------------------------------------------------


@query("filter_language", f"SELECT * FROM documents WHERE lang IN ({_IN})")
def filter_language(t: Tables):
    return curation.keep_languages(t.documents, _LANGUAGES)


_TOXIC = "SELECT doc_id FROM labels WHERE toxic = 1"


@query("filter_toxic", f"SELECT * FROM documents WHERE doc_id NOT IN ({_TOXIC})")
def filter_toxic(t: Tables):
    return curation.drop_labelled(t.documents, t("labels"), "toxic")


@query(
    "kl_filter",
    f"""WITH w AS MATERIALIZED (SELECT doc_id, word, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_WORDS}')) AS word FROM documents) GROUP BY ALL),
    q AS (SELECT word, sum(n) AS q FROM w GROUP BY word),
    s AS (SELECT sum(q) AS total, count(*) AS words FROM q),
    k AS (SELECT doc_id, sum(n * (ln(n) - ln((q + 1) / (total + words + 1)::DOUBLE))) / sum(n) - ln(sum(n)) AS d
      FROM w JOIN q USING (word), s GROUP BY doc_id)
    SELECT doc_id, round(d, 6) AS divergence FROM k WHERE d <= 6.0""",
)
def kl_filter(t: Tables):
    counts = cut_lineage(curation.word_counts(t.documents), "words")
    reference = counts.groupBy("word").agg(F.sum("n").alias("n"))
    scored = curation.divergence(counts, reference).where(F.col("divergence") <= 6.0)
    return scored.withColumn("divergence", F.round("divergence", 6))


_PERPLEXITY = 10.0


@query(
    "perplexity_filter",
    f"""WITH {_SQL_SCORED} SELECT doc_id, round(exp(-log_prob / transitions), 6) AS perplexity
    FROM scored WHERE exp(-log_prob / transitions) <= {_PERPLEXITY}""",
)
def perplexity_filter(t: Tables):
    model = bg.fit(t.stored, len(t.vocabulary), _S)
    sums = bg.log_probability(t.stored, model).select("doc_id", "transitions", "log_prob")
    # two numbers a row, written, as the filter would add up the scores of each row again
    scored = bg.perplexity(cut_lineage(sums, "scores"))
    kept = scored.where((F.col("transitions") > 0) & (F.col("perplexity") <= _PERPLEXITY))
    return kept.select("doc_id", F.round("perplexity", 6).alias("perplexity"))


_RUN = 8


def _sql_runs(key: str, table: str) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(w[i:i + {_RUN - 1}], ' ') AS run FROM (
      SELECT {key}, w, unnest(range(1, len(w) - {_RUN - 2})) AS i FROM (
        SELECT {key}, regexp_extract_all(lower(text), '{_WORDS}') AS w FROM {table}))"""


@query(
    "decontaminate",
    f"""WITH d AS ({_sql_runs('doc_id', 'documents')}), b AS ({_sql_runs('item_id', 'benchmark')})
    SELECT doc_id, count(*) AS shared FROM d WHERE run IN (SELECT run FROM b) GROUP BY doc_id""",
)
def decontaminate(t: Tables):
    return curation.contamination(t.documents.select("doc_id", "text"), t("benchmark"), _RUN)


# --- duplicates -------------------------------------------------------------------------


@query(
    "dedup_exact",
    "SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)",
)
def dedup_exact(t: Tables):
    return curation.drop_exact(t.documents)


@query(
    "dedup_lines",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS k FROM l),
    j AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text FROM r
      WHERE k = 1 OR NOT regexp_matches(line, '[^ \\t-\\r]') GROUP BY doc_id)
    SELECT doc_id, coalesce(j.text, '') AS text FROM documents LEFT JOIN j USING (doc_id)""",
)
def dedup_lines(t: Tables):
    return curation.drop_repeated_lines(t.documents.select("doc_id", "text"))


def _sql_chars(name: str, table: str, stage: int) -> str:
    return f"""SELECT {stage}::INTEGER AS stage, '{name}' AS name, count(*) AS documents,
      coalesce(sum(length(text)), 0)::BIGINT AS characters FROM {table}"""


def _sql_near(docs: str) -> str:
    """CTEs up to ``groups`` (id, class_id, n_links, group_id) of a table of documents."""
    return f"""w AS (SELECT doc_id, regexp_extract_all(lower(text), '{_WORDS}') AS w FROM {docs}),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {similar.WORDS - 1}], ' ') AS sh FROM (
      SELECT doc_id, w, unnest(range(1, greatest(len(w) - {similar.WORDS - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
    sets AS (SELECT doc_id, md5(string_agg(sh, chr(1) ORDER BY sh)) AS d, count(*) AS n FROM s GROUP BY doc_id),
    class AS MATERIALIZED (SELECT doc_id, min(doc_id) OVER (PARTITION BY d) AS class_id, n FROM sets),
    inv AS MATERIALIZED (SELECT doc_id AS id, n, sh FROM s JOIN class USING (doc_id) WHERE doc_id = class_id),
    pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS common, x.n + y.n - count(*) AS total
      FROM inv x JOIN inv y ON x.sh = y.sh AND x.id < y.id GROUP BY x.id, y.id, x.n, y.n),
    near AS MATERIALIZED (SELECT a, b, common, common / total::DOUBLE AS similarity FROM pairs
      WHERE common / total::DOUBLE >= {similar.SIMILARITY}),
    e AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
    reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
    roots AS (SELECT a AS class_id, least(a, min(b)) AS group_id FROM reach GROUP BY a),
    links AS (SELECT a AS class_id, count(*) AS n_links FROM e GROUP BY a),
    groups AS (SELECT doc_id AS id, coalesce(class_id, doc_id) AS class_id, coalesce(n_links, 0) AS n_links,
      coalesce(group_id, class_id, doc_id) AS group_id
      FROM {docs} LEFT JOIN class USING (doc_id) LEFT JOIN roots USING (class_id) LEFT JOIN links USING (class_id))"""


_SQL_CHAIN = f"""s1 AS MATERIALIZED (SELECT doc_id, lang, source, {_sql_clean('text')} AS text FROM documents),
    s2 AS (SELECT * FROM s1 WHERE lang IN ({_IN})),
    s3 AS (SELECT * FROM s2 WHERE doc_id NOT IN ({_TOXIC})),
    s4 AS MATERIALIZED (SELECT * FROM s3 WHERE doc_id IN (SELECT min(doc_id) FROM s3 GROUP BY text)),
    {_sql_near('s4')},
    s5 AS MATERIALIZED (SELECT * FROM s4 WHERE doc_id IN (SELECT group_id FROM groups)),
    s6 AS (SELECT * FROM s5 WHERE len(regexp_extract_all(text, '{_WORDS}')) >= 50
      AND length(regexp_replace(text, '[^\\p{{L}}]+', '', 'g'))
        >= 0.6::DOUBLE * length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))),
    s7 AS (SELECT * REPLACE ({_sql_redacted('text')} AS text) FROM s6),
    s8 AS (SELECT *, sha256(text) AS sha256, len(regexp_extract_all(text, '{_WORDS}'))::INTEGER AS n_words,
      len(string_split(text, chr(10)))::INTEGER AS n_lines FROM s7)"""

_CHAIN = ["input", "clean", "language", "toxic", "copies", "near copies", "quality", "personal", "provenance"]


def _chain(t: Tables) -> list:
    labels = t("labels")
    long = F.regexp_count("text", F.lit(_WORDS)) >= 50
    steps = [
        lambda df: df.select("doc_id", "lang", "source", tx.clean(F.col("text")).alias("text")),
        lambda df: curation.keep_languages(df, _LANGUAGES),
        lambda df: curation.drop_labelled(df, labels, "toxic"),
        curation.drop_exact,
        similar.drop_near,
        lambda df: df.where(long & curation.readable(F.col("text"))),
        lambda df: df.withColumn("text", personal.redact(F.col("text"))),
        curation.with_provenance,
    ]
    return list(zip(_CHAIN[1:], steps, strict=True))


@query(
    "curation_funnel",
    f"WITH RECURSIVE {_SQL_CHAIN} "
    + " UNION ALL ".join(_sql_chars(name, "documents" if k == 0 else f"s{k}", k) for k, name in enumerate(_CHAIN)),
)
def curation_funnel(t: Tables):
    return curation.funnel(t.documents, _chain(t))


@query("curation_chain", f"WITH RECURSIVE {_SQL_CHAIN} SELECT * FROM s8")
def curation_chain(t: Tables):
    docs = t.documents
    for _, step in _chain(t):
        docs = cut_lineage(step(docs), "step")
    return docs


@query("quality_classifier")
def quality_classifier(t: Tables):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = curation.fit_quality(t.documents.where(~held_out), t("labels"))
    scored = curation.quality_scores(t.documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), F.round("score", 4).alias("score"))


# --- web pages --------------------------------------------------------------------------


@query(
    "html_paragraphs",
    f"""WITH p AS (SELECT page_id, lower(regexp_extract(url, {sql_text(html.URL_HOST)}, 1)) AS host, string_split(
        regexp_replace(regexp_replace(html, {sql_text(html.HIDDEN)}, '', 'g'), {sql_text(html.BLOCK)}, chr(10), 'g'),
        chr(10)) AS parts FROM pages),
    e AS (SELECT page_id, host, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM p),
    x AS (SELECT page_id, host, place, trim(regexp_replace(part, '{html.TAG}', '', 'g')) AS text, length(regexp_replace(
        array_to_string(regexp_extract_all(part, {sql_text(html.LINK)}, 1), ''), '{html.TAG}', '', 'g')) AS links FROM e),
    own AS (SELECT * FROM x WHERE text <> '' AND links <= length(text) * 0.5::DOUBLE),
    common AS (SELECT host, text FROM own GROUP BY ALL HAVING count(DISTINCT page_id) > 2),
    j AS (SELECT page_id, count(*) AS n, string_agg(text, chr(10) ORDER BY place) AS text
      FROM own ANTI JOIN common USING (host, text) GROUP BY page_id)
    SELECT page_id, host, coalesce(n, 0)::INTEGER AS paragraphs, coalesce(j.text, '') AS text
    FROM (SELECT DISTINCT page_id, host FROM p) LEFT JOIN j USING (page_id)""",
)
def html_paragraphs(t: Tables):
    return curation.page_texts(t("pages"))


# the pages have no images, so each gets two that carry its address
_IMAGES_SQL = """html || '<img src="a.png" alt="' || url || '"><IMG alt="" width=1>'"""


@query(
    "html_alt_text",
    f"""SELECT page_id, len(a)::INTEGER AS images, array_to_string(a, ' | ') AS texts FROM (
      SELECT page_id, regexp_extract_all({_IMAGES_SQL}, {sql_text(html.ALT)}, 1) AS a FROM pages)""",
)
def html_alt_text(t: Tables):
    raw = F.concat("html", F.lit('<img src="a.png" alt="'), "url", F.lit('"><IMG alt="" width=1>'))
    found = t("pages").select("page_id", html.alt_texts(raw).alias("a"))
    return found.select("page_id", F.size("a").alias("images"), F.array_join("a", " | ").alias("texts"))


@query(
    "page_provenance",
    f"""SELECT page_id, lower(regexp_extract(url, {sql_text(html.URL_HOST)}, 1)) AS host,
      regexp_extract(url, {sql_text(html.URL_PATH)}, 1) AS path,
      lower(regexp_extract(html, {sql_text(html.HTML_LANG)}, 1)) AS lang FROM pages""",
)
def page_provenance(t: Tables):
    return t("pages").select(
        "page_id",
        html.host(F.col("url")).alias("host"),
        html.path(F.col("url")).alias("path"),
        html.declared_language(F.col("html")).alias("lang"),
    )


# --- ids --------------------------------------------------------------------------------

_LONG = 100
_LANG_TOKENS = {"de": 1001, "en": 1002, "fr": 1003}


@query(
    "post_special_tokens",
    f"""WITH {SQL_ENCODED} SELECT doc_id, array_to_string(
      [1000] || list_transform(ids, lambda i: CASE WHEN i < 40 THEN i ELSE 1002 END) || [1001], ' ') AS ids FROM enc""",
)
def post_special_tokens(t: Tables):
    ids = tokens.with_special(F.col("ids"), bos=1000, eos=1001, unk=1002, size=40)
    return t.encoded.select("doc_id", spaced(ids).alias("ids"))


@query(
    "truncate_split",
    f"""WITH {SQL_ENCODED} SELECT doc_id, k::INTEGER AS piece,
      array_to_string(ids[k * {_LONG} + 1:(k + 1) * {_LONG}], ' ') AS ids
    FROM (SELECT doc_id, ids, unnest(range(0, (len(ids) + {_LONG - 1}) // {_LONG})) AS k FROM enc)""",
)
def truncate_split(t: Tables):
    pieces = F.posexplode(tokens.split_long(F.col("ids"), _LONG)).alias("piece", "ids")
    return t.encoded.select("doc_id", pieces).withColumn("ids", spaced("ids"))


@query(
    "pad_left",
    f"""WITH {SQL_ENCODED} SELECT doc_id, array_to_string(
      list_transform(range(0, greatest(2000 - len(ids), 0)), lambda i: 0) || ids[greatest(len(ids) - 2000, 0) + 1:], ' ') AS ids
    FROM enc""",
)
def pad_left(t: Tables):
    return t.encoded.select("doc_id", spaced(tokens.pad_left(F.col("ids"), 2000)).alias("ids"))


_PAIR = 40
_PAIRS_SQL = """pairs AS (SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS response
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""


@query(
    "truncate_pairs",
    f"""WITH RECURSIVE {_PAIRS_SQL},
    w AS (SELECT conv_id, turn, regexp_extract_all(instruction, '{_WORDS}') AS a, regexp_extract_all(response, '{_WORDS}') AS b
      FROM pairs),
    cut AS (SELECT conv_id, turn, len(a) AS n, len(b) AS m FROM w
      UNION ALL SELECT conv_id, turn, n - (n >= m)::INTEGER, m - (n < m)::INTEGER FROM cut WHERE n + m > {_PAIR}),
    done AS (SELECT conv_id, turn, n, m FROM cut WHERE n + m <= {_PAIR})
    SELECT conv_id, turn, array_to_string(a[:n], ' ') AS longest_a, array_to_string(b[:m], ' ') AS longest_b,
      array_to_string(a[:least(len(a), greatest({_PAIR} - len(b), 0))], ' ') AS only_a,
      array_to_string(b[:{_PAIR} - least(len(a), greatest({_PAIR} - len(b), 0))], ' ') AS only_b
    FROM w JOIN done USING (conv_id, turn)""",
)
def truncate_pairs(t: Tables):
    words = [F.regexp_extract_all(F.col(c), F.lit(_WORDS), F.lit(0)).alias(x) for c, x in (("instruction", "a"), ("response", "b"))]
    pairs = curation.instruction_pairs(t("conversations")).select("conv_id", "turn", *words)
    both = pairs.select(
        "conv_id", "turn",
        tokens.truncate_pair(F.col("a"), F.col("b"), _PAIR).alias("longest"),
        tokens.truncate_pair(F.col("a"), F.col("b"), _PAIR, longest_first=False).alias("only"),
    )
    return both.select(
        "conv_id", "turn",
        *[spaced(f"{way}.{side}").alias(f"{way}_{x}") for way in ("longest", "only") for side, x in (("first", "a"), ("second", "b"))],
    )


@query(
    "post_lang_token",
    f"""WITH {SQL_ENCODED} SELECT doc_id, array_to_string([CASE lang """
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _LANG_TOKENS.items())
    + " ELSE 1000 END] || ids, ' ') AS ids FROM enc",
)
def post_lang_token(t: Tables):
    ids = tokens.with_language(F.col("ids"), F.col("lang"), _LANG_TOKENS, 1000)
    return t.encoded.select("doc_id", spaced(ids).alias("ids"))


# --- tuning sets ------------------------------------------------------------------------


@query("instruction_pairs", f"WITH {_PAIRS_SQL} SELECT * FROM pairs")
def instruction_pairs(t: Tables):
    return curation.instruction_pairs(t("conversations"))


@query(
    "mlm_rows",
    f"""WITH {SQL_ENCODED},
    m AS (SELECT doc_id, pos, x, {sql_uniform(SEED, 'doc_id', 'pos')} < 0.15 AS hit
      FROM (SELECT doc_id, unnest(ids) AS x, generate_subscripts(ids, 1) - 1 AS pos FROM enc))
    SELECT doc_id, string_agg((CASE WHEN hit THEN 999 ELSE x END)::VARCHAR, ' ' ORDER BY pos) AS input,
      string_agg((CASE WHEN hit THEN x ELSE -100 END)::VARCHAR, ' ' ORDER BY pos) AS labels FROM m GROUP BY doc_id""",
)
def mlm_rows(t: Tables):
    rows = curation.masked_rows(t.encoded.select("doc_id", "ids"), 0.15, 999, SEED)
    return rows.select("doc_id", spaced("input").alias("input"), spaced("labels").alias("labels"))


@query(
    "labelled_set",
    f"""SELECT doc_id, text, quality, CASE WHEN
      row_number() OVER (PARTITION BY quality ORDER BY {sql_uniform(SEED, 'doc_id')}, doc_id) <=
      floor(count(*) OVER (PARTITION BY quality) * 0.8::DOUBLE)
      THEN 'train' ELSE 'validation' END AS split FROM documents JOIN labels USING (doc_id)""",
)
def labelled_set(t: Tables):
    rows = t.documents.select("doc_id", "text")
    named = curation.labelled(rows, t("labels").select("doc_id", "quality"))
    # narrow rows are ranked; the texts are joined to their label afterwards
    split = splits.split_stratified(named.select("doc_id", "quality"), "quality", ["doc_id"], 0.8, SEED)
    return rows.join(split, "doc_id")


# --- near-duplicates --------------------------------------------------------------------

_SQL_NEAR = _sql_near("documents")


@query("dedup_near", f"WITH RECURSIVE {_SQL_NEAR} SELECT a, b, common::INTEGER AS common, similarity FROM near")
def dedup_near(t: Tables):
    return similar.near_classes(t.documents)[1]


@query("dedup_groups", f"WITH RECURSIVE {_SQL_NEAR} SELECT * FROM groups")
def dedup_groups(t: Tables):
    return similar.near_groups(t.documents)


@query(
    "dedup_near_kept",
    f"WITH RECURSIVE {_SQL_NEAR} SELECT * FROM documents WHERE doc_id IN (SELECT group_id FROM groups)",
)
def dedup_near_kept(t: Tables):
    return similar.drop_near(t.documents)


@query("dedup_minhash")
def dedup_minhash(t: Tables):
    return similar.near_rows_minhash(t.documents)


@query("semantic_pairs")
def semantic_pairs(t: Tables):
    return similar.near_vector_rows(t("embeddings"))
