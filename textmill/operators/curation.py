"""Choosing and preparing documents: filters, duplicates, boilerplate, and tuning sets."""

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import html as pages
from textmill.functions.hashing import below
from textmill.functions.lambdas import let
from textmill.operators.joins import lookup_join
from textmill.sources.storage import cut_lineage, fits

_BROADCAST_HASHES = 2_000_000  # of 16 bytes each


# --- filters ----------------------------------------------------------------------------


def keep_languages(docs: DataFrame, languages: list[str], lang: str = "lang") -> DataFrame:
    """Rows in one of the languages; rows without a language go."""
    return docs.where(F.col(lang).isin(languages))


def drop_labelled(docs: DataFrame, labels: DataFrame, flag: str, key: str = "doc_id") -> DataFrame:
    """Rows without the ones whose label is set. Rows without a label stay."""
    return docs.join(labels.where(F.col(flag) == 1).select(key), key, "left_anti")


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, word, n): how often each row has each of its lower-case words."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select(key, F.explode(words).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))


def divergence(counts: DataFrame, reference: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, divergence): sum of P ln(P/Q) over the words of each row.

    P is the row's own share of a word, Q its add-one smoothed share in ``reference``
    (word, n), where one more place is kept for all words that are not in it. Sums of
    n ln(n) and n ln(Q) combine before the shuffle: no row's words are gathered.
    """
    places = reference.agg(F.sum("n") + F.count("*") + 1).scalar()
    priced = lookup_join(counts, reference.select("word", F.col("n").alias("__q")), ["word"], [key], "left")
    n = F.col("n").cast("double")
    q = (F.coalesce("__q", F.lit(0)) + 1) / places
    return (
        priced.groupBy(key)
        .agg(F.sum(n * (F.ln(n) - F.ln(q))).alias("__s"), F.sum(n).alias("__n"))
        .select(key, (F.col("__s") / F.col("__n") - F.ln("__n")).alias("divergence"))
    )


def fit_quality(
    docs: DataFrame, labels: DataFrame, flag: str = "quality", key: str = "doc_id", text: str = "text",
    features: int = 1 << 16, strength: float = 0.001, rounds: int = 60,
) -> PipelineModel:
    """A logistic regression of a label on hashed words, over all rows that have one.

    Gradients are added up over the partitions by tree, so neither the rows nor the features of
    a partition go to one task; the weights, one number for each of the ``features``, are what
    is sent around.
    """
    rows = docs.where(F.col(text).isNotNull()).join(
        labels.where(F.col(flag).isin(0, 1)).select(key, F.col(flag).cast("double").alias("__label")), key
    )
    words = RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[\x20\x09-\x0D]+")
    hashed = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=features)
    model = LogisticRegression(
        featuresCol="__counts", labelCol="__label", rawPredictionCol="__raw", probabilityCol="__probability",
        predictionCol="__prediction", regParam=strength, maxIter=rounds,
    )
    return Pipeline(stages=[words, hashed, model]).fit(rows.select(text, "__label"))


def quality_scores(docs: DataFrame, model: PipelineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): how likely the label is 1. A null text is scored as one without words."""
    scored = model.transform(docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text)))
    return scored.select(key, vector_to_array("__probability")[1].alias("score"))


def readable(text: Column, letters: float = 0.6) -> Column:
    """Whether at least a share of the characters that are not blank are letters."""
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    return F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) >= letters * solid


# --- duplicates -------------------------------------------------------------------------


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each text, the one with the smallest key. Rows without a text all stay.

    The smallest key of a digest is a partial minimum, so many copies of one text are no
    hot spot, and the texts themselves are not shuffled until the keys are known.
    """
    digest = F.coalesce(F.sha2(F.col(text), 256), F.concat(F.lit("null "), F.col(key).cast("string")))
    first = docs.groupBy(digest.alias("__digest")).agg(F.min(key).alias(key)).select(key)
    return docs.join(first, key, "left_semi")


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts without lines that stand earlier in the corpus, by (key, place). Keys are unique.

    Lines without a visible character stay. Lines are compared as text: a hash only chooses
    the lines worth comparing.
    """
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("place", "line")).where(
        F.col("line").rlike(r"[^\s]")
    )
    place = F.struct(key, "place")
    first = lines.groupBy("line").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    first = cut_lineage(first, "lines")
    found = lookup_join(lines, first.drop("n"), ["line"], [key, "place"], counts=first.drop("first"))
    gone = found.where(place != F.col("first")).groupBy(key).agg(F.collect_set("place").alias("__gone"))
    kept = let(
        F.struct(F.split(text, "\n").alias("lines"), F.col("__gone").alias("gone")),
        lambda s: F.array_join(F.filter(s["lines"], lambda _, k: ~F.array_contains(s["gone"], k)), "\n"),
    )
    joined = docs.join(gone, key, "left")
    return joined.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept)).drop("__gone")


def _word_runs(text: Column, length: int) -> Column:
    """The runs of lower-case words, repeats included, each as 128 bits of hashes.

    Repeats stay, as Spark compares the structs of an array each with each to make them distinct.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def hashed(found: Column) -> Column:
        count = F.size(found) - length + 1
        starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: let(
                F.array_join(F.slice(found, i, F.lit(length)), " "),
                lambda run: F.struct(F.xxhash64(run).alias("a"), F.xxhash64(F.lit(1), run).alias("b")),
            ),
        )

    return let(words, hashed)


def contamination(
    docs: DataFrame, items: DataFrame, length: int = 8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, shared): rows that share runs of words with held-out items, and how many distinct ones.

    Only 128 bits of each run are kept. The items' runs are counted and broadcast while they
    are few; beyond that the join is shuffled, and a run of very many rows is spread by key.
    Repeats of a run in a row are told apart after the join, among the few that are shared.
    """
    held = cut_lineage(items.select(F.explode(_word_runs(F.col(text), length)).alias("r")).select("r.*").distinct(), "runs")
    asked = docs.select(key, F.explode(_word_runs(F.col(text), length)).alias("r")).select(key, "r.*")
    if fits(held, _BROADCAST_HASHES):
        found = asked.join(F.broadcast(held), ["a", "b"], "left_semi")
    else:
        found = lookup_join(asked, held, ["a", "b"], [key], "left_semi")
    return found.select(key, "a", "b").distinct().groupBy(key).agg(F.count("*").alias("shared"))


# --- web pages --------------------------------------------------------------------------


def page_texts(
    table: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    max_link_share: float = 0.5, max_pages: int = 2,
) -> DataFrame:
    """(key, host, paragraphs, text): each page's paragraphs without boilerplate, one per line.

    A paragraph is boilerplate when more than ``max_link_share`` of it stands in links, or when
    more than ``max_pages`` pages of its host have it. A host may hold much of the table:
    paragraphs are counted with partial sums, and frequent ones are spread by page.
    """
    named = table.select(
        key, pages.host(F.col(url)).alias("host"), F.posexplode(pages.paragraphs(F.col(html))).alias("place", "p")
    ).select(key, "host", "place", "p.*")
    own = named.where(F.col("link_chars") <= F.length("text") * F.lit(max_link_share))
    seen = own.select(key, "host", "text").distinct().groupBy("host", "text").agg(F.count("*").alias("__pages"))
    common = cut_lineage(seen.where(F.col("__pages") > max_pages), "boilerplate")
    marked = lookup_join(
        own, common.drop("__pages").withColumn("__common", F.lit(True)), ["host", "text"], [key, "place"], "left",
        counts=common.select("host", "text", F.col("__pages").alias("n")),
    )
    kept = (
        marked.where(F.col("__common").isNull())
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("__kept"))
    )
    return table.select(key, pages.host(F.col(url)).alias("host")).join(kept, key, "left").select(
        key,
        "host",
        F.coalesce(F.size("__kept"), F.lit(0)).alias("paragraphs"),
        F.coalesce(F.array_join(F.transform("__kept", lambda p: p["text"]), "\n"), F.lit("")).alias("text"),
    )


# --- tuning sets ------------------------------------------------------------------------


def instruction_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, instruction, response): each user turn that an assistant turn follows.

    Joined on (conv_id, turn), so a conversation of any length is spread over the tasks.
    """
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    given = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(given, ["conv_id", "turn"])


def masked_rows(
    df: DataFrame, ratio: float, mask_id: int, seed: int, key: str = "doc_id", ids: str = "ids", ignore: int = -100
) -> DataFrame:
    """Adds ``input`` and ``labels``: masked positions hold the mask in one and their id in the other.

    All other labels are ``ignore``, which a loss leaves out. Draws depend on key and position.
    """
    held = df.withColumn("__hits", below(ratio, seed, key, F.col(ids)))
    return held.withColumn(
        "input", F.zip_with(ids, "__hits", lambda x, hit: F.when(hit, F.lit(mask_id)).otherwise(x))
    ).withColumn(
        "labels", F.zip_with(ids, "__hits", lambda x, hit: F.when(hit, x).otherwise(F.lit(ignore)))
    ).drop("__hits")


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that have labels, with them."""
    return docs.join(labels, key)


def with_provenance(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds what a document is traced by: ``sha256`` of its text, ``n_words`` and ``n_lines``."""
    return docs.withColumns(
        {
            "sha256": F.sha2(F.col(text), 256),
            "n_words": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")),
            "n_lines": F.size(F.split(text, "\n")),
        }
    )


def funnel(docs: DataFrame, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]], text: str = "text") -> DataFrame:
    """(stage, name, documents, characters): what is left after each step of a chain.

    Each step's rows are written once and are the next one's input.
    """
    counted = None
    for stage, (name, step) in enumerate([("input", lambda df: df), *steps]):
        docs = step(docs) if stage == 0 else cut_lineage(step(docs), "step")
        own = docs.agg(
            F.lit(stage).alias("stage"),
            F.lit(name).alias("name"),
            F.count("*").alias("documents"),
            F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias("characters"),
        )
        counted = own if counted is None else counted.unionByName(own)
    return counted
