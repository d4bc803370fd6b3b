"""Quality rules by robust multivariate outliers, by DataFrame operations only.

Base rules come first: a document fails with fewer than 50 words, or when more than half of its
words lie in three-word windows that occur twice or more in it. The others are described by five
transformed statistics: length, word length, and the shares of symbols, repeated lines and
repeated words. For each language and source, location and scatter are estimated by the minimum
covariance determinant, and a document is rejected if its squared Mahalanobis distance exceeds
``CUTOFF``.

The determinant is minimised by concentration steps: from the half nearest to the median
(scaled by the median deviation), mean and covariance are taken over the ``COVERAGE`` nearest
documents, until no group's determinant falls by a hundredth (``STEPS`` times at most). A group is never gathered: the
medians and the nearest share come from counts in bins, mean and covariance from exact integer
sums, so a group with a third of all rows is only partial sums, and reruns agree.

A variance floor for each statistic keeps the estimates regular where most documents have the
same value. Shares of repeated lines and words are angles, arcsin of the root, so that the floors
leave room for an extreme value of either to exceed the cut-off by itself. Groups of fewer than
``MIN_GROUP`` documents use the estimate of their language over all sources; if that is as small,
their documents are kept.

Defined results: a null or empty text has no words and fails the base rules. A null language or
source is a value of its own. Repeated rows each get a row. Only doc_id, text, lang and source
are read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions.lambdas import let
from textmill.sources.storage import cut_lineage, fits

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent
COVERAGE = 0.75
STEPS = 8  # at most; they end when no determinant falls by a hundredth any more
MIN_GROUP = 40
CUTOFF = 24.0  # the 0.9998 quantile of chi-square with 5 degrees of freedom
# statistics are integers of thousandths, so that sums are exact
UNIT = 1000
NAMES = ("t_length", "t_word", "t_symbols", "t_lines", "t_repeats")
# an extreme value of any one statistic must exceed the cut-off by itself where the group has no
# scatter: the last two do with four in ten of a long text, and with less when both are high
FLOORS = (0.3, 0.06, 0.5, 0.14, 0.14)
# added to the whole of a share, so that one repeated line in a text of few lines is not extreme
PRIOR_LINES = 4
PRIOR_WORDS = 10
# covariance of the nearest three quarters of a normal sample in 5 dimensions, to that of all
CONSISTENCY = 1.41
_BROADCAST_GROUPS = 100_000  # rows of 20 numbers
_PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _word_list(text: Column) -> Column:
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """The number of words in three-word windows that occur twice or more."""

    def covered(places: Column) -> Column:
        ends = F.concat(F.slice(places, F.lit(2), F.size(places)), F.array(F.element_at(places, -1) + 3))
        spans = F.zip_with(places, ends, lambda a, b: F.least(F.lit(3), b - a))
        return F.aggregate(spans, F.lit(0), lambda total, x: total + x)

    def twice(ordered: Column) -> Column:
        last = F.size(ordered) - 1

        def same(k: Column, other: Column) -> Column:
            return F.get(ordered, k)["h"] == F.get(ordered, other)["h"]

        where = F.filter(
            F.sequence(F.lit(0), last),
            lambda k: ((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1)),
        )
        return let(F.sort_array(F.transform(where, lambda k: F.get(ordered, k)["i"])), covered)

    def count(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(let(F.sort_array(numbered), twice))

    # the words after each word, side by side
    n = F.size(words)
    triples = F.arrays_zip(
        F.slice(words, F.lit(1), n - 2).alias("a"),
        F.slice(words, F.lit(2), n - 2).alias("b"),
        F.slice(words, F.lit(3), n - 2).alias("c"),
    )
    hashes = F.transform(triples, lambda z: F.xxhash64(z["a"], z["b"], z["c"]))
    return F.when(n < 4, F.lit(0)).otherwise(let(hashes, count))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    own = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    per_text = own.select(
        "doc_id",
        "lang",
        "source",
        let(_word_list(F.col("text")), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("l"),
    )
    return per_text.select(
        "doc_id",
        "lang",
        "source",
        F.col("w.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.d").cast("long").alias("n_dup_lines"),
        F.col("w.r").cast("long").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"),
    )


def _angle(part: Column, whole: Column) -> Column:
    """A share as an angle from 0 to pi/2: its variance no longer depends on the share."""
    return F.asin(F.sqrt(part / whole))


def _transformed() -> list[Column]:
    words, chars = F.col("n_words") + 1, F.col("word_chars") + 1
    values = [
        F.ln(words),
        F.ln(chars / words),
        F.ln(1 + 100 * F.col("n_symbols") / chars),
        _angle(F.col("n_dup_lines"), F.col("n_lines") + PRIOR_LINES),
        _angle(F.col("n_repeat_words"), F.col("n_words") + PRIOR_WORDS),
    ]
    return [F.round(v * UNIT).cast("long").alias(name) for v, name in zip(values, NAMES, strict=True)]


def _below(counts: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """(by, cut): the smallest value that at least a share of the group does not exceed."""
    whole = W.partitionBy(*by)
    upto = whole.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = counts.select(*by, value, F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("all"))
    return placed.where(F.col("upto") >= F.ceil(F.col("all") * share)).groupBy(*by).agg(F.min(value).alias("cut"))


def _start(rows: DataFrame) -> DataFrame:
    """(group, m_k, s_k): medians and floored median deviations, from counts of values."""
    long = rows.select(
        "group", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("v")) for k, n in enumerate(NAMES)])).alias("x")
    ).select("group", "x.k", "x.v")
    counts = cut_lineage(long.groupBy("group", "k", "v").agg(F.count("*").alias("n")), "values")
    middle = _below(counts, ["group", "k"], "v", 0.5).withColumnRenamed("cut", "m")
    away = counts.join(middle, ["group", "k"]).select("group", "k", F.abs(F.col("v") - F.col("m")).alias("v"), "n")
    away = away.groupBy("group", "k", "v").agg(F.sum("n").alias("n"))
    spread = _below(away, ["group", "k"], "v", 0.5).withColumnRenamed("cut", "s")
    both = middle.join(spread, ["group", "k"])
    floors = F.element_at(F.array(*[F.lit(f * UNIT) for f in FLOORS]), F.col("k") + 1)
    both = both.withColumn("s", F.greatest(F.col("s") * 1.4826, floors))
    return both.groupBy("group").agg(
        *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}_{k}") for k in range(len(NAMES)) for c in ("m", "s")]
    )


def _solved(estimate: DataFrame) -> DataFrame:
    """(group, m_k, c_i_j) -> (group, m_k, l_i_j): the Cholesky factor of each covariance."""
    for i, j in _PAIRS:
        done = [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)]
        rest = reduce(lambda a, b: a - b, done, F.col(f"c_{i}_{j}"))
        estimate = estimate.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    return estimate.select("group", *[f"m_{k}" for k in range(len(NAMES))], *[f"l_{i}_{j}" for i, j in _PAIRS])


def _distance(rows: DataFrame) -> DataFrame:
    """Add d2, the squared distance, by forward substitution."""
    for i in range(len(NAMES)):
        done = [F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)]
        rest = reduce(lambda a, b: a - b, done, F.col(NAMES[i]) - F.col(f"m_{i}"))
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{k}") ** 2 for k in range(1, len(NAMES))), F.col("y_0") ** 2))


def _concentrated(placed: DataFrame, share: float) -> DataFrame:
    """(group, m_k, c_i_j) over each group's share of rows with the smallest d2.

    Distances are compared in bins of about one per cent, so the share is met up to one bin.
    """
    binned = placed.withColumn("bin", F.floor(F.ln(1 + F.col("d2")) * 100).cast("int"))
    counts = binned.groupBy("group", "bin").agg(F.count("*").alias("n"))
    cuts = _by_group(cut_lineage(_below(counts, ["group"], "bin", share), "cuts"))
    near = binned.join(cuts, "group").where("bin <= cut")
    sums = near.groupBy("group").agg(
        F.count("*").alias("n"),
        *[F.sum(n).alias(f"a_{k}") for k, n in enumerate(NAMES)],
        *[F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"b_{i}_{j}") for i, j in _PAIRS],
    )
    mean = {k: F.col(f"a_{k}") / F.col("n") for k in range(len(NAMES))}
    cov = [
        (
            CONSISTENCY * (F.col(f"b_{i}_{j}") / F.col("n") - mean[i] * mean[j])
            + F.lit((FLOORS[i] * UNIT) ** 2 if i == j else 0.0)
        ).alias(f"c_{i}_{j}")
        for i, j in _PAIRS
    ]
    return sums.select("group", *[m.alias(f"m_{k}") for k, m in mean.items()], *cov)


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(group, m_k, l_i_j): location and Cholesky factor of the scatter, one row per group."""
    found = _start(rows)
    for i, j in _PAIRS:
        found = found.withColumn(f"l_{i}_{j}", F.col(f"s_{i}") if i == j else F.lit(0.0))
    found = cut_lineage(found, "estimate")
    for step in range(steps):
        share = 0.5 if step == 0 else COVERAGE
        placed = _distance(rows.join(_by_group(found), "group"))
        before, found = found, cut_lineage(_solved(_concentrated(placed, share)), "estimate")
        if step > 1:
            log = sum((F.ln(f"l_{k}_{k}") for k in range(1, len(NAMES))), F.ln("l_0_0"))
            fell = found.select("group", log.alias("now")).join(before.select("group", log.alias("then")), "group")
            if fell.where(F.col("now") < F.col("then") - 0.01).isEmpty():
                break
    return found


def _by_group(table: DataFrame) -> DataFrame:
    """A table of one row for each group, sent to every task where there are few groups.

    A group may hold a third of the rows, which a join on the group would deal to one task.
    With very many groups no broadcast is made; the optimizer then splits large groups.
    """
    return F.broadcast(table) if fits(table, _BROADCAST_GROUPS) else table


def rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, the counts, base_failed, kept, d2) of every row."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = statistics(docs).withColumn("base_failed", failed).select("*", *_transformed())
    rows = cut_lineage(rows, "statistics")
    named = [F.coalesce(F.concat(F.lit("="), c), F.lit("null")) for c in ("lang", "source")]
    fine, coarse = F.concat_ws("\x01", *named), F.concat(named[0], F.lit("\x02"))
    good = rows.where(~F.col("base_failed"))
    counts = good.groupBy(fine.alias("fine"), coarse.alias("coarse")).agg(F.count("*").alias("n"))
    own = counts.where(F.col("n") >= MIN_GROUP).select(F.col("fine").alias("group"))
    sizes = counts.groupBy("coarse").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_GROUP)
    # one small row per group: which estimate each (language, source) uses
    uses = counts.join(own, counts.fine == own.group, "left").join(sizes.select("coarse", F.lit(True).alias("big")), "coarse", "left")
    uses = cut_lineage(
        uses.select("fine", F.when(F.col("group").isNotNull(), F.col("fine")).when(F.col("big"), F.col("coarse")).alias("group"), "coarse"),
        "groups",
    )
    narrow = good.select(fine.alias("fine"), coarse.alias("coarse"), *NAMES)
    used = uses.where("group = coarse").select("coarse").distinct()
    parts = narrow.join(_by_group(uses.where("group = fine").select("fine")), "fine").select(F.col("fine").alias("group"), *NAMES)
    whole = narrow.join(_by_group(used), "coarse").select(F.col("coarse").alias("group"), *NAMES)
    found = estimates(cut_lineage(parts.unionByName(whole), "vectors"))
    located = uses.join(found, "group").drop("coarse", "group").withColumnRenamed("fine", "fine_")
    judged = _distance(rows.join(_by_group(located), fine == F.col("fine_"), "left"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), F.when(~F.col("base_failed"), F.col("d2")).alias("d2"),
    )
