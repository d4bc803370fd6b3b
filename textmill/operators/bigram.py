"""Counted bigram model: fitting, scoring and sampling.

The model is the sparse table of pairs that occur. Smoothing gives every other pair the
same small weight, so it is added when a probability is read and never stored:

    p(next | prev) = (n + s) / (row_sum + s * V)
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.functions.hashing import uniform
from textmill.functions.lambdas import let
from textmill.operators.joins import lookup_join
from textmill.operators.ranking import rejoin
from textmill.sources.storage import cut_lineage, fits

_BROADCAST_ROWS = 500_000
# Log-probabilities kept as one array (2 MB).
_TABLE_CELLS = 250_000
# Sampling steps between two written tables.
_STEPS_PER_STAGE = 16


@dataclass(frozen=True)
class BigramModel:
    """counts: (prev, next, n). Not fitted (no pairs seen) means a uniform model."""

    counts: DataFrame
    vocab_size: int
    smoothing: float = 1e-6
    fitted: bool = True

    def __post_init__(self) -> None:
        if self.vocab_size <= 0:
            raise ValueError("a model needs a vocabulary of at least one token")

    @property
    def small(self) -> bool:
        return fits(self.counts, _BROADCAST_ROWS)


def pairs(df: DataFrame, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, prev, next) for each neighbouring pair; computed inside each row."""
    return df.select(key, F.inline(tokens.adjacent_pairs(F.col(ids))))


def count_pairs(df: DataFrame, ids: str = "ids") -> DataFrame:
    """(prev, next, n): partial sums per task, then one row per distinct pair."""
    return (
        df.select(F.inline(tokens.adjacent_pairs(F.col(ids))))
        .groupBy("prev", "next")
        .agg(F.count("*").alias("n"))
    )


def fit(
    df: DataFrame, vocab_size: int, smoothing: float = 1e-6, ids: str = "ids"
) -> BigramModel:
    """Count the pairs of all rows. Ids outside [0, vocab_size) are an error."""
    BigramModel(df, vocab_size)  # checks the size before any job runs
    counts = cut_lineage(count_pairs(df, ids), "bigram")
    ends = counts.agg(
        F.least(F.min("prev"), F.min("next")).alias("lo"),
        F.greatest(F.max("prev"), F.max("next")).alias("hi"),
    ).first()
    if ends.lo is not None and not (0 <= ends.lo and ends.hi < vocab_size):
        raise ValueError("the ids of a model's vocabulary must be in range: one lies outside")
    return BigramModel(counts, vocab_size, smoothing, ends.lo is not None)


def _smoothed(model: BigramModel, n: Column, row_sum: Column) -> Column:
    return (n + model.smoothing) / (row_sum + model.smoothing * model.vocab_size)


def row_sums(model: BigramModel) -> DataFrame:
    return model.counts.groupBy("prev").agg(F.sum("n").alias("row_sum"))


def probabilities(model: BigramModel) -> DataFrame:
    """(prev, next, n, p) for the pairs that occur. A window row is at most one per token id."""
    row_sum = F.sum("n").over(W.partitionBy("prev"))
    return model.counts.withColumn("p", _smoothed(model, F.col("n"), row_sum))


def next_distribution(model: BigramModel, spark: SparkSession, token_id: int) -> DataFrame:
    """(next, p) over the whole vocabulary for one token; uniform when not fitted."""
    if not 0 <= token_id < model.vocab_size:
        raise ValueError("no such token in the vocabulary")
    every = spark.range(model.vocab_size).select(F.col("id").cast("int").alias("next"))
    if not model.fitted:
        return every.withColumn("p", F.lit(1.0 / model.vocab_size))
    row = model.counts.where(F.col("prev") == token_id).select("next", "n")
    total = F.coalesce(row.agg(F.sum("n").alias("s")).scalar(), F.lit(0))
    n = F.coalesce(F.col("n"), F.lit(0))
    return every.join(row, "next", "left").select("next", _smoothed(model, n, total).alias("p"))


# --- scoring ----------------------------------------------------------------------------


def log_probability(
    df: DataFrame, model: BigramModel, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Add (transitions, log_prob) to each row.

    Fewer than two tokens score 0; an id outside the vocabulary scores -infinity, and so
    does a pair with no probability when smoothing is 0. Over a small vocabulary rows are
    scored in place; otherwise scores are joined back by ``key``, which must then be unique.
    """
    size = F.coalesce(F.size(ids), F.lit(0))
    transitions = F.greatest(size - 1, F.lit(0))
    unknown = F.coalesce(
        F.exists(ids, lambda i: (i < 0) | (i >= model.vocab_size)), F.lit(False)
    )
    out = df.withColumn("transitions", transitions)
    if not model.fitted:
        score = transitions * -F.ln(F.lit(float(model.vocab_size)))
    elif model.vocab_size**2 <= _TABLE_CELLS:
        out = out.withColumn("__cells", _cells(model, df.sparkSession))
        place = lambda p: p["prev"] * model.vocab_size + p["next"]
        score = F.aggregate(
            tokens.adjacent_pairs(F.col(ids)), F.lit(0.0), lambda acc, p: acc + F.get("__cells", place(p))
        )
    else:
        out = rejoin(out, _pair_scores(df, model, key, ids), key, "left")
        score = F.coalesce(F.col("__score"), F.lit(0.0))
    value = (
        F.when(transitions == 0, F.lit(0.0))
        .when(unknown, F.lit(float("-inf")))
        .otherwise(score)
    )
    return out.withColumn("log_prob", value).drop("__score", "__cells")


def _log_p(model: BigramModel) -> Column:
    """ln p of a pair from its ``n`` and ``row_sum``, null where it was not seen."""
    n = F.coalesce("n", F.lit(0))
    row_sum = F.coalesce("row_sum", F.lit(0)).cast("double")
    if model.smoothing > 0:
        p = _smoothed(model, n, row_sum)
    else:
        p = F.try_divide(n.cast("double"), row_sum)
    # a pair without probability: ln gives null, which sum() would skip
    return F.coalesce(F.ln(p), F.lit(float("-inf")))


def _cells(model: BigramModel, spark: SparkSession) -> Column:
    """ln p of every pair as one array, by prev * vocabulary size + next; at most _TABLE_CELLS."""
    v = model.vocab_size
    cell = F.col("id")
    every = spark.range(v * v).select(
        "id", F.floor(cell / v).cast("int").alias("prev"), (cell % v).cast("int").alias("next")
    )
    known = every.join(model.counts, ["prev", "next"], "left").join(row_sums(model), "prev", "left")
    rows = known.select(F.struct("id", _log_p(model).alias("l")).alias("c"))
    return rows.agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["l"]).alias("cells")).scalar()


def _pair_scores(df: DataFrame, model: BigramModel, key: str, ids: str) -> DataFrame:
    """(key, __score): sum of ln p over the pairs of each row.

    A small model is broadcast and each pair looks itself up in place, with only sums
    leaving the task. For a large one each row's pairs are counted first, so the shuffle
    carries distinct pairs and not tokens.
    """
    sums = row_sums(model)
    if model.small:
        found = pairs(df, key, ids).withColumn("times", F.lit(1))
        found = found.join(F.broadcast(model.counts), ["prev", "next"], "left")
        found = found.join(F.broadcast(sums), "prev", "left")
    else:
        found = pairs(df, key, ids).groupBy(key, "prev", "next").agg(F.count("*").alias("times"))
        found = lookup_join(found, model.counts, ["prev", "next"], [key], "left")
        found = lookup_join(found, sums, ["prev"], [key, "next"], "left")
    return found.groupBy(key).agg(F.sum(F.col("times") * _log_p(model)).alias("__score"))


def perplexity(scored: DataFrame) -> DataFrame:
    """Add perplexity to scored rows: NaN without a transition, infinity without a finite score."""
    n, score = F.col("transitions"), F.col("log_prob")
    value = (
        F.when(n == 0, F.lit(float("nan")))
        .when(score == float("-inf"), F.lit(float("inf")))
        .otherwise(F.exp(-score / n))
    )
    return scored.withColumn("perplexity", value)


def cross_entropy(scored: DataFrame, by: str) -> DataFrame:
    """(by, transitions, cross_entropy): mean negative log-probability per transition."""
    return scored.groupBy(by).agg(
        F.sum("transitions").cast("long").alias("transitions"),
        (-F.sum("log_prob") / F.sum("transitions")).alias("cross_entropy"),
    )


# --- sampling ---------------------------------------------------------------------------


def reshaped(model: BigramModel, temperature: float) -> DataFrame:
    """(prev, next, p): probabilities after softmax(ln(p + 1e-20) / T), for pairs that occur.

    The softmax runs over the whole vocabulary. All pairs that do not occur have one and the
    same weight in a row, so their share of the sum is that weight times their number.
    """
    if temperature <= 0:
        raise ValueError("a temperature above zero is needed")
    probs = probabilities(model)
    if temperature == 1.0:
        return probs.select("prev", "next", "n", "p")
    row = W.partitionBy("prev")
    row_sum = F.sum("n").over(row)
    logit = F.ln(F.col("p") + 1e-20) / temperature
    unseen_logit = F.ln(_smoothed(model, F.lit(0), row_sum) + 1e-20) / temperature
    staged = probs.select(
        "prev", "next", "n", logit.alias("l"), unseen_logit.alias("l0"),
        (F.lit(model.vocab_size) - F.count("*").over(row)).alias("unseen"),
    ).withColumn("top", F.max("l").over(row))
    total = F.sum(F.exp(F.col("l") - F.col("top"))).over(row) + F.col("unseen") * F.exp(
        F.col("l0") - F.col("top")
    )
    return staged.select("prev", "next", "n", (F.exp(F.col("l") - F.col("top")) / total).alias("p"))


def _row_facts(model: BigramModel, seen: DataFrame, spark: SparkSession, temperature: float) -> DataFrame:
    """(prev, known, mass, p0) for every id: pairs seen, their probability, that of an unseen one."""
    every = spark.range(model.vocab_size).select(F.col("id").cast("int").alias("prev"))
    facts = seen.groupBy("prev").agg(F.count("*").alias("known"), F.sum("p").alias("mass"))
    known = F.coalesce("known", F.lit(0))
    mass = F.coalesce("mass", F.lit(0.0))
    unseen = model.vocab_size - known
    p0 = F.when(unseen > 0, F.greatest(1 - mass, F.lit(0.0)) / unseen).otherwise(F.lit(0.0))
    return every.join(facts, "prev", "left").select(
        "prev", known.alias("known"), mass.alias("mass"), p0.alias("p0")
    )


def _with_unseen(
    seen: DataFrame, facts: DataFrame, missing: Column, vocab_size: int
) -> DataFrame:
    """Add, to rows that need them, their ``missing`` lowest-numbered unseen continuations.

    Among ids 0 .. known + missing - 1 at least ``missing`` are unseen, so no more are made.
    """
    short = facts.withColumn("missing", missing).where(F.col("missing") > 0)
    upto = F.least(F.col("known") + F.col("missing"), F.lit(vocab_size)) - 1
    ids = short.select(
        "prev", "missing", "p0",
        F.explode(F.sequence(F.lit(0), upto.cast("int"))).alias("next"),
    )
    unseen = ids.join(seen.select("prev", "next"), ["prev", "next"], "left_anti")
    place = F.row_number().over(W.partitionBy("prev").orderBy("next"))
    kept = unseen.withColumn("place", place).where(F.col("place") <= F.col("missing"))
    return seen.select("prev", "next", "p").unionByName(
        kept.select("prev", "next", F.col("p0").alias("p"))
    )


def _renormalised(candidates: DataFrame) -> DataFrame:
    total = F.sum("p").over(W.partitionBy("prev"))
    return candidates.select("prev", "next", (F.col("p") / total).alias("p"))


def top_k(model: BigramModel, spark: SparkSession, k: int, temperature: float = 1.0) -> DataFrame:
    """(prev, next, p): the k likeliest continuations of every id, with probabilities that sum to 1.

    Equal probabilities go to the lower id. k above the vocabulary size means all of it.
    """
    if k <= 0:
        raise ValueError("at least one continuation must be kept")
    k = min(k, model.vocab_size)
    seen = reshaped(model, temperature)
    facts = _row_facts(model, seen, spark, temperature)
    everyone = _with_unseen(seen, facts, F.lit(k) - F.col("known"), model.vocab_size)
    place = F.row_number().over(W.partitionBy("prev").orderBy(F.desc("p"), "next"))
    return _renormalised(everyone.withColumn("place", place).where(F.col("place") <= k))


def top_p(
    model: BigramModel, spark: SparkSession, threshold: float, temperature: float = 1.0
) -> DataFrame:
    """(prev, next, p): the smallest set of likeliest continuations that reaches the threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a share above 0 and up to 1")
    seen = reshaped(model, temperature)
    facts = _row_facts(model, seen, spark, temperature)
    lacking = F.lit(threshold) - F.col("mass")
    needed = F.ceil(F.try_divide(lacking, F.col("p0"))) + 1
    unseen = F.lit(model.vocab_size) - F.col("known")
    missing = F.when((lacking > 0) & (unseen > 0), F.least(F.coalesce(needed, unseen), unseen))
    everyone = _with_unseen(seen, facts, F.coalesce(missing, F.lit(0)), model.vocab_size)
    order = W.partitionBy("prev").orderBy(F.desc("p"), "next")
    cum = F.sum("p").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    kept = everyone.withColumn("cum", cum).where(F.col("cum") - F.col("p") < threshold)
    return _renormalised(kept)


def _walk(
    starts: DataFrame,
    length: int,
    key: str,
    step: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """Extend every sequence one token at a time: (key, ids).

    Sequences move together: step t is one join of all of them with the continuation
    table. The state is written out every few steps to keep the plan short.
    """
    if length <= 0:
        raise ValueError("a sequence has at least one token")
    state = starts.select(key, F.array("start").alias("ids"), F.col("start").alias("prev"))
    for t in range(1, length):
        state = step(state, t)
        if t % _STEPS_PER_STAGE == 0 and t + 1 < length:
            state = cut_lineage(state, "walk")
    return state.select(key, "ids")


def _continuations(table: DataFrame, weight: str) -> DataFrame:
    """(prev, options): one row per id with its continuations and their running weights."""
    order = W.partitionBy("prev").orderBy("next")
    cum = F.sum(weight).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        table.withColumn("cum", cum)
        .groupBy("prev")
        .agg(F.array_sort(F.collect_list(F.struct("cum", "next"))).alias("options"))
    )


def _attach(state: DataFrame, table: DataFrame, small: bool, key: str) -> DataFrame:
    if small:
        return state.join(F.broadcast(table), "prev", "left")
    return lookup_join(state, table, ["prev"], [key], "left")


def _advance(state: DataFrame, key: str, chosen: Column) -> DataFrame:
    return state.select(key, "ids", chosen.cast("int").alias("prev")).select(
        key, F.concat("ids", F.array("prev")).alias("ids"), "prev"
    )


def _first_above(point: Column) -> Column:
    """The continuation whose running weight first exceeds the point (else the last one)."""
    # the number of weights up to the point, found from its highest bit to its lowest
    bits = F.sequence(F.floor(F.log2(F.size("options"))).cast("int"), F.lit(0), F.lit(-1))

    def more(count: Column, bit: Column, p: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), bit)
        within = F.get("options", count + step - 1)["cum"] <= p
        return count + F.when(within, step).otherwise(F.lit(0))

    count = let(point, lambda p: F.aggregate(bits, F.lit(0), lambda acc, bit: more(acc, bit, p)))
    return F.coalesce(F.get("options", count)["next"], F.element_at("options", -1)["next"])


def sample(
    starts: DataFrame, model: BigramModel, length: int, seed: int, key: str = "doc_id"
) -> DataFrame:
    """(key, ids): one sequence per (key, start) row, drawn from the smoothed model.

    The smoothed row is a mixture: with probability row_sum / (row_sum + s V) a draw from
    the counts, otherwise a uniform draw over the vocabulary. So unseen pairs are reached
    without a row for each. A start that is not in the vocabulary fails the job.
    """
    bad = F.raise_error(F.lit("a sequence starts with an id outside the vocabulary")).cast("int")
    first = F.when(F.col("start").between(0, model.vocab_size - 1), F.col("start")).otherwise(bad)
    starts = starts.withColumn("start", first.cast("int"))
    table = cut_lineage(_continuations(model.counts, "n"), "continuations")
    small = model.small
    pseudo = model.smoothing * model.vocab_size

    def step(state: DataFrame, t: int) -> DataFrame:
        drawn = _attach(state, table, small, key)
        seen = F.coalesce(F.element_at("options", -1)["cum"], F.lit(0))
        share = F.coalesce(F.try_divide(seen.cast("double"), seen + F.lit(pseudo)), F.lit(0.0))
        counted = _first_above(F.floor(uniform(seed, key, F.lit(f"c{t}")) * seen))
        anything = F.floor(uniform(seed, key, F.lit(f"u{t}")) * model.vocab_size)
        from_counts = uniform(seed, key, F.lit(f"m{t}")) < share
        return _advance(drawn, key, F.when(from_counts, counted).otherwise(anything))

    return _walk(starts, length, key, step)


def sample_from(
    starts: DataFrame, candidates: DataFrame, length: int, seed: int, key: str = "doc_id"
) -> DataFrame:
    """(key, ids): sequences drawn from a (prev, next, p) table such as ``top_k`` gives."""
    table = cut_lineage(_continuations(candidates, "p"), "continuations")
    small = fits(table.select(F.explode("options")), _BROADCAST_ROWS)

    def step(state: DataFrame, t: int) -> DataFrame:
        drawn = _attach(state, table, small, key)
        total = F.element_at("options", -1)["cum"]
        return _advance(drawn, key, _first_above(uniform(seed, key, F.lit(f"c{t}")) * total))

    return _walk(starts, length, key, step)
