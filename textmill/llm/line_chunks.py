"""Line deduplication in content-defined chunks, by DataFrame operations only.

A text is a row of lines with a character other than white space, each with the blank lines
before it. A rolling hash runs over the hashes of two neighbouring lines, and a chunk begins
where it is lower than at the places before and after. A chunk thus has two lines at least, and
where it begins depends on the lines near its start alone: a passage is cut at the same places
wherever it stands, however many lines were put in before it.

Chunks are first counted by a 64-bit hash of their bytes. Only those whose hash repeats are read
again with their text, and they are grouped by the text itself, so a chunk is removed after its
bytes were compared and never on a hash. The first copy by (doc_id, place) stays.

The ends of a passage seldom fall on the borders of chunks, and a passage of two or three lines
may hold no whole chunk. So matches are extended: every line outside the removed chunks is
compared, together with its neighbour, with the pairs of lines that stand earlier, in the same
way and with the same comparison of bytes. What is removed in the end is every line that belongs
to a run of two or more lines that stands earlier in the corpus, whatever its length.

Defined results: a null text stays null, with no lines; an empty text is one line and stays.
Rows with the same doc_id and the same text are one document here, so both stay as they are
left; ids that are null sort before others. Equal chunks within a document count as repeats. The
blank lines before a removed line go with it. Columns other than doc_id and text pass through
untouched.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.lambdas import let
from textmill.operators.joins import lookup_join
from textmill.sources.storage import cut_lineage, fits

_BROADCAST_HASHES = 1_000_000  # of 8 bytes each
_SOLID = r"\S"


def line_array(text: Column) -> Column:
    """ARRAY<STRING> of the lines, each with the blank lines before it; joined by newlines they are the text."""

    def cut(lines: Column) -> Column:
        last = F.size(lines) - 1
        inner = F.filter(F.sequence(F.lit(0), last), lambda i: (i < last) & F.get(lines, i).rlike(_SOLID))
        return let(
            F.concat(inner, F.array(last)),
            lambda e: F.transform(
                e,
                lambda end, k: F.array_join(
                    let(
                        F.when(k == 0, F.lit(-1)).otherwise(F.get(e, k - 1)),
                        lambda before: F.slice(lines, before + 2, end - before),
                    ),
                    "\n",
                ),
            ),
        )

    return let(F.split(text, "\n"), cut)


def _solid(lines: Column) -> Column:
    """How many of the lines are solid; only the last one may be blank."""
    return F.size(lines) - F.when(F.element_at(lines, -1).rlike(_SOLID), 0).otherwise(1)


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s*\n", "")


def chunk_starts(lines: Column) -> Column:
    """ARRAY<INT>: the lines at which chunks begin, the first line among them."""

    def minima(rolling: Column) -> Column:
        last = F.size(rolling) - 1
        here = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
        low = F.filter(
            here,
            lambda i: (i < last)
            & (F.get(rolling, i) < F.get(rolling, i - 1))
            & (F.get(rolling, i) <= F.get(rolling, i + 1)),
        )
        return F.concat(F.array(F.lit(0)), F.filter(low, lambda i: i > 1))

    def rolled(hashes: Column) -> Column:
        after = F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0)))
        return let(F.slice(F.zip_with(hashes, after, lambda a, b: F.xxhash64(a, b)), F.lit(1), F.size(after)), minima)

    bare = F.transform(F.slice(lines, F.lit(1), _solid(lines)), lambda line: F.xxhash64(_bare(line)))
    return let(bare, rolled)


def _chunks(text: Column) -> Column:
    """ARRAY<STRUCT<place, n, within, unit>> of the chunks of two or more lines."""

    def cut(lines: Column) -> Column:
        def whole(starts: Column) -> Column:
            each = F.transform(
                starts,
                lambda first, k: let(
                    F.coalesce(F.get(starts, k + 1), _solid(lines)) - first,
                    lambda n: F.struct(
                        first.alias("place"),
                        n.alias("n"),
                        F.lit(-1).alias("within"),
                        _bare(F.array_join(F.slice(lines, first + 1, n), "\n")).alias("unit"),
                    ),
                ),
            )
            return F.filter(each, lambda c: c["n"] > 1)

        return let(chunk_starts(lines), whole)

    return let(line_array(text), cut)


def _pairs(text: Column) -> Column:
    """ARRAY<STRUCT<place, n, within, unit>> of each line with the next one; ``within`` is the
    start of the chunk that holds both."""

    def cut(lines: Column) -> Column:
        n = F.greatest(_solid(lines) - 1, F.lit(0))
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

        def paired(starts: Column) -> Column:
            return F.transform(
                places,
                lambda k: F.struct(
                    k.alias("place"),
                    F.lit(2).alias("n"),
                    F.when(F.array_contains(starts, k + 1), F.lit(-1))
                    .otherwise(F.array_max(F.filter(starts, lambda s: s <= k)))
                    .alias("within"),
                    F.concat(_bare(F.get(lines, k)), F.lit("\n"), F.get(lines, k + 1)).alias("unit"),
                ),
            )

        return let(chunk_starts(lines), paired)

    return let(line_array(text), cut)


def _units(docs: DataFrame, cut: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, th, at, place, n, within, unit, h). th tells texts of one id apart."""
    own = docs.where(F.col("text").contains("\n")).select(
        "doc_id", F.xxhash64("text").alias("th"), F.posexplode(cut(F.col("text"))).alias("at", "u")
    )
    return own.select("doc_id", "th", "at", "u.*", F.xxhash64("u.unit").alias("h"))


def _fetched(docs: DataFrame, found: DataFrame, again: DataFrame, cut: Callable[[Column], Column]) -> DataFrame:
    """The units whose hash repeats, with their text; no other text goes through a shuffle."""
    hits = lookup_join(found.drop("unit"), again.select("h"), ["h"], ["doc_id", "th", "at"], counts=again)
    ats = hits.groupBy(F.col("doc_id").alias("id"), F.col("th").alias("th_")).agg(F.collect_set("at").alias("ats"))
    own = docs.join(ats, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("th_")))
    units = let(
        F.struct(cut(F.col("text")).alias("u"), F.col("ats").alias("ats")),
        lambda s: F.transform(s["ats"], lambda k: F.get(s["u"], k)),
    )
    return own.select("doc_id", F.col("th_").alias("th"), F.inline(units))


def _repeated(docs: DataFrame, cut: Callable[[Column], Column], gone: DataFrame | None = None) -> DataFrame:
    """(doc_id, th, place, n) of the units that stand earlier in the corpus.

    Units within the chunks of ``gone`` are left out; each has an equal one that is not.
    """
    found = _units(docs, cut)
    if gone is not None:
        few = fits(gone, _BROADCAST_HASHES)
        same = (
            F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")) & (F.col("within") == F.col("__place"))
        )
        named = gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("place").alias("__place"))
        found = found.join(F.broadcast(named) if few else named, same, "left_anti")
    again = cut_lineage(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "hashes")
    few = fits(again, _BROADCAST_HASHES)
    held = found.join(F.broadcast(again.select("h")), "h", "left_semi") if few else _fetched(docs, found, again, cut)
    held = cut_lineage(held.select("doc_id", "th", "place", "n", "unit"), "held")
    place = F.struct("doc_id", "th", "place")
    first = held.groupBy("unit").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = cut_lineage(first, "first")
    # a unit in a third of all documents is spread over all tasks
    both = lookup_join(
        held, first.select("unit", "first"), ["unit"], ["doc_id", "th", "place"], counts=first.select("unit", "n")
    )
    return both.where(place != F.col("first")).select("doc_id", "th", "place", "n")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, th, place, n): runs of lines to remove, which may overlap."""
    docs = docs.select("doc_id", "text")
    chunks = cut_lineage(_repeated(docs, _chunks), "chunks")
    return chunks.unionByName(_repeated(docs, _pairs, chunks))


def dedup(docs: DataFrame, detail: bool = False) -> DataFrame:
    """The rows without the lines of repeated chunks.

    With ``detail``, only (doc_id, text, n_removed, n_chars_removed) are returned.
    """
    runs = repeated_runs(docs).groupBy("doc_id", "th").agg(F.collect_set(F.struct("place", "n")).alias("runs"))
    lines = F.array_distinct(
        F.flatten(F.transform("runs", lambda r: F.sequence(r["place"], r["place"] + r["n"] - 1)))
    )
    gone = runs.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), lines.alias("__gone"))
    if detail:
        docs = docs.select("doc_id", "text")
    joined = docs.join(
        gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th")), "left"
    )
    left = let(
        F.struct(line_array(F.col("text")).alias("c"), F.col("__gone").alias("g")),
        lambda s: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(s.c) - 1), s.g), lambda k: F.get(s.c, k)), "\n"
        ),
    )
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left)
    if not detail:
        return joined.withColumn("text", text).select(docs.columns)
    removed = F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size("__gone"))
    return joined.select(
        "doc_id",
        text.alias("__text"),
        F.length("text").alias("__before"),
        removed.cast("long").alias("n_removed"),
    ).select(
        "doc_id",
        F.col("__text").alias("text"),
        "n_removed",
        F.coalesce(F.col("__before") - F.length("__text"), F.lit(0)).cast("long").alias("n_chars_removed"),
    )


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``dedup`` without the documents that lost their whole text."""
    had, has = "__had_text", F.col("text").rlike(_SOLID)
    marked = dedup(docs.withColumn(had, F.coalesce(has, F.lit(False))))
    return marked.where(~F.col(had) | has).select(docs.columns)


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, n, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS solid FROM (
    SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i, len(ls) AS n
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM {docs} WHERE text IS NOT NULL))),
placed AS (
  SELECT *, coalesce(sum(solid::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM lines),
units AS (
  SELECT doc_id, k, string_agg(l, chr(10) ORDER BY i) AS unit, max(CASE WHEN solid THEN l END) AS bare
  FROM placed GROUP BY doc_id, k),
pairs AS (
  SELECT u.doc_id, u.k, u.bare || chr(10) || v.unit AS pair
  FROM units u JOIN units v ON v.doc_id = u.doc_id AND v.k = u.k + 1 AND v.bare IS NOT NULL),
repeats AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY pair ORDER BY doc_id, k) AS copy FROM pairs)
  WHERE copy > 1),
gone AS (SELECT doc_id, k FROM repeats UNION SELECT doc_id, k + 1 FROM repeats),
kept AS (
  SELECT u.doc_id, string_agg(unit, chr(10) ORDER BY u.k) FILTER (g.k IS NULL) AS text, count(g.k) AS n_removed
  FROM units u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.k = u.k GROUP BY u.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(length(d.text) - length(coalesce(k.text, '')), 0)::BIGINT AS n_chars_removed
FROM {docs} d LEFT JOIN kept k USING (doc_id)
"""
