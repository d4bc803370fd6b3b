"""Similar rows: set-similarity joins of texts, MinHash, near vectors, and groups of near-duplicates.

Texts are compared as sets of word shingles. Texts with equal sets form a class, named by its
smallest key, and only one row of each class is compared further, so thousands of copies cost
no more than one. Nothing is lost by that: members of two classes are as similar as the classes.

``near_classes`` is exact. Shingles are put in one order for all rows, rarest first. Two sets
with similarity t or more must meet in the first n - ceil(t n) + 1 shingles of this order, so
only those are joined; lengths and places in the order rule out more, and what is left is
verified on the whole sets. A shingle that occurs once meets nothing and is never joined.

A value that many rows share is cut in cells of at most ``BLOCK`` rows by ``BLOCK`` rows, each
joined on its own, so no task holds all rows of one value.

Keys are unique and not null. Rows without a word have no set: they are a class of their own
and near nothing. Shingles are compared by 64 bits of hash, classes by 128.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.lambdas import let
from textmill.operators.components import components
from textmill.operators.joins import lookup_join
from textmill.operators.repeats import repeats
from textmill.sources.storage import cut_lineage, fits, remove

WORDS, SIMILARITY = 5, 0.8
BLOCK = 256
# Keys that are sent to every task, to leave out the rows that have none of them.
_BROADCAST_ROWS = 1_000_000
_SLACK = 1e-9  # products like 0.8 * 35 are a little above the whole number


# --- pairs of rows that share a value -----------------------------------------------------


def pairs_by_value(rows: DataFrame, possible: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(a, b), a < b, of the ids of rows that share a ``value``, each once.

    ``possible`` takes two prefixes of column names and says which pairs to keep.
    """
    # read twice below: by the counts, and by the join
    rows = cut_lineage(rows, "rows")
    counts = cut_lineage(rows.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"), "values")
    parts = counts.select("value", F.ceil(F.col("n") / BLOCK).cast("int").alias("__parts"))
    sized = cut_lineage(lookup_join(rows, parts, ["value"], ["id"], counts=counts), "shared")
    remove(rows)
    sized = sized.withColumn("__own", F.pmod(F.xxhash64("id"), F.col("__parts")).cast("int"))
    others = [c for c in rows.columns if c != "value"]

    def side(name: str, x: Column, y: Column, cells: Column) -> DataFrame:
        spread = sized.withColumn("__cell", F.explode(cells))
        return spread.select("value", x.alias("__x"), y.alias("__y"), *[F.col(c).alias(f"{name}_{c}") for c in others])

    own, cell = F.col("__own"), F.col("__cell")
    left = side("left", own, cell, F.sequence(own, F.col("__parts") - 1))
    right = side("right", cell, own, F.sequence(F.lit(0), own))
    # in a cell beside the diagonal every pair is new, in one on it each pair would come twice
    joined = left.join(right, ["value", "__x", "__y"]).where(
        (F.col("left_id") < F.col("right_id")) | ((F.col("__x") != F.col("__y")) & (F.col("left_id") != F.col("right_id")))
    )
    if possible is not None:
        joined = joined.where(possible("left", "right"))
    return joined.select(
        F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b")
    ).distinct()


def _beside(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """(a, b, x, y): pairs with the contents (id, x) of both; an id may be in very many pairs."""
    first = lookup_join(pairs, content.select(F.col("id").alias("a"), F.col("x")), ["a"], ["b"])
    return lookup_join(first, content.select(F.col("id").alias("b"), F.col("x").alias("y")), ["b"], ["a"])


def pairs_of_rows(pairs: DataFrame, members: DataFrame, alike: DataFrame) -> DataFrame:
    """(a, b, ...) of all rows whose classes are near or the same, from ``pairs`` (a, b, ...) of classes.

    ``members`` are the rows (id, class_id); ``alike`` (class_id, ...) has for each class what two
    rows of it have in common, in the columns of ``pairs``. Rows of a class are met in cells of
    about ``BLOCK`` by ``BLOCK``, so no task holds all rows of a class.
    """
    members = cut_lineage(members, "members")
    counts = cut_lineage(members.groupBy("class_id").agg(F.count("*").alias("n")).where("n > 1"), "copies")
    if counts.isEmpty():
        return pairs
    sizes = counts.select("class_id", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    blocks = lookup_join(members, sizes, ["class_id"], ["id"], counts=counts)
    blocks = cut_lineage(blocks.groupBy("class_id", part.alias("part")).agg(F.collect_list("id").alias("ids")), "blocks")
    values = [c for c in pairs.columns if c not in ("a", "b")]
    own = alike.join(counts.select("class_id"), "class_id", "left_semi").distinct()
    own = own.select(F.col("class_id").alias("a"), F.col("class_id").alias("b"), *values)
    cells = cut_lineage(pairs.distinct().unionByName(own), "near")
    for one, other, first in (("a", "b", F.lit(0)), ("b", "a", F.when(F.expr("a = b"), F.col("a_part")).otherwise(F.lit(0)))):
        named = sizes.select(F.col("class_id").alias(one), F.col("parts").alias(f"{one}_parts"))
        cells = lookup_join(cells, named, [one], [other], "left")
        parts = F.coalesce(f"{one}_parts", F.lit(1))
        cells = cells.withColumn(f"{one}_part", F.explode(F.sequence(first, parts - 1)))
    cells = cut_lineage(cells, "cells")
    for one, other in (("a", "b"), ("b", "a")):
        named = blocks.select(F.col("class_id").alias(one), F.col("part").alias(f"{one}_part"), F.col("ids").alias(f"{one}_ids"))
        cells = lookup_join(cells, named, [one, f"{one}_part"], [other, f"{other}_part"], "left")
        # a class of one row has no block, one of more may have an empty one
        alone = F.when(F.col(f"{one}_parts").isNull(), F.array(one))
        cells = cells.withColumn(f"{one}_ids", F.coalesce(f"{one}_ids", alone))
    met = cells.select("a", "b", "a_part", "b_part", "b_ids", *values, F.explode("a_ids").alias("x"))
    met = met.select("a", "b", "a_part", "b_part", "x", F.explode("b_ids").alias("y"), *values)
    met = met.where("x != y AND (a != b OR a_part != b_part OR x < y)")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *values)


# --- sets of shingles ---------------------------------------------------------------------


def shingle_set(text: Column, words: int = WORDS) -> Column:
    """The distinct shingles as sorted hashes; a shorter text is one shingle, one without words null."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def hashed(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(own) - words + 1, F.lit(1)))
        each = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(own, i, F.lit(words)), " ")))
        return F.when(F.size(own) > 0, F.array_sort(F.array_distinct(each)))

    return let(found, hashed)


def shingle_classes(docs: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, class_id) of every row, and (id, shingles) of one row of each class with a set."""
    own = docs.select(F.col(key).alias("id"), shingle_set(F.col(text), words).alias("shingles"))
    digest = F.coalesce(F.md5(F.array_join(F.col("shingles").cast("array<string>"), ",")), F.col("id").cast("string"))
    own = cut_lineage(own.withColumn("digest", digest), "sets")
    first = own.groupBy("digest").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    first = cut_lineage(first, "classes")
    members = lookup_join(
        own.select("id", "digest"), first.drop("n"), ["digest"], ["id"], counts=first.select("digest", "n")
    )
    members = cut_lineage(members.select("id", "class_id"), "named")
    names = first.select(F.col("class_id").alias("id"))
    # the fewer rows: those that name no class
    copies = cut_lineage(members.where("id != class_id").select("id").join(names, "id", "left_anti").distinct(), "copies")
    sets = own.where(F.col("shingles").isNotNull() & F.col("id").isNotNull()).select("id", "shingles")
    if fits(copies, _BROADCAST_ROWS):
        return members, sets.join(F.broadcast(copies), "id", "left_anti")
    return members, cut_lineage(sets.join(names, "id", "left_semi"), "heads")


def _rare_heads(sets: DataFrame, similarity: float) -> DataFrame:
    """(value, id, n, place): the shingles of each set's head that other sets have as well.

    A set near another has at least the share ``similarity`` of its shingles in others. Only the sets
    that can have it are taken apart, and only into the shingles that can occur in others.
    """
    each = cut_lineage(repeats(sets, "shingles", similarity), "again")
    counts = cut_lineage(each.groupBy("value").agg(F.count("*").alias("n")).where("n > 1"), "shingles")
    known = lookup_join(each, counts.withColumnRenamed("n", "c"), ["value"], ["id"], counts=counts)
    inorder = known.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("c", "value"))).alias("s"))
    alone = F.col("n") - F.size("s")  # these come first
    head = F.col("n") - F.ceil(F.col("n") * similarity - _SLACK) + 1
    taken = F.slice("s", F.lit(1), F.greatest(head - alone, F.lit(0)).cast("int"))
    rows = inorder.select("id", "n", alone.alias("alone"), F.posexplode(taken).alias("at", "s"))
    rows = rows.select(F.col("s.value").alias("value"), "id", "n", (F.col("alone") + F.col("at")).alias("place"))
    rows = cut_lineage(rows, "heads")
    remove(each)
    return rows


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    pairs = cut_lineage(pairs, "candidates")
    ids = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired")
    # so that the other sets do not move
    ids = F.broadcast(ids) if fits(ids, _BROADCAST_ROWS) else ids
    both = _beside(pairs, sets.withColumnRenamed("shingles", "x").join(ids, "id", "left_semi"))
    common = F.size(F.array_intersect("x", "y"))
    sized = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("sum"))
    share = F.col("common") / (F.col("sum") - F.col("common"))
    return sized.select("a", "b", "common", share.alias("similarity")).where(F.col("similarity") >= similarity)


def near_sets(sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b, common, similarity) of all pairs of sets (id, shingles) with at least the similarity."""

    def possible(x: str, y: str) -> Column:
        n, m = F.col(f"{x}_n"), F.col(f"{y}_n")
        needed = F.ceil((n + m) * (similarity / (1 + similarity)) - _SLACK)
        left = F.least(n - F.col(f"{x}_place"), m - F.col(f"{y}_place"))
        # the first shingle in common is at places that leave enough room for the others
        return (left >= needed) & (F.least(n, m) >= F.ceil(F.greatest(n, m) * similarity - _SLACK))

    heads = _rare_heads(sets, similarity)
    pairs = pairs_by_value(heads, possible)
    remove(heads)
    return _verified(pairs, sets, similarity)


# --- MinHash ------------------------------------------------------------------------------

BANDS, ROWS = 20, 6


def _band_hashes(bands: int, rows: int, seed: int):
    draw = np.random.default_rng(seed)
    odd = draw.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = draw.integers(0, 2**63, bands * rows, dtype=np.uint64)

    @F.arrow_udf("array<long>")
    def hashes(sets: pa.Array) -> pa.Array:
        out = []
        for own in sets:
            h = own.values.to_numpy().view(np.uint64)
            least = np.array([_scrambled(h * a + b).min() for a, b in zip(odd, add, strict=True)])
            value = np.zeros(bands, np.uint64)
            for k in range(rows):
                value = _scrambled(value * odd[0] + least[k::rows])
            out.append(value.view(np.int64))
        return pa.array(out, pa.list_(pa.int64()))

    return hashes


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def near_sets_minhash(
    sets: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, seed: int = 42
) -> DataFrame:
    """As ``near_sets``, with candidates that agree in a band of a MinHash signature.

    No pair is wrong, as candidates are verified; one of similarity s is found with the chance
    1 - (1 - s^rows)^bands, which is 0.997 at 0.8.
    """
    signed = sets.select("id", F.posexplode(_band_hashes(bands, rows, seed)(F.col("shingles"))).alias("band", "h"))
    values = signed.select(F.xxhash64("band", "h").alias("value"), "id")
    return _verified(pairs_by_value(values), sets, similarity)


def near_rows_minhash(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(a, b, common, similarity) of all pairs of rows: those of equal sets, and those whose classes are
    found by ``near_sets_minhash``."""
    members, sets = shingle_classes(docs, words, key, text)
    pairs = cut_lineage(near_sets_minhash(sets, similarity), "found")
    alike = sets.select(F.col("id").alias("class_id"), F.size("shingles").alias("common"), F.lit(1.0).alias("similarity"))
    return pairs_of_rows(pairs, members, alike)


# --- groups -------------------------------------------------------------------------------


def near_classes(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, class_id) of every row and (a, b, common, similarity) of all near classes."""
    members, sets = shingle_classes(docs, words, key, text)
    return members, cut_lineage(near_sets(sets, similarity), "near")


def near_groups(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, class_id, n_links, group_id) of every row.

    ``n_links`` is how many other classes are near, ``group_id`` the smallest key that can be
    reached over near classes.
    """
    members, pairs = near_classes(docs, words, similarity, key, text)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class_id"))
    linked = ends.groupBy("class_id").agg(F.count("*").alias("n_links"))
    rooted = components(pairs).select(F.col("node").alias("class_id"), F.col("root").alias("group_id"))
    classes = linked.join(rooted, "class_id")  # both have one row for each linked class
    named = lookup_join(members, classes, ["class_id"], ["id"], "left")
    return named.select(
        "id", "class_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("group_id", "class_id").alias("group_id"),
    )


def drop_near(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest key."""
    first = near_groups(docs, words, similarity, key, text).where("id = group_id").select(F.col("id").alias(key))
    return docs.join(first, key, "left_semi")


# --- vectors ------------------------------------------------------------------------------

COSINE, RECALL = 0.9, 1.0
_BUCKET = 64  # rows that share a side of all planes, if directions were even
_CHUNK = 1024  # rows of a bucket that travel together, each vector once; rows that are multiplied at a time
_TILE = 1 << 25  # bytes of the vectors of a block that is paired with each other one


def planes_for(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """(planes, tables): planes so that buckets stay small however many rows there are, and
    tables so that a pair at the cosine is found with the chance ``recall``."""
    planes = min(max(math.ceil(math.log2(max(rows, 1) / _BUCKET)), 6), 30)
    same = (1 - math.acos(min(max(cosine, -1.0), 1.0)) / math.pi) ** planes
    return planes, 1 if same >= recall else math.ceil(math.log(1 - recall) / math.log(1 - same))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, seed: int = 42, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(a, b, cosine) of pairs of classes whose vectors have at least the cosine.

    Equal vectors are one class, named by its smallest key. Zero and null vectors have no
    direction and are near nothing. All vectors have one length.

    With a ``recall`` of 1 every pair is met. Below, candidates are on the same side of all random
    planes of one of several tables (``planes_for``). Either way a pair is verified where its
    vectors are gathered, so that no vector moves once for each candidate.
    """
    return _near_directions(_directions(vectors, key, vector)[1], cosine, recall, seed)


def near_vector_rows(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, seed: int = 42, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """As ``near_vectors``, of all pairs of rows, with those of equal vectors."""
    own, first = _directions(vectors, key, vector)
    near = _near_directions(first, cosine, recall, seed)
    several = first.where("n > 1")
    if several.isEmpty():
        return near
    classes = several.select("x", F.col("id").alias("class_id"))
    members = lookup_join(own, classes, ["x"], ["id"], counts=several.select("x", "n"))
    itself = F.aggregate(F.transform("x", lambda v: v / F.col("length")), F.lit(0.0), lambda s, v: s + v * v)
    alike = several.select(F.col("id").alias("class_id"), itself.alias("cosine"))
    alike = alike.where(~F.isnan("cosine") & (F.col("cosine") >= cosine))
    return pairs_of_rows(cut_lineage(near, "found"), members.select("id", "class_id").distinct(), alike)


def _directions(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(id, x, length) of all rows with a direction, and (id, x, length, n) of one of each class."""
    own = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    own = own.withColumn("length", length).where(F.col("length") > 0)
    first = own.groupBy("x").agg(F.min("id").alias("id"), F.first("length").alias("length"), F.count("*").alias("n"))
    return own, cut_lineage(first.select("id", "x", "length", "n"), "vectors")


def _near_directions(first: DataFrame, cosine: float, recall: float, seed: int) -> DataFrame:
    first = first.select("id", F.transform("x", lambda v: v / F.col("length")).alias("x"))
    return _near_blocks(first, cosine) if recall >= 1 else _near_buckets(first, cosine, recall, seed)


def _near_blocks(first: DataFrame, cosine: float) -> DataFrame:
    """(a, b, cosine) of all near vectors (id, x): each block is paired with each, itself included.

    A task holds two blocks and gives their pairs tile by tile, so memory follows neither the
    rows nor the pairs. Products in single precision choose, with room for their error; the
    cosines given are sums in double precision from the first place to the last.
    """
    size = first.select(F.size("x")).head()
    if size is None:
        return first.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("cosine"))
    rows, cores = first.count(), first.sparkSession.sparkContext.defaultParallelism
    # enough pairs of blocks for all cores, if the rows are not few
    blocks = max(math.ceil(rows * size[0] * 8 / _TILE), min(math.ceil(math.sqrt(6 * cores)), math.ceil(rows / _CHUNK)))
    slack, side = (size[0] + 4) * 2.0**-23, _CHUNK

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.Table.from_batches(batches).combine_chunks()
        block = own["block"].to_numpy()
        x = pa.concat_arrays(own["x"].chunks).flatten().to_numpy().reshape(len(own), -1)
        first_block, last_block = divmod(own["cell"][0].as_py(), blocks)
        same = first_block == last_block
        low, high = np.flatnonzero(block == first_block), np.flatnonzero(block == last_block)
        single = x.astype(np.float32)
        for i in range(0, len(low), side):
            left = low[i : i + side]
            for j in range(i if same else 0, len(high), side):
                right = high[j : j + side]
                kept = single[left] @ single[right].T >= cosine - slack
                p, q = np.nonzero(np.triu(kept, 1) if same and i == j else kept)
                p, q = left[p], right[q]
                exact = np.zeros(len(p))
                for d in range(x.shape[1]):
                    exact += x[p, d] * x[q, d]
                good = exact >= cosine
                a, b = own["id"].take(pa.array(p[good])), own["id"].take(pa.array(q[good]))
                yield pa.RecordBatch.from_arrays(
                    [a.combine_chunks(), b.combine_chunks(), pa.array(exact[good])], ["a", "b", "cosine"]
                )

    own = first.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = F.least("block", "other") * F.lit(blocks).cast("long") + F.greatest("block", "other")
    cells = other.select(cell.alias("cell"), "block", "id", "x")
    spread = cells.repartition(min(2 * blocks * (blocks + 1), 2000), "cell")
    kind = first.schema["id"].dataType.simpleString()
    met = spread.groupBy("cell").applyInArrow(near, f"a {kind}, b {kind}, cosine double")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")


def _near_buckets(first: DataFrame, cosine: float, recall: float, seed: int) -> DataFrame:
    bits, tables = planes_for(first.count(), cosine, recall)

    @F.arrow_udf("array<long>")
    def sides(rows: pa.Array) -> pa.Array:
        size = len(rows[0])
        planes = np.random.default_rng(seed).standard_normal((size, tables * bits))
        found = rows.flatten().to_numpy().reshape(-1, size) @ planes > 0
        codes = found.reshape(-1, tables, bits) @ (1 << np.arange(bits))
        return pa.array(list(codes.astype(np.int64)), pa.list_(pa.int64()))

    coded = first.select("id", "x", F.posexplode(sides("x")).alias("table", "code"))
    coded = coded.select(F.xxhash64("table", "code").alias("value"), "id", "x")
    # buckets of more than a chunk, of which there can be few
    parts = coded.groupBy("value").agg(F.ceil(F.count("*") / _CHUNK).cast("int").alias("parts")).where("parts > 1")
    large = F.broadcast(cut_lineage(parts, "large-buckets"))
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))
    held = coded.join(large, "value", "left").groupBy("value", "parts", part.alias("part")).agg(
        F.collect_list(F.struct("id", "x")).alias("held")
    )
    chunks = held.select("value", "parts", "part", F.col("held.id").alias("ids"), F.flatten("held.x").alias("xs"))
    chunks = cut_lineage(chunks.where("parts > 1 OR size(ids) > 1"), "chunks")
    split = chunks.where("parts > 1")
    right = split.select("value", *[F.col(c).alias(f"r_{c}") for c in ("part", "ids", "xs")])
    others = F.sequence(F.col("l_part") + 1, F.col("parts") - 1)
    left = split.select("value", "parts", *[F.col(c).alias(f"l_{c}") for c in ("part", "ids", "xs")])
    left = left.where("l_part < parts - 1").withColumn("r_part", F.explode(others))
    beside = left.join(right, ["value", "r_part"])
    whole = chunks.select(*[F.col(c).alias(f"{side}_{c}") for side in ("l", "r") for c in ("ids", "xs")])
    found = [_close(whole, True, cosine), _close(beside, False, cosine)]
    return found[0].unionByName(found[1]).groupBy("a", "b").agg(F.first("cosine").alias("cosine"))


def _close(chunks: DataFrame, same: bool, cosine: float) -> DataFrame:
    """(a, b, cosine) of the near vectors of two chunks, or of one with itself, each pair once.

    A matrix product chooses; the cosines given are sums from the first place to the last.
    """

    @F.arrow_udf("array<struct<i: int, j: int, cosine: double>>")
    def near(left: pa.Array, sizes: pa.Array, right: pa.Array) -> pa.Array:
        out, ends = [], [0]
        for row, n in enumerate(sizes.to_pylist()):
            x = left[row].values.to_numpy(zero_copy_only=False).reshape(n, -1)
            y = right[row].values.to_numpy(zero_copy_only=False).reshape(-1, x.shape[1])
            kept = x @ y.T >= cosine - _SLACK
            i, j = np.nonzero(np.triu(kept, 1) if same else kept)
            exact = np.zeros(len(i))
            for d in range(x.shape[1]):
                exact += x[i, d] * y[j, d]
            good = exact >= cosine
            out.append((i[good], j[good], exact[good]))
            ends.append(ends[-1] + len(out[-1][0]))
        i, j, exact = (np.concatenate([o[k] for o in out]) if out else np.zeros(0) for k in range(3))
        flat = pa.StructArray.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(exact)], ["i", "j", "cosine"]
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    pairs = chunks.select("l_ids", "r_ids", F.inline(near("l_xs", F.size("l_ids"), "r_xs")))
    x, y = F.get("l_ids", F.col("i")), F.get("r_ids", F.col("j"))
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), "cosine")


def chance(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """The chance that ``near_sets_minhash`` finds a pair."""
    return 1 - math.pow(1 - math.pow(similarity, rows), bands)
