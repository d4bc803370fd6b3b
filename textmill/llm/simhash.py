"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Fingerprint. A-Z are lower-cased and words cut at the characters 0x20 and 0x09-0x0D. Every run
of three words (repeats included; the whole sequence when there are fewer) is hashed with XXH64,
seed 42, and bit b of the fingerprint is set if it is set in more than half of the hashes.

Search. Each of the 64 bits is given a vector of GF(2)^4. For each of the 15 nonzero vectors v,
a mask keeps the bits whose vector has an odd product with v. Whichever three bits two
fingerprints differ in, three linear conditions leave a nonzero v for which none of the three is
in the mask: so every pair within the radius agrees under some mask, and none is lost.

Fingerprints that agree under a mask form a bucket. Distinct fingerprints only are searched, so
copies cost nothing. A bucket of more than ``BUCKET`` fingerprints is split until it is not: the
bits outside its mask are cut in four parts, and two members within distance 3 agree on one of
the parts, which is added to the mask. A bucket gives a spanning forest of its links and not all
pairs. Components of the links are found by alternating large-star and small-star steps, as
tables, until nothing changes.

Defined results: a null text, an empty one, or one without a word has fingerprint zero, which is
linked like any other. Rows with a null ``doc_id`` take part, but a component's id is its
smallest id that is not null. Repeated rows each get a row. Only doc_id and text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrays import runs
from textmill.sources.storage import cut_lineage

RADIUS = 3
SEED = 42
SHINGLE = 3
BUCKET = 4096
_BLOCK = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks() -> list[int]:
    """The 15 masks, as signed 64-bit integers."""
    vectors = [1 + (7 * bit) % 15 for bit in range(64)]
    return [
        _signed(sum(1 << bit for bit in range(64) if (vectors[bit] & v).bit_count() % 2))
        for v in range(1, 1 << (RADIUS + 1))
    ]


def _refined(mask: int) -> list[int]:
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [free[k :: RADIUS + 1] for k in range(RADIUS + 1)]
    return [_signed((mask & (2**64 - 1)) | sum(1 << b for b in part)) for part in parts]


def fingerprint_of(text: bytes) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    found = text.lower().split()  # bytes methods: A-Z and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    n = len(found) - SHINGLE + 1
    if n < 1:
        return digest(joined, SEED)
    size = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:n].tolist(), end[SHINGLE - 1 :].tolist()
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        part = np.ascontiguousarray(hashes[k : k + _BLOCK]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(batch.num_rows, np.uint64)
        for first, last, data, offsets in runs(batch.column(1)):
            raw = data.tobytes()
            for row in range(last - first):
                out[first + row] = fingerprint_of(raw[offsets[row] : offsets[row + 1]])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["doc_id", "fp"])


def _forest(prints: np.ndarray) -> np.ndarray:
    """For each of a bucket's fingerprints, the index of the first one of its component."""
    root = np.arange(len(prints))
    free = np.ones(len(prints), bool)
    for i in range(len(prints)):
        if not free[i]:
            continue
        free[i] = False
        queue = [i]
        while queue:
            near = np.flatnonzero(free & (np.bitwise_count(prints ^ prints[queue.pop()]) <= RADIUS))
            free[near] = False
            root[near] = i
            queue += near.tolist()
    return root


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) from rows (mask, value, fp) sorted by bucket; buckets do not cross tasks."""

    def links(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]))
        size = np.diff(np.append(edge, len(mask)))
        pair = edge[size == 2]
        near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= RADIUS]
        a, b = [fp[near]], [fp[near + 1]]
        for first, n in zip(edge[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = fp[first : first + n]
            root = _forest(own)
            moved = root != np.arange(n)
            a.append(own[root[moved]])
            b.append(own[moved])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"]
        )

    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(k).to_numpy() for k in range(3)]
        held = [np.concatenate([h, n.view(h.dtype)]) for h, n in zip(held, new, strict=True)]
        same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
        whole = len(same) - int(same.sum())  # the last bucket may go on in the next batch
        if whole:
            yield links(*[h[:whole] for h in held])
            held = [h[whole:] for h in held]
    if len(held[0]):
        yield links(*held)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that keep every component."""
    spark = prints.sparkSession
    masks = covering_masks()
    rows = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    rows = rows.select("mask", F.expr("fp & mask").alias("value"), "fp")
    found = None
    while True:
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        sizes = cut_lineage(sizes, "buckets")
        large = sizes.where(F.col("n") > bucket).select("mask", "value")
        small = sizes.where(F.col("n") <= bucket).select("mask", "value")
        done = (
            rows.join(small, ["mask", "value"], "left_semi")
            .repartition("mask", "value")
            .sortWithinPartitions("mask", "value", "fp")
            .mapInArrow(_bucket_links, "a long, b long")
        )
        found = done if found is None else found.unionByName(done)
        if large.isEmpty():
            return cut_lineage(found.distinct(), "links")
        # as many masks as tables, whatever the data
        finer = {m: _refined(m) for m in masks}
        table = spark.createDataFrame([(m, f) for m, fs in finer.items() for f in fs], "mask long, finer long")
        masks = [f for fs in finer.values() for f in fs]
        rows = (
            rows.join(large, ["mask", "value"], "left_semi")
            .join(F.broadcast(table), "mask")
            .select(F.col("finer").alias("mask"), F.expr("fp & finer").alias("value"), "fp")
        )
        rows = cut_lineage(rows, "finer")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (a, b), the smallest node of its component."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = moved.unionByName(low.withColumnRenamed("m", "b")).distinct()
        edges = cut_lineage(edges, "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    own = cut_lineage(texts.mapInArrow(_fingerprints, "doc_id long, fp long"), "prints")
    prints = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = components(links(prints))
    roots = prints.join(rooted, prints.fp == rooted.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return own.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with the columns it came with.

    Rows without an id cannot be told apart and stay. Of several rows with the same id one stays.
    """
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
