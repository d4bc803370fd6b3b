"""Training sequences: windows, blocks, samples of blocks, and packing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import tokens
from textmill.functions.draws import uniforms
from textmill.functions.hashing import uniform
from textmill.operators.ranking import key_at_total, rejoin, running_total, running_totals
from textmill.sources.storage import cut_lineage

_BROADCAST_ROWS = 100_000


def window_index(
    df: DataFrame, length: Column | int, key: str = "doc_id", ids: str = "ids", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(key, ids, kept columns, start): one row per window, the window itself not yet cut.

    The starts are exploded beside the token array and the slice is taken from it in the
    same generated code, so the array is not copied per row.
    """
    starts = tokens.window_starts(F.col(ids), length)
    extra = [] if isinstance(length, int) else [length]
    return df.select(key, ids, *keep, *extra, F.explode(starts).alias("start"))


def windows(df: DataFrame, length: int, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, start, input, target): each window and its next token. Narrow, no shuffle.

    This multiplies the tokens by ``length``, so it belongs right before a sink. Splits
    and batches can be computed on (key, start) and cut their windows last.
    """
    start = F.col("start")
    return window_index(df, length, key, ids).select(
        key,
        start,
        tokens.block_at(F.col(ids), start, length).alias("input"),
        F.get(F.col(ids), start + length).alias("target"),
    )


def blocks(df: DataFrame, length: int, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, start, x, y): each block and the same block moved on by one token."""
    start = F.col("start")
    return window_index(df, length, key, ids).select(
        key,
        start,
        tokens.block_at(F.col(ids), start, length).alias("x"),
        tokens.block_at(F.col(ids), start + 1, length).alias("y"),
    )


def with_block_count(df: DataFrame, length: int, ids: str = "ids") -> DataFrame:
    return df.withColumn("blocks", tokens.window_count(F.col(ids), length))


def offsets(df: DataFrame, size: Column, key: str = "doc_id") -> DataFrame:
    """(key, size, offset): where each row begins in the corpus stream, rows in key order.

    Sizes are computed once and written as two numbers per row, as the passes that follow
    would otherwise repeat the work that made the tokens. Rows without tokens (null) have
    no place and are left out, which is decided on the written sizes: a filter on the
    tokens would move down to the scan and make them once more there.
    """
    sizes = cut_lineage(df.select(key, size.cast("long").alias("size")), "sizes")
    return running_total(sizes.where(F.col("size").isNotNull()), key, "size", "offset")


def sample_blocks(
    draws: DataFrame,
    df: DataFrame,
    length: int,
    seed: int,
    draw_key: str = "draw",
    key: str = "doc_id",
    ids: str = "ids",
) -> DataFrame:
    """One block per draw, its start uniform over all starts of the corpus, with replacement.

    A draw is a position in the list of all starts. Documents own ranges of that list, so
    this is a lookup of a point in a range: both sides are put in cells of the list, joined
    on the cell, and matched inside it. A cell is as wide as the average document's range,
    so documents cover few cells; a draw is spread evenly by construction.
    """
    places = cut_lineage(
        offsets(df, tokens.window_count(F.col(ids), length), key)
        .where(F.col("size") > 0)
        .withColumnRenamed("size", "blocks"),
        "places",
    )
    placed = rejoin(df.select(key, ids), places, key)
    summary = places.agg(
        F.sum("blocks").cast("long").alias("total"),
        F.ceil(F.avg("blocks")).cast("long").alias("cell"),
    )
    total, cell = summary.select("total").scalar(), summary.select("cell").scalar()
    points = draws.select(
        draw_key, F.floor(uniform(seed, draw_key) * total).cast("long").alias("point")
    ).withColumn("cell", F.floor(F.col("point") / cell).cast("long"))
    last = F.col("offset") + F.col("blocks") - 1
    width = F.col("width")

    def cut(c: Column) -> Column:
        # only the tokens a cell can need go with it, so a very long row is not copied per cell
        low = F.greatest(F.col("offset"), c * width)
        high = F.least(last, (c + 1) * width - 1)
        piece = F.slice(
            ids, (low - F.col("offset") + 1).cast("int"), (high - low + 1 + length).cast("int")
        )
        return F.struct(
            c.alias("cell"), low.alias("low"), high.alias("high"), piece.alias("piece")
        )

    cells = F.sequence(F.floor(F.col("offset") / width), F.floor(last / width))
    ranges = placed.withColumn("width", cell).select(
        key, "offset", F.inline(F.transform(cells, cut))
    )
    matched = points.join(ranges, "cell").where(F.col("point").between(F.col("low"), F.col("high")))
    inside = (F.col("point") - F.col("low")).cast("int")
    return matched.select(
        draw_key,
        key,
        (F.col("point") - F.col("offset")).cast("int").alias("start"),
        tokens.block_at(F.col("piece"), inside, length).alias("x"),
        tokens.block_at(F.col("piece"), inside + 1, length).alias("y"),
    )


def sample_blocks_once(
    df: DataFrame, length: int, count: int, seed: int, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """``count`` different blocks, without replacement, in a seeded random order.

    Only (key, start) is ranked; each task keeps its own best ``count``. The token arrays
    are joined to the few chosen starts afterwards.
    """
    # a start is its own place among the starts of its row, so the draws go by place
    drawn = uniforms(seed, key, tokens.window_starts(F.col(ids), length))
    chosen = df.select(key, F.posexplode(drawn).alias("start", "u")).orderBy("u", key, "start").limit(count)
    # at most ``count`` rows
    small = F.broadcast(chosen) if count <= _BROADCAST_ROWS else chosen
    return df.select(key, ids).join(small, key).select(
        key,
        "start",
        "u",
        tokens.block_at(F.col(ids), F.col("start"), length).alias("x"),
        tokens.block_at(F.col(ids), F.col("start") + 1, length).alias("y"),
    )


def pack(
    df: DataFrame, length: int, separator: int, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(block_id, tokens): the corpus as one stream with a separator after each row, cut up.

    Each row finds its place by a running total of lengths and cuts itself at the block
    borders, so what is shuffled is at most one piece per row and block, not one row per
    token. A block holds at most ``length`` pieces. The last block may be short.
    """
    stream = df.select(
        key, F.concat(F.col(ids), F.array(F.lit(separator))).alias("stream")
    )
    placed = rejoin(stream, offsets(df, F.size(ids) + 1, key), key)
    first = F.floor(F.col("offset") / length).cast("long")
    last = F.floor((F.col("offset") + F.size("stream") - 1) / length).cast("long")

    def cut(block: Column) -> Column:
        begin = F.greatest(block * length - F.col("offset"), F.lit(0))
        end = F.least((block + 1) * length - F.col("offset"), F.size("stream").cast("long"))
        piece = F.slice("stream", (begin + 1).cast("int"), (end - begin).cast("int"))
        return F.struct(block.alias("block_id"), piece.alias("piece"))

    return (
        placed.select("offset", F.inline(F.transform(F.sequence(first, last), cut)))
        .groupBy("block_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "piece"))).alias("pieces"))
        .select("block_id", F.flatten(F.transform("pieces", lambda p: p["piece"])).alias("tokens"))
    )


def corpus_prefix(df: DataFrame, chars: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The first ``chars`` characters of the corpus: whole rows in key order, the last one cut.

    Sizes tell where the prefix ends, so the texts are only filtered by key and never moved.
    Rows without a text or a key have no place and are left out.
    """
    usable = df.where(F.col(text).isNotNull() & F.col(key).isNotNull())
    sizes = cut_lineage(usable.select(key, F.length(text).cast("long").alias("size")), "sizes")
    last = key_at_total(sizes, key, "size", chars)
    if last is None:
        return usable if chars > 0 else usable.limit(0)
    key_there, left = last
    cut = F.when(F.col(key) == key_there, F.substring(text, 1, left)).otherwise(F.col(text))
    return usable.where(F.col(key) <= key_there).withColumn(text, cut)


def concat_texts(
    df: DataFrame, group: str, separator: str, key: str = "doc_id", text: str = "text",
    part_chars: int = 1_000_000,
) -> DataFrame:
    """(group, part, text): the texts of a group joined in key order.

    A group may be far larger than one string can be, so every group is written in parts: a
    row belongs to part k if k * ``part_chars`` characters, separators included, stand before
    it. Joining the parts of a group in order with the same separator gives the whole.
    """
    usable = df.where(F.col(text).isNotNull()).select(group, key, text)
    size = F.length(text) + len(separator)
    placed = running_total(usable, key, size.cast("long"), "offset", [group])
    part = F.floor(F.col("offset") / part_chars).cast("long")
    return (
        placed.groupBy(group, part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(key, text))).alias("rows"))
        .select(group, "part", F.array_join(F.transform("rows", lambda r: r[text]), separator).alias("text"))
    )


def causal_prefix_mean(
    df: DataFrame, group: str, order: str, value: str, out: str = "prefix_mean"
) -> DataFrame:
    """Add, per group, the mean of all values up to and including each row.

    The running sums go through buckets of the order column, so a group with a large part
    of all rows is not gathered in one task.
    """
    summed = running_totals(
        df, order, {"__sum": F.col(value).cast("double"), "__rows": F.lit(1)}, [group]
    )
    mean = (F.col("__sum") + F.col(value)) / (F.col("__rows") + 1)
    return summed.withColumn(out, mean).drop("__sum", "__rows")
