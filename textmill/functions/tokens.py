"""Token ids held as text, and arrays of token ids.

A token sequence is kept as a string with one character per token, so that a merge of two
neighbours is one ``replace`` and neighbour pairs are two-character strings. The character's
code point is the token id, moved past the surrogate range, which strings cannot hold.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SURROGATES_FROM = 0xD800
_SURROGATES = 0x800
MAX_TOKEN_ID = 0x10FFFF - _SURROGATES


def id_to_char(token_id: int) -> str:
    """The character that stands for a token id (driver side, for literals)."""
    if not 0 <= token_id <= MAX_TOKEN_ID:
        raise ValueError(f"token id {token_id} does not fit in one character")
    return chr(token_id if token_id < _SURROGATES_FROM else token_id + _SURROGATES)


def id_to_symbol(token_id: Column) -> Column:
    """The character that stands for a token id, for ids in a column."""
    point = F.when(token_id < _SURROGATES_FROM, token_id).otherwise(token_id + _SURROGATES)
    # a byte order mark first, so that a mark after it is read as a character
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(point), 8, "0"))), "UTF-32")


def char_to_id(char: Column) -> Column:
    point = F.ascii(char)
    return F.when(point < _SURROGATES_FROM, point).otherwise(point - _SURROGATES)


def symbols_to_ids(symbols: Column) -> Column:
    """String of one character per token -> ARRAY<INT>."""
    return F.transform(F.filter(F.split(symbols, ""), lambda c: c != ""), char_to_id)


def utf8_symbols(text: Column) -> Column:
    """One character per UTF-8 byte of the text; the code point is the byte's value."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def utf8_ids(text: Column) -> Column:
    return symbols_to_ids(utf8_symbols(text))


def lookup(values: Sequence[str]) -> Column:
    """A constant ARRAY<STRING> for position lookups. Values must not hold commas.

    Written as ``split`` of one literal, which the optimizer folds to a single constant;
    ``array(lit, lit, ...)`` would put one expression per entry in the plan.
    """
    if not values:
        return F.array().cast("array<string>")
    return F.split(F.lit(",".join(values)), ",")


def ids_to_text(ids: Column, hex_of_id: Sequence[str]) -> Column:
    """Join the bytes of each id and read them as UTF-8.

    Ids outside the table are skipped; malformed bytes become U+FFFD. Null stays null.
    """
    table = lookup(hex_of_id)
    parts = F.filter(F.transform(ids, lambda i: F.get(table, i)), lambda h: h.isNotNull())
    raw = F.unhex(F.array_join(parts, ""))
    return F.make_valid_utf8(raw.cast("string"))


def pairs_of(symbols: Column) -> Column:
    """Overlapping neighbour pairs of a symbol string, as two-character strings.

    A look-ahead finds a pair at every place. It must not begin in the middle of a
    character that Java keeps as two units, hence the class.
    """
    return F.regexp_extract_all(symbols, F.lit(r"(?s)(?=([^\x{DC00}-\x{DFFF}].))"), F.lit(1))


def adjacent_pairs(ids: Column) -> Column:
    """ARRAY<STRUCT<prev, next>> of neighbouring tokens; no shuffle, no window."""
    count = F.greatest(F.size(ids) - 1, F.lit(0))
    heads = F.slice(ids, F.lit(1), count).alias("prev")
    tails = F.slice(ids, F.lit(2), count).alias("next")
    return F.arrays_zip(heads, tails)


# --- arrays of ids ---------------------------------------------------------------------


def truncate(ids: Column, length: int) -> Column:
    return F.slice(ids, 1, length)


def crop_last(ids: Column, length: int) -> Column:
    """The last ``length`` tokens, which is the context a model of that width sees."""
    first = F.greatest(F.size(ids) - length, F.lit(0)) + 1
    return F.slice(ids, first, F.lit(length))


def pad(ids: Column, length: Column | int, pad_id: int = 0) -> Column:
    """Cut or fill at the right to exactly ``length`` tokens."""
    length = F.lit(length) if isinstance(length, int) else length
    kept = F.slice(ids, F.lit(1), length)
    missing = F.greatest(length - F.size(kept), F.lit(0))
    return F.concat(kept, F.array_repeat(F.lit(pad_id).cast("int"), missing))


def attention_mask(ids: Column, length: Column | int) -> Column:
    """1 for each real token and 0 for each padded position."""
    length = F.lit(length) if isinstance(length, int) else length
    real = F.least(F.size(ids), length)
    ones = F.array_repeat(F.lit(1), real)
    return F.concat(ones, F.array_repeat(F.lit(0), length - real))


def window_count(ids: Column, length: Column | int) -> Column:
    """How many starts leave a full window and one token after it: max(n - length, 0)."""
    return F.greatest(F.size(ids) - length, F.lit(0))


def window_starts(ids: Column, length: Column | int) -> Column:
    """0 .. n - length - 1 as an array; empty when the row is too short."""
    count = window_count(ids, length)
    # sequence(0, -1) counts down, so the empty case needs its own branch
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )


def block_at(ids: Column, start: Column, length: Column | int) -> Column:
    return F.slice(ids, start + 1, F.lit(length))


def pad_left(ids: Column, length: Column | int, pad_id: int = 0) -> Column:
    """Cut to the last ``length`` tokens or fill at the left to exactly that many."""
    length = F.lit(length) if isinstance(length, int) else length
    kept = F.slice(ids, F.greatest(F.size(ids) - length, F.lit(0)) + 1, length)
    missing = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(F.array_repeat(F.lit(pad_id).cast("int"), missing), kept)


def split_long(ids: Column, length: int) -> Column:
    """Consecutive pieces of ``length`` tokens, the last one shorter; none for an empty row."""
    if length < 1:
        raise ValueError("a piece holds at least one token")
    pieces = F.ceil(F.size(ids) / length).cast("int")
    starts = F.when(pieces > 0, F.sequence(F.lit(0), pieces - 1)).when(
        ids.isNotNull(), F.array().cast("array<int>")
    )
    return F.transform(starts, lambda k: F.slice(ids, k * length + 1, F.lit(length)))


def pair_lengths(first: Column, second: Column, length: int, longest_first: bool = True) -> Column:
    """STRUCT<first, second>: how many tokens each side of a pair keeps within ``length``.

    Longest-first takes tokens from whichever side is longer, from the first side on a tie;
    otherwise only the first side is cut, and the second only when nothing of the first is left.
    """
    n, m = F.size(first), F.size(second)
    if longest_first:
        # both sides above half end at half; a side below it keeps all, the other has the rest
        half = length // 2
        kept = F.when(n + m <= length, n).when(m <= length - half, length - m).otherwise(F.least(n, F.lit(half)))
        kept = F.greatest(kept, F.lit(0))
    else:
        kept = F.least(n, F.greatest(length - m, F.lit(0)))
    return F.struct(kept.alias("first"), F.least(m, length - kept).alias("second"))


def truncate_pair(first: Column, second: Column, length: int, longest_first: bool = True) -> Column:
    """STRUCT<first, second> of the two id arrays, cut as ``pair_lengths`` says."""
    kept = pair_lengths(first, second, length, longest_first)
    return F.struct(
        F.slice(first, F.lit(1), kept["first"]).alias("first"),
        F.slice(second, F.lit(1), kept["second"]).alias("second"),
    )


def with_special(
    ids: Column, bos: int | None = None, eos: int | None = None, unk: int | None = None, size: int | None = None
) -> Column:
    """Ids between a start and an end token; with ``unk``, ids outside [0, size) become it."""
    if unk is not None:
        if size is None:
            raise ValueError("unk needs the size of the vocabulary")
        ids = F.transform(ids, lambda i: F.when((i >= 0) & (i < size), i).otherwise(F.lit(unk)))
    parts = [F.array(F.lit(bos))] if bos is not None else []
    parts.append(ids)
    if eos is not None:
        parts.append(F.array(F.lit(eos)))
    return F.concat(*parts)


def with_language(ids: Column, language: Column, token_of: dict[str, int], other: int) -> Column:
    """Ids with the token of the row's language in front; ``other`` where it has none."""
    table = F.create_map(*[F.lit(x) for item in token_of.items() for x in item])
    return F.concat(F.array(F.coalesce(table[language], F.lit(other))), ids)
