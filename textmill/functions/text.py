"""Cleaning and splitting of text, as single projections that stay in the JVM."""

import sys
import unicodedata
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The artefacts that are removed or unescaped, in the order they apply.
ARTIFACTS = [
    ("\ufeff", ""),
    ("\u200b", ""),
    ("\u200c", ""),
    ("\\n", "\n"),
    ("\\t", "\t"),
]

# Fixed value: the punctuation that survives removal of special characters.
KEPT_PUNCTUATION = " \n.,!?;:'\""

# The published chunking patterns.
GPT4_CHUNKS = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)
# (in this one, whitespace is Python's: U+001C-1F are in it)
ASCII_CHUNKS = (
    r"'(?:s|d|m|t|ll|ve|re)|[a-zA-Z]+|[0-9]{1,3}|[^a-zA-Z0-9\s\x1c-\x1f]|[\s\x1c-\x1f]+"
)
WORD_PIECES = r"\w+|[^\w\s]+"

# What Python calls whitespace: Unicode White_Space plus the four separators U+001C-1F.
_SPACE = r"[\s\x1c-\x1f]"
_SPACE_IN_LINE = r"[\s\x1c-\x1f&&[^\n]]"


@dataclass(frozen=True)
class CleanOptions:
    lowercase: bool = False
    remove_special: bool = False


def fix_artifacts(text: Column) -> Column:
    """Drop the byte order mark and zero-width characters, unescape ``\\n`` and ``\\t``."""
    for found, put in ARTIFACTS:
        text = F.replace(text, F.lit(found), F.lit(put))
    return text


def unify_newlines(text: Column) -> Column:
    text = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(text, F.lit("\r"), F.lit("\n"))


def rstrip_lines(text: Column) -> Column:
    # The look-behind lets a match begin only at the head of a run of spaces, so a long
    # run inside a line is passed over once and not once per character.
    pattern = rf"(?U)(?<!{_SPACE_IN_LINE}){_SPACE_IN_LINE}++(?=\n|\z)"
    return F.regexp_replace(text, pattern, "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{_SPACE}++|(?<!{_SPACE}){_SPACE}++\z", "")


def drop_special(text: Column) -> Column:
    kept = KEPT_PUNCTUATION.replace('"', r"\"")
    return F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{kept}]", "")


def clean(text: Column, options: CleanOptions = CleanOptions()) -> Column:
    """All cleaning steps in their fixed order; a null text stays null."""
    text = strip(rstrip_lines(unify_newlines(fix_artifacts(text))))
    if options.lowercase:
        text = F.lower(text)
    if options.remove_special:
        text = drop_special(text)
    return text


@cache
def _accented() -> tuple[str, str]:
    """Letters that canonically are a base character with marks, and their base characters."""
    found = []
    for point in range(0x80, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFD", chr(point))
        if len(parts) > 1 and unicodedata.combining(parts[0]) == 0 and all(map(unicodedata.combining, parts[1:])):
            found.append((chr(point), parts[0]))
    return "".join(a for a, _ in found), "".join(b for _, b in found)


def strip_accents(text: Column) -> Column:
    """Accented letters become their base letter, and free-standing accents go."""
    return F.regexp_replace(F.translate(text, *_accented()), r"\p{Mn}+", "")


def is_blank(text: Column) -> Column:
    """True for an empty or whitespace-only text; null counts as blank."""
    return F.coalesce(~text.rlike(rf"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def chunks(text: Column, pattern: str = GPT4_CHUNKS) -> Column:
    """All matches of a chunking pattern, in order, as an array of strings."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def ascii_chunks(text: Column) -> Column:
    return chunks(text, ASCII_CHUNKS)


def word_pieces(text: Column) -> Column:
    return chunks(text, WORD_PIECES)


def characters(text: Column) -> Column:
    """Array of single characters. ``split`` gives one empty string for an empty text."""
    return F.filter(F.split(text, ""), lambda c: c != "")

