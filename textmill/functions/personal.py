"""Personal data in text: counting it and putting tags in its place."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is looked for and the tag that replaces it, in the order they apply.
# An address goes first, as the digits in it must not be taken for a number; the longer
# numbers go before the telephone numbers.
PATTERNS = {
    "email": (r"[A-Za-z0-9_.=+-]+@[A-Za-z0-9_.-]+\.[A-Za-z]{2,}", "<email>"),
    "ssn": (r"\b[0-8][0-9]{2}[- ][0-9]{2}[- ][0-9]{4}\b", "<ssn>"),
    "card": (r"\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b", "<card_number>"),
    "ip": (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "<ip_address>"),
    "phone": (r"\+[0-9]{1,3} ?\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}\b", "<phone_number>"),
}


def count(text: Column, kind: str) -> Column:
    """How often one kind occurs; null for a null text."""
    return F.regexp_count(text, F.lit(PATTERNS[kind][0]))


def redact(text: Column) -> Column:
    """The text with a tag in the place of each item; null stays null."""
    for pattern, tag in PATTERNS.values():
        text = F.regexp_replace(text, pattern, tag)
    return text
