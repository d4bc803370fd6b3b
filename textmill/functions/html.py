"""Raw web pages as columns: paragraphs, image texts, and where a page comes from."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.lambdas import let

# What is not text at all, and the tags that end a paragraph.
HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|head)\b.*?</(?:script|style|head)\s*>"
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|div|footer|form|h[1-6]|header|hr|html|li"
    r"|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>"
)
LINK = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
TAG = r"<[^>]*>"
ALT = r"""(?i)<img\b[^>]*?\balt="([^"]*)\""""
URL_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
URL_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"
HTML_LANG = r"""(?i)<html\b[^>]*?\blang="([^"]*)\""""


def paragraphs(html: Column) -> Column:
    """ARRAY<STRUCT<text, link_chars>> of the paragraphs with any text, in page order.

    ``link_chars`` is how many characters of the paragraph stand inside links. Null gives null.
    """
    parts = F.split(F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), BLOCK, "\n"), "\n")
    plain = F.transform(
        parts,
        lambda part: F.struct(
            F.trim(F.regexp_replace(part, TAG, "")).alias("text"),
            F.length(
                F.regexp_replace(F.array_join(F.regexp_extract_all(part, F.lit(LINK), F.lit(1)), ""), TAG, "")
            ).alias("link_chars"),
        ),
    )
    return let(plain, lambda found: F.filter(found, lambda p: p["text"] != ""))


def alt_texts(html: Column) -> Column:
    """The texts given for images, in page order; null gives null."""
    return F.regexp_extract_all(html, F.lit(ALT), F.lit(1))


def host(url: Column) -> Column:
    """The host in lower case; empty where the URL has none."""
    return F.lower(F.regexp_extract(url, URL_HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, URL_PATH, 1)


def declared_language(html: Column) -> Column:
    """The language the page names for itself; empty where it names none."""
    return F.lower(F.regexp_extract(html, HTML_LANG, 1))
