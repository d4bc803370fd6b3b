"""Named queries over the test tables, each with the SQL it is checked against."""

from textmill.plans.catalogue import (  # noqa: F401  (importing registers the queries)
    bigrams,
    curation,
    numbers,
    sequences,
    storage,
    subwords,
    texts,
    vocabularies,
)
from textmill.plans.catalogue.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
