"""Help with higher-order functions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once per row for use inside a lambda.

    A lambda evaluates everything in it once per element, whether it depends on the
    element or not. Here the value becomes a lambda variable of an outer, one-element array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
