"""Repeatable pseudo-random numbers.

``rand(seed)`` depends on how the rows happen to be partitioned, so a retried task or
another cluster size changes the draw. These values depend on the row's key alone.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.draws import are_below

# 13 hex digits are 52 bits, which a double holds exactly.
_HEX_DIGITS = 13
_SCALE = float(16**_HEX_DIGITS)


def uniform(seed: int, *keys: Column | str) -> Column:
    """A double in [0, 1) that is a function of the seed and the keys."""
    parts = [k if isinstance(k, Column) else F.col(k) for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    digits = F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10)
    return digits.cast("double") / F.lit(_SCALE)


def below(share: float, seed: int, key: Column | str, values: Column) -> Column:
    """Per position of an array, whether ``uniform(seed, key, position)`` is below a share.

    The digits are compared as whole numbers, so the draw is never made a double.
    """
    return are_below(math.ceil(min(max(share, 0.0), 1.0) * _SCALE), seed, key, values)


def gaussian(seed: int, *keys: Column | str) -> Column:
    """A standard normal value from two independent uniforms (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.ln(1.0 - uniform(seed, *keys, F.lit("r"))))
    return radius * F.cos(2.0 * F.pi() * uniform(seed, *keys, F.lit("a")))
