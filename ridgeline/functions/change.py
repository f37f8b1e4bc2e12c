"""Relative change between two metric values, in the three forms in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def relative_change(a: Column, b: Column, variant: str) -> Column:
    """Change from ``a`` to ``b``.

    ``signed_percent``  percent by which the winner beats the loser. B must be
                        strictly greater to win; a win of A is negated. Infinite
                        when B beats a value of 0 or less, 0 when A does.
    ``ratio``           ``(b - a) / a``, 0 where ``a`` is not positive.
    ``ratio_or_inf``    the same, infinite where ``a`` is not positive.
    """
    ratio = F.try_divide(b - a, a)
    if variant == "signed_percent":
        b_wins = F.when(a > 0, ratio * 100).otherwise(INFINITY)
        a_wins = -F.when(b > 0, F.try_divide(a - b, b) * 100).otherwise(0.0)
        return F.when(b > a, b_wins).otherwise(a_wins)
    if variant == "ratio":
        return F.when(a > 0, ratio).otherwise(0.0)
    if variant == "ratio_or_inf":
        return F.when(a > 0, ratio).otherwise(INFINITY)
    raise ValueError(f"unknown variant: {variant}")


def winner(a: Column, b: Column) -> Column:
    """``B`` only if strictly greater, so A keeps ties."""
    return F.when(b > a, "B").otherwise("A")
