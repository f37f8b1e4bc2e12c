"""Joins that stay even when one key holds much of the rows.

AQE splits a skewed join only where both sides come straight from a shuffle. A
lookup table that was just grouped by the key does not, so hot keys are spread
here: their rows over salts, their lookup row to each salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.runtime import materialize

# A key is hot when it holds more than 1/HOT_SHARE of the rows. No more than
# HOT_SHARE keys can, which bounds every table of hot keys that is broadcast.
HOT_SHARE = 1000
# Smaller groups are never worth spreading.
MIN_HOT_ROWS = 100_000


def ordinary_rows(total: Column, min_rows: int) -> Column:
    """The largest number of rows a key may hold without being hot."""
    return F.greatest(F.lit(min_rows), F.ceil(total / HOT_SHARE))


def cuts(rows: Column, ordinary: Column) -> Column:
    """Into how many parts a key is to be cut."""
    return F.greatest(F.lit(1), F.ceil(rows / ordinary)).cast("int")


def merged(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the input, by sorting both.

    Spark guesses a side's size from its files, where sorted keys take a small part of the
    memory they take as rows; a broadcast chosen by that guess has to fit the driver.
    """
    return left.join(right.hint("merge"), on if isinstance(on, str) else list(on), how)


def lookup(
    rows: DataFrame, table: DataFrame, key: str, spread: Sequence[str], how: str = "inner",
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Joins ``rows`` with a table of one row per ``key``, ``inner`` or ``left``.

    ``spread`` names columns that differ within a key; their hash picks the salt,
    so a repeated task picks the same one. ``rows`` are read twice: counts per key
    are written first, one row each.
    """
    counts = materialize(
        rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), "key-counts"
    )
    sized = counts.withColumn("_ordinary", ordinary_rows(counts.agg(F.sum("_n")).scalar(), min_hot_rows))
    hot = F.broadcast(
        sized.where("_n > _ordinary").select(key, cuts(F.col("_n"), F.col("_ordinary")).alias("_salts"))
    )
    salts = F.coalesce("_salts", F.lit(1))
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), salts).cast("int")
    ).drop("_salts")
    copies = table.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    ).drop("_salts")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
