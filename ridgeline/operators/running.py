"""Running aggregates over keys too large for one task.

A window over a key puts the whole key into one task. Here the caller names a
*segment* that grows with the order, so a key spreads over many tasks: each
segment runs on its own, and a small table of segment totals supplies what came
before it. The segment must be a plain function of the row, so that recomputed
tasks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.runtime import materialize

_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(how: str, before: Column, here: Column) -> Column:
    if how == "sum":
        return F.coalesce(before, F.lit(0)) + here
    return F.least(before, here) if how == "min" else F.greatest(before, here)


def running(
    df: DataFrame,
    keys: Sequence[str],
    segment: Column,
    order: Sequence[str],
    aggregates: dict[str, tuple[str, Column]],
    before: bool = False,
    totals: bool = False,
) -> DataFrame:
    """Adds one running aggregate per entry ``name -> (sum|min|max, column)``.

    Rows of a key run by ``(segment, order)``. With ``before`` the row itself is
    left out (NULL on the first row of a key). Sums must be over non-null values;
    a NULL key or segment is an error, for the join below compares with ``=``: so
    it meets the partitioning and order of the window, and rows shuffle once.
    With ``totals`` a column ``<name>_total`` tells the aggregate of the whole key.
    """
    seg, tag = "_segment", "_before_"
    for k in keys:
        segment = F.when(F.col(k).isNotNull(), segment)
    known = F.coalesce(segment, F.raise_error(F.lit("running: a key or segment is NULL")))
    work = df.withColumns(
        {seg: known, **{f"_in_{n}": col for n, (_, col) in aggregates.items()}}
    )
    part = [*keys, seg]
    frame = W.partitionBy(*part).orderBy(*order).rowsBetween(
        W.unboundedPreceding, -1 if before else W.currentRow
    )
    local = work.withColumns(
        {n: _MERGE[how](f"_in_{n}").over(frame) for n, (how, _) in aggregates.items()}
    )

    by_segment = work.groupBy(*part).agg(
        *[_MERGE[how](f"_in_{n}").alias(f"_in_{n}") for n, (how, _) in aggregates.items()]
    )
    earlier = W.partitionBy(*keys).orderBy(seg).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*keys)
    offsets = by_segment.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(part)],
        *[_MERGE[how](f"_in_{n}").over(earlier).alias(tag + n) for n, (how, _) in aggregates.items()],
        *[_MERGE[how](f"_in_{n}").over(whole).alias(f"{n}_total") for n, (how, _) in aggregates.items() if totals],
    )
    same = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(part)]
    joined = local.join(offsets, same, "left")

    def merged(name: str, how: str) -> Column:
        if how == "sum" and before:
            # NULL only where neither this segment nor an earlier one has a row.
            return F.when(
                F.col(tag + name).isNotNull() | F.col(name).isNotNull(),
                F.coalesce(F.col(tag + name), F.lit(0)) + F.coalesce(F.col(name), F.lit(0)),
            )
        return _combine(how, F.col(tag + name), F.col(name))

    return joined.select(
        *df.columns,
        *[merged(n, how).alias(n) for n, (how, _) in aggregates.items()],
        *[f"{n}_total" for n in aggregates if totals],
    )


def numbered(
    df: DataFrame, keys: Sequence[str], segment: Column, order: Sequence[str], name: str
) -> DataFrame:
    """Adds the 1-based position of a row within its key."""
    return running(df, keys, segment, order, {name: ("sum", F.lit(1).cast("long"))})


def running_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], aggregates: dict[str, tuple[str, Column]],
    totals: bool = False,
) -> DataFrame:
    """:func:`running` where no segment is known: rows are dealt by ranges of ``(keys, order)``.

    A key of any size, also with all rows at one time, is cut at its order. The
    ranges are written, so a repeated task cannot draw others. ``order`` must part the
    rows of a key.
    """
    dealt = materialize(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges", df.sparkSession)
    return running(dealt, keys, F.col("_range"), order, aggregates, totals=totals).drop("_range")


def numbered_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, totals: bool = False
) -> DataFrame:
    """The 1-based position of a row within its key; with ``totals`` also ``<name>_total``, the key's rows."""
    return running_by_range(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, totals)
