"""Label dictionaries: sorted distinct ids to dense integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.operators.skew import MIN_HOT_ROWS, lookup
from ridgeline.runtime import materialize

# monotonically_increasing_id keeps the partition in the upper bits.
_LOCAL_BITS = 33


def ordered_rank(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds the 0-based global position by ``order``, without a one-task sort.

    Rows are range-sorted and written with their partition and local position;
    what an executor loss might redraw is thereby fixed. One offset per
    partition then turns local positions into global ones.
    """
    sorted_rows = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    fixed = materialize(sorted_rows, "rank").withColumns({
        "_part": F.shiftright("_id", _LOCAL_BITS),
        "_local": F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return fixed.join(offsets, "_part").select(
        *df.columns, (F.col("_offset") + F.col("_local")).alias(name)
    )


def build_label_index(df: DataFrame, id_col: str) -> DataFrame:
    """``(id_col, label)`` with labels 0..k-1 in id order; nulls get none.

    Distinct ids are ranked by range partitions, so their number has no bound.
    """
    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return ordered_rank(ids, [id_col], "label").select(id_col, F.col("label").cast("int"))


def save_labels(labels: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Stores a dictionary, so that scoring later uses that of training."""
    labels.write.mode(mode).parquet(path)


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def num_classes(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count("*").alias("num_classes"))


def attach_label(
    df: DataFrame, labels: DataFrame, id_col: str = "subject_id", spread: Sequence[str] | None = None,
    max_ids: int | None = None, min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Adds ``label``; rows of unknown ids keep NULL.

    ``max_ids`` is a bound the id format itself proves (strict subject ids: three
    digits), under which the dictionary is broadcast. Otherwise it grows with the
    subjects and carries no hint. ``spread`` then names columns that differ within an
    id; with it hot ids are spread over tasks.
    """
    if max_ids is not None:
        return df.join(F.broadcast(labels), id_col, "left")
    if spread:
        return lookup(df, labels, id_col, spread, "left", min_hot_rows)
    return df.join(labels, id_col, "left")
