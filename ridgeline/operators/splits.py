"""Exact seeded splits, batches and sample caps.

The order behind every split is ``md5(seed:key)``. Its values are uniform, so
their leading hex digits make balanced segments whatever the keys look like.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.rows import inline_rows
from ridgeline.operators.running import running

SPLITS = ("train", "val", "test")
RATIOS = (0.7, 0.15, 0.15)
_DIGITS = 3  # 4096 buckets per level


def order_hash(seed: int | str, *keys: Column | str) -> Column:
    """Hash of the seed and the keys; no two different lists of keys are written alike."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    plain = [F.replace(F.replace(p.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p, F.lit("\\N")) for p in plain]))


def split_cutoffs(
    df: DataFrame, key: Sequence[str], ratios: Sequence[float] = RATIOS, seed: int = 42
) -> DataFrame:
    """One row with the hash values at which ``train`` and ``val`` end.

    A selection instead of a sort: count rows per hash prefix, find the bucket
    that holds the wanted position, count again inside it, and sort only the few
    rows left. Nothing but counts of at most 4096 buckets is shuffled until then.
    A column is NULL where its split is empty from the start.
    """
    hashed = df.select(order_hash(seed, *key).alias("h"))
    running_count = W.partitionBy("cut").orderBy("bucket").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )

    def located(counts: DataFrame) -> DataFrame:
        """The bucket of each cut, and the position wanted inside it."""
        upto = counts.withColumn("upto", F.sum("n").over(running_count))
        return upto.where("upto - n < need and need <= upto").select(
            "cut", F.col("bucket").alias("outer"), (F.col("need") - F.col("upto") + F.col("n")).alias("need")
        )

    first = hashed.groupBy(F.substring("h", 1, _DIGITS).alias("bucket")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy())
    first = first.withColumns({
        "n_train": F.floor(total * F.lit(float(ratios[0]))),
        "n_val": F.floor(total * F.lit(float(ratios[1]))),
    }).select("bucket", "n", inline_rows(
        ["cut", "need"],
        [F.lit("train"), F.col("n_train")],
        [F.lit("val"), F.col("n_train") + F.col("n_val")],
    ))

    # Two rows at most on the broadcast side: one per cut.
    inside = hashed.join(
        F.broadcast(located(first)), F.substring("h", 1, _DIGITS) == F.col("outer")
    )
    second = inside.groupBy("cut", "need", F.substring("h", 1, 2 * _DIGITS).alias("bucket")).agg(
        F.count("*").alias("n")
    )
    last = hashed.join(
        F.broadcast(located(second)), F.substring("h", 1, 2 * _DIGITS) == F.col("outer")
    ).withColumn("rank", F.row_number().over(W.partitionBy("cut").orderBy("h")))
    return last.where("rank = need").agg(
        F.max(F.when(F.col("cut") == "train", F.col("h"))).alias("train"),
        F.max(F.when(F.col("cut") == "val", F.col("h"))).alias("val"),
    )


def split_at(df: DataFrame, key: Sequence[str], cutoffs: Row, seed: int = 42) -> DataFrame:
    """Adds ``split`` by two known cutoffs: a comparison per row, nothing else.

    The cutoffs of :func:`split_cutoffs` can be kept, to split later rows alike.
    """
    h = order_hash(seed, *key)

    def upto(cut: str | None) -> Column:
        return F.lit(False) if cut is None else h <= cut

    train, val, test = SPLITS
    return df.withColumn(
        "split", F.when(upto(cutoffs["train"]), train).when(upto(cutoffs["val"]), val).otherwise(test)
    )


def exact_split(
    df: DataFrame, key: str | Sequence[str], ratios: Sequence[float] = RATIOS, seed: int = 42
) -> DataFrame:
    """Adds ``split``: exactly ``int(r0*n)`` train, ``int(r1*n)`` val, the rest test.

    ``key`` must be unique per row; where repeats make the sizes come out wrong, this
    raises. The two cutoffs are found at once and become constants of the plan, so
    later jobs on the result do not look for them again; rows are not moved. The keys
    are read four times and never shuffled whole: that is what no sort costs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cutoffs = split_cutoffs(df, keys, ratios, seed).first()
    h = order_hash(seed, *keys)
    upto = [F.count_if(h <= cutoffs[c]).alias(c) if cutoffs[c] is not None else F.lit(0).alias(c) for c in ("train", "val")]
    got = df.agg(F.count("*").alias("n"), *upto).first()
    train, val = (math.floor(got["n"] * float(r)) for r in ratios[:2])
    # A cutoff that is NULL stands for a split that is empty from the start.
    if (cutoffs["train"] is not None and got["train"] != train) or (cutoffs["val"] is not None and got["val"] != train + val):
        raise ValueError(f"keys {keys} repeat: no exact split")
    return split_at(df, keys, cutoffs, seed)


def grouped_split(
    df: DataFrame, group: str, ratios: Sequence[float] = RATIOS, seed: int = 42
) -> DataFrame:
    """Splits whole groups, so no subject is in two splits; sizes count groups."""
    cutoffs = split_cutoffs(df.select(group).distinct(), [group], ratios, seed).first()
    return split_at(df, [group], cutoffs, seed)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    size: int,
    seed: int = 42,
    epoch: int | None = None,
    drop_last: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds ``batch_id``; ``epoch`` gives each epoch its own order.

    ``within`` restarts the numbering, say per split. ``drop_last`` leaves out an
    incomplete last batch. Positions run over 65536 hash segments in parallel.
    """
    keys = [key] if isinstance(key, str) else list(key)
    salt = str(seed) if epoch is None else f"{seed}:{epoch}"
    hashed = df.withColumn("_h", order_hash(salt, *keys))
    placed = running(
        hashed, list(within), F.substring("_h", 1, 4), ["_h"],
        {"_pos": ("sum", F.lit(1).cast("long"))}, totals=drop_last,
    ).withColumn("batch_id", F.floor((F.col("_pos") - 1) / size))
    if drop_last:
        placed = placed.where(F.col("batch_id") < F.floor(F.col("_pos_total") / size))
    return placed.select(*df.columns, "batch_id")


def collate(df: DataFrame, batch_cols: Sequence[str], order: str) -> DataFrame:
    """One row per batch with its rows as a sorted array; a batch is small by its size."""
    rest = [c for c in df.columns if c not in (*batch_cols, order)]
    return df.groupBy(*batch_cols).agg(
        F.array_sort(F.collect_list(F.struct(order, *rest))).alias("rows"),
        F.count("*").alias("n"),
    )


def sample_cap(df: DataFrame, order_col: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order_col`` (top-n, no full sort); all without ``n``."""
    return df if n is None else df.orderBy(order_col).limit(n)
