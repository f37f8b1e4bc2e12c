"""Drift per event-time window with a state of bounded size.

The exact form keeps one row for each distinct value of the open windows. Here a window keeps
one mergeable quantile sketch (KLL) for each column, some kilobytes whatever arrives. The
reference, which stands still, is known exactly: a grid of its values, just fine enough
that no more than ``1 / points`` of the reference lies between two of them, is computed once.

Error bound. Between two neighbours of the grid the reference function rises by at most
``1 / points``, and the largest gap lies no more than that above the largest one seen on the grid's
values or just below them. The sketch's ranks are off by :func:`rank_error` at most (with
99 % confidence, and not at all while a window has fewer than ``k`` values). So the KS statistic
is off by ``rank_error(k) + 1 / points`` at most, which the result states.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgeline.operators.drift import P_THRESHOLD, ColumnProfile, ks_pvalue, long_values, numeric_value, per_feature, reference_profiles
from ridgeline.operators.running import running_by_range
from ridgeline.streaming.drift import reference_counts

_WINDOW = "window_start"
SKETCH_K = 2048
GRID_POINTS = 1000


def rank_error(k: int) -> float:
    """Largest error of a rank read from a sketch, at 99 % confidence: the published fit for KLL."""
    return 2.296 / k**0.9723


@dataclass(frozen=True)
class Grid:
    """The reference's distribution function of one column: ``heights`` at ``places``, on its values and just below them."""

    places: tuple[float, ...]
    heights: tuple[float, ...]


def reference_grid(ref: DataFrame, profiles: Sequence[ColumnProfile], points: int = GRID_POINTS) -> list[Grid]:
    """The grid of each column.

    A value belongs to the grid if a multiple of ``1 / points`` is reached with it: at most
    ``points + 1`` of a column do, and the largest value always. Only those rows come to the driver.
    """
    counts = reference_counts(ref, profiles)
    upto = running_by_range(counts, ["feature_no"], ["value"], {"upto": ("sum", F.col("n_ref"))})
    n = per_feature([p.n_ref for p in profiles], "long")
    before = F.col("upto") - F.col("n_ref")
    crosses = F.floor(F.col("upto") * points / n) > F.floor(before * points / n)
    on: list[list[tuple[float, float]]] = [[] for _ in profiles]
    for r in upto.where(crosses).select("feature_no", "value", (F.col("upto") / n).alias("at"), (before / n).alias("below")).toLocalIterator():
        on[r.feature_no] += [(r.value, r.at), (math.nextafter(r.value, -math.inf), r.below)]
    return [Grid(*zip(*sorted(rows))) for rows in on]


def _doubles(values: Sequence[float]) -> Column:
    """An array of doubles as one constant."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def window_sketches(
    df: DataFrame, profiles: Sequence[ColumnProfile], ts: str, width: str, k: int = SKETCH_K, delay: str | None = None
) -> DataFrame:
    """``(window_start, feature_no, n, sketch)``; with ``delay`` also on a stream, where the sketches are the state."""
    rows = df.select(F.col(ts).cast("timestamp").alias("_ts"), *[numeric_value(p.name).alias(p.name) for p in profiles])
    if delay is not None:
        rows = rows.withWatermark("_ts", delay)
    return (
        long_values(rows, [p.name for p in profiles], ["_ts"])
        .groupBy(F.window("_ts", width).alias("w"), "feature_no")
        .agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))
        .select(F.col("w.start").alias(_WINDOW), "feature_no", "n", "sketch")
    )


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """Sketches of the same windows from several sources, as of all their values together."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(_WINDOW, "feature_no").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_ks(
    grid: Sequence[Grid], sketches: DataFrame, profiles: Sequence[ColumnProfile], points: int = GRID_POINTS, k: int = SKETCH_K,
    threshold: float = P_THRESHOLD,
) -> DataFrame:
    """KS test of every window and column; ``error`` bounds what the statistic is off by. Rows are not shuffled."""
    gap = F.lit(None).cast("double")
    for i, g in enumerate(grid):
        ranks = F.kll_sketch_get_rank_double("sketch", _doubles(g.places))
        largest = F.array_max(F.zip_with(ranks, _doubles(g.heights), lambda here, there: F.abs(here - there)))
        gap = F.when(F.col("feature_no") == i, largest).otherwise(gap)
    n_ref = per_feature([p.n_ref for p in profiles], "long")
    exact = F.col("n") < k
    return sketches.select(
        _WINDOW, per_feature([p.name for p in profiles], "string").alias("feature"), gap.alias("ks_statistic"), n_ref.alias("n_ref"),
        F.col("n").alias("n_cur"), (F.when(exact, 0.0).otherwise(rank_error(k)) + 1 / points).alias("error"),
    ).withColumn("p_value", ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))).withColumn("drifted", F.col("p_value") < threshold)


def sketched_drift(
    ref: DataFrame, cur: DataFrame, ts: str, width: str = "1 day", columns: Sequence[str] | None = None,
    threshold: float = P_THRESHOLD, k: int = SKETCH_K, points: int = GRID_POINTS,
) -> DataFrame:
    """The batch form: every window of ``cur``."""
    profiles = reference_profiles(ref, columns)
    grid = reference_grid(ref, profiles, points)
    return sketched_ks(grid, window_sketches(cur, profiles, ts, width, k), profiles, points, k, threshold)


def stream_sketched_drift(
    ref: DataFrame, stream: DataFrame, sink: str, checkpoint: str, ts: str, width: str = "1 day", delay: str = "1 hour",
    columns: Sequence[str] | None = None, threshold: float = P_THRESHOLD, k: int = SKETCH_K, points: int = GRID_POINTS,
) -> StreamingQuery:
    """Tests each window once, when the watermark closes it; the file sink commits each batch once.

    The state is one sketch for each open window and column, whatever number of distinct values arrives.
    """
    profiles = reference_profiles(ref, columns)
    grid = reference_grid(ref, profiles, points)
    sketches = window_sketches(stream, profiles, ts, width, k, delay)
    return (
        sketched_ks(grid, sketches, profiles, points, k, threshold).writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
