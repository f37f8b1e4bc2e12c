"""Drift per event-time window against a fixed reference.

A window is compared at its own distinct values only: between two of them its
distribution function is flat and the reference one rises, so the largest gap
lies at a value of the window, on it or just before it. The reference is never
repeated per window.
"""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgeline.operators.drift import (
    P_THRESHOLD,
    ColumnProfile,
    ks_pvalue,
    long_values,
    numeric_value,
    per_feature,
    reference_profiles,
)
from ridgeline.operators.running import running_by_range
from ridgeline.runtime import discarding, materialize

_WINDOW = "window_start"


def reference_counts(ref: DataFrame, profiles: Sequence[ColumnProfile]) -> DataFrame:
    """``(feature_no, value, n_ref)`` of the reference."""
    values = ref.select(*[numeric_value(p.name).alias(p.name) for p in profiles])
    return long_values(values, [p.name for p in profiles], []).groupBy("feature_no", "value").agg(
        F.count("*").alias("n_ref")
    )


def window_counts(
    df: DataFrame, profiles: Sequence[ColumnProfile], ts: str, width: str, delay: str | None = None
) -> DataFrame:
    """``(window_start, feature_no, value, n)``; with ``delay`` also on a stream.

    On a stream these counts are the state: one row per distinct value of the
    windows still open.
    """
    at = F.col(ts).cast("timestamp")
    rows = df.select(at.alias("_ts"), *[numeric_value(p.name).alias(p.name) for p in profiles])
    if delay is not None:
        rows = rows.withWatermark("_ts", delay)
    return (
        long_values(rows, [p.name for p in profiles], ["_ts"])
        .groupBy(F.window("_ts", width).alias("w"), "feature_no", "value")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias(_WINDOW), "feature_no", "value", "n")
    )


def windowed_ks(
    reference: DataFrame, counts: DataFrame, profiles: Sequence[ColumnProfile],
    threshold: float = P_THRESHOLD,
) -> DataFrame:
    """KS test of every window and column against the reference counts.

    Both sides are summed up along ranges drawn from their own values, so values that
    have drifted out of the reference spread like any others.
    """
    asked = counts.select("feature_no", "value").distinct().withColumn("n_ref", F.lit(0).cast("long"))
    merged = reference.unionByName(asked).groupBy("feature_no", "value").agg(F.sum("n_ref").alias("n_ref"))
    heights = running_by_range(merged, ["feature_no"], ["value"], {"upto_ref": ("sum", F.col("n_ref"))})
    own = running_by_range(
        counts, [_WINDOW, "feature_no"], ["value"], {"upto": ("sum", F.col("n"))}, totals=True,
    ).withColumnRenamed("upto_total", "n_cur")
    n_ref = per_feature([p.n_ref for p in profiles], "long")
    rows = own.join(heights, ["feature_no", "value"])
    gap = F.greatest(
        F.abs(F.col("upto_ref") / n_ref - F.col("upto") / F.col("n_cur")),
        F.abs((F.col("upto_ref") - F.col("n_ref")) / n_ref - (F.col("upto") - F.col("n")) / F.col("n_cur")),
    )
    result = rows.groupBy(_WINDOW, "feature_no").agg(
        F.max(gap).alias("ks_statistic"), F.first("n_cur").alias("n_cur")
    )
    return result.select(
        _WINDOW,
        per_feature([p.name for p in profiles], "string").alias("feature"),
        "ks_statistic",
        n_ref.alias("n_ref"),
        "n_cur",
        ks_pvalue(F.col("ks_statistic"), n_ref, F.col("n_cur")).alias("p_value"),
    ).withColumn("drifted", F.col("p_value") < threshold)


def windowed_drift(
    ref: DataFrame, cur: DataFrame, ts: str, width: str = "1 day",
    columns: Sequence[str] | None = None, threshold: float = P_THRESHOLD,
) -> DataFrame:
    """The batch form: every window of ``cur``."""
    profiles = reference_profiles(ref, columns)
    return windowed_ks(
        reference_counts(ref, profiles), window_counts(cur, profiles, ts, width), profiles, threshold
    )


def _note_late(query: StreamingQuery, late: dict[int, int]) -> dict[int, int]:
    """Adds to ``late``, the values left out by batch, what the query still remembers."""
    for step in query.recentProgress:
        n = sum(state["numRowsDroppedByWatermark"] for state in step["stateOperators"])
        late[step["batchId"]] = max(n, late.get(step["batchId"], 0))
    return late


def late_rows(query: StreamingQuery) -> int:
    """Values a run of :func:`stream_windowed_drift` left out because their window was closed already."""
    return sum(_note_late(query, query.late_by_batch).values())


def stream_windowed_drift(
    ref: DataFrame, stream: DataFrame, sink: str, checkpoint: str, ts: str,
    width: str = "1 day", delay: str = "1 hour",
    columns: Sequence[str] | None = None, threshold: float = P_THRESHOLD,
) -> StreamingQuery:
    """Tests each window once, when the watermark closes it.

    The reference counts are written once before the stream starts. Each
    micro-batch writes its own folder, so a repeated batch replaces itself, and
    removes its scratch tables. A window still open at the end stays in the state for
    the next run; what arrives for a closed one is left out, and :func:`late_rows`
    counts it over all batches of the run.
    """
    profiles = reference_profiles(ref, columns)
    reference = materialize(reference_counts(ref, profiles), "reference-counts")

    started, running, late = Event(), [], {}

    def test_closed(closed: DataFrame, batch_id: int) -> None:
        # A query remembers its last batches only (100, unless set): each batch notes those before it.
        if started.wait(60):
            _note_late(running[0], late)
        # The closed windows' counts feed three branches below: fix them first.
        with discarding(ref.sparkSession):
            fixed = materialize(closed, f"windows-{batch_id}", ref.sparkSession)
            if not fixed.isEmpty():
                out = windowed_ks(reference, fixed, profiles, threshold)
                out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    query = (
        window_counts(stream, profiles, ts, width, delay).writeStream.outputMode("append")
        .foreachBatch(test_closed).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.late_by_batch = late
    running.append(query)
    started.set()
    return query
