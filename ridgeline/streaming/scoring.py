"""Scoring of newly arrived rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def stream_score(
    source: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
) -> StreamingQuery:
    """Scores what arrived since the last run, then stops.

    ``scorer`` is the batch scorer: per-row work, so the stream keeps no state.
    The file sink commits each batch once; ``checkpoint`` remembers what was read.
    """
    return (
        scorer(source).writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
