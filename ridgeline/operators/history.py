"""Training-history analytics over many runs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.operators.running import running
from ridgeline.operators.skew import lookup

# Early-stopping defaults and the metrics a history keeps.
PATIENCE, MIN_DELTA = 10, 0.001
METRICS = ("train_loss", "train_acc", "val_loss", "val_acc")

# Blocks of epochs per segment of a run; an ordinary run is one segment.
SEGMENT_BLOCKS = 10_000


def _until_stopped(h: DataFrame, patience: int, min_delta: float, run: str) -> DataFrame:
    """The epochs of a run up to a point where it must have stopped.

    While training goes on, ``2 * patience`` epochs hold two improvements of more
    than ``min_delta`` each, and the best loss is at most ``min_delta`` above the
    least one seen; so the least loss falls by more than ``min_delta``. The first
    block of that length where it falls by half of that or less ends the run for
    certain. What is left has at most ``2 * patience`` epochs per ``min_delta / 2``
    of loss, however long the run.
    """
    span = 2 * patience
    blocks = h.groupBy(run, F.floor((F.col("epoch") - 1) / span).alias("block")).agg(F.min("loss").alias("least"))
    seen = running(
        blocks, [run], F.floor(F.col("block") / SEGMENT_BLOCKS), ["block"],
        {"earlier": ("min", F.col("least"))}, before=True,
    )
    fell = F.col("earlier") - F.least("earlier", "least")
    ends = seen.where(fell <= min_delta / 2).groupBy(run).agg(F.min((F.col("block") + 1) * span).alias("_end"))
    return lookup(h, ends, run, ["epoch"], "left").where("_end is null or epoch <= _end").drop("_end")


def early_stop(
    h: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA, run: str = "run_id"
) -> DataFrame:
    """Best epoch, its loss and the epoch training stopped at, per run.

    Input ``(run, epoch, loss)``, epochs counted from 1 without gaps. An epoch is
    best only if it beats the best loss by more than ``min_delta``; after
    ``patience`` epochs without one, training stops and the rest is not seen.
    """
    if patience < 1:
        raise ValueError("patience must be at least 1")
    lengths = h.groupBy(run).agg(F.max("epoch").alias("epochs"))
    seen = _until_stopped(h.select(run, "epoch", "loss"), patience, min_delta, run)
    ordered = seen.select(run, F.col("epoch").cast("long"), F.col("loss").cast("double")).repartition(run).sortWithinPartitions(run, "epoch")
    fields = T.StructType([
        h.schema[run], T.StructField("best_epoch", T.LongType()), T.StructField("best_loss", T.DoubleType()),
    ])
    best = ordered.mapInArrow(_best_of_runs(run, patience, min_delta), fields)
    out_of_patience = F.col("epochs") - F.col("best_epoch") >= patience
    return best.join(lengths, run).select(
        run,
        "best_epoch",
        "best_loss",
        F.when(out_of_patience, F.col("best_epoch") + patience).otherwise(F.col("epochs")).alias("last_epoch"),
        out_of_patience.alias("stopped_early"),
    )


def _best_of_runs(run: str, patience: int, min_delta: float):
    """Folds sorted epochs batch by batch; of a run only its best so far is kept."""

    def fold(batches):
        current, best_epoch, best_loss, stopped, begun = None, 0, float("inf"), False, False
        for batch in batches:
            names = batch.column(0)
            epochs, losses = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
            ids = names.to_pylist()
            limits = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)] if ids else []
            done = []
            for a, b in zip(limits, limits[1:]):
                if not begun or ids[a] != current:
                    if begun:
                        done.append((current, best_epoch, best_loss))
                    current, best_epoch, best_loss, stopped, begun = ids[a], 0, float("inf"), False, True
                part = losses[a:b]
                # Only epochs below all before them in the batch can be the next best.
                below = np.fmin.accumulate(part)
                records = np.flatnonzero(np.concatenate(([True], below[1:] < below[:-1])))
                for i in records.tolist():
                    stopped = stopped or epochs[a + i] - best_epoch > patience
                    if stopped:
                        break
                    if part[i] < best_loss - min_delta:
                        best_epoch, best_loss = int(epochs[a + i]), float(part[i])
            yield _best_rows(done, names.type, run)
        if begun:
            yield _best_rows([(current, best_epoch, best_loss)], names.type, run)

    return fold


def _best_rows(rows: list[tuple], kind: pa.DataType, run: str) -> pa.RecordBatch:
    ids, epochs, losses = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array(epochs, pa.int64()), pa.array(losses, pa.float64())], names=[run, "best_epoch", "best_loss"]
    )


def history_pivot(
    h: DataFrame, run: str = "run_id", metrics: Sequence[str] = METRICS
) -> DataFrame:
    """``(run, epoch, metric, value)`` to one column per metric.

    One value per metric and epoch; conditional aggregates take one shuffle where
    a pivot takes two.
    """
    return h.groupBy(run, "epoch").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


def final_metrics(wide: DataFrame, best: DataFrame, run: str = "run_id") -> DataFrame:
    """The metrics of the best epoch of each run; 0 where none were kept."""
    at_best = best.select(run, F.col("best_epoch").alias("epoch"), F.col("best_loss").alias("val_loss"))
    kept = wide.select(
        run, "epoch",
        F.col("val_acc"), F.col("train_loss"),
    )
    return at_best.join(kept, [run, "epoch"], "left").select(
        run,
        F.col("epoch").alias("best_epoch"),
        "val_loss",
        F.coalesce("val_acc", F.lit(0.0)).alias("val_acc"),
        F.coalesce("train_loss", F.lit(0.0)).alias("train_loss"),
    )
