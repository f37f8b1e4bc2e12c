"""Retraining and evaluation around the version log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.drift import PRIMARY_METRIC
from ridgeline.operators.metrics import with_run
from ridgeline.operators.scoring import Model, centroid_fit, centroid_scorer, load_stored, scored_by, store_model
from ridgeline.operators.splits import RATIOS, exact_split
from ridgeline.operators.versions import (
    CHALLENGER,
    LOG_COLUMNS,
    PROMOTION_THRESHOLD,
    current_versions,
    pick_model,
    promote,
    registered,
    retrain_decision,
)
from ridgeline.plans.evaluation import evaluate_split
from ridgeline.runtime import materialize, scratch_path

# The tag of a version that names where its model is stored.
MODEL_PATH = "model_path"


@dataclass(frozen=True)
class Retraining:
    """What a retraining leaves: the log after it, and the comparison as one stored record."""

    log: DataFrame
    comparison: DataFrame


def stored_version(log: DataFrame, model: str, alias: str | None = None, version: int | None = None) -> tuple[int, str] | None:
    """Number and place of the named version, else of the champion, else of the latest; None where it is not stored."""
    own = log.where(F.col("model") == model)
    row = _with_path(pick_model(own, alias, version), own).first()
    return (row.version, row.path) if row else None


def _with_path(picked: DataFrame, log: DataFrame) -> DataFrame:
    paths = current_versions(log).select("model", "version", F.try_element_at("tags", F.lit(MODEL_PATH)).alias("path"))
    return picked.join(paths, ["model", "version"]).where("path is not null")


def comparison_record(decision: DataFrame, metric: str, threshold: float, at: datetime) -> DataFrame:
    """A decision as it is stored: both sides' values, the metric, the threshold and the time."""
    return decision.select(
        "model", "champion_value", "challenger_value", "winner", "promoted", "improvement",
        F.lit(metric).alias("metric"), F.lit(float(threshold)).alias("threshold"), F.lit(at.isoformat()).alias("timestamp"),
    )


def retrain_pipeline(
    df: DataFrame, log: DataFrame, model: str, key: str, vec: str, at: datetime, label: str = "label",
    metric: str = PRIMARY_METRIC, threshold: float = PROMOTION_THRESHOLD, force: bool = False,
    ratios: Sequence[float] = RATIOS, seed: int = 42, fit: Callable[[DataFrame], Model] | None = None, store: str | None = None,
) -> Retraining:
    """Split, fit a challenger, score it and the stored champion on the same test split, decide, and log.

    ``fit`` makes a model of any kind from the training rows; without it class centroids are
    fitted. Champion and challenger need not be of one kind. The challenger is registered with its metrics and
    place; if it wins it is promoted. Without a champion, or one whose model is not stored, it wins.
    Models are kept under ``store``, a folder of their own: a registered model must outlive the scratch
    folder, which is used only where no store is named.
    """
    spark = df.sparkSession
    parted = exact_split(df, key, ratios, seed)
    train = parted.where("split = 'train'")
    place = store or scratch_path(spark, "models")
    if fit is None:
        challenger = centroid_scorer(centroid_fit(train, vec, label), path=f"{place.rstrip('/')}/centroids-{uuid.uuid4().hex}")
    else:
        challenger = fit(train)
    stored_at = store_model(spark, challenger, place)

    def measured(scorer: Model) -> dict[str, float]:
        record = evaluate_split(parted, lambda rows: scored_by(rows, scorer, vec), "test", label).first()
        return {k: float(v) for k, v in record.asDict().items() if v is not None}

    new = measured(challenger)
    held = stored_version(log, model, alias="champion")
    old = measured(load_stored(spark, held[1])) if held else None
    side = "model string, value double"
    decision = retrain_decision(
        spark.createDataFrame([(model, old[metric])] if old else [], side),
        spark.createDataFrame([(model, new[metric])], side), threshold, force,
    )
    fresh = spark.createDataFrame(
        [(model, at, 1, {MODEL_PATH: stored_at}, new)],
        "model string, event_ts timestamp, run int, tags map<string,string>, metrics map<string,double>",
    )
    after = materialize(registered(log.select(*LOG_COLUMNS), fresh, "run", CHALLENGER), "version-log")
    version = after.where((F.col("model") == model) & (F.col("alias") == CHALLENGER)).agg(F.max("version").alias("challenger"))
    moves = decision.select("model", F.col("promoted").alias("promote")).crossJoin(F.broadcast(version)).withColumn(
        "champion", F.lit(held[0] if held else None).cast("int")
    )
    return Retraining(promote(after, moves, at), comparison_record(decision, metric, threshold, at))


def evaluate_from_log(
    df: DataFrame, log: DataFrame, model: str, key: str, vec: str, at: datetime, label: str = "label",
    split: str = "test", alias: str | None = None, version: int | None = None,
    ratios: Sequence[float] = RATIOS, seed: int = 42,
) -> DataFrame:
    """The evaluation record of a logged version (champion, else the latest), with its ``version`` and ``model_path``."""
    found = stored_version(log, model, alias, version)
    if found is None:
        raise ValueError(f"no stored model for {model}")
    number, path = found
    scorer = load_stored(df.sparkSession, path)
    parted = exact_split(df, key, ratios, seed)
    record = evaluate_split(parted, lambda rows: scored_by(rows, scorer, vec), split, label)
    return with_run(record, at, model_path=path).withColumn("version", F.lit(number))
