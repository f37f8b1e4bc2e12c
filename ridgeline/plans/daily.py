"""The daily chain: score with the model the log names now, check the predictions, watch for drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ridgeline.operators.drift import PRIMARY_METRIC
from ridgeline.operators.metrics import evaluate
from ridgeline.operators.scoring import Model, load_stored, score_table, validate_predictions
from ridgeline.operators.versions import current_versions
from ridgeline.plans.monitoring import monitor_against_profile, run_monitoring
from ridgeline.plans.retraining import stored_version
from ridgeline.sources.tables import export_predictions, metric_rows
from ridgeline.streaming.scoring import stream_score


@dataclass(frozen=True)
class DailyRun:
    """What a run leaves: the version it scored with, its stored predictions, their violations and the report."""

    version: int
    predictions: DataFrame
    violations: DataFrame
    report: DataFrame


def current_model(log: DataFrame, model: str, alias: str | None = None, version: int | None = None) -> tuple[int, Model]:
    """The model to score with now: the named one, else the champion, else the latest; an unknown or unstored one raises."""
    found = stored_version(log, model, alias, version)
    if found is None:
        raise ValueError(f"no stored model for {model}")
    return found[0], load_stored(log.sparkSession, found[1])


def version_metrics(log: DataFrame, model: str, version: int) -> DataFrame:
    """``(metric, value)`` as a version was registered with."""
    held = current_versions(log).where((F.col("model") == model) & (F.col("version") == version))
    return held.select(F.explode("metrics").alias("metric", "value"))


def daily_run(
    rows: DataFrame, log: DataFrame, model: str, vec: str, out: str, known: DataFrame,
    profile: DataFrame | None = None, features: DataFrame | None = None, labels: DataFrame | None = None,
    alias: str | None = None, version: int | None = None, primary: str = PRIMARY_METRIC, keep: str | None = None,
) -> DailyRun:
    """Scores ``rows``, validates and monitors, in one job.

    The model is looked up in the log at each run. Predictions are written to ``out`` once and read
    by all that follows; ``known`` is the dictionary of labels they are checked against. The
    model's registered metrics are the baseline, those of the labelled predictions the present ones;
    ``features`` are compared with the stored ``profile`` of the reference, and their own is left at ``keep``.
    """
    spark = rows.sparkSession
    number, scorer = current_model(log, model, alias, version)
    export_predictions(score_table(rows, scorer, vec, labels), out)
    predictions = spark.read.parquet(out)
    violations = validate_predictions(predictions, known)
    baseline = version_metrics(log, model, number)
    present = metric_rows(evaluate(predictions, "label", "prediction"))
    if profile is not None and features is not None:
        report = monitor_against_profile(profile, features, baseline, present, primary, keep=keep)
    else:
        report = run_monitoring(None, None, baseline, present, primary)
    return DailyRun(number, predictions, violations, report)


def score_arrivals(
    source: DataFrame, log: DataFrame, model: str, vec: str, sink: str, checkpoint: str, labels: DataFrame | None = None,
) -> StreamingQuery:
    """Scores what arrived since the last run with the model that is champion when the run starts."""
    _, scorer = current_model(log, model)
    return stream_score(source, lambda rows: score_table(rows, scorer, vec, labels), sink, checkpoint)
