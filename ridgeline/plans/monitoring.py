"""The monitoring job: data drift, model drift, health, report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.drift import (
    PRIMARY_METRIC,
    ShareParams,
    align_features,
    column_share_drift,
    data_drift,
    data_drift_record,
    feature_profile,
    health_status,
    ks_test,
    model_drift,
    model_drift_record,
    profile_counts,
)
from ridgeline.operators.stats import pair_features
from ridgeline.runtime import materialize
from ridgeline.sources.tables import read_reference, write_reference, write_report

# Metrics of a baseline made before any evaluation.
PLACEHOLDER_METRICS = ("accuracy", "f1_macro", "f1_weighted")


def create_baseline(
    iris: DataFrame, fingerprint: DataFrame, champion_metrics: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Reference features and baseline ``(metric, value)``, zero where unknown."""
    features = pair_features(iris, fingerprint)
    spark = features.sparkSession
    zeros = spark.createDataFrame([(m, 0.0) for m in PLACEHOLDER_METRICS], "metric string, value double")
    if champion_metrics is None:
        return features, zeros
    known = champion_metrics.select("metric", F.coalesce("value", F.lit(0.0)).alias("value"))
    missing = zeros.join(known, "metric", "left_anti")
    return features, known.unionByName(missing)


def save_baseline(features: DataFrame, metrics: DataFrame, path: str) -> tuple[str, str]:
    """Writes both parts under ``path`` and returns their places."""
    at = f"{path}/reference_features", f"{path}/baseline_metrics"
    write_reference(features, at[0])
    write_report(metrics, at[1])
    return at


def load_baseline(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        read_reference(spark, f"{path}/reference_features"),
        spark.read.schema("metric string, value double").json(f"{path}/baseline_metrics"),
    )


def run_monitoring(
    ref: DataFrame | None = None,
    cur: DataFrame | None = None,
    baseline: DataFrame | None = None,
    current: DataFrame | None = None,
    primary: str = PRIMARY_METRIC,
    column_share: str | None = None,
    categorical: Sequence[str] = (),
    params: ShareParams = ShareParams(),
) -> DataFrame:
    """The monitoring report: one row with both verdicts, status and advice.

    Data drift needs ``ref`` and ``cur``, model drift ``baseline`` and
    ``current``; a part without its inputs is left out. ``column_share`` names a method
    of :func:`column_share_drift`, which then decides instead of KS on all columns.
    """
    data = model = None
    if ref is not None and cur is not None:
        data = column_share_drift(ref, cur, column_share, categorical, params) if column_share else data_drift(ks_test(ref, cur))
    if baseline is not None and current is not None:
        model = model_drift(baseline, current, primary)
    if data is None and model is None:
        raise ValueError("nothing to monitor: give features or metrics of both sides")
    return health_status(data, model)


def save_profile(profile: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keeps a profile, sorted by feature and value, so that a read of one feature skips the others' row groups."""
    profile.repartitionByRange("feature", "value").sortWithinPartitions("feature", "value").write.mode(mode).parquet(path)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature string, value double, n long").parquet(path)


def monitor_against_profile(
    profile: DataFrame, cur: DataFrame, baseline: DataFrame | None = None, current: DataFrame | None = None,
    primary: str = PRIMARY_METRIC, columns: Sequence[str] | None = None, keep: str | None = None,
) -> DataFrame:
    """:func:`run_monitoring` with the reference as its stored profile: only the new rows are read.

    The reference is touched as distinct values and their counts. ``keep`` names a folder where the
    new rows' own profile is left, to be merged into a later reference.
    """
    spark = cur.sparkSession
    new = feature_profile(cur, columns)
    if keep is None:
        new = materialize(new, "profile")
    else:
        save_profile(new, keep)
        new = load_profile(spark, keep)
    values = profile_counts(profile, new, align_features(cur, cur, columns))
    data = data_drift(ks_test(cur, cur, values=values) if values else ks_test(cur.limit(0), cur, columns=[]))
    model = model_drift(baseline, current, primary) if baseline is not None and current is not None else None
    return health_status(data, model)


def monitoring_record(
    at: datetime,
    ref: DataFrame | None = None,
    cur: DataFrame | None = None,
    baseline: DataFrame | None = None,
    current: DataFrame | None = None,
    primary: str = PRIMARY_METRIC,
) -> DataFrame:
    """The full report in one nested row, as it is stored.

    Both drift results with their details (absent without inputs), the status,
    the recommendations and the time.
    """
    parts = {}
    if ref is not None and cur is not None:
        # Tested once, read by the verdict and by the details.
        tests = materialize(ks_test(ref, cur), "drift-tests")
        parts["data_drift"] = data_drift_record(tests, at)
    if baseline is not None and current is not None:
        parts["model_drift"] = model_drift_record(baseline, current, at, primary)
    if not parts:
        raise ValueError("nothing to monitor: give features or metrics of both sides")
    verdicts = {name: part.select("record.*") for name, part in parts.items()}
    status = health_status(verdicts.get("data_drift"), verdicts.get("model_drift"))
    return status.select(
        *[part.scalar().alias(name) for name, part in parts.items()],
        "overall_status",
        "recommendations",
        F.lit(at.isoformat()).alias("timestamp"),
    )
