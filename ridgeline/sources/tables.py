"""Feature tables, prediction exports, drift references and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.rows import inline_rows
from ridgeline.operators.labels import build_label_index
from ridgeline.operators.stats import STATISTICS

# Explicit, so a read never scans the file to guess types.
REFERENCE_SCHEMA = T.StructType([
    *[T.StructField(f"iris_{s}", T.DoubleType()) for s in STATISTICS],
    *[T.StructField(f"fingerprint_{s}", T.DoubleType()) for s in STATISTICS],
    T.StructField("subject_id", T.StringType()),
])

PREDICTION_COLUMNS = ("subject_id", "prediction", "label", "confidence", "correct")


def write_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Feature table as snappy Parquet."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_features(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The feature table; only ``columns`` are read from the files."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def feature_labels(features: DataFrame) -> DataFrame:
    """Label dictionary of a feature table; reads the id column alone."""
    return build_label_index(features, "subject_id")


def export_predictions(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Prediction table as ``parquet`` or ``csv`` with header."""
    out = df.select(*PREDICTION_COLUMNS).write.mode(mode)
    if fmt == "parquet":
        out.parquet(path)
    elif fmt == "csv":
        out.csv(path, header=True)
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_reference(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Drift features as CSV with header."""
    df.select(*REFERENCE_SCHEMA.names).write.mode(mode).csv(path, header=True)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REFERENCE_SCHEMA).csv(path, header=True)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A report (metrics, drift, monitoring, comparison) as JSON, one object per row."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def metric_rows(record: DataFrame) -> DataFrame:
    """The numeric columns of a one-row record as ``(metric, value)`` rows."""
    numeric = [f.name for f in record.schema if isinstance(f.dataType, T.NumericType)]
    return record.select(inline_rows(
        ["metric", "value"], *[[F.lit(c), F.col(c).cast("double")] for c in numeric]
    ))
