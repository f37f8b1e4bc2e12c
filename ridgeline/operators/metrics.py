"""Classification metrics from one confusion aggregate, losses and meters.

Rows are counted once per (label, prediction); everything else works on those
few cells. Rates over nothing are 0. Classes are all true or predicted values.

One rule for missing values: a row without a label is left out of everything; a row
without a prediction is a sample that was missed. It lowers accuracy and the recall of
its class, and NULL is no class.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.rows import inline_rows
from ridgeline.functions.vectors import argmax, log_sum_exp
from ridgeline.operators.running import running
from ridgeline.runtime import materialize

_RATES = ("precision", "recall", "f1")


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    hits = F.coalesce(F.col(p) == F.col(y), F.lit(False)).cast("double")
    return df.where(F.col(y).isNotNull()).agg(F.avg(hits).alias("accuracy"), F.count("*").alias("num_samples"))


def confusion_cells(df: DataFrame, y: str, p: str) -> DataFrame:
    """Counts of the (label, prediction) combinations that occur; a missing prediction is NULL."""
    return df.where(F.col(y).isNotNull()).groupBy(F.col(y).alias("label"), F.col(p).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, y: str, p: str, dense: bool = False) -> DataFrame:
    """``(label, prediction, n)``: the cells that occur; ``dense`` also lists the zeros.

    The dense form pairs every class with every class, as its result does; missing
    predictions keep their cells in both.
    """
    cells = confusion_cells(df, y, p)
    if not dense:
        return cells
    cells = materialize(cells, "confusion")
    classes = cells.select(F.explode(F.array("label", "prediction")).alias("label")).where("label is not null").distinct()
    every = classes.crossJoin(classes.select(F.col("label").alias("prediction")))
    filled = every.join(cells, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))
    return filled.unionByName(cells.where("prediction is null"))


def per_class_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 and support of every class."""
    return class_metrics_from_cells(confusion_cells(df, y, p))


def class_metrics_from_cells(cells: DataFrame) -> DataFrame:
    """The same from ``(label, prediction, n)`` cells, however they were counted."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    roles = inline_rows(
        ["class", "support", "predicted", "tp"],
        [F.col("label"), F.col("n"), none, hit],
        [F.col("prediction"), none, F.col("n"), none],
    )
    counts = cells.select(roles).where(F.col("class").isNotNull()).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    return counts.select(
        "class",
        _rate(F.col("tp"), F.col("predicted")).alias("precision"),
        _rate(F.col("tp"), F.col("support")).alias("recall"),
        # 2PR/(P+R) in counts.
        _rate(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "tp",
    )


def _average(metric: str, how: str) -> Column:
    if how == "macro":
        return F.avg(metric)
    return _rate(F.sum(F.col(metric) * F.col("support")), F.sum("support"))


def averaged_metrics(df: DataFrame, y: str, p: str, average: str) -> DataFrame:
    """Precision, recall and F1 as ``macro`` (plain) or ``weighted`` (by support) mean."""
    if average not in ("macro", "weighted"):
        raise ValueError(f"unknown average: {average}")
    return per_class_metrics(df, y, p).agg(
        *[_average(m, average).alias(f"{m}_{average}") for m in _RATES]
    )


def _record(classes: DataFrame) -> DataFrame:
    return classes.agg(
        _rate(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[
            _average(m, how).alias(f"{m}_{how}")
            for how in ("macro", "weighted")
            for m in _RATES
        ],
        F.count("*").cast("int").alias("num_classes"),
        F.sum("support").alias("num_samples"),
    )


def evaluate(df: DataFrame, y: str, p: str) -> DataFrame:
    """The evaluation record: one row with every metric, from one pass over ``df``."""
    return _record(per_class_metrics(df, y, p))


def with_run(
    record: DataFrame, at: datetime, inference_time_ms: float = 0.0, model_path: str | None = None
) -> DataFrame:
    """The evaluation record as it is stored: with latency, time and model."""
    return record.withColumns({
        "inference_time_ms": F.lit(float(inference_time_ms)),
        "timestamp": F.lit(at.isoformat()),
        "model_path": F.lit(model_path).cast("string"),
    })


def classification_report(
    df: DataFrame, y: str, p: str, names: DataFrame | None = None
) -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages.

    ``names`` maps ``class`` to ``name``; a class without one keeps its value.
    All rows come from the one aggregate over ``df``: the summary rows are laid
    out as an array of one record.
    """
    classes = per_class_metrics(df, y, p)
    named = classes if names is None else classes.join(names, "class", "left")
    shown = F.col("class").cast("string")
    body = named.select(
        (shown if names is None else F.coalesce("name", shown)).alias("row"),
        "precision", "recall", "f1", "support",
    )
    nothing = F.lit(None).cast("double")
    r = _record(classes)

    def summary(title: str, suffix: str) -> list[Column]:
        return [F.lit(title), *[F.col(f"{m}_{suffix}") for m in _RATES], F.col("num_samples")]

    tail = r.select(inline_rows(
        ["row", *_RATES, "support"],
        [F.lit("accuracy"), nothing, nothing, F.col("accuracy"), F.col("num_samples")],
        summary("macro avg", "macro"),
        summary("weighted avg", "weighted"),
    ))
    return body.unionByName(tail)


def cross_entropy(df: DataFrame, z: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of ``logsumexp(z) - z[y]`` and accuracy.

    Batch means weighted by batch size are the mean over rows, so batches need
    not be formed. Rows without scores or label are left out of all three; a label
    outside the scores is an error.
    """
    place = F.col(y)
    outside = F.format_string("label %d has no score", place.cast("long"))
    own = F.when((place < 0) | (place >= F.size(z)), F.raise_error(outside).cast("double")).otherwise(F.get(F.col(z), place))
    return df.where(F.col(z).isNotNull() & place.isNotNull()).groupBy(*by).agg(
        F.avg(log_sum_exp(F.col(z)) - own).alias("loss"),
        F.avg((argmax(F.col(z)) == place).cast("double")).alias("accuracy"),
        F.count("*").alias("n"),
    )


def weighted_meter(df: DataFrame, v: str, n: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Weighted mean, last value, sum and count of a stream of measurements."""
    total = F.sum(F.col(v) * F.col(n))
    return df.groupBy(*by).agg(
        F.max_by(v, order).alias("val"),
        total.alias("sum"),
        F.sum(n).alias("count"),
        _rate(total, F.sum(n)).alias("avg"),
    )


def running_average(
    df: DataFrame, v: str, n: str, order: str, by: Sequence[str], segment: Column
) -> DataFrame:
    """The meter after each update: weighted mean of all rows up to this one.

    ``segment`` must not fall as ``order`` rises; it spreads a long run over tasks.
    """
    sums = running(df, by, segment, [order], {
        "_sum": ("sum", F.col(v) * F.col(n)),
        "_count": ("sum", F.col(n)),
    })
    return sums.select(*df.columns, _rate(F.col("_sum"), F.col("_count")).alias("running_avg"))


def batch_latency(df: DataFrame, ms: str, batch: str, by: Sequence[str] = ()) -> DataFrame:
    """Total milliseconds over the number of batches."""
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(ms), F.count_distinct(F.col(batch))).alias("inference_time_ms")
    )
