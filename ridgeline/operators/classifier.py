"""Training and storing a classifier with Spark ML."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.vectors import matrix_rows

_VECTOR = "_features"


def _vectors(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn(_VECTOR, array_to_vector(F.col(vec)))


def train_classifier(
    df: DataFrame,
    vec: str = "embedding",
    label: str = "label",
    kind: str = "logistic",
    seed: int = 42,
    reg: float = 1e-4,
    max_iter: int = 50,
    hidden: int = 256,
    start: PipelineModel | None = None,
) -> PipelineModel:
    """Fits a cross-entropy classifier on fused vectors.

    ``logistic`` is the linear head with L2 decay ``reg``; ``perceptron`` adds a
    hidden layer. Gradients are summed over the cluster, the data stays put.
    ``start`` resumes a perceptron from its stored weights; the logistic optimum
    does not depend on where one starts, so there it is an error.
    """
    rows = _vectors(df.select(vec, F.col(label).cast("double").alias("label")), vec)
    if start is not None and kind != "perceptron":
        raise ValueError("only a perceptron resumes from a model")
    if kind == "logistic":
        stage = LogisticRegression(
            featuresCol=_VECTOR, labelCol="label", family="multinomial", regParam=reg, maxIter=max_iter,
            standardization=False,
        )
    elif kind == "perceptron":
        shape = rows.agg(
            F.max(F.size(vec)).alias("d"), (F.max("label") + 1).cast("int").alias("k")
        ).first()
        stage = MultilayerPerceptronClassifier(
            featuresCol=_VECTOR, labelCol="label", layers=[shape["d"], hidden, shape["k"]],
            seed=seed, maxIter=max_iter,
        )
        if start is not None:
            stage.setInitialWeights(start.stages[-1].weights)
    else:
        raise ValueError(f"unknown classifier: {kind}")
    return Pipeline(stages=[stage]).fit(rows)


def model_scores(df: DataFrame, model: PipelineModel, vec: str = "embedding") -> DataFrame:
    """Adds ``prediction`` and ``confidence`` of a fitted classifier."""
    scored = model.transform(_vectors(df, vec))
    probability: Column = vector_to_array("probability")
    return scored.select(
        *[c for c in df.columns],
        F.col("prediction").cast("int").alias("prediction"),
        F.array_max(probability).alias("confidence"),
    )


def _gradient_parts(rows: DataFrame, w: np.ndarray, b: np.ndarray) -> DataFrame:
    """One row for each partition of ``rows`` (y, x): ``[rows, rows per class.., gradient by class and place..]`` as one array."""
    k, d = w.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + k + k * (d + 1))
        for batch in batches:
            x, present = matrix_rows(batch.column(1))
            if not len(x):
                continue
            y = batch.column(0).to_numpy()[present]
            z = x @ w.T + b
            z = np.exp(z - z.max(axis=1, keepdims=True))
            share = z / z.sum(axis=1, keepdims=True)
            share[np.arange(len(y)), y] -= 1
            total[0] += len(y)
            total[1 : 1 + k] += np.bincount(y, minlength=k)
            total[1 + k :] += np.concatenate((share.sum(axis=0)[:, None], share.T @ x), axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["part"])

    return rows.mapInArrow(run, "part array<double>")


def _summed(parts: DataFrame) -> DataFrame:
    """The sum of all parts, in two levels: no task adds up more than the square root of them."""
    number = F.spark_partition_id()
    vectors = parts.select(array_to_vector("part").alias("v"), number.alias("n"))
    groups = F.floor(F.sqrt(F.col("n") + 1.0)).alias("g")
    middle = vectors.groupBy(groups).agg(Summarizer.sum(F.col("v")).alias("v"))
    return middle.agg(Summarizer.sum(F.col("v")).alias("v")).select(vector_to_array("v").alias("total"))


def gradient_norm(
    df: DataFrame, model: PipelineModel, vec: str = "embedding", label: str = "label", reg: float = 1e-4
) -> DataFrame:
    """One row: ``rows``, ``classes`` and ``norm``, the largest part of the loss gradient of a logistic model.

    At the optimum the gradient is zero: with class shares p, the mean of
    ``(p - y) x + reg w``, and of ``p - y`` for the intercepts. Each task sums its rows as one
    matrix product and hands on one row; a vector is never copied per class.
    """
    fitted = model.stages[-1]
    w, b = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    k, d = w.shape
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), F.col(vec).cast("array<double>").alias("x"))
    n = F.col("total")[0]
    # The decay of each weight, none for an intercept; k * (d + 1) numbers, as many as the model has.
    decay = F.split(F.lit(",".join(map(repr, np.concatenate((np.zeros((k, 1)), reg * w), axis=1).ravel().tolist()))), ",").cast("array<double>")
    gradient = F.slice("total", 2 + k, k * (d + 1))
    parts = F.zip_with(gradient, decay, lambda g, r: F.abs(g / n + r))
    return _summed(_gradient_parts(rows, w, b)).select(
        n.cast("long").alias("rows"), F.size(F.filter(F.slice("total", 2, k), lambda c: c > 0)).cast("long").alias("classes"),
        F.array_max(parts).alias("norm"),
    )


def cross_entropy_of(df: DataFrame, model: PipelineModel, vec: str = "embedding", label: str = "label") -> DataFrame:
    """One row: the mean loss of a fitted classifier over labelled rows."""
    scored = model.transform(_vectors(df.where(F.col(label).isNotNull()), vec))
    own = F.get(vector_to_array("probability"), F.col(label).cast("int"))
    return scored.agg(F.avg(-F.log(F.greatest(own, F.lit(1e-300)))).alias("loss"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved classifier; an unknown path raises."""
    return PipelineModel.load(path)
