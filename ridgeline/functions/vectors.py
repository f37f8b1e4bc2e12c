"""Fusion of two embeddings, classifier heads and per-row prediction columns.

Elementwise work stays in Spark expressions. Matrix products go through Arrow
batches: weights travel once per task with the function, rows never shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds ``value`` once, so a lambda over an array need not recompute it."""
    return F.transform(F.array(value), body)[0]


def matrix_rows(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Non-null rows of a list array as one matrix, and the mask of those rows."""
    present = np.asarray(values.is_valid())
    kept = values.drop_null()
    if len(kept) == 0:
        return np.empty((0, 0)), present
    flat = np.asarray(kept.flatten(), dtype=np.float64)
    return flat.reshape(len(kept), -1), present


def list_rows(matrix: np.ndarray, present: np.ndarray, item: pa.DataType) -> pa.Array:
    """A matrix as list array, with NULL where ``present`` is false."""
    width = matrix.shape[1] if matrix.size else 0
    offsets = np.concatenate([[0], np.cumsum(np.where(present, width, 0))]).astype(np.int32)
    flat = pa.array(np.ascontiguousarray(matrix).ravel(), type=item)
    mask = pa.array(~present) if not present.all() else None
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=mask)


# ---------------------------------------------------------------- fusion

def fuse_concat(a: Column, b: Column) -> Column:
    """[D] and [D] to [2D]."""
    return F.concat(a, b)


def fusion_weights(raw: Sequence[float] = (0.5, 0.5)) -> tuple[float, float]:
    """Softmax of the two raw modality weights."""
    top = max(raw)
    e0, e1 = (math.exp(w - top) for w in raw)
    return e0 / (e0 + e1), e1 / (e0 + e1)


def fuse_weighted(a: Column, b: Column, weights: Sequence[float] = (0.5, 0.5)) -> Column:
    """Weighted sum of both embeddings; the weights pass through a softmax."""
    w0, w1 = fusion_weights(weights)
    return F.zip_with(a, b, lambda x, y: x * F.lit(w0) + y * F.lit(w1))


def _attention(a: np.ndarray, b: np.ndarray, params: dict[str, np.ndarray]) -> np.ndarray:
    hidden = np.tanh(np.hstack([a, b]) @ params["w1"].T + params["b1"])
    z = hidden @ params["w2"].T + params["b2"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _checked(params: dict) -> dict[str, np.ndarray]:
    return {name: np.asarray(values, dtype=np.float64) for name, values in params.items()}


def attention_weights(a: Column, b: Column, params: dict) -> Column:
    """The two attention weights of a row; they sum to 1.

    ``params``: ``w1`` [D, 2D], ``b1`` [D], ``w2`` [2, D], ``b2`` [2].
    """
    weights = _checked(params)

    @F.arrow_udf("array<double>")
    def op(left: pa.Array, right: pa.Array) -> pa.Array:
        x, present = matrix_rows(left)
        y, _ = matrix_rows(right)
        return list_rows(_attention(x, y, weights) if len(x) else x, present, pa.float64())

    return op(F.when(b.isNotNull(), a), F.when(a.isNotNull(), b))


def fuse_attention(a: Column, b: Column, params: dict) -> Column:
    """Sum of both embeddings under the weights of :func:`attention_weights`."""
    weights = _checked(params)

    @F.arrow_udf("array<double>")
    def op(left: pa.Array, right: pa.Array) -> pa.Array:
        x, present = matrix_rows(left)
        y, _ = matrix_rows(right)
        if len(x):
            w = _attention(x, y, weights)
            x = w[:, :1] * x + w[:, 1:] * y
        return list_rows(x, present, pa.float64())

    return op(F.when(b.isNotNull(), a), F.when(a.isNotNull(), b))


# ------------------------------------------------------------------ head

def head_scores(vector: Column, params: dict) -> Column:
    """Logits of a classifier head.

    ``w``/``b`` give the linear head; with ``w1``/``b1`` before them the head is
    Linear, ReLU, Linear. Dropout plays no part when scoring.
    """
    weights = _checked(params)

    @F.arrow_udf("array<double>")
    def op(vectors: pa.Array) -> pa.Array:
        x, present = matrix_rows(vectors)
        if len(x):
            if "w1" in weights:
                x = np.maximum(x @ weights["w1"].T + weights["b1"], 0.0)
            x = x @ weights["w"].T + weights["b"]
        return list_rows(x, present, pa.float64())

    return op(vector)


def argmax(z: Column) -> Column:
    """Index of the greatest score, the first one on ties."""
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def softmax(z: Column) -> Column:
    return let(
        F.array_max(z),
        lambda top: let(
            F.transform(z, lambda x: F.exp(x - top)),
            lambda e: let(_total(e), lambda s: F.transform(e, lambda x: x / s)),
        ),
    )


def confidence(z: Column) -> Column:
    """Greatest softmax probability, without building the distribution."""
    return let(
        F.array_max(z),
        lambda top: 1.0 / F.aggregate(z, F.lit(0.0), lambda s, x: s + F.exp(x - top)),
    )


def log_sum_exp(z: Column) -> Column:
    return let(
        F.array_max(z),
        lambda top: top + F.log(F.aggregate(z, F.lit(0.0), lambda s, x: s + F.exp(x - top))),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
