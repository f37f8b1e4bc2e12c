"""Batch scoring with linear class scores, and checks on its output."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import dataset
from pyarrow.fs import FileSystem, FileType
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.rows import inline_rows
from ridgeline.functions.vectors import (
    argmax,
    confidence,
    fuse_attention,
    fuse_concat,
    fuse_weighted,
    head_scores,
    matrix_rows,
)
from ridgeline.operators.classifier import load_model, model_scores, save_model
from ridgeline.runtime import materialize, scratch_path

# Classes per block: with vectors of 1024 doubles a block is 32 MB, which is what
# a task holds of a model.
BLOCK_CLASSES = 4096
# Bytes of vectors a task gathers before it goes through the blocks of a stored model, and
# rows that meet a block in one product.
ROW_BLOCK_BYTES = 64 << 20
_PRODUCT_ROWS = 1024


@dataclass(frozen=True)
class ScoreBlock:
    """Weights of some classes: ``x @ w.T + b`` scores ``labels``, ascending."""

    labels: np.ndarray
    w: np.ndarray
    b: np.ndarray


@dataclass(frozen=True)
class LinearScorer:
    """A linear head over any number of classes, as blocks of bounded size."""

    blocks: tuple[ScoreBlock, ...]
    # Nothing is read for a batch, so none waits for another.
    gather_bytes = 0

    def each(self) -> Iterator[ScoreBlock]:
        return iter(self.blocks)


@dataclass(frozen=True)
class StoredScorer:
    """The same with its blocks in a folder that every task can read.

    The driver holds no class. A task gathers rows to a block of ``ROW_BLOCK_BYTES`` and reads
    one block of classes at a time for all of them, in label order; a model of one block is
    read once per process.
    """

    path: str
    blocks: int

    @property
    def gather_bytes(self) -> int:
        return ROW_BLOCK_BYTES if self.blocks > 1 else 0

    def each(self) -> Iterator[ScoreBlock]:
        if self.blocks == 1:
            yield _only_block(self.path)
        else:
            # A range that no label fell into has no folder.
            yield from filter(None, (_read_block(self.path, i) for i in range(self.blocks)))


def _read_block(path: str, number: int) -> ScoreBlock | None:
    store, root = FileSystem.from_uri(path)
    if store.get_file_info(f"{root}/block={number}").type == FileType.NotFound:
        return None
    table = dataset.dataset(f"{root}/block={number}", filesystem=store, format="parquet").to_table(columns=["label", "centroid"])
    order = np.argsort(table["label"].to_numpy(), kind="stable")
    w = np.asarray(table["centroid"].combine_chunks().flatten(), np.float64).reshape(len(order), -1)[order]
    return ScoreBlock(table["label"].to_numpy()[order], w, -(w**2).sum(axis=1) / 2)


@lru_cache(maxsize=2)
def _only_block(path: str) -> ScoreBlock:
    return _read_block(path, 0)


def linear_scorer(
    weights: np.ndarray, bias: np.ndarray, labels: Sequence[int] | None = None,
    block_classes: int = BLOCK_CLASSES,
) -> LinearScorer:
    w, b = np.asarray(weights, dtype=np.float64), np.asarray(bias, dtype=np.float64)
    names = np.arange(len(w)) if labels is None else np.asarray(labels)
    cuts = [slice(i, i + block_classes) for i in range(0, len(w), block_classes)]
    return LinearScorer(tuple(ScoreBlock(names[c], w[c], b[c]) for c in cuts))


def centroid_fit(df: DataFrame, vec: str, label: str = "label") -> DataFrame:
    """Mean vector of each class, combined per task before the shuffle."""
    rows = df.select(F.col(label).alias("label"), array_to_vector(F.col(vec)).alias("v"))
    return rows.groupBy("label").agg(
        Summarizer.mean(F.col("v")).alias("m"), F.count("*").alias("n")
    ).select("label", vector_to_array("m").alias("centroid"), "n")


def centroid_scorer(centroids: DataFrame, block_classes: int = BLOCK_CLASSES, path: str | None = None) -> StoredScorer:
    """Nearest centroid as a linear head: ``x . c - |c|^2 / 2`` is greatest for the nearest.

    Classes are written in blocks of some ``block_classes``, as ranges of their labels, one
    road for a model of any size and for labels however far apart. Models are kept at
    ``path`` (a new folder); without it they lie in the scratch folder and last as long.
    """
    spark = centroids.sparkSession
    table = materialize(centroids.select(F.col("label").cast("long"), "centroid").where("label is not null"), "classes")
    classes = table.count()
    if not classes:
        raise ValueError("no centroids to score with")
    blocks = -(-classes // block_classes)
    path = path or scratch_path(spark, "centroids")
    dealt = table.repartitionByRange(blocks, "label") if blocks > 1 else table.coalesce(1)
    dealt.withColumn("block", F.spark_partition_id()).write.partitionBy("block").parquet(path)
    return load_scorer(spark, path) if blocks > 1 else StoredScorer(path, 1)


def load_scorer(spark: SparkSession, path: str) -> StoredScorer:
    """The scorer that :func:`centroid_scorer` wrote there."""
    blocks = spark.read.parquet(path).select(F.max("block")).first()[0]
    if blocks is None:
        raise ValueError(f"no centroids in {path}")
    return StoredScorer(path, blocks + 1)


def best_classes(batches: Iterator[pa.Array], scorer: LinearScorer | StoredScorer) -> Iterator[pa.Array]:
    """First label of the best score and its softmax share for each vector: a blocked matrix product.

    Row blocks meet class blocks one after the other, so a class block is read once for
    each row block. What a class block leaves behind is merged exactly: the better of two bests (the
    earlier, smaller label on ties) and the sum of both masses, relative to it.
    """

    def scored(held: list[pa.Array]) -> pa.Array:
        vectors = pa.concat_arrays(held) if len(held) > 1 else held[0]
        x, present = matrix_rows(vectors)
        label, share = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
        if len(x):
            top, at, mass = np.full(len(x), -np.inf), np.zeros(len(x), np.int64), np.zeros(len(x))
            for block in scorer.each():
                for i in range(0, len(x), _PRODUCT_ROWS):
                    rows = slice(i, i + _PRODUCT_ROWS)
                    z = x[rows] @ block.w.T + block.b
                    best = z.argmax(axis=1)
                    high = z[np.arange(len(z)), best]
                    peak = np.maximum(top[rows], high)
                    at[rows] = np.where(high > top[rows], block.labels[best], at[rows])
                    mass[rows] = mass[rows] * np.exp(top[rows] - peak) + np.exp(z - peak[:, None]).sum(axis=1)
                    top[rows] = peak
            label[present], share[present] = at, 1.0 / mass
        return pa.StructArray.from_arrays(
            [pa.array(label), pa.array(share)], names=["label", "confidence"], mask=pa.array(~present),
        )

    held, size = [], 0
    for vectors in batches:
        held.append(vectors)
        size += vectors.nbytes
        if size >= scorer.gather_bytes:
            yield scored(held)
            held, size = [], 0
    if held:
        yield scored(held)


def _best_of(scorer: LinearScorer | StoredScorer, vec: Column) -> Column:
    @F.arrow_udf("struct<label:bigint,confidence:double>")
    def op(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return best_classes(batches, scorer)

    return op(vec)


def score(df: DataFrame, scorer: LinearScorer | StoredScorer, vec: str, label_type: str = "int") -> DataFrame:
    """Adds ``prediction`` and ``confidence`` in one pass; no row is shuffled.

    Ties go to the smallest label. ``label_type`` is that of the labels the model was fitted on.
    """
    return df.withColumn("_best", _best_of(scorer, F.col(vec))).select(
        *df.columns, F.col("_best.label").cast(label_type).alias("prediction"), F.col("_best.confidence").alias("confidence")
    )


def score_head(df: DataFrame, vec: str, params: dict) -> DataFrame:
    """The same from a trained head (:func:`head_scores`): first best logit and its softmax share."""
    z = F.col("_z")
    return df.withColumn("_z", head_scores(F.col(vec), params)).select(
        *df.columns, argmax(z).alias("prediction"), confidence(z).alias("confidence")
    )


Model = LinearScorer | StoredScorer | PipelineModel | dict

# How the folder of a stored model says what lies in it.
_HEAD, _CLASSIFIER = "head", "classifier"


def store_model(spark: SparkSession, model: Model, folder: str) -> str:
    """Keeps a model in a new place under ``folder``, and tells where; :func:`load_stored` reads it there.

    Centroids were written when they were fitted: they stay where they are. The
    parameters of a head become one JSON row.
    """
    if isinstance(model, StoredScorer):
        return model.path
    kind = _HEAD if isinstance(model, dict) else _CLASSIFIER
    path = f"{folder.rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    if isinstance(model, PipelineModel):
        save_model(model, path)
    elif isinstance(model, dict):
        plain = {k: np.asarray(v).tolist() for k, v in model.items()}
        spark.createDataFrame([(json.dumps(plain),)], "value string").coalesce(1).write.text(path)
    else:
        raise ValueError("a linear scorer in memory is stored as its centroids")
    return path


def load_stored(spark: SparkSession, path: str) -> Model:
    """The model that :func:`store_model` or :func:`centroid_scorer` left at ``path``."""
    kind = path.rstrip("/").rsplit("/", 1)[-1].split("-")[0]
    if kind == _CLASSIFIER:
        return load_model(path)
    if kind == _HEAD:
        return {k: np.asarray(v) for k, v in json.loads(spark.read.text(path, wholetext=True).first().value).items()}
    return load_scorer(spark, path)


def scored_by(df: DataFrame, model: Model, vec: str) -> DataFrame:
    """``prediction`` and ``confidence`` of any model: centroids, a linear scorer, head parameters, or a fitted classifier."""
    if isinstance(model, (LinearScorer, StoredScorer)):
        return score(df, model, vec)
    if isinstance(model, dict):
        return score_head(df, vec, model)
    return model_scores(df, model, vec)


def score_table(
    df: DataFrame, model: Model, vec: str = "embedding",
    labels: DataFrame | None = None, with_embeddings: bool = False, keep: Sequence[str] = (),
) -> DataFrame:
    """The prediction table: subject, prediction, label, confidence, correct; and the columns to ``keep``.

    ``labels`` (subject_id, label) is the dictionary of training; without it the
    rows bring their own ``label``. A subject the dictionary lacks has a NULL label.
    """
    known = df if labels is None else df.drop("label").join(labels, "subject_id", "left")
    scored = scored_by(known, model, vec)
    return scored.select(
        "subject_id", "prediction", F.col("label").cast("int").alias("label"), "confidence",
        (F.col("prediction") == F.col("label")).alias("correct"),
        *([F.col(vec).alias("embedding")] if with_embeddings else []),
        *keep,
    )


def extract_embeddings(
    df: DataFrame, method: str, params: dict | None = None, a: str = "iris", b: str = "fingerprint"
) -> DataFrame:
    """Adds ``fused``: both embeddings by ``concat``, ``weighted_sum`` or ``attention``."""
    x, y = F.col(a), F.col(b)
    if method == "concat":
        fused = fuse_concat(x, y)
    elif method == "weighted_sum":
        fused = fuse_weighted(x, y, (params or {}).get("weights", (0.5, 0.5)))
    elif method == "attention":
        if not params:
            raise ValueError("attention needs its parameters")
        fused = fuse_attention(x, y, params)
    else:
        raise ValueError(f"unknown fusion method: {method}")
    return df.withColumn("fused", fused)


def validate_predictions(df: DataFrame, labels: DataFrame, key: str = "subject_id") -> DataFrame:
    """Violations per rule: nulls, confidence range, unknown label, repeated key.

    The predictions are read once: each row is counted under its key and under its prediction,
    combined before the one shuffle; what is left is a row for each key and class.
    """
    nulls = F.greatest(*[F.col(c).isNull().cast("long") for c in (key, "prediction", "confidence")])
    outside = F.coalesce((~F.col("confidence").between(0.0, 1.0)).cast("long"), F.lit(0))
    zero = F.lit(0).cast("long")
    counted = df.select(inline_rows(
        ["kind", "value", "nulls", "outside"],
        [F.lit("key"), F.col(key).cast("string"), nulls, outside], [F.lit("label"), F.col("prediction").cast("string"), zero, zero],
    )).groupBy("kind", "value").agg(F.count("*").alias("n"), F.sum("nulls").alias("nulls"), F.sum("outside").alias("outside"))
    known = labels.where("label is not null").select(F.lit("label").alias("kind"), F.col("label").cast("string").alias("value")).distinct()
    met = counted.join(known.withColumn("known", F.lit(True)), ["kind", "value"], "left")
    named = F.col("value").isNotNull()
    totals = {
        "null_value": F.col("nulls"), "confidence_range": F.col("outside"),
        "unknown_label": F.when((F.col("kind") == "label") & named & F.col("known").isNull(), F.col("n")),
        "duplicate_key": F.when((F.col("kind") == "key") & named, F.col("n") - 1),
    }
    flat = met.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(rule) for rule, v in totals.items()])
    return flat.select(inline_rows(["rule", "violations"], *[[F.lit(rule), F.col(rule)] for rule in totals]))
