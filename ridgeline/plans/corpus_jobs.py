"""Jobs that start at an image corpus: drift features, monitoring, predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.bitmaps import raw_pixels
from ridgeline.operators.images import DEFAULT_SIZE, preprocess_images
from ridgeline.operators.pairing import first_match_pair, pair_samples
from ridgeline.operators.scoring import Model, extract_embeddings, score_table
from ridgeline.operators.stats import STATISTICS, pair_features
from ridgeline.plans.monitoring import run_monitoring
from ridgeline.runtime import materialize
from ridgeline.sources.corpus import read_manifest, read_tree, split_modalities, with_subject
from ridgeline.sources.tables import export_predictions


def _images(spark: SparkSession, corpus: str | DataFrame) -> DataFrame:
    """Files with their bytes and subject: of a folder, or of a manifest table with a ``path``."""
    return with_subject(read_tree(spark, corpus) if isinstance(corpus, str) else read_manifest(corpus))


def corpus_features(spark: SparkSession, corpus: str | DataFrame) -> DataFrame:
    """Folder to drift features: nine statistics of each iris image and of its subject's first fingerprint.

    Raw gray pixels, neither resized nor normalised. The modality is chosen before
    anything is decoded, so each image is decoded once; those that do not decode drop out.
    """
    iris, finger = (
        side.select("subject_id", "path", raw_pixels("content").alias("pixels"))
        for side in split_modalities(_images(spark, corpus))
    )
    # Left out only now: a condition on the pixels themselves would decode them for its own sake too.
    return pair_features(iris, finger).where("iris_mean is not null")


def monitor_corpus(
    spark: SparkSession, corpus: str | DataFrame, reference: DataFrame,
    baseline: DataFrame | None = None, current: DataFrame | None = None, **rules,
) -> DataFrame:
    """The monitoring report of a corpus against stored reference features.

    Metrics of both sides are as in :func:`run_monitoring`, as are further rules.
    """
    names = [f"{side}_{s}" for side in ("iris", "fingerprint") for s in STATISTICS]
    present = corpus_features(spark, corpus)
    return run_monitoring(reference.select(*names), present.select(*names), baseline, current, **rules)


def score_corpus(
    spark: SparkSession, corpus: str | DataFrame, model: Model, labels: DataFrame,
    embed: Callable[[DataFrame], DataFrame] | None = None, fusion: str = "concat", params: dict | None = None,
    size: tuple[int, int] = DEFAULT_SIZE, normalize: bool = True, first_match: bool = True,
    export: str | None = None, fmt: str = "parquet", mode: str = "errorifexists", keep: Sequence[str] = (),
) -> DataFrame:
    """Batch inference: folder to prediction table, optionally exported.

    Every image is decoded once into features, written, and paired: each iris with its
    subject's first fingerprint, or with all. ``embed`` turns ``iris_features`` and
    ``fingerprint_features`` into ``iris`` and ``fingerprint``; without it the features are
    the embeddings. Both are fused, scored by any model, and labelled by the stored
    dictionary of training. ``keep`` adds ``iris_path`` or ``fingerprint_path``.
    """
    features = preprocess_images(_images(spark, corpus), size, normalize)
    kept = materialize(features.where("ok").select("subject_id", "modality", "path", "features"), "image-features")
    iris, finger = split_modalities(kept)
    if first_match:
        chosen = first_match_pair(iris.select("subject_id", "path"), finger.select("subject_id", "path"))
        rows = chosen.join(
            iris.select(F.col("path").alias("iris_path"), F.col("features").alias("iris_features")), "iris_path"
        ).join(
            finger.select(F.col("path").alias("fingerprint_path"), F.col("features").alias("fingerprint_features")), "fingerprint_path"
        )
    else:
        rows = pair_samples(iris, finger, ("features", "path"))
    embedded = embed(rows) if embed else rows.withColumnsRenamed({"iris_features": "iris", "fingerprint_features": "fingerprint"})
    fused = extract_embeddings(embedded, fusion, params)
    table = score_table(fused, model, "fused", labels, keep=keep)
    if export is not None:
        table = materialize(table, "predictions")
        export_predictions(table, export, fmt, mode)
    return table
