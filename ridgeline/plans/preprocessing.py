"""From an image corpus to a feature table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.images import DEFAULT_SIZE, preprocess_images, preprocess_stats
from ridgeline.operators.pairing import pair_samples
from ridgeline.runtime import scratch_path
from ridgeline.sources.corpus import read_corpus, split_modalities, with_subject
from ridgeline.sources.tables import read_features, write_features


def image_feature_job(
    spark: SparkSession, root: str, path: str | None = None,
    size: tuple[int, int] = DEFAULT_SIZE, normalize: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Decodes every image once and writes one feature row per image.

    Returns that table and the statistics of the run.
    """
    path = path or scratch_path(spark, "image-features")
    started = time.perf_counter()
    write_features(preprocess_images(with_subject(read_corpus(spark, root)), size, normalize), path)
    seconds = time.perf_counter() - started
    features = read_features(spark, path)
    return features, preprocess_stats(features.select("subject_id", "modality", "ok"), seconds)


def pair_table(features: DataFrame) -> DataFrame:
    """The feature table of all pairs, from one feature row per image.

    ``subject_id``, features and path of both images, height and width; a pair
    with a failed image drops out.
    """
    iris, finger = split_modalities(features.where("ok"))
    pairs = pair_samples(iris, finger, ("features", "path", "height", "width"))
    return pairs.select(
        "subject_id", "iris_features", "fingerprint_features", "iris_path", "fingerprint_path",
        F.col("iris_height").alias("height"), F.col("iris_width").alias("width"),
    )
