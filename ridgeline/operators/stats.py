"""Nine statistics of an image, and the drift features of a pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.skew import lookup
from ridgeline.runtime import materialize

STATISTICS = ("mean", "std", "min", "max", "median", "q25", "q75", "skewness", "kurtosis")
_TYPE = pa.struct([(name, pa.float64()) for name in STATISTICS])


def _nine(x: np.ndarray) -> np.ndarray:
    """[n, pixels] to [n, 9]; NaN where a constant image has no shape moments."""
    mean = x.mean(axis=1)
    centred = x - mean[:, None]
    m2 = (centred**2).mean(axis=1)
    q25, median, q75 = np.percentile(x, [25, 50, 75], axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        m2_safe = np.where(m2 > 0, m2, np.nan)
        skewness = (centred**3).mean(axis=1) / m2_safe**1.5
        kurtosis = (centred**4).mean(axis=1) / m2_safe**2 - 3.0
    return np.stack(
        [mean, np.sqrt(m2), x.min(axis=1), x.max(axis=1), median, q25, q75, skewness, kurtosis],
        axis=1,
    )


def pixel_stats(pixels: Column) -> Column:
    """Struct of the nine statistics of an array of pixels.

    Population deviation, linearly interpolated quartiles, biased skewness and
    excess kurtosis (NULL for a constant image). An image is one row, so nothing
    is exploded or shuffled; a batch is computed per image length.
    """

    @F.arrow_udf("struct<" + ",".join(f"{name}:double" for name in STATISTICS) + ">")
    def op(rows: pa.Array) -> pa.Array:
        lengths = np.asarray(rows.value_lengths().fill_null(0))
        out = np.full((len(rows), len(STATISTICS)), np.nan)
        for n in np.unique(lengths[lengths > 0]):
            at = np.flatnonzero(lengths == n)
            flat = np.asarray(rows.take(pa.array(at)).flatten(), dtype=np.float64)
            out[at] = _nine(flat.reshape(len(at), n))
        columns = [pa.array(c, mask=np.isnan(c)) for c in out.T]
        return pa.StructArray.from_arrays(
            columns, fields=list(_TYPE), mask=pa.array(lengths == 0)
        )

    return op(pixels)


def image_stats(df: DataFrame, pixels: str, prefix: str = "") -> DataFrame:
    """The other columns of ``df`` with nine statistics in place of ``pixels``."""
    rest = [c for c in df.columns if c != pixels]
    return df.withColumn("_s", pixel_stats(F.col(pixels))).select(
        *rest, *[F.col(f"_s.{name}").alias(prefix + name) for name in STATISTICS]
    )


def pair_features(iris: DataFrame, fingerprint: DataFrame) -> DataFrame:
    """Statistics of each iris image and of the first fingerprint of its subject.

    Inputs: ``subject_id``, ``path``, ``pixels``. Statistics are taken per image
    before anything is joined or grouped, so pixels never shuffle; a fingerprint
    without pixels does not count. Statistics read twice are written first, so each
    image is worked on once.
    """
    left = materialize(image_stats(iris.select("subject_id", "path", "pixels"), "pixels", "iris_"), "image-stats")
    nine = fingerprint.select("subject_id", "path", pixel_stats(F.col("pixels")).alias("s"))
    first = nine.groupBy("subject_id").agg(F.min_by("s", F.when(F.col("s").isNotNull(), F.col("path"))).alias("s"))
    right = first.select(
        "subject_id", *[F.col(f"s.{name}").alias(f"fingerprint_{name}") for name in STATISTICS]
    )
    return lookup(left, right, "subject_id", ["path"])
