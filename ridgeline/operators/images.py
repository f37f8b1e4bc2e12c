"""Decoded images to normalised feature arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.bitmaps import decode_bitmap
from ridgeline.functions.pixels import gray_from_bgr

DEFAULT_SIZE = (128, 128)

Transform = Callable[[np.ndarray], np.ndarray]

# 8-bit resampling works on integer weights with this many fraction bits.
_PRECISION = 22

# Feature rows per Arrow batch handed back: 16 MB at the default size.
_ROWS_OUT = 256


def _taps(source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Per target pixel the source pixels it reads and their whole-number weights.

    A triangle filter. Downscaling widens it by the scale, so every source pixel
    counts. Both arrays are [taps, target]; unused taps weigh 0.
    """
    scale = source / target
    reach = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    low = np.maximum((centre - reach + 0.5).astype(int), 0)
    high = np.minimum((centre + reach + 0.5).astype(int), source)
    at = low + np.arange((high - low).max())[:, None]
    tri = np.maximum(1.0 - np.abs((at + 0.5 - centre) / reach), 0.0)
    tri = np.where(at < high, tri, 0.0)
    weight = np.floor(tri / tri.sum(axis=0) * (1 << _PRECISION) + 0.5)
    return np.minimum(at, source - 1), weight.astype(np.int32)


def _rescale(pixels: np.ndarray, target: int) -> np.ndarray:
    """Scales the rows of ``[source, other]``; sums of 30 bits fit int32."""
    at, weight = _taps(len(pixels), target)
    total = np.full((target, pixels.shape[1]), 1 << (_PRECISION - 1), dtype=np.int32)
    for source, w in zip(at, weight):
        total += pixels[source] * w[:, None]
    return np.clip(total >> _PRECISION, 0, 255)


def resize_bilinear(gray: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """``[h, w]`` 8-bit gray to ``size`` = (height, width).

    Across first, then down, rounding to 8 bits after each.
    """
    out = gray.astype(np.int32)
    if gray.shape[1] != size[1]:
        out = _rescale(np.ascontiguousarray(out.T), size[1]).T
    if gray.shape[0] != size[0]:
        out = _rescale(np.ascontiguousarray(out), size[0])
    return out.astype(np.uint8)


def default_transform(size: tuple[int, int], normalize: bool) -> Transform:
    """Resize and scale one gray image to float32."""

    def apply(gray: np.ndarray) -> np.ndarray:
        small = resize_bilinear(gray, size).astype(np.float32)
        return small / np.float32(127.5) - np.float32(1.0) if normalize else small / np.float32(255.0)

    return apply


def _image_gray(row: dict) -> np.ndarray:
    """Gray pixels of a Spark image struct; height -1 marks one that did not decode."""
    h, w, c = row["height"], row["width"], row["nChannels"]
    return gray_from_bgr(np.frombuffer(row["data"], dtype=np.uint8).reshape(h, w, c))


def _features(rows: Iterable, gray: Callable, transform: Transform) -> pa.Array:
    """One float32 list per row, None where decoding or the transform failed."""
    lengths, parts = [], []
    for row in rows:
        try:
            if row is None:
                raise ValueError("no image")
            part = np.asarray(transform(gray(row)), dtype=np.float32).ravel()
        except Exception:  # noqa: BLE001 - a bad image is counted, not fatal
            lengths.append(-1)
            continue
        lengths.append(part.size)
        parts.append(part)
    sizes = np.array(lengths, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.float32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array(sizes < 0))


def preprocess_images(
    images: DataFrame,
    size: tuple[int, int] = DEFAULT_SIZE,
    normalize: bool = True,
    transform: Transform | None = None,
) -> DataFrame:
    """Decode, gray, resize and normalise each image once, before any pairing.

    Input: ``content`` (bitmap bytes) or ``image`` (Spark image struct, for any
    format Spark decodes) and other columns, which are kept. Adds ``features``
    (row-major array<float>), ``height``, ``width`` and ``ok``; a row that failed
    stays with ``ok`` false so it can be counted.

    ``transform`` replaces the default one; it gets one 8-bit gray image [h, w]
    and may return any shape, so the size columns are NULL then.
    """
    encoded = "content" in images.columns
    source = "content" if encoded else "image"
    kept = [c for c in images.columns if c != source]
    apply = transform or default_transform(size, normalize)
    schema = T.StructType([*[images.schema[c] for c in kept], T.StructField("features", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Features can be larger than files: answer in small batches.
            for start in range(0, batch.num_rows, _ROWS_OUT):
                part = batch.slice(start, _ROWS_OUT)
                rows = part.column(source)
                if encoded:
                    features = _features((r.as_buffer() if r.is_valid else None for r in rows), decode_bitmap, apply)
                else:
                    features = _features((r.as_py() for r in rows), _image_gray, apply)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], features], names=schema.names)

    known = transform is None
    return images.mapInArrow(run, schema).select(
        *kept,
        "features",
        F.lit(size[0] if known else None).cast("int").alias("height"),
        F.lit(size[1] if known else None).cast("int").alias("width"),
        F.col("features").isNotNull().alias("ok"),
    )


def preprocess_stats(features: DataFrame, seconds: float = 0.0) -> DataFrame:
    """Samples in all, processed and failed, and the rate (0 without a time).

    A sample is a pair and fails if either image did. Per subject that is
    ``good iris * good fingerprint`` of ``iris * fingerprint``, so the counts
    need no pairs.
    """
    def files(modality: str, only_ok: bool) -> Column:
        wanted = F.col("modality") == modality
        return F.count_if(wanted & F.col("ok") if only_ok else wanted)

    per_subject = features.groupBy("subject_id").agg(
        (files("iris", False) * files("fingerprint", False)).alias("total"),
        (files("iris", True) * files("fingerprint", True)).alias("processed"),
    )
    took = F.lit(float(seconds))
    return per_subject.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_samples"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed_samples"),
    ).select(
        "total_samples",
        "processed_samples",
        (F.col("total_samples") - F.col("processed_samples")).alias("failed_samples"),
        took.alias("processing_time"),
        F.when(took > 0, F.try_divide(F.col("processed_samples"), took)).otherwise(0.0).alias("throughput"),
    )
