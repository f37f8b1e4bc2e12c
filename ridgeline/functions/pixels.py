"""Pixel arithmetic on arrays and the byte form of feature tensors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Integer luma weights for R, G, B in 1/65536, with rounding.
LUMA_R, LUMA_G, LUMA_B, LUMA_ROUND, LUMA_SHIFT = 19595, 38470, 7471, 32768, 16


def gray_from_bgr(pixels: np.ndarray, method: str = "luma") -> np.ndarray:
    """``[..., channels]`` in Spark's B, G, R(, A) order to ``[...]`` gray."""
    if method == "mean":
        return pixels.mean(axis=-1)
    if pixels.shape[-1] == 1:
        return pixels[..., 0]
    # Sums stay below 2**24, so float32 holds them exactly.
    weights = np.array([LUMA_B, LUMA_G, LUMA_R], dtype=np.float32)
    total = pixels[..., :3].astype(np.float32) @ weights + np.float32(LUMA_ROUND)
    return (total * np.float32(0.5**LUMA_SHIFT)).astype(np.uint8)


def to_gray(data: Column, channels: Column, method: str = "luma") -> Column:
    """Interleaved pixel bytes (Spark's image layout) to an array of gray values.

    ``luma`` is the 8-bit weighted form, ``mean`` the plain channel mean.
    """
    if method not in ("luma", "mean"):
        raise ValueError(f"unknown method: {method}")

    @F.arrow_udf("array<double>")
    def op(blobs: pa.Array, counts: pa.Array) -> pa.Array:
        known = pc.and_(blobs.is_valid(), counts.is_valid()).to_numpy(zero_copy_only=False)
        channels = np.where(known, counts.fill_null(0).to_numpy(zero_copy_only=False), 0)
        sizes = np.where(known, pc.binary_length(blobs).fill_null(0).to_numpy(zero_copy_only=False), 0)
        lengths = sizes // np.maximum(channels, 1)
        limits = np.concatenate(([0], np.cumsum(lengths)))
        gray = np.empty(limits[-1], np.float64)
        # Images of one kind are one matrix.
        for n in np.unique(channels[known]).tolist():
            at = np.flatnonzero(known & (channels == n))
            pixels = np.frombuffer(b"".join(blobs.take(pa.array(at)).to_pylist()), np.uint8).reshape(-1, n)
            begin = np.repeat(limits[at] - np.concatenate(([0], np.cumsum(lengths[at])[:-1])), lengths[at])
            gray[begin + np.arange(len(begin))] = gray_from_bgr(pixels, method)
        return pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(gray), mask=pa.array(~known))

    return op(data, channels)


def normalize_pixels(
    pixels: Column, mode: str = "signed", mean: float = 0.5, std: float = 0.5
) -> Column:
    """Gray values 0..255 to model input.

    ``signed``   ``x / 127.5 - 1``, in [-1, 1]
    ``unit``     ``x / 255``, in [0, 1]
    ``standard`` ``(x / 255 - mean) / std``; the same as ``signed`` at 0.5, 0.5
    """
    scale = {
        "signed": lambda x: x / 127.5 - 1.0,
        "unit": lambda x: x / 255.0,
        "standard": lambda x: (x / 255.0 - mean) / std,
    }
    if mode not in scale:
        raise ValueError(f"unknown mode: {mode}")
    return F.transform(pixels, scale[mode])


def tensor_encode(values: Column) -> Column:
    """array<float> to row-major little-endian float32 bytes."""

    @F.arrow_udf("binary")
    def op(rows: pa.Array) -> pa.Array:
        # The values already lie back to back: their limits in bytes make the rows.
        limits = rows.offsets.to_numpy()
        flat = pc.fill_null(rows.values, float("nan")).to_numpy(zero_copy_only=False).astype("<f4", copy=False)
        data = flat[limits[0] : limits[-1]].tobytes()
        ends = pa.py_buffer(((limits - limits[0]) * 4).astype(np.int32))
        out = pa.Array.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(data)])
        return pc.if_else(rows.is_valid(), out, pa.scalar(None, pa.binary()))

    return op(values.cast("array<float>"))


def tensor_decode(blob: Column) -> Column:
    """The inverse of :func:`tensor_encode`; bytes that are no whole floats are an error."""

    @F.arrow_udf("array<float>")
    def op(rows: pa.Array) -> pa.Array:
        full = rows.fill_null(b"")
        limits = np.frombuffer(full.buffers()[1], np.int32)[full.offset : full.offset + len(full) + 1]
        if (np.diff(limits) % 4).any():
            raise ValueError("tensor bytes are no whole floats")
        data = np.frombuffer(full.buffers()[2] or b"", np.uint8)[limits[0] : limits[-1]]
        flat = pa.array(data.copy().view("<f4"))
        return pa.ListArray.from_arrays(pa.array((limits - limits[0]) // 4), flat, mask=rows.is_null())

    return op(blob)
