"""Bitmap bytes to gray pixels, without going through a color image."""

from __future__ import annotations

import struct

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.functions.pixels import gray_from_bgr

# Bits per pixel read here; all uncompressed.
DEPTHS = (1, 4, 8, 24, 32)


def decode_bitmap(content: memoryview | bytes) -> np.ndarray:
    """[h, w] 8-bit gray of an uncompressed bitmap; raises ValueError otherwise."""
    blob = memoryview(content)
    if len(blob) < 54 or bytes(blob[:2]) != b"BM":
        raise ValueError("not a bitmap")
    start, info, w, h, _, bits, packing = struct.unpack_from("<IIiiHHI", blob, 10)
    if bits not in DEPTHS or packing != 0 or w <= 0 or h == 0:
        raise ValueError(f"unsupported bitmap: {bits} bits, packing {packing}")
    rows, stride = abs(h), (w * bits + 31) // 32 * 4
    if len(blob) < start + rows * stride:
        raise ValueError("truncated bitmap")
    lines = np.frombuffer(blob, np.uint8, rows * stride, start).reshape(rows, stride)
    if h > 0:  # stored bottom-up
        lines = lines[::-1]
    if bits > 8:
        step = bits // 8
        return gray_from_bgr(lines[:, : w * step].reshape(rows, w, step)[..., :3])
    if bits < 8:
        lines = np.unpackbits(lines, axis=1).reshape(rows, -1, bits) @ (1 << np.arange(bits)[::-1])
    used = struct.unpack_from("<I", blob, 46)[0] or 1 << bits
    colors = np.frombuffer(blob, np.uint8, used * 4, 14 + info).reshape(used, 4)
    table = np.zeros(256, np.uint8)
    table[:used] = gray_from_bgr(colors[:, :3])
    return table[lines[:, :w]]


def raw_pixels(content: str, decode: Callable[[memoryview], np.ndarray] = decode_bitmap) -> Column:
    """The gray pixels of a file as ``array<double>``, row by row; NULL if it does not decode."""

    @F.arrow_udf("array<double>")
    def op(blobs: pa.Array) -> pa.Array:
        lengths, parts = [], []
        for blob in blobs:
            try:
                part = decode(blob.as_buffer() if blob.is_valid else b"").astype(np.float64).ravel()
            except ValueError:
                lengths.append(-1)
                continue
            lengths.append(part.size)
            parts.append(part)
        sizes = np.array(lengths, np.int64)
        limits = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0)))).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.empty(0)
        return pa.ListArray.from_arrays(pa.array(limits), pa.array(flat), mask=pa.array(sizes < 0))

    return op(F.col(content))
