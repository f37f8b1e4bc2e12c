"""Bitmap files for tests."""

from __future__ import annotations

import struct
from pathlib import Path

import numpy as np

from ridgeline.workloads.bitmaps import bitmap_bytes


def palette_bitmap(gray: np.ndarray) -> bytes:
    """An 8-bit bitmap with a gray palette."""
    h, w = gray.shape
    stride = (w + 3) // 4 * 4
    body = np.zeros((h, stride), np.uint8)
    body[:, :w] = gray[::-1]
    palette = b"".join(bytes([i, i, i, 0]) for i in range(256))
    start = 54 + len(palette)
    header = struct.pack("<2sIHHI", b"BM", start + body.size, 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8, 0, body.size, 2835, 2835, 256, 0)
    return header + info + palette + body.tobytes()


def put(root: Path, name: str, content: bytes) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


def flat(gray: int, h: int = 128, w: int = 128) -> bytes:
    return palette_bitmap(np.full((h, w), gray, np.uint8))


def small_corpus(root: Path, subjects: int, files: int = 1) -> Path:
    """Flat-gray images, ``files`` per subject and modality."""
    for s in range(subjects):
        for n in range(1, files + 1):
            put(root, f"iris/{s:03d}_L_{n:02d}.bmp", flat(50 + 40 * (s % 5)))
            put(root, f"fingerprint/{s:03d}_L_thumb_{n:02d}.BMP", flat(60 + 30 * (s % 5)))
    return root


__all__ = ["bitmap_bytes", "flat", "palette_bitmap", "put", "small_corpus"]
