"""Decoded images back to bitmap files, to have a corpus to scan."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def bitmap_bytes(gray: np.ndarray) -> bytes:
    """A 24-bit uncompressed bitmap of a [h, w] 8-bit image: rows bottom-up, padded to 4 bytes."""
    h, w = gray.shape
    stride = (w * 3 + 3) // 4 * 4
    body = np.zeros((h, stride), dtype=np.uint8)
    body[:, : w * 3] = np.repeat(gray[::-1], 3, axis=1)
    header = struct.pack("<2sIHHI", b"BM", 54 + body.size, 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, body.size, 2835, 2835, 0, 0)
    return header + info + body.tobytes()


def write_bitmaps(images: DataFrame, root: str) -> int:
    """Writes one file per row (path, one-channel image) under ``root``; returns the count.

    Each task writes its own rows, whole files under their final names, so a
    repeated task writes the same bytes again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            made: set[str] = set()
            for row in batch.to_pylist():
                target = f"{base}/{row['path']}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                image = row["image"]
                gray = np.frombuffer(image["data"], dtype=np.uint8).reshape(image["height"], image["width"])
                with system.open_output_stream(target) as out:
                    out.write(bitmap_bytes(gray))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return images.mapInArrow(write, "n long").agg({"n": "sum"}).first()[0] or 0
