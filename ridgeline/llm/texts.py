"""Texts inside a task: bounded slices of Arrow columns, words, and their hashes.

Everything here works on the UTF-8 bytes of many rows lying back to back, so
that one numpy call serves a megabyte of text, whatever the rows' lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Bytes and rows of text a task works on at a time; one longer row is taken alone.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 2000
# Rows of an Arrow batch: texts are long, and a batch lies in the JVM and in Python at once.
BATCH_ROWS = 1000

_U = np.uint64
# An odd multiplier and its inverse modulo 2**64, for hashes of byte ranges.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


class Texts:
    """A run of rows: bytes ``data``, row limits ``offsets``, and which rows are null."""

    def __init__(self, column: pa.Array):
        self.null = column.is_null().to_numpy(zero_copy_only=False)
        column = pc.fill_null(column, "") if self.null.any() else column
        _, limits, data = column.buffers()
        limits = np.frombuffer(limits, np.int32)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data or b"", np.uint8)
        self.data = whole[limits[0] : limits[-1]]
        self.offsets = limits.astype(np.int64) - int(limits[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def rows(self) -> Iterator[bytes]:
        raw, limits = self.data.tobytes(), self.offsets.tolist()
        for a, b in zip(limits, limits[1:]):
            yield raw[a:b]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges holding at most ``limit`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(ends, before + limit, "right"))))
        yield at, to
        at = to


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands texts to Python in batches of at most ``BATCH_ROWS`` rows from here on."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def map_texts(
    df: DataFrame, text: str, carry: Sequence[str], fields: str,
    start: Callable[[], Callable[[Texts, pa.StructArray], Sequence[pa.Array]]],
) -> DataFrame:
    """One row per row: the carried columns in a struct ``row``, then ``fields``.

    ``start`` runs once per task and returns the function applied to each slice.
    Carried columns stay in a struct, so they can have any names.
    """
    given = small_batches(df).select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([given.schema["row"], *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        work = start()
        for batch in batches:
            rows, column = batch.column(0), batch.column(1)
            for a, b in slices(column):
                part = rows.slice(a, b - a)
                made = work(Texts(column.slice(a, b - a)), part)
                yield pa.RecordBatch.from_arrays(
                    [part, *[m.cast(f.type) for m, f in zip(made, list(arrow)[1:])]], names=arrow.names
                )

    return given.mapInArrow(run, schema)


def byte_table(words: Callable[[int], bool]) -> np.ndarray:
    """For each byte whether it belongs to a word."""
    return np.array([words(b) for b in range(256)])


# Words as regex [^\x20\x09-\x0D]+ reads them.
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


def word_bounds(texts: Texts, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row limit how many words lie before it."""
    inside = is_word[texts.data]
    limits = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(inside))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # A row's limit parts words even where no separator stands.
    first[limits] = inside[limits]
    last[limits - 1] = inside[limits - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``; kept for the next slice up to a few megabytes."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1), base, _U)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def sums(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums that :func:`range_hash` reads."""
    out = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of the values from ``starts`` to ``ends``, the same wherever they stand."""
    inverse = pow(base, -1, 1 << 64)
    return mix((prefix[ends] - prefix[starts]) * powers(inverse, len(prefix))[starts])


def word_hashes(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(sums(texts.data.astype(_U) + _U(1), _BASE), starts, ends, _BASE)
