"""Repeated passages: a count-min prefilter, then exact grouping of what it lets through.

A window is 20 consecutive words of a document. Counting all windows needs a
shuffle row for each word of the corpus; nearly all are unique, so two scans keep
them at home:

1. Each task sketches its share; the sketches are added cell by cell. What is
   counted is a window's *anchor*, the smallest hash among its 10-word runs. Equal
   windows have equal anchors at as many places, so an anchor's count is never
   below that of its windows, and there are six times fewer anchors than windows.
   Collisions in the sketch only add. A cell counted twice or more is one bit.
2. Windows whose anchor is estimated at two or more are grouped exactly, by 128
   bits of hash; the smallest document owns the window. All others lose it.

No window that repeats is lost at any sketch size; a small sketch only lets more
windows through to the shuffle. The bits are broadcast: two rows of at most
``2 ** max_bits`` (a proven bound, 128 MB by default). Beyond some 10 GB of text
raise ``max_bits`` with the memory of the executors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.texts import Texts, map_texts, mix, range_hash, small_batches, sums, word_bounds, word_hashes

WINDOW = 20
MAX_BITS = 29
# Cells that are merged together, and sketched anchors a task holds before it sends them.
_SHARD_BITS = 20
_FLUSH = 1 << 21
_U = np.uint64
_FIRST, _SECOND = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
# Numbers of rows without an id: the last ones there are, by a hash of the text.
_NO_ID, _NO_ID_BITS = (1 << 63) - 1, 60


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each ``width`` consecutive values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


class Windows:
    """The windows of a slice of texts: places, hashes and anchors."""

    def __init__(self, texts: Texts, window: int):
        self.starts, self.ends, self.limits = word_bounds(texts)
        n, run = len(self.starts), max(1, window // 2)
        words = word_hashes(texts, self.starts, self.ends)
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.limits))
        count = max(0, n - window + 1)
        self.at = np.arange(count)
        inside = self.row[: count] == self.row[window - 1 : window - 1 + count]
        self._prefix = sums(words, _FIRST)
        self._words, self._window = words, window
        runs = np.arange(max(0, n - run + 1))
        grams = range_hash(self._prefix, runs, runs + run, _FIRST)
        span = window - run + 1
        anchor = _sliding(grams, span, np.minimum) if count else grams[:0]
        # A run is sketched if some window of its document has it as its smallest.
        known = np.where(inside, anchor, _U(0))
        padded = np.concatenate((np.zeros(span - 1, _U), known, np.zeros(span - 1, _U)))
        self.sketched = grams[grams == _sliding(padded, span, np.maximum)] if count else grams[:0]
        self.at, self.anchor = self.at[inside], anchor[inside]

    def hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        second = sums(mix(self._words + _U(_SECOND)), _SECOND)
        return (
            range_hash(self._prefix, at, at + self._window, _FIRST),
            range_hash(second, at, at + self._window, _SECOND),
        )


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of the sketch."""
    return [anchors >> _U(64 - bits), mix(anchors + _U(1)) >> _U(64 - bits)]


def _sketch(df: DataFrame, bits: int, window: int) -> list[np.ndarray]:
    """For each row of the sketch the bits of the cells counted at least twice."""
    shard_bits = min(bits, _SHARD_BITS)
    columns = pa.schema([("shard", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def partial(batches):
        from ridgeline.llm.texts import slices

        held, size = [], 0

        def send():
            for row, cells in enumerate(_cells(np.concatenate(held), bits)):
                cells, counts = np.unique(cells, return_counts=True)
                shard = (cells >> _U(shard_bits)).astype(np.int64)
                low, edge = (cells & _U((1 << shard_bits) - 1)).astype("<u4"), np.flatnonzero(np.diff(shard)) + 1
                out = [[], [], []]
                for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(cells)]):
                    more = counts[a:b] > 1
                    out[0].append((row << (bits - shard_bits)) + int(shard[a]))
                    out[1].append(_packed(low[a:b][~more]))
                    out[2].append(_packed(low[a:b][more]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, columns)], schema=columns)

        for batch in batches:
            for a, b in slices(batch.column(0)):
                new = Windows(Texts(batch.column(0).slice(a, b - a)), window).sketched
                held.append(new)
                size += len(new)
                if size >= _FLUSH:
                    yield from send()
                    held, size = [], 0
        if size:
            yield from send()

    def merged(batches):
        shard, counts = None, None

        def done():
            bit = np.packbits(counts >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([bit], pa.binary())], names=["shard", "bits"])

        for batch in batches:
            for s, once, twice in zip(*[c.to_pylist() for c in batch.columns]):
                if s != shard:
                    if shard is not None:
                        yield done()
                    shard, counts = s, np.zeros(1 << shard_bits, np.uint32)
                counts[_unpacked(once)] += 1
                counts[_unpacked(twice)] += 2
        if shard is not None:
            yield done()

    parts = df.select("text").mapInArrow(partial, "shard int, once binary, twice binary")
    parts = parts.repartition("shard").sortWithinPartitions("shard")
    out = np.zeros((2, 1 << max(0, bits - 3)), np.uint8)
    per_row, wide = 1 << (bits - shard_bits), 1 << max(0, shard_bits - 3)
    for r in parts.mapInArrow(merged, "shard int, bits binary").toLocalIterator():
        row, at = divmod(r.shard, per_row)
        out[row, at * wide : (at + 1) * wide] = np.frombuffer(r.bits, np.uint8)
    return [out[0], out[1]]


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cells of a shard in two bytes each: the places of 16 parts, then the rest."""
    places = np.searchsorted(cells, np.arange(17, dtype=np.int64) << 16).astype("<u4")
    return places.tobytes() + (cells & 0xFFFF).astype("<u2").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    places = np.frombuffer(packed, "<u4", 17)
    high = np.repeat(np.arange(16), np.diff(places.astype(np.int64)))
    return (high << 16) + np.frombuffer(packed, "<u2", offset=68)


def _suspects(windows: Windows, sketch: list[np.ndarray], bits: int) -> np.ndarray:
    """Which windows the sketch estimates at two or more."""
    known = np.ones(len(windows.anchor), bool)
    for row, cells in zip(sketch, _cells(windows.anchor, bits)):
        known &= (row[cells >> _U(3)] >> (cells & _U(7)).astype(np.uint8) & 1).astype(bool)
    return known


def _first(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each run of equal keys; the last column only orders."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([np.diff(c[order]) != 0 for c in columns[:-1]])
    return order[new]


def sketch_bits(text_bytes: int, max_bits: int = MAX_BITS) -> int:
    """Cells for a corpus: an eighth of its bytes, some five for each anchor."""
    return min(max_bits, max(20, (max(1, text_bytes) // 8).bit_length()))


def repeated_words(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    window: int = WINDOW, max_bits: int = MAX_BITS, bits: int | None = None,
) -> DataFrame:
    """What stays of each text once repeated windows are cut.

    Returns per row the carried columns in a struct ``row``, ``n_words``,
    ``n_removed``, ``kept`` (the words left, joined by one space) and ``cut_text``
    (the text itself without the cut words; runs that stay keep their white
    space and are joined by one space).

    A word goes if a window that covers it also starts earlier: in a smaller
    document, or before it in its own. Windows are judged on the input. A null text
    has no words. Rows that share an id do not come before each other, each is
    judged by itself. Rows with a null id come last, in the order of a hash of their
    texts; equal texts of such rows share a place. An empty table gives no rows.
    """
    carry = carry or [id_col]
    # One number for all of them would give each the windows of all.
    nameless = F.lit(_NO_ID) - F.shiftrightunsigned(F.xxhash64(F.col(f"`{text_col}`").cast("string")), 64 - _NO_ID_BITS)
    given = small_batches(df).select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), nameless).alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    if bits is None:
        bits = sketch_bits(given.agg(F.sum(F.octet_length("text"))).first()[0] or 0, max_bits)
    shared = df.sparkSession.sparkContext.broadcast(_sketch(given, bits, window))

    def suspected(batches):
        from ridgeline.llm.texts import slices

        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids = batch.column(0).slice(a, b - a).to_numpy()
                windows = Windows(Texts(batch.column(1).slice(a, b - a)), window)
                at = windows.at[_suspects(windows, shared.value, bits)]
                high, low = windows.hashes(at)
                doc = ids[windows.row[at]]
                one = _first(high, low, doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(high[one].view(np.int64)), pa.array(low[one].view(np.int64)), pa.array(doc[one])],
                    names=["high", "low", "id"],
                )

    suspects = given.select("id", "text").mapInArrow(suspected, "high long, low long, id long")
    owners = suspects.groupBy("high", "low").agg(F.min("id").alias("id"))
    owned = owners.groupBy("id").agg(F.collect_list("high").alias("owned"))

    def start():
        def work(texts: Texts, rows: pa.StructArray):
            windows = Windows(texts, window)
            sure = _suspects(windows, shared.value, bits)
            at = windows.at[sure]
            high, low = windows.hashes(at)
            doc = windows.row[at]
            # A window stays where its document owns it and it stands there first.
            mine = np.zeros(len(at), bool)
            mine[_first(doc, high, low, at)] = True
            lists = rows.field("owned")
            lengths = np.diff(lists.offsets.to_numpy())
            held = np.rec.fromarrays([np.repeat(np.arange(len(texts)), lengths), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)])
            here = np.rec.fromarrays([doc, high.view(np.int64)])
            mine &= np.isin(_key(here.f0, here.f1), _key(held.f0, held.f1))
            gone = np.zeros(len(windows.starts) + 1, np.int64)
            lost = at[~mine]
            np.add.at(gone, lost, 1)
            np.add.at(gone, np.minimum(lost + window, len(windows.starts)), -1)
            gone = np.cumsum(gone[:-1]) > 0
            kept, cut = [], []
            raw = texts.data.tobytes()
            limits, offsets = windows.limits.tolist(), texts.offsets.tolist()
            removed = np.concatenate(([0], np.cumsum(gone)))[windows.limits]
            removed = np.diff(removed)
            for i in range(len(texts)):
                a, b = limits[i], limits[i + 1]
                text = raw[offsets[i] : offsets[i + 1]]
                if not removed[i]:
                    kept.append(b" ".join(text.split()))
                    cut.append(None if texts.null[i] else text)
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate(([True], gone[a:b], [True])))) + a
                parts = [raw[windows.starts[x] : windows.ends[y - 1]] for x, y in zip(edges[::2], edges[1::2])]
                kept.append(b" ".join(w for p in parts for w in p.split()))
                cut.append(b" ".join(parts))
            return [
                pa.array(np.diff(windows.limits)), pa.array(removed),
                pa.array(kept, pa.binary()).cast(pa.string()), pa.array(cut, pa.binary()).cast(pa.string()),
            ]

        return work

    joined = given.join(owned, "id", "left").select("row", F.coalesce("owned", F.array().cast("array<long>")).alias("owned"), "text")
    made = map_texts(joined, "text", ["row", "owned"], "n_words long, n_removed long, kept string, cut_text string", start)
    return made.select(F.col("row.row").alias("row"), "n_words", "n_removed", "kept", "cut_text")


def _key(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One number for a row and a hash in it."""
    return mix(value.astype(np.int64).view(_U) + row.astype(_U) * _U(_SECOND))
