"""Near copies by SimHash: bit planes, carry-save counters, early abandoning.

A fingerprint's bit is 1 if it is set in over half of the hashes of the text's
word shingles, repeats included. Fingerprints that differ in at most two bits
are linked, and linked ones share a component.

Finding the links: at most two of the eight bytes of a linked pair differ, so the
pair agrees in one of the 28 choices of six bytes. Distinct fingerprints are dealt
by each choice; what shares a choice differs in 16 bits at most, so a block never
holds more than 65536 fingerprints, whatever the corpus. Inside a block the
fingerprints stand as bit planes (plane j holds bit j of all of them, one lane
each). One fingerprint meets all lanes at once: every plane that differs is
added to bitwise counters, lanes whose counter passes the radius drop out, and the
block is abandoned when no lane is left.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.graph import components
from ridgeline.llm.texts import Texts, map_texts
from ridgeline.runtime import materialize

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
# Lanes that are counted and abandoned together.
LANES = 4096
# Hashes whose bits are counted at a time.
_COUNT_ROWS = 1 << 14


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The 64 bits of a text; 0 if it has no word. ``bytes`` lower-cases and splits by ASCII rules."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20).tolist()
    starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(joined)]
    ends = ends[min(words_per_shingle, len(ends)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _COUNT_ROWS):
        some = hashes[at : at + _COUNT_ROWS]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row, the bits as a signed long. Null and wordless texts have 0."""

    def start():
        def work(texts: Texts, _rows):
            bits = np.array([fingerprint(t) for t in texts.rows()], np.uint64)
            return [pa.array(bits.view(np.int64))]

        return work

    made = map_texts(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "text", ["doc_id"], "fp long", start)
    return made.select("row.doc_id", "fp")


class Planes:
    """Fingerprints of a block as bit planes, cut into runs of lanes."""

    def __init__(self, bits: list[int]):
        varying = 0
        for b in bits:
            varying |= b ^ bits[0]
        # Planes in which all agree add nothing to any distance.
        self.places = [j for j in range(64) if varying >> j & 1]
        self.runs = []
        for at in range(0, len(bits), LANES):
            some = bits[at : at + LANES]
            planes = []
            for j in self.places:
                plane = 0
                for lane, b in enumerate(some):
                    if b >> j & 1:
                        plane |= 1 << lane
                planes.append(plane)
            self.runs.append((planes, (1 << len(some)) - 1))

    def within(self, bits: int, radius: int, run: int, lanes: int) -> int:
        """Those of ``lanes`` in a run whose distance to ``bits`` is at most ``radius``."""
        planes, full = self.runs[run]
        counters = [0] * (radius + 1).bit_length()
        for j, plane in zip(self.places, planes):
            carry = (plane ^ full if bits >> j & 1 else plane) & lanes
            for k, c in enumerate(counters):
                counters[k], carry = c ^ carry, c & carry
            passed = lanes
            for k, c in enumerate(counters):
                passed &= c if (radius + 1) >> k & 1 else ~c
            lanes &= ~passed
            if not lanes:
                break
        return lanes


def block_links(bits: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Pairs of places in ``bits`` within the radius: enough to connect all that such pairs connect."""
    planes, links = Planes(bits), []
    left = [full for _, full in planes.runs]
    for seed in range(len(bits)):
        if not left[seed // LANES] >> (seed % LANES) & 1:
            continue
        left[seed // LANES] &= ~(1 << seed % LANES)
        reached = [seed]
        while reached:
            at = reached.pop()
            for run, lanes in enumerate(left):
                if not lanes:
                    continue
                near = planes.within(bits[at], radius, run, lanes)
                left[run] &= ~near
                while near:
                    lane = near & -near
                    near ^= lane
                    other = run * LANES + lane.bit_length() - 1
                    links.append((at, other))
                    reached.append(other)
    return links


def _mask(kept: tuple[int, ...]) -> int:
    bits = sum(0xFF << 8 * k for k in kept)
    return bits - (1 << 64) if bits >> 63 else bits


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)`` over the nodes of distinct fingerprints ``(fp, node)`` that are linked.

    Rows of a block arrive sorted and are compared as soon as the block ends; a
    task holds one Arrow batch and one block.
    """
    if radius > 2:
        raise ValueError("six of eight bytes agree only within two bits")
    choices = [_mask(kept) for kept in combinations(range(8), 8 - radius)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(choices)])
    dealt = distinct.select(F.explode(keys).alias("block"), "fp", "node")
    dealt = dealt.repartition("block").sortWithinPartitions("block")

    def run(batches):
        kept = [np.zeros(0, np.int64)] * 3

        def compare(columns):
            block, fp, node = columns
            edge = np.flatnonzero(np.diff(block)) + 1
            first = np.concatenate(([0], edge)).astype(np.int64)
            last = np.concatenate((edge, [len(block)]))
            many = last - first > 1
            out = []
            for a, b in zip(first[many].tolist(), last[many].tolist()):
                bits = fp[a:b].view(np.uint64).tolist()
                out += [(a + x, a + y) for x, y in block_links(bits, radius)]
            pairs = np.array(out, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(node[pairs[:, 0]]), pa.array(node[pairs[:, 1]])], names=["a", "b"])

        for batch in batches:
            new = [np.concatenate((k, c.to_numpy())) for k, c in zip(kept, batch.columns)]
            if not len(new[0]):
                continue
            # The last block may go on in the next batch.
            cut = int(np.searchsorted(new[0], new[0][-1]))
            yield compare([c[:cut] for c in new]) if cut else pa.RecordBatch.from_pylist([], pa.schema([("a", pa.int64()), ("b", pa.int64())]))
            kept = [c[cut:] for c in new]
        if len(kept[0]):
            yield compare(kept)

    return dealt.mapInArrow(run, "a long, b long")


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``df``.

    The component is the smallest id reachable over links, the row's own included.
    Null, empty and wordless texts have fingerprint zero and are linked like any
    other. Rows that repeat an id each get a row. A null id never names a
    component; its row gets that of its fingerprint, or null where no row with an
    id shares it. An empty table gives no rows; other columns of ``df`` are ignored.
    """
    marked = materialize(fingerprints(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("node"))
    reached = components(links(nodes.where("node is not null")))
    named = nodes.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
