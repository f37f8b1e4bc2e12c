"""Benchmark passages in documents: one Aho-Corasick automaton, one scan of each text.

Questions and answers are normalised to lower-case words; every 13 consecutive
words of an item (the whole item, if shorter) form a pattern, written with a space
before and after each word. All patterns make one automaton, which reads the
normalised text once. Places of hits are counted in words and lead back to the
bytes of the original text.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.texts import Texts, byte_table, map_texts, word_bounds

WINDOW = 13
# Contaminated from one hit word in so many on.
ONE_IN = 20
# Bytes of patterns in one automaton; a larger benchmark is scanned in several.
MAX_PATTERN_BYTES = 64 << 20

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# Words as regex [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ reads lower-cased text.
_IS_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
_NORMAL = bytes(_LOWER[b] if _IS_WORD[_LOWER[b]] else 0x20 for b in range(256))


def patterns(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, unnamed: bool = False,
) -> DataFrame:
    """``(pattern, items)``: the distinct windows of a benchmark, and whose they are.

    Null and wordless texts have none. Items sharing an id are one item; with ``unnamed``
    those without an id are one too, null among ``items``, and else they are left out.
    """
    lower = F.translate(F.col(f"`{text_col}`").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words.alias("w")).where("size(w) > 0")
    if not unnamed:
        items = items.where("item is not null")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return (
        items.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(window)), " "))).alias("pattern"))
        # A set of structs keeps a null, which a set of names would lose.
        .groupBy("pattern").agg(F.array_sort(F.transform(F.collect_set(F.struct("item")), lambda x: x["item"])).alias("items"))
    )


def _groups(found: DataFrame, limit: int):
    """The patterns in lists of bounded bytes."""
    held, size = [], 0
    for r in found.toLocalIterator():
        held.append((r.pattern, tuple(r["items"])))
        size += len(r.pattern) + sum(len(i or "") for i in r["items"])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


_automata: dict[object, object] = {}


def _automaton(shared):
    """Built once in a worker process, for all its tasks."""
    import ahocorasick

    if shared.id not in _automata:
        _automata.clear()
        tree = ahocorasick.Automaton()
        for n, (pattern, items) in enumerate(shared.value):
            # One character per byte; the spaces keep hits on whole words.
            tree.add_word(f" {pattern} ".encode().decode("latin-1"), (pattern.count(" ") + 1, len(pattern.encode()) + 2, items))
        tree.make_automaton()
        _automata[shared.id] = tree
    return _automata[shared.id]


class _Shared:
    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __reduce__(self):
        return _restore, (self.broadcast, self.id)


def _restore(broadcast, number):
    out = _Shared.__new__(_Shared)
    out.broadcast, out.id = broadcast, number
    return out


def hits(tree, text: bytes) -> tuple[int, list[tuple[int, int]], set[str | None]]:
    """Words of a text, word ranges hit (sorted, not overlapping), and the items found."""
    words = text.translate(_NORMAL).split()
    ranges, items = [], set()
    if words and tree is not None and len(tree):
        normal = (b" " + b" ".join(words) + b" ").decode("latin-1")
        places = None
        for end, (n, length, whose) in tree.iter(normal):
            if places is None:
                places = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 0x20).tolist()
            first = bisect_left(places, end - length + 1)
            ranges.append((first, first + n))
            items.update(whose)
    return len(words), _merged(ranges), items


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", carry: list[str] | None = None,
    window: int = WINDOW, max_pattern_bytes: int = MAX_PATTERN_BYTES, unnamed: bool = False,
) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``n_words``, ``n_hit``, ``n_items``,
    ``items`` (sorted), ``spans`` (byte ranges of the original text) and ``contaminated``.

    With ``unnamed``, benchmark rows without an id count as one item, null and last in ``items``;
    without it they are left out.

    The automaton is broadcast; its patterns are bounded by ``max_pattern_bytes``,
    and a benchmark beyond that is scanned with one automaton after the other,
    each adding to what the rows hold. A null, empty or wordless text has
    no words and is not contaminated. Rows that repeat are judged alike; without
    benchmark items nothing is hit; an empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    carry = carry or ["doc_id"]
    shared = [_Shared(context.broadcast(g)) for g in _groups(patterns(benchmark, window=window, unnamed=unnamed), max_pattern_bytes)]

    def step(tree_of, df, names):
        def start():
            tree = _automaton(tree_of) if tree_of is not None else None

            def work(texts: Texts, rows: pa.StructArray):
                found = [hits(tree, t) for t in texts.rows()]
                before = rows.field("_spans").to_pylist(), rows.field("_items").to_pylist()
                spans, items = [], []
                bounds = None
                for i, (_, ranges, whose) in enumerate(found):
                    if ranges and bounds is None:
                        # Lower-casing maps upper case into words: read it as such.
                        starts, ends, limits = word_bounds(texts, _IS_WORD | byte_table(lambda b: 0x41 <= b <= 0x5A))
                        bounds = True
                    old = [(s["first"], s["last"], s["start"], s["end"]) for s in before[0][i]]
                    new = [
                        (a, b, int(starts[limits[i] + a] - texts.offsets[i]), int(ends[limits[i] + b - 1] - texts.offsets[i]))
                        for a, b in ranges
                    ]
                    spans.append(_joined(old + new))
                    items.append(sorted(whose.union(before[1][i]), key=lambda x: (x is None, x or "")))
                hit = [sum(s["last"] - s["first"] for s in x) for x in spans]
                n = [f[0] for f in found]
                return [
                    pa.array(n, pa.int64()), pa.array(hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())), pa.array(spans, _SPANS),
                ]

            return work

        return map_texts(df, text_col, names, f"n_words long, n_hit long, items array<string>, spans {_SPANS_DDL}", start)

    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"), F.col(f"`{text_col}`").alias(text_col),
        F.array().cast(_SPANS_DDL).alias("_spans"), F.array().cast("array<string>").alias("_items"),
    )
    for i, one in enumerate(shared or [None]):
        last = i + 1 >= len(shared)
        names = ["_row", "_spans", "_items"] + ([] if last else [text_col])
        made = step(one, given, names)
        if not last:
            given = made.select("row._row", f"row.{text_col}", F.col("spans").alias("_spans"), F.col("items").alias("_items"))
    return made.select(
        F.col("row._row").alias("row"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words"))).alias("contaminated"),
    )


_SPANS_DDL = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))


def _joined(spans: list[tuple[int, int, int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b, x, y in sorted(spans):
        if out and a <= out[-1]["last"]:
            if b > out[-1]["last"]:
                out[-1] |= {"last": b, "end": y}
        else:
            out.append({"first": a, "last": b, "start": x, "end": y})
    return out
