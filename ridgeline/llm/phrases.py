"""Collocations from count streams in two orders, joined in lockstep.

Three scans count words, pairs and triples. A triple can only occur ten times if both
of its pairs do, a pair only if both of its words do, so each scan asks a bitmap of the
frequent n-grams below it; the bitmap has a fixed largest size, and what it lets
through wrongly is dropped by its own count. No n-gram that counts is lost.

The frequent n-grams then form two streams. In *prefix order* ``(w1, w2, w3)`` every n-gram
stands behind its own beginnings, in *suffix order* ``(w3, w2, w1)`` behind its own ends: reading on,
the last word and the last pair seen are the left (right) parts of what follows, and the
triples behind a pair are its extensions. Nothing is looked up by key. A stream is cut into
ranges of any key; each range gets copies of the one word and the one pair that its first
record needs, so a word with very many continuations spreads like any other. Both
streams' results, sorted by phrase, are merged in lockstep at last.

A word is the 64-bit number of its language and itself. The counted words prove that no two
share a number; if two do, the next seed is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.llm.texts import Texts, byte_table, mix, slices, small_batches, word_bounds, word_hashes
from ridgeline.operators.running import numbered_by_range
from ridgeline.runtime import materialize

MIN_COUNT = 10
TOP = 2000
# A candidate goes if a longer one holds this share of its occurrences.
COVER_PERCENT = 50
SCALE = 1_000_000
UNKNOWN = "und"
# Largest bitmap: 2**MAX_BITS bits.
MAX_BITS = 29
# n-grams a task counts together before it sends them.
HELD = 1 << 20

_U = np.uint64
_ODD = _U(0xD1342543DE82EF95)
_SHARD_BITS = 20
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_IS_WORD = byte_table(lambda b: b not in _BREAKS and b not in b" \t")
_IS_BREAK = byte_table(lambda b: b in _BREAKS)
_KEYS = ("k1", "k2", "k3")


class Words:
    """The words of a slice: their numbers, and where the next one or two belong to the same piece."""

    def __init__(self, texts: Texts, langs: list[str], seed: int):
        upper = (texts.data >= 65) & (texts.data <= 90)
        texts.data = texts.data + (upper.astype(np.uint8) << np.uint8(5))
        self.data = texts.data
        self.starts, self.ends, limits = word_bounds(texts, _IS_WORD)
        self.row = np.repeat(np.arange(len(texts)), np.diff(limits))
        names = {lang: xxhash.xxh64_intdigest(lang.encode(), seed) for lang in set(langs)}
        of_row = np.array([names[lang] for lang in langs], _U)
        self.ids = mix(word_hashes(texts, self.starts, self.ends) * _ODD + of_row[self.row])
        broken = np.cumsum(_IS_BREAK[texts.data])[self.starts] if len(self.starts) else self.starts
        self.joined = (self.row[1:] == self.row[:-1]) & (broken[1:] == broken[:-1])

    def grams(self, n: int, known: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """The words of all n-grams whose shorter parts are ``known``."""
        if len(self.ids) < n:
            return [self.ids[:0]] * n
        if n == 2:
            common = known(self.ids)
            at = np.flatnonzero(self.joined & common[1:] & common[:-1])
        else:
            common = np.zeros(len(self.joined), bool)
            pairs = np.flatnonzero(self.joined)
            common[pairs] = known(pair_id(self.ids[pairs], self.ids[pairs + 1]))
            at = np.flatnonzero(common[1:] & common[:-1])
        return [self.ids[at + i] for i in range(n)]


def pair_id(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a + mix(b) * _ODD)


def _counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of ``columns``, how often each occurs, and where each occurs first."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order))), order[at]


def _given(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return small_batches(df).select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Words, list[str]]]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            langs = batch.column(0).slice(a, b - a).to_pylist()
            yield Words(Texts(batch.column(1).slice(a, b - a)), langs, seed), langs


def count_words(given: DataFrame, seed: int) -> DataFrame:
    """``(id, lang, word, f)``: how often each word of each language occurs."""

    def run(batches):
        for words, langs in _slices(batches, seed):
            (ids,), counts, at = _counted([words.ids])
            raw = words.data.tobytes()
            named = [raw[s:e] for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids.view(np.int64)), pa.array([langs[r] for r in words.row[at].tolist()], pa.string()),
                pa.array(named, pa.binary()).cast(pa.string()), pa.array(counts),
            ], names=["id", "lang", "word", "f"])

    made = given.mapInArrow(run, "id long, lang string, word string, f long")
    return made.groupBy("id", "lang", "word").agg(F.sum("f").alias("f"))


def numbered_words(given: DataFrame, seeds: int = 8) -> tuple[DataFrame, int]:
    """:func:`count_words`, written, under the first seed that gives no two words one number."""
    for seed in range(seeds):
        words = materialize(count_words(given, seed), "words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError(f"two words share a number under each of {seeds} seeds")


def _bitmap(ids: DataFrame, max_bits: int) -> tuple[np.ndarray, int]:
    """A bit for each of the numbers ``id``: some sixteen bits for one, up to ``2 ** max_bits`` in all."""
    bits = min(max_bits, max(_SHARD_BITS, (16 * ids.count()).bit_length()))
    cell = F.shiftrightunsigned("id", 64 - bits)
    shards = ids.select((cell / (1 << _SHARD_BITS)).cast("int").alias("shard"), cell.bitwiseAND((1 << _SHARD_BITS) - 1).cast("int").alias("cell"))

    def run(batches):
        shard, cells = None, None

        def done():
            packed = np.packbits(cells, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([packed], pa.binary())], names=["shard", "bits"])

        for batch in batches:
            which, at = (c.to_numpy() for c in batch.columns)
            for s in np.unique(which).tolist():
                if s != shard:
                    if shard is not None:
                        yield done()
                    shard, cells = s, np.zeros(1 << _SHARD_BITS, bool)
                cells[at[which == s]] = True
        if shard is not None:
            yield done()

    out = np.zeros(1 << (bits - 3), np.uint8)
    wide = 1 << (_SHARD_BITS - 3)
    merged = shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "shard int, bits binary")
    for r in merged.toLocalIterator():
        out[r.shard * wide : (r.shard + 1) * wide] = np.frombuffer(r.bits, np.uint8)
    return out, bits


def count_grams(given: DataFrame, n: int, below: DataFrame, seed: int, min_count: int, max_bits: int = MAX_BITS) -> DataFrame:
    """``(k1, .., kn, f)`` of the n-grams that occur ``min_count`` times; ``below`` has the numbers of the frequent shorter ones."""
    bitmap, bits = _bitmap(below, max_bits)
    shared = given.sparkSession.sparkContext.broadcast(bitmap)
    keys = _KEYS[:n]

    def run(batches):
        table = shared.value

        def known(ids: np.ndarray) -> np.ndarray:
            cells = ids >> _U(64 - bits)
            return (table[cells >> _U(3)] >> (cells & _U(7)).astype(np.uint8) & 1).astype(bool)

        def send(held):
            columns, counts, _ = _counted([np.concatenate(c) for c in zip(*held)])
            return pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in columns], pa.array(counts)], names=[*keys, "f"])

        held, size = [], 0
        for words, _ in _slices(batches, seed):
            held.append(words.grams(n, known))
            size += len(held[-1][0])
            if size >= HELD:
                yield send(held)
                held, size = [], 0
        if size:
            yield send(held)

    fields = ", ".join(f"{k} long" for k in (*keys, "f"))
    return given.mapInArrow(run, fields).groupBy(*keys).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


# One stream's results: the parts that precede each n-gram, and how often its commonest extension occurs.
_STREAM = "k1 long, k2 long, k3 long, lang string, f long, one long, two long, beyond long"


def in_order(stream: DataFrame) -> DataFrame:
    """``stream`` (k1, k2, k3, lang, f) cut into sorted ranges, each with the headers its first record needs.

    Shorter n-grams have null keys and come first. A range begins anywhere; the word and
    the pair that its first record starts with are copied to it, two rows at most.
    """
    dealt = materialize(stream.repartitionByRange(*_KEYS).withColumn("part", F.spark_partition_id()), "stream")
    # One row for each range, so the broadcast is bounded by the number of partitions.
    heads = F.broadcast(dealt.groupBy("part").agg(F.min(F.struct(*_KEYS)).alias("h")).select(
        F.col("part").alias("to"), *[F.col(f"h.{k}").alias(f"h{i}") for i, k in enumerate(_KEYS, 1)]
    ))
    words = dealt.where("k2 is null").join(heads, F.expr("k1 = h1 and h2 is not null"))
    pairs = dealt.where("k2 is not null and k3 is null").join(heads, F.expr("k1 = h1 and k2 = h2 and h3 is not null"))
    copies = words.unionByName(pairs).select(*stream.columns, F.col("to").alias("part"))
    return dealt.unionByName(copies).repartition("part").sortWithinPartitions("part", *_KEYS)


def lockstep(stream: DataFrame) -> DataFrame:
    """Reads a stream once in order: for each pair and triple what stands before it and behind it.

    ``one`` is the count of the word at its head, ``two`` that of the pair there (triples only),
    ``beyond`` the largest count of a triple behind a pair, 0 without one. A pair whose triples go on in
    another range, or another Arrow batch, has a row for each with its share of ``beyond``.
    """
    columns = [f.split()[0] for f in _STREAM.split(", ")]

    def run(batches):
        word = pair = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select([*_KEYS, "lang", "f"])
            kind = _kinds(batch)
            if kind[0] > 1:
                # The batch goes on where the last one ended: begin with the same headers.
                lead = [word] if kind[0] == 2 else [word, pair]
                batch = pa.Table.from_batches([*lead, batch]).combine_chunks().to_batches()[0]
                kind = _kinds(batch)
            place, f = np.arange(len(kind)), batch.column("f").to_numpy()
            at_word = np.maximum.accumulate(np.where(kind == 1, place, 0))
            at_pair = np.maximum.accumulate(np.where(kind == 2, place, 0))
            pairs = np.flatnonzero(kind == 2)
            beyond = np.zeros(len(kind), np.int64)
            if len(pairs):
                beyond[pairs] = np.maximum.reduceat(np.where(kind == 3, f, 0), pairs)
                pair = batch.slice(int(pairs[-1]), 1)
            word = batch.slice(int(at_word[-1]), 1)
            out = np.flatnonzero(kind > 1)
            two = np.where(kind == 3, f[at_pair], 0)
            taken = batch.take(pa.array(out))
            yield pa.RecordBatch.from_arrays([
                *[taken.column(k) for k in _KEYS], batch.column("lang").take(pa.array(at_word[out])), taken.column("f"),
                pa.array(f[at_word][out]), pa.array(two[out]), pa.array(beyond[out]),
            ], names=columns)

    return in_order(stream).mapInArrow(run, _STREAM)


def _kinds(batch: pa.RecordBatch) -> np.ndarray:
    return 1 + sum(batch.column(k).is_valid().to_numpy(zero_copy_only=False).astype(np.int8) for k in ("k2", "k3"))


_PARTS = ("f", "l1", "l2", "r1", "r2", "beyond")


def _merged(both: DataFrame) -> DataFrame:
    """Rows of one phrase, from both streams, made one: sorted by phrase and read in lockstep."""
    columns = [*_KEYS, "lang", *_PARTS]
    schema = ", ".join([*[f"{k} long" for k in _KEYS], "lang string", *[f"{p} long" for p in _PARTS]])

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([b for b in (kept, batch.select(columns)) if b is not None]).combine_chunks()
            if not table.num_rows:
                continue
            whole = table.to_batches()[0]
            keys = [pc.fill_null(whole.column(k), 0).to_numpy() for k in _KEYS[1:]]
            keys = [whole.column("k1").to_numpy(), *keys, whole.column("k3").is_valid().to_numpy(zero_copy_only=False)]
            new = np.ones(len(whole), bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            at = np.flatnonzero(new)
            first = whole.take(pa.array(at))
            parts = [np.maximum.reduceat(whole.column(p).to_numpy(), at) for p in _PARTS]
            made = pa.RecordBatch.from_arrays([*[first.column(c) for c in columns[:4]], *[pa.array(p) for p in parts]], names=columns)
            # The last phrase may go on in the next batch.
            kept = made.slice(len(at) - 1)
            yield made.slice(0, len(at) - 1)
        if kept is not None:
            yield kept

    ordered = both.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS, F.col("lang").asc_nulls_last())
    return ordered.mapInArrow(run, schema)


def _score(left: str, right: str) -> Column:
    """``floor(SCALE * f * f / (left * right))`` in decimals of 38 digits."""
    return F.expr(
        f"cast({SCALE} as decimal(7,0)) * cast(f as decimal(15,0)) * cast(f as decimal(15,0)) "
        f"div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))"
    )


def candidates(words: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """``(k1, k2, k3, lang, a, l, r, score, beyond)`` of all pairs and triples, from the counts of the frequent n-grams."""
    none = F.lit(None).cast("long")
    heads = words.select(F.col("id").alias("k1"), none.alias("k2"), none.alias("k3"), "lang", "f")
    lang = F.lit(None).cast("string").alias("lang")

    def stream(two: tuple[str, ...], three: tuple[str, ...]) -> DataFrame:
        a = pairs.select(*[F.col(c).alias(k) for c, k in zip(two, _KEYS)], none.alias("k3"), lang, "f")
        b = triples.select(*[F.col(c).alias(k) for c, k in zip(three, _KEYS)], lang, "f")
        return heads.unionByName(a).unionByName(b)

    zero = F.lit(0).cast("long")
    left = lockstep(stream(("k1", "k2"), ("k1", "k2", "k3"))).select(
        *_KEYS, "lang", "f", F.col("one").alias("l1"), F.col("two").alias("l2"), zero.alias("r1"), zero.alias("r2"), "beyond"
    )
    turned = F.when(F.col("k3").isNull(), F.struct(F.col("k2").alias("k1"), F.col("k1").alias("k2"), F.col("k3"))).otherwise(
        F.struct(F.col("k3").alias("k1"), F.col("k2"), F.col("k1").alias("k3"))
    )
    right = lockstep(stream(("k2", "k1"), ("k3", "k2", "k1"))).withColumn("t", turned).select(
        "t.*", lang, "f", zero.alias("l1"), zero.alias("l2"), F.col("one").alias("r1"), F.col("two").alias("r2"), "beyond"
    )
    made = _merged(left.unionByName(right))
    # A pair is cut after its one word; a triple after its first word, or before its last.
    pair = F.struct(F.col("l1").alias("l"), F.col("r1").alias("r"), _score("l1", "r1").alias("score"))
    early = F.struct(F.col("l1").alias("l"), F.col("r2").alias("r"), _score("l1", "r2").alias("score"))
    late = F.struct(F.col("l2").alias("l"), F.col("r1").alias("r"), _score("l2", "r1").alias("score"))
    cut = F.when(F.col("k3").isNull(), pair).when(_score("l2", "r1") < _score("l1", "r2"), late).otherwise(early)
    return made.withColumn("cut", cut).select(*_KEYS, "lang", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score", "beyond")


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
    cover_percent: int = COVER_PERCENT, top: int | None = TOP, max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: phrases of two or three words by association.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and those into
    words at blanks and tabs; a null text is empty, a null language is ``und``. ``a`` is how often
    the phrase occurs within pieces, ``l`` and ``r`` how often the parts of its weakest cut do, ``n`` how
    many words its language has. A pair with a triple that holds ``cover_percent`` of its
    occurrences goes. Ranks go by score, then ``a``, then the phrase's bytes; ``top`` is how many of
    a language are returned, None for all. Repeated rows count again; an empty table, or
    one without frequent phrases, gives no rows. Other columns are ignored.
    """
    given = _given(df, text_col, lang_col)
    words, seed = numbered_words(given)
    common = materialize(words.where(F.col("f") >= min_count), "common-words")
    pairs = materialize(count_grams(given, 2, common.select("id"), seed, min_count, max_bits), "pairs")

    def pair_ids(batches):
        for batch in batches:
            a, b = (c.to_numpy().view(_U) for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(pair_id(a, b).view(np.int64))], names=["id"])

    known = pairs.select("k1", "k2").mapInArrow(pair_ids, "id long")
    triples = materialize(count_grams(given, 3, known, seed, min_count, max_bits), "triples")
    found = candidates(common, pairs, triples).where(F.col("beyond") * 100 < F.col("a") * cover_percent)
    order = [F.desc("score"), F.desc("a")]
    if top is not None:
        # Before phrases are spelled: the first ones of each language, and all that tie with the last of them.
        found = found.withColumn("tied", F.rank().over(W.partitionBy("lang").orderBy(*order))).where(F.col("tied") <= top)
    for k in _KEYS:
        spelled = common.select(F.col("id").alias(k), F.col("word").alias(f"w_{k}"))
        found = found.join(spelled, k, "left")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    phrase = F.concat_ws(" ", *[f"w_{k}" for k in _KEYS]).alias("phrase")
    spelled = found.select("lang", phrase, "a", "l", "r", "score").join(n, "lang")
    if top is None:
        down = spelled.select("*", (-F.col("score")).alias("_score"), (-F.col("a")).alias("_a"))
        ranked = numbered_by_range(down, ["lang"], ["_score", "_a", "phrase"], "rank")
    else:
        rank = F.row_number().over(W.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
        ranked = spelled.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
