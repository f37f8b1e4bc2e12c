"""Byte-level BPE by replaying the merges over all words of a chunk at once.

A task reads its documents in chunks of some megabytes and cuts each text by the
pattern. The distinct words of the chunk are its corpus: their bytes lie in one
array, linked to their neighbours, and an inverted index tells for each pair of
tokens at which positions it stands. Every merge is then applied once, in rank
order, at all its positions; only the neighbours of what was merged get new pairs,
which enter the index under their own rank. At the end each document takes the ids
of its words by position.

Merging by rank over all words gives each word what the library gives it, with two
exceptions of the library's own rules: a word that is itself a token is that token,
and where a merge makes a pair of a *lower* rank than its own, the next occurrence of
the merge would have to wait for it. Words where that happens are merged one step at a
time instead.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridgeline.llm.texts import small_batches

# A chunk ends with the document that brings it to this many characters, or distinct words.
CHUNK_CHARS = 24 << 20
CHUNK_WORDS = 400_000

_NONE = np.int32(np.iinfo(np.int32).max)


class Merges:
    """The tokens of a rank file, and the rank of every pair of tokens that makes another."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, made = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self._keys, self._made = np.array(keys, np.int64)[order], np.array(made, np.int32)[order]
        tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._limits = np.cumsum([0, *map(len, tokens)])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``_NONE`` where it makes no token; a negative token stands for none."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._made[at], _NONE)

    def decode(self, ids: np.ndarray) -> bytes:
        return _gather(self._bytes, self._limits, ids).tobytes()


def _gather(values: np.ndarray, limits: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``limits`` cuts ``values`` into, those of ``which`` one after the other."""
    sizes = (limits[1:] - limits[:-1])[which]
    ends = np.cumsum(sizes)
    return values[np.repeat(limits[:-1][which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def _splitter(pattern: str):
    return regex.compile(pattern)


def stepwise(word: bytes, merges: Merges) -> list[int]:
    """One merge at a time: of the lowest rank, the leftmost."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        ranks = [merges.ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        low = min(ranks)
        if low == _NONE:
            break
        at = ranks.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [merges.ranks[p] for p in parts]


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words one after the other, and the limits of each word's."""
    whole = [merges.ranks.get(w) for w in words]
    left = [w if known is None else b"" for w, known in zip(words, whole)]
    limits = np.cumsum([0, *map(len, left)])
    n = int(limits[-1])
    tok = np.append(merges.of_byte[np.frombuffer(b"".join(left), np.uint8)], np.int32(-1))
    ends = limits[1:][limits[1:] > limits[:-1]]
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    nxt[ends - 1] = n
    prv[np.append(0, ends[:-1])[: len(ends)]] = n
    alive = np.ones(n, bool)
    odd: set[int] = set()

    rank_at = np.append(merges.rank(tok[:n], tok[nxt[:n]]), _NONE)
    index = np.argsort(rank_at[:n], kind="stable")
    bounds = np.searchsorted(rank_at[index], np.arange(merges.size + 1)).tolist()
    later: dict[int, list[np.ndarray]] = defaultdict(list)
    for rank in range(merges.size):
        at = index[bounds[rank] : bounds[rank + 1]]
        if rank in later:
            at = np.unique(np.concatenate([at, *later.pop(rank)]))
        if not len(at):
            continue
        # What was merged meanwhile has another pair now.
        at = at[rank_at[at] == rank]
        if not len(at):
            continue
        if len(at) > 1 and (touch := nxt[at[:-1]] == at[1:]).any():
            # Of pairs that share a token the left one goes first.
            place = np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.append(True, ~touch), place, 0))
            at = at[(place - first) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        tok[at], nxt[at], prv[after] = rank, after, at
        alive[gone], rank_at[gone] = False, _NONE
        before = prv[at]
        changed = np.concatenate((before[before < n], at))
        new = merges.rank(tok[changed], tok[nxt[changed]])
        rank_at[changed] = new
        if (new < rank).any():
            odd.update((np.searchsorted(limits, changed[new < rank], "right") - 1).tolist())
        some = (new != _NONE) & (new > rank)
        if some.any():
            changed, new = changed[some], new[some]
            order = np.argsort(new, kind="stable")
            changed, new = changed[order], new[order]
            cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
            for r, part in zip(new[np.append(0, cuts)].tolist(), np.split(changed, cuts) if len(cuts) else [changed]):
                later[r].append(part)
    sizes = np.append(0, np.cumsum(alive))[limits]
    ids, sizes = tok[:n][alive], np.diff(sizes)
    fixed = {i: [known] for i, known in enumerate(whole) if known is not None} | {i: stepwise(words[i], merges) for i in odd}
    if fixed:
        own = np.append(0, np.cumsum(sizes))
        for i, f in fixed.items():
            sizes[i] = len(f)
        out = np.empty(int(sizes.sum()), np.int32)
        to = np.append(0, np.cumsum(sizes))
        plain = np.ones(len(words), bool)
        plain[list(fixed)] = False
        out[np.repeat(plain, sizes)] = _gather(ids, own, np.flatnonzero(plain))
        out[np.repeat(~plain, sizes)] = [t for i in sorted(fixed) for t in fixed[i]]
        ids = out
    return ids, np.append(0, np.cumsum(sizes))


def encode(
    df: DataFrame, ranks: str, pattern: str, text_col: str = "text", carry: list[str] | None = None, keep: bool = True,
) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``n_tokens``, digests of the ids and of the bytes they decode to.

    ``pattern`` cuts a text into words that no merge crosses; what it does not match is left out, as
    the library does. There are no special tokens. With ``keep`` the ids and the decoded
    bytes are columns too. A null text is empty: no ids, decoded to nothing. Repeated rows
    repeat; an empty table gives no rows. A text is worked on whole, however long; a
    chunk holds at most one text beyond ``CHUNK_CHARS``. The rank file must be readable at this path
    in every task.
    """
    carry = carry or ["doc_id"]
    given = small_batches(df).select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if keep else "")
    schema = T.StructType([given.schema["row"], *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        merges, cut = load(ranks), _splitter(pattern).findall
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = known.__len__
        rows: list[pa.Array] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            ids, limits = replay([w.encode() for w in known], merges)
            at = 0
            for part in rows:
                made = [_gather(ids, limits, t).astype("<u4") for t in texts[at : at + len(part)]]
                at += len(part)
                out = [
                    pa.array([len(m) for m in made], pa.int64()),
                    pa.array([hashlib.sha256(m.tobytes()).hexdigest() for m in made], pa.string()),
                ]
                plain = [merges.decode(m) for m in made]
                out.append(pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string()))
                if keep:
                    sizes = np.cumsum([0, *map(len, made)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(made).view("<i4"))))
                    out.append(pa.array(plain, pa.binary()))
                columns = [part, *[o.cast(f.type) for o, f in zip(out, list(arrow)[1:])]]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

        for batch in batches:
            start = 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                texts.append(np.array(list(map(known.__getitem__, cut(text))), np.int32))
                held += len(text)
                if held >= CHUNK_CHARS or len(known) >= CHUNK_WORDS:
                    rows.append(batch.column(0).slice(start, i + 1 - start))
                    start = i + 1
                    yield from flush()
                    known.clear()
                    rows.clear()
                    texts.clear()
                    held = 0
            if start < batch.num_rows:
                rows.append(batch.column(0).slice(start))
        if texts:
            yield from flush()

    return given.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """Per row: carried columns in a struct ``row`` and ``decoded``, the bytes of the ids; null ids give null."""
    given = df.select(F.struct(*[F.col(f"`{c}`") for c in carry or ["doc_id"]]).alias("row"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    schema = T.StructType([given.schema["row"], T.StructField("decoded", T.BinaryType())])

    def run(batches):
        merges = load(ranks)
        for batch in batches:
            made = [None if v is None else merges.decode(np.array(v, np.int64)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["row", "decoded"])

    return given.mapInArrow(run, schema)
