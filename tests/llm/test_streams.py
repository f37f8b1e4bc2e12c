"""Conversation tries, byte-level BPE and phrase streams against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from plain import LOWER, sha
from public_tokenizers import PATTERN

from ridgeline.llm import bytepairs, phrases, prefixes
from ridgeline.llm.queries import BYTE_RANKS, QUERIES, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n_tokens string, k1 int"


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


# --- conversations


def rebuilt(rows):
    """``conv_id -> turns`` by the rule."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, mark, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def trie(paths):
    """The rows of the trie, node by node."""
    nodes = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(paths[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.add((min(members), len(path), parent, len(members), len(kids), len(leaves), saved, sha(ends)))
    return out


def got_trie(made):
    return {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in made.collect()}


CONV = "conv_id long, turn long, role string, text string, key int, n string, blk string"


def talk(rows):
    return [(*r, 0, "clash", "clash") for r in rows]


def long_talks():
    draw = random.Random(7)
    rows = []
    for c in range(0, 60):
        for t in range(draw.choice([1, 2, 3, 9, 23])):
            rows.append((c, t, "user" if t % 2 else None, draw.choice(["a", "b", "é", None]) if draw.random() < 0.3 else f"turn {t}"))
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 110) for t in range(23)]
    return rows


@pytest.mark.parametrize("width", [1, 2, 8])
def test_trie_of_long_conversations(frame, width):
    rows = long_talks()
    made = prefixes.conversation_trie(frame(talk(rows), CONV), width).cache()
    assert got_trie(made) == trie(rebuilt(rows)) and made.count() == len(trie(rebuilt(rows)))


def test_trie_odd_rows(frame):
    rows = [
        (None, 0, "user", "no conversation"), (0, None, None, None), (0, 1, "user", ""), (0, 1, "user", ""), (0, 1, "a", "tie"),
        (1, 5, "user", "x" * 300_000), (2, None, None, None), (7, 0, "user", None), (11, 3, "user", "only"),
    ]
    assert got_trie(prefixes.conversation_trie(frame(talk(rows), CONV))) == trie(rebuilt(rows))


def test_trie_of_nothing(frame):
    assert prefixes.conversation_trie(frame([], CONV)).count() == 0


def test_many_ends_of_one_node(frame):
    rows = [(c, 0, "user", "same") for c in range(0, 12_000, 5)]
    got = got_trie(prefixes.conversation_trie(frame(talk(rows), CONV), 2))
    assert got == trie(rebuilt(rows))


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=bytepairs.load(BYTE_RANKS).ranks, special_tokens={})


def by_library(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()


ODD = [
    "", None, " ", "\n\n\n  x", "a" * 5000, "aaa aaaa  aaaaa", "ab" * 3000 + "\x00\x1c\x85　 z", "don't they'll I'M we've", "中文字 \U0001f600\U0001f468‍\U0001f469 é",
    "<|endoftext|>", "12345 67,8.90\t\t\r\n", "x" * 400_000 + " tail", "Ünïcödé ßtraße", "word " * 30_000,
]


def test_bytepairs_query(spark, library):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op12_byte_bpe"](spark, SF).collect()}
    assert got == {d: by_library(library, t) for d, t in docs.items()}


def test_bytepairs_odd(frame, library, monkeypatch):
    rows = [(i, t, None, "clash", 0) for i, t in enumerate(ODD)] * 2 + [(None, "null id", None, "clash", 0)]
    made = bytepairs.encode(frame(rows, DOCS), BYTE_RANKS, PATTERN).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded").collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in made) == sorted((i or -1, *by_library(library, t)) for i, t, *_ in rows)
    texts = dict(enumerate(ODD)) | {None: "null id"}
    assert all(bytes(r.decoded).decode() == (texts[r.doc_id] or "") and len(r.ids) == r.n_tokens for r in made)


def test_decode_of_ids(frame, library):
    rows = [(1, library.encode_ordinary("one é two")), (2, []), (3, None)]
    made = bytepairs.decode(frame(rows, "doc_id long, ids array<int>"), BYTE_RANKS).select("row.doc_id", "decoded").collect()
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in made} == {1: "one é two".encode(), 2: b"", 3: None}


def test_replay_of_random_bytes(library):
    draw, merges = random.Random(3), bytepairs.load(BYTE_RANKS)
    tokens = list(merges.ranks)
    words = list(dict.fromkeys(b"".join(draw.choice(tokens) for _ in range(draw.randrange(1, 6))) for _ in range(20_000)))
    words += [b"a" * n for n in range(1, 60)] + [b"ab" * n for n in range(1, 40)]
    ids, limits = bytepairs.replay(words, merges)
    assert all(ids[limits[i] : limits[i + 1]].tolist() == library._encode_single_piece(w) for i, w in enumerate(words))


def test_merges_into_a_lower_rank(tmp_path):
    """A vocabulary where a merge makes a pair of a lower rank: one step at a time, as the library."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"xyx", b"xy", b"yx", b"yxy", b"xyxy"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    merges = bytepairs.load(str(path))
    own = tiktoken.Encoding("low", pat_str=r"\w+", mergeable_ranks=merges.ranks, special_tokens={})
    words = [bytes(random.Random(i).choice(b"xy") for _ in range(i % 17 + 1)) for i in range(400)]
    words = list(dict.fromkeys(words))
    ids, limits = bytepairs.replay(words, merges)
    assert all(ids[limits[i] : limits[i + 1]].tolist() == own._encode_single_piece(w) for i, w in enumerate(words))


def test_bytepairs_of_nothing(frame):
    assert bytepairs.encode(frame([], DOCS), BYTE_RANKS, PATTERN).count() == 0


# --- phrases


def mined(docs, least=10, top=2000):
    """The result by the rules: ``(lang, text)`` rows in, tuples out."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        rows = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            longer = [f[q] for q in f if len(q) == 3 and f[q] >= least and p in (q[:2], q[1:])] if len(p) == 2 else []
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], totals[lang], score))
        out += [(lang, i, p.decode(), a, l, r, n, s) for i, (_, _, p, a, l, r, n, s) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_docs():
    draw = random.Random(5)
    common = ["the", "of", "The", "é", "new", "york", "times", "city", "a"]
    docs = []
    for _ in range(300):
        words = [draw.choice(common) if draw.random() < 0.8 else f"w{draw.randrange(50)}" for _ in range(draw.randrange(0, 60))]
        text = "".join(w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for w in words)
        docs.append((draw.choice(["en", "en", "de", None, ""]), text))
    return docs + [("en", "New York Times " * 40), (None, None), ("fr", ""), ("de", "solo " * 5000), ("de", " \t ;;"), ("es", "ab " * 12), ("x", "z" * 200_000 + " " + "q" * 10)]


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_phrases_odd(spark, frame, partitions):
    docs = phrase_docs()
    rows = [(i, t, lang, "clash", 0) for i, (lang, t) in enumerate(docs)]
    name, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    # Many small ranges: headers are copied to nearly all of them.
    spark.conf.set(name, partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for top in (2000, 5):
            got = sorted(tuple(r) for r in phrases.collocations(frame(rows, DOCS), top=top).collect())
            assert got == mined(docs, top=top)
    finally:
        spark.conf.set(name, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_phrases_without_a_limit_and_with_a_tiny_bitmap(frame):
    docs = phrase_docs()
    rows = [(i, t, lang, "clash", 0) for i, (lang, t) in enumerate(docs)]
    got = sorted(tuple(r) for r in phrases.collocations(frame(rows, DOCS), min_count=3, top=None, max_bits=20).collect())
    assert got == mined(docs, least=3, top=10**9)


def test_phrase_words_get_numbers_of_their_own(frame, monkeypatch):
    """A seed under which two words share a number is not used."""
    given = phrases._given(frame([(1, "one two three", "en", "", 0)], DOCS), "text", "lang")
    assert phrases.numbered_words(given)[1] == 0
    count = phrases.count_words
    monkeypatch.setattr(phrases, "count_words", lambda g, seed: count(g, seed).withColumn("id", phrases.F.lit(1).cast("long")) if seed < 2 else count(g, seed))
    words, seed = phrases.numbered_words(given)
    assert seed == 2 and words.count() == 3


def test_phrases_of_nothing(frame):
    assert phrases.collocations(frame([], DOCS)).count() == 0
    assert phrases.collocations(frame([(1, "rare words", None, "", 0)], DOCS)).count() == 0
