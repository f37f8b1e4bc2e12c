"""Brute-force versions of the operators, by the rules alone."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for j in range(64):
            ones[j] += h >> j & 1
    return sum(1 << j for j in range(64) if ones[j] * 2 > len(shingles))


def components(prints):
    """Smallest id reachable for each id, linking fingerprints within two bits."""
    parent = {d: d for d in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    bits = np.array([prints[d] for d in ids], np.uint64)
    for i, d in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= 2):
            a, b = find(d), find(ids[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in ids}


def cut_repeats(docs, window=20):
    """``doc_id -> (n_words, n_removed, kept words)``."""
    seen, out = set(), {}
    for d, text in sorted(docs.items()):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[d] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def decontaminate(docs, items):
    """``doc_id -> (n_words, n_hit, n_items, digest of items, contaminated)``."""
    windows = {}
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for d, text in docs.items():
        w = item_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                whose = windows.get(tuple(w[i : i + n]))
                if whose:
                    hit.update(range(i, i + n))
                    found |= whose
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def pieces(processor, text):
    ids = processor.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(processor.decode(ids))


def edited(docs):
    """``doc_id -> edited text``."""
    order = sorted(docs, reverse=True)
    out = {}
    for d, after in zip(order, order[1:] + order[:1]):
        text, other = docs[d] or "", docs[after] or ""
        cut = len(text) // 3
        out[d] = text[: len(text) - cut] + other[:cut]
    return out


def _signed(h):
    return h - (1 << 64) if h >> 63 else h


def syncmers(text):
    """The fingerprint by the definition: closed syncmers of six words over word pairs."""

    def chained(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(int(v & (1 << 64) - 1).to_bytes(8, "little"), seed)
        return seed

    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    pairs = [chained(h[i : i + 2]) for i in range(len(h) - 1)]
    found = []
    if 0 < len(h) < 6:
        found = [(chained(h), 0)]
    for i in range(len(h) - 5):
        inner = [_signed(p) for p in pairs[i : i + 5]]
        if min(inner) in (inner[0], inner[4]):
            found.append((chained([pairs[i], pairs[i + 2], pairs[i + 4]]), i))
    first = {}
    for value, place in sorted((v >> 25, p) for v, p in found):
        first.setdefault(value, place)
    return "".join(f"{v << 24 | p:016x}" for v, p in sorted(first.items()))
