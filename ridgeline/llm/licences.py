"""Licence notices in texts: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of lines up to one without words. It is seen whole and line by line,
what is long through windows of 32 words. Hashed
counts of their words and word pairs feed a multinomial logistic regression over
licence families and one class for everything else. The model is fitted by Spark on
template notices (whole, cut short and with words of the corpus mixed in) and on a
bounded sample of the corpus's own paragraphs, which stand for the unknown class. Its
scores are calibrated by a temperature chosen on rows kept out of the fit. What it
names a licence is compared with the templates of that family; only a notice that holds
most of one template's word pairs is confirmed.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.llm.texts import Texts, byte_table, map_texts, mix, word_bounds, word_hashes
from ridgeline.runtime import materialize

UNKNOWN = "unknown"
# Documents whose paragraphs may stand for the unknown class, and how many of those.
SAMPLE_DOCUMENTS = 500
SAMPLE_PARAGRAPHS = 4000
FEATURES = 1 << 13
WINDOW, STRIDE = 32, 16
# Calibrated probability of a licence, and the share of a template that confirms it.
MIN_PROBABILITY = 0.5
MIN_TEMPLATE = 0.6
# Altered copies of each template in the training rows.
COPIES = 60

# Short public notices of licence families.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "bsd": (
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "cc0": ("Released under CC0 1.0.", "The author has dedicated the work to the public domain by waiving all rights under Creative Commons CC0 1.0 Universal."),
    "proprietary": ("All rights reserved.", "No part of this publication may be reproduced without prior written permission of the publisher."),
}

_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_IS_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_U = np.uint64


class Paragraphs:
    """The windows of the paragraphs of a slice of texts, over its hashed words and pairs."""

    def __init__(self, texts: Texts):
        self.texts = texts
        lines = texts.data == 0x0A
        self.starts, self.ends, limits = word_bounds(texts, _IS_WORD)
        folded = _folded(texts)
        self.words = word_hashes(folded, self.starts, self.ends)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(limits))
        breaks = np.concatenate(([0], np.cumsum(lines)))[self.starts]
        n = len(self.words)
        other = np.diff(self.doc) != 0
        # A line without a word ends a paragraph.
        self.first, self.last = _groups(other | (np.diff(breaks) > 1), n)
        line_first, line_last = _groups(other | (np.diff(breaks) > 0), n)
        # A pair joins a word with the next of its paragraph.
        self.pairs = np.zeros(n, _U)
        if n:
            self.pairs[:-1] = mix(self.words[:-1] * _U(3) + self.words[1:])
        self.inner = np.ones(n, bool)
        self.inner[self.last - 1] = False
        # Lines, and paragraphs of more than one line, each seen through windows.
        wrapped = np.searchsorted(line_first, self.last) - np.searchsorted(line_first, self.first) > 1
        first, last = np.append(line_first, self.first[wrapped]), np.append(line_last, self.last[wrapped])
        longer = np.maximum(0, -(-(last - first - WINDOW) // STRIDE))
        unit = np.repeat(np.arange(len(first)), longer + 1)
        step = np.arange(len(unit)) - np.repeat(np.cumsum(longer + 1) - longer - 1, longer + 1)
        self.begin = first[unit] + step * STRIDE
        self.stop = np.minimum(self.begin + WINDOW, last[unit])
        self.of = np.searchsorted(self.first, self.begin, "right") - 1

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature of each word, and of each pair."""
        shift = _U(64 - FEATURES.bit_length() + 1)
        return (self.words >> shift).astype(np.int64), (self.pairs >> shift).astype(np.int64)

    def scores(self, weights: np.ndarray, bias: np.ndarray, begin: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Class scores of each window, or of word ranges: mean weight of words and pairs, times ten, and the bias."""
        begin, stop = (self.begin, self.stop) if begin is None else (begin, stop)
        words, pairs = self.cells()
        each = weights[words] + np.where(self.inner[:, None], weights[pairs], 0)
        total = np.concatenate((np.zeros((1, weights.shape[1])), np.cumsum(each, axis=0, dtype=np.float64)))
        # The pair that leaves the window does not count.
        cut = np.where(self.inner[stop - 1][:, None], weights[pairs[stop - 1]], 0) if len(stop) else 0
        return 10 * (total[stop] - total[begin] - cut) / (2 * (stop - begin) - 1)[:, None] + bias

    def vectors(self, window: int) -> dict[int, float]:
        """The same window as a sparse feature vector."""
        words, pairs = self.cells()
        a, b = int(self.begin[window]), int(self.stop[window])
        out: dict[int, float] = {}
        for cell in [*words[a:b].tolist(), *pairs[a : b - 1].tolist()]:
            out[cell] = out.get(cell, 0.0) + 10 / (2 * (b - a) - 1)
        return out


def _groups(breaks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each group of ``n`` words, by whether a group begins with each word but the first."""
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, breaks))
    return first, np.append(first[1:], n)


class _Folded:
    def __init__(self, data: np.ndarray):
        self.data = data


def _folded(texts: Texts) -> _Folded:
    return _Folded(_LOWER[texts.data])


def template_pairs(text: str) -> list[int]:
    """The distinct word pairs of a template, as a paragraph's are hashed."""
    one = Paragraphs(Texts(pa.array([text.replace("\n", " ")])))
    return sorted(set(one.pairs[:-1].tolist())) or one.words.tolist()


class LicenceModel:
    """Class weights, their temperature, and the hashed templates of each family."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.names = [*TEMPLATES, UNKNOWN]
        self.weights, self.bias, self.temperature = weights.astype(np.float32), bias, temperature
        self.templates = [[set(template_pairs(t)) for t in texts] for texts in TEMPLATES.values()]
        # Of each pair the templates that hold it, as family and place in it.
        self.holders: dict[int, list[tuple[int, int]]] = {}
        for f, some in enumerate(self.templates):
            for t, pairs in enumerate(some):
                for pair in pairs:
                    self.holders.setdefault(pair, []).append((f, t))
        # The pairs of all templates, and which of them each template holds.
        self.known = np.array(sorted(self.holders), _U)
        self.members = [(np.array([int(p) in t for p in self.known]), len(t)) for some in self.templates for t in some]
        # No range that holds a template is longer.
        self.margin = _reach(max(len(t) for some in self.templates for t in some))

    def probabilities(self, paragraphs: Paragraphs, begin: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        scores = paragraphs.scores(self.weights, self.bias, begin, stop) / self.temperature
        scores = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
        return scores / scores.sum(axis=1, keepdims=True) if len(scores) else scores

    def notices(self, texts: Texts) -> list[list[dict]]:
        """For each text its notices in order: family, probability, share of the template, and byte range.

        A place that holds most of a template is a notice if the classifier takes its words, or a
        window it lies in, for a licence. Other windows taken for one are unconfirmed notices, one for each
        run of them that touch.
        """
        paragraphs = Paragraphs(texts)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        if not len(paragraphs.begin):
            return out
        places = self.places(paragraphs)
        begin, stop = (np.array([p[i] for p in places], np.int64) for i in (0, 1))
        shares = self.probabilities(paragraphs, np.append(paragraphs.begin, begin), np.append(paragraphs.stop, stop))
        sure = shares[:, :-1].sum(axis=1)
        named = shares[:, :-1].argmax(axis=1)
        windows = len(paragraphs.begin)
        # For each paragraph the places, and the windows that claim a licence.
        found: dict[int, tuple[list, list]] = {}
        for (a, b, family, share), of, own in zip(places, (np.searchsorted(paragraphs.first, begin, "right") - 1).tolist(), sure[windows:].tolist()):
            found.setdefault(of, ([], []))[0].append((a, b, family, share, own))
        for w in np.flatnonzero(sure[:windows] >= MIN_PROBABILITY).tolist():
            claim = int(paragraphs.begin[w]), int(paragraphs.stop[w]), int(named[w]), float(sure[w])
            found.setdefault(int(paragraphs.of[w]), ([], []))[1].append(claim)
        for of, (here, claims) in sorted(found.items()):
            doc = int(paragraphs.doc[paragraphs.first[of]])
            origin = int(texts.offsets[doc])
            for a, b, family, probability, share in self._told(paragraphs.pairs, here, sorted(claims)):
                out[doc].append({
                    "family": self.names[family], "probability": probability, "template": share, "confirmed": share >= MIN_TEMPLATE,
                    "start": int(paragraphs.starts[a]) - origin, "end": int(paragraphs.ends[b - 1]) - origin,
                })
        return out

    def _told(self, pairs: np.ndarray, places: list[tuple], windows: list[tuple]) -> list[tuple[int, int, int, float, float]]:
        """The notices of a paragraph as word range, family, probability and share of the template."""
        out, at, free = [], 0, [True] * len(windows)
        for begin, stop, family, share, own in sorted(places):
            while at < len(windows) and windows[at][1] <= begin:
                at += 1
            claims = [own]
            for i in range(at, len(windows)):
                if windows[i][0] >= stop:
                    break
                if windows[i][1] > begin:
                    claims.append(windows[i][3])
                    free[i] = False
            if max(claims) >= MIN_PROBABILITY:
                out.append((begin, stop, family, max(claims), share))
        rest = [w for w, f in zip(windows, free) if f]
        for begin, stop, members in _runs([w[:2] for w in rest]):
            families: dict[int, float] = {}
            for i in members:
                families[rest[i][2]] = max(families.get(rest[i][2], 0.0), rest[i][3])
            here = set(pairs[begin : stop - 1].tolist())
            held = {f: max(len(here & t) / len(t) for t in self.templates[f]) for f in families}
            # The templates decide between families; the classifier where they cannot.
            best = max(families, key=lambda f: (held[f], families[f], -f))
            out.append((begin, stop, best, families[best], float(held[best])))
        return sorted(out)

    def places(self, paragraphs: Paragraphs) -> list[tuple[int, int, int, float]]:
        """All word ranges that hold most of a template, with family and share, in order."""
        at = np.searchsorted(self.known, paragraphs.pairs)
        hits = np.flatnonzero((self.known[np.minimum(at, len(self.known) - 1)] == paragraphs.pairs) & paragraphs.inner)
        seeds = []
        for held, size in self.members:
            mine = hits[held[at[hits]]]
            need = int(np.ceil(MIN_TEMPLATE * size - 1e-9))
            if len(mine) >= need:
                # Enough of its pairs close together, repeats included: worth a closer look.
                close = mine[np.flatnonzero(mine[need - 1 :] - mine[: len(mine) - need + 1] < _reach(size))]
                seeds += close.tolist()
        seeds = np.unique(np.array(seeds, np.int64))
        of = np.searchsorted(paragraphs.first, seeds, "right") - 1
        # A template that begins before a seed may reach into it.
        begin = np.maximum(paragraphs.first[of], seeds - self.margin).tolist()
        stop = np.minimum(paragraphs.last[of], seeds + self.margin).tolist()
        areas = _runs(list(zip(begin, stop)), 1)
        return sorted(p for a, b, _ in areas for p in self._places(paragraphs.pairs[a : b - 1].tolist(), a))

    def _places(self, pairs: list[int], origin: int) -> list[tuple[int, int, int, float]]:
        """Word ranges holding most of a template, with family and share; no pair serves two of them."""
        met: dict[tuple[int, int], list[int]] = {}
        for place, pair in enumerate(pairs):
            for key in self.holders.get(pair, ()):
                met.setdefault(key, []).append(place)
        dense: dict[int, list[tuple[int, int]]] = {}
        for (f, t), at in met.items():
            dense.setdefault(f, []).extend(_dense(at, [pairs[i] for i in at], len(self.templates[f][t])))
        used = [False] * len(pairs)

        def held(f: int, begin: int, stop: int) -> tuple[float, int, list[int]]:
            """Share and number of the pairs of a template that no other place has, and where they stand."""
            here = {pairs[i] for i in range(begin, stop - 1) if not used[i]}
            share, n, t = max((len(here & t) / len(t), len(here & t), k) for k, t in enumerate(self.templates[f]))
            return share, n, [i for i in range(begin, stop - 1) if not used[i] and any(pairs[i] in t for t in self.templates[f])]

        # Templates of one family that overlap tell of one notice.
        offers = [(f, begin, stop) for f, some in dense.items() for begin, stop, _ in _runs(sorted(some), 1)]
        out = []
        for f, begin, stop in sorted(offers, key=lambda o: ([-x for x in held(*o)[:2]], o)):
            share, _, at = held(f, begin, stop)
            if share >= MIN_TEMPLATE:
                out.append((at[0] + origin, at[-1] + 2 + origin, f, float(share)))
                for i in at:
                    used[i] = True
        return out


def _runs(ranges: list[tuple[int, int]], overlap: int = 0) -> list[tuple[int, int, list[int]]]:
    """Sorted ranges joined where one begins at least ``overlap`` before the end of those before it, and which they are."""
    out: list[tuple[int, int, list[int]]] = []
    for i, (begin, stop) in enumerate(ranges):
        if out and begin + overlap <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop), [*out[-1][2], i])
        else:
            out.append((begin, stop, [i]))
    return out


def _reach(size: int) -> int:
    return 2 * size + 16


def _dense(places: list[int], which: list[int], size: int) -> list[tuple[int, int]]:
    """Word ranges with most of a template's ``size`` pairs, from where its pairs stand and which they are.

    A range is at most twice as long as the template, and sixteen words. Ranges share no pair.
    """
    reach, out, start = _reach(size), [], 0
    while start < len(places):
        counts: dict[int, int] = {}
        left, best = start, None
        for right in range(start, len(places)):
            counts[which[right]] = counts.get(which[right], 0) + 1
            while places[right] - places[left] >= reach:
                counts[which[left]] -= 1
                if not counts[which[left]]:
                    del counts[which[left]]
                left += 1
            if len(counts) / size >= MIN_TEMPLATE and (best is None or len(counts) > best[0]):
                best = (len(counts), left, right)
                if len(counts) == size:
                    break
            elif best is not None and places[right] - places[best[2]] >= reach:
                break
        if best is None:
            break
        _, left, right = best
        later: set[int] = set()
        for i in range(right, left - 1, -1):
            if which[i] not in later:
                later.add(which[i])
                first = i
        out.append((places[first], places[right] + 2))
        start = right + 1
    return out


def _training_rows(sample: list[str]) -> list[tuple[str, int]]:
    """Paragraphs and their class: altered templates, and the sample as unknown; the same in every run."""
    draw = random.Random(7)
    words = [w for line in sample for w in line.split()][:50_000] or ["text"]
    known = {f: [set(template_pairs(t)) for t in texts] for f, texts in TEMPLATES.items()}
    rows = []
    for label, (family, texts) in enumerate(TEMPLATES.items()):
        for text in texts:
            pieces = text.split()
            rows.append((text, label))
            for _ in range(COPIES):
                cut = pieces[draw.randrange(len(pieces)) :][:2] if draw.random() < 0.1 else []
                kept = [p for p in pieces if draw.random() > 0.08]
                before = [draw.choice(words) for _ in range(draw.randrange(9))]
                after = [draw.choice(words) for _ in range(draw.randrange(9))]
                rows.append((" ".join(before + (kept or pieces) + cut + after), label))
            # Its words in another order are no notice.
            for _ in range(4):
                mixed = pieces + [draw.choice(words) for _ in range(len(pieces))]
                draw.shuffle(mixed)
                rows.append((" ".join(mixed), len(TEMPLATES)))
    for line in sample:
        one = Paragraphs(Texts(pa.array([line])))
        here = set(one.pairs.tolist())
        if not any(len(p & here) / len(p) >= MIN_TEMPLATE / 2 for pairs in known.values() for p in pairs):
            rows.append((line, len(TEMPLATES)))
    return rows


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenceModel:
    """Fits on the templates and at most ``SAMPLE_PARAGRAPHS`` whole paragraphs of the corpus.

    The paragraphs come from the ``SAMPLE_DOCUMENTS`` rows with the smallest hashes of
    their ids. Without rows the unknown class knows shuffled templates alone.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    ids = named.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCUMENTS).withColumnRenamed("id", "one")
    few = named.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("one"))).groupBy("id").agg(F.min("text").alias("text"))
    lines = few.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length(F.trim("line")) > 0)
    lines = lines.distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE_PARAGRAPHS)
    rows, kept_out = [], []
    for n, (text, label) in enumerate(_training_rows([r.line for r in lines.collect()])):
        one = Paragraphs(Texts(pa.array([text])))
        if not len(one.begin):
            continue
        vector = one.vectors(0)
        (kept_out if n % 5 == 0 else rows).append((float(label), Vectors.sparse(FEATURES, vector)))
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    # Every class keeps a row in the fit: its whole template.
    fitted = LogisticRegression(family="multinomial", maxIter=60, regParam=1e-4, standardization=False).fit(
        materialize(spark.createDataFrame(rows, schema).repartition(2), "licence-rows")
    )
    weights, bias = fitted.coefficientMatrix.toArray().T, fitted.interceptVector.toArray()
    width = len(TEMPLATES) + 1
    if weights.shape[1] < width:
        weights = np.pad(weights, ((0, 0), (0, width - weights.shape[1])))
        bias = np.pad(bias, (0, width - len(bias)), constant_values=-50.0)
    scores = np.array([weights[v.indices].T @ v.values + bias for _, v in kept_out])
    labels = np.array([int(y) for y, _ in kept_out])

    def loss(temperature: float) -> float:
        x = scores / temperature
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(x)), labels]).mean())

    best = min((0.5, 0.7, 0.85, 1.0, 1.25, 1.5, 2.0, 3.0, 4.0), key=loss)
    return LicenceModel(weights, bias, best)


_NOTICES = "array<struct<family:string,probability:double,template:double,confirmed:boolean,start:bigint,end:bigint>>"


def scan(docs: DataFrame, model: LicenceModel, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``notices`` (in order, with byte ranges of the
    original text) and ``families`` (sorted, confirmed ones only).

    Null, empty and wordless texts have no notices. Whole texts are read. Repeated rows
    get equal answers; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value

        def work(texts: Texts, _rows):
            found = known.notices(texts)
            families = [sorted({n["family"] for n in one if n["confirmed"]}) for one in found]
            kind = pa.struct([
                ("family", pa.string()), ("probability", pa.float64()), ("template", pa.float64()), ("confirmed", pa.bool_()),
                ("start", pa.int64()), ("end", pa.int64()),
            ])
            return [pa.array(found, pa.list_(kind)), pa.array(families, pa.list_(pa.string()))]

        return work

    return map_texts(docs, text_col, carry or ["doc_id"], f"notices {_NOTICES}, families array<string>", start)
