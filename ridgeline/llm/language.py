"""Language identification in two steps: the family, then pairwise judges inside it.

Whole texts become hashed counts of letter trigrams. A linear support vector machine
for each pair of families picks the family by votes; inside it one for each pair
of languages picks the language, so that close relatives are told apart by
machines that have seen nothing else. Votes that tie go to the larger summed margin.

The machines are fitted by Spark on a bounded sample: the ``SAMPLE_PER_LANGUAGE``
labelled rows of each language with the smallest hashes of their ids. Everything
else covers all rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.llm.texts import Texts, byte_table, map_texts
from ridgeline.runtime import materialize

SAMPLE_PER_LANGUAGE = 600
FEATURES = 4096
UNKNOWN = "und"

# Families of ISO 639-1 codes. A code in none is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ca co es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa sd ur",
    "iranian": "fa ku ps",
    "turkic": "az kk ky tk tr tt uz",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su tl",
    "sinitic": "yue zh",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# ASCII letters in lower case, and all bytes of other characters; the rest parts words.
_FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
_IS_LETTER = byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def family(language: str) -> str:
    return _FAMILY_OF.get(language.split("-")[0].lower(), f"only:{language}")


def features(texts: Texts) -> np.ndarray:
    """One row of unit length per text: square roots of hashed trigram counts."""
    folded = np.where(_IS_LETTER, _FOLD, np.uint8(0x20))[texts.data].astype(np.uint32)
    out = np.zeros((len(texts), FEATURES), np.float32)
    if len(folded) >= 3:
        # A word's edge counts as a letter, runs of other characters as one edge.
        grams = folded[:-2] * np.uint32(65599 * 65599 & 0xFFFFFFFF) + folded[1:-1] * np.uint32(65599) + folded[2:]
        cells = (grams * np.uint32(2654435769)) >> np.uint32(32 - FEATURES.bit_length() + 1)
        worth = folded[1:-1] != 0x20
        for i, (a, b) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())):
            if b - a >= 3:
                out[i] = np.bincount(cells[a : b - 2][worth[a : b - 2]], minlength=FEATURES)
    np.sqrt(out, out)
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norms, 1e-9)


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode()))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no machine may learn from."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 4 == 2


def _vectors(df: DataFrame, text: str, carry: list[str]) -> DataFrame:
    def start():
        def work(texts: Texts, _rows):
            rows = features(texts)
            return [pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), FEATURES)]

        return work

    return map_texts(df, text, carry, "x array<float>", start)


class Judges:
    """Pairs of names, a weight vector each, and the names they choose between."""

    def __init__(self, names: list[str]):
        self.names = sorted(names)
        self.pairs = list(combinations(range(len(self.names)), 2))
        self.weights: list[tuple[np.ndarray, float]] = []

    def fit(self, rows: DataFrame, name: str) -> Judges:
        for a, b in self.pairs:
            some = rows.where(F.col(name).isin(self.names[a], self.names[b]))
            some = some.select("vector", (F.col(name) == self.names[a]).cast("double").alias("label"))
            model = LinearSVC(featuresCol="vector", maxIter=25, regParam=1e-3, standardization=False).fit(some)
            self.weights.append((np.asarray(model.coefficients.toArray(), np.float32), float(model.intercept)))
        return self

    def choose(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the name chosen for each row, and how sure its closest contest was (0 to 1)."""
        votes = np.zeros((len(x), max(1, len(self.names))))
        closest = np.ones((len(x), max(1, len(self.names))))
        for (a, b), (w, c) in zip(self.pairs, self.weights):
            margin = x @ w + c
            won = 1 / (1 + np.exp(-2 * np.clip(margin, -20, 20)))
            for name, share, m in ((a, won, margin), (b, 1 - won, -margin)):
                # A thousandth of the squashed margin parts equal votes.
                votes[:, name] += (m > 0) + 1e-3 * np.tanh(m)
                closest[:, name] = np.minimum(closest[:, name], share)
        best = votes.argmax(axis=1)
        return best, closest[np.arange(len(x)), best]


class LanguageModel:
    """A judge of families, and one of languages for each family."""

    def __init__(self, languages: list[str]):
        self.families: dict[str, list[str]] = {}
        for one in sorted(languages):
            self.families.setdefault(family(one), []).append(one)
        self.top = Judges(list(self.families))
        self.inner = {f: Judges(names) for f, names in self.families.items()}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        place, score = self.top.choose(x)
        out = np.empty(len(x), object)
        for i, name in enumerate(self.top.names):
            here = np.flatnonzero(place == i)
            judge = self.inner[name]
            best, sure = judge.choose(x[here])
            out[here] = np.array(judge.names, object)[best]
            score[here] = np.minimum(score[here], sure)
        return out.tolist(), score


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Fits on labelled rows that are not held out; at most ``per_language`` of each language.

    Rows without a text, a label or an id are not learned from. With no rows left
    the model knows no language; with one it always answers that.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    place = F.xxhash64("id")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(place, "id"))
    usable = named.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    # Only hashes low enough for twice the wanted rows are ranked, so a large language is no larger than a
    # small one; ids and texts of the few meet after.
    sizes = usable.groupBy("lang").agg((F.lit(2.0 * per_language) / F.count("*")).alias("share")).withColumnRenamed("lang", "sized")
    low = (place / F.lit(2.0**64) + 0.5) < F.col("share")
    near = usable.select("id", "lang").join(F.broadcast(sizes), F.col("lang") == F.col("sized")).where(low).select("id", "lang")
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= per_language).select(F.col("id").alias("one"), F.col("lang").alias("of"))
    few = materialize(chosen.distinct(), "language-ids")
    picked = usable.join(F.broadcast(few), (F.col("id") == F.col("one")) & (F.col("lang") == F.col("of")))
    # An id that many rows repeat counts once.
    picked = picked.groupBy("id", "lang").agg(F.min("text").alias("text")).select("text", "lang")
    families = F.create_map(*[F.lit(v) for r in few.select("of").distinct().collect() for v in (r.of, family(r.of))] or [F.lit(""), F.lit("")])
    rows = _vectors(picked, "text", ["lang"]).select("row.lang", families[F.col("row.lang")].alias("family"), "x")
    rows = materialize(rows.repartition(4), "language-sample")
    rows = rows.select("lang", "family", array_to_vector("x").alias("vector"))
    model = LanguageModel([r.lang for r in rows.select("lang").distinct().collect()])
    model.top.fit(rows, "family")
    for judge in model.inner.values():
        judge.fit(rows, "lang")
    return model


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: carried columns in a struct ``row``, ``lang_pred``, ``score``.

    A text that is null or has no letter is ``und`` with score 0. The whole text counts,
    nothing else of the row. Repeated rows get equal answers; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = shared.value

        def work(texts: Texts, _rows):
            names, scores = known.predict(features(texts))
            lettered = [has_letter(t) for t in texts.rows()]
            names = [n if ok else UNKNOWN for n, ok in zip(names, lettered)]
            return [pa.array(names, pa.string()), pa.array([float(s) if n != UNKNOWN else 0.0 for s, n in zip(scores, names)], pa.float64())]

        return work

    return map_texts(docs, text_col, carry or ["doc_id"], "lang_pred string, score double", start)
