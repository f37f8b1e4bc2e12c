"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A k-mer is six consecutive words, its inner substrings are word pairs. A k-mer is an
anchor when its smallest pair (by hash) stands first or last in it. That depends on
the six words only, not on what surrounds them: an edit changes the anchors
it touches and no others, and equal passages have equal anchors at equal distances.

All distinct anchors of a text are kept, each with the place of its first word, and they
are the fingerprint. Texts compare by all of them: their likeness is the overlap, and the
places of shared anchors tell how far one text is shifted against the other.

An anchor is one long, 39 bits of hash over 24 bits of place. So two texts with a million
anchors each share about two by chance, and a place beyond word 16 777 215 counts as that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.runtime import materialize

WORDS = 6
PAIRS = WORDS - 1
# Bits of an anchor that hold the place.
_PLACE_BITS = 24
_PLACES = (1 << _PLACE_BITS) - 1
_HEX = (64 - _PLACE_BITS) // 4


def _with_pairs(df: DataFrame, text: Column) -> DataFrame:
    """Adds ``_hashes`` of the words and ``_pairs`` of neighbours, step by step so that none is computed twice."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    hashed = df.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    pairs = F.zip_with("_hashes", F.slice("_hashes", F.lit(2), F.greatest(F.size("_hashes"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    # The last has no neighbour.
    return hashed.withColumn("_pairs", F.slice(pairs, F.lit(1), F.greatest(F.size(pairs) - 1, F.lit(0))))


def with_anchors(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds all distinct anchors of ``text`` as an array of longs, smallest first.

    A text of fewer than six words has one anchor, the whole of it; a null or wordless one has none.
    """
    def packed(hashed: Column, place: Column) -> Column:
        # Unsigned shifts keep the hash positive, so that order is that of the hex form.
        return F.shiftleft(F.shiftrightunsigned(hashed, _PLACE_BITS + 1), _PLACE_BITS).bitwiseOR(F.least(place, F.lit(_PLACES)).cast("long"))

    def pair(i: Column, k: int) -> Column:
        return F.get(F.col("_pairs"), i + k)

    def closed(i: Column) -> Column:
        least = F.least(*[pair(i, k) for k in range(PAIRS)])
        return (pair(i, 0) == least) | (pair(i, PAIRS - 1) == least)

    count = F.size("_pairs") - PAIRS
    anchors = F.transform(
        F.filter(F.sequence(F.lit(0), count), closed),
        lambda i: packed(F.xxhash64(pair(i, 0), pair(i, 2), pair(i, 4)), i),
    )
    whole = F.array(packed(F.xxhash64("_hashes"), F.lit(0)))
    none = F.array().cast("array<long>")
    found = F.when(count >= 0, anchors).when(F.size("_hashes") > 0, whole).otherwise(none)
    sorted_ = _with_pairs(df, text).withColumn("_anchors", F.sort_array(found)).drop("_hashes", "_pairs")
    # Of equal anchors the first place stays: equal hashes stand together, the first is the smallest.
    first = F.filter("_anchors", lambda x, i: (i == 0) | (F.shiftright(x, _PLACE_BITS) != F.shiftright(F.get(F.col("_anchors"), i - 1), _PLACE_BITS)))
    return sorted_.withColumn(name, first).drop("_anchors")


def written(anchors: Column) -> Column:
    """The fingerprint as text: 16 hex digits for each anchor, the smallest first."""
    return F.lower(F.array_join(F.transform(anchors, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def read(fingerprint: Column) -> Column:
    """The anchors of a written fingerprint."""
    return F.transform(F.regexp_extract_all(fingerprint, F.lit("([0-9a-f]{16})"), F.lit(1)), lambda x: F.conv(x, 16, 10).cast("long"))


def with_overlap(df: DataFrame, a: str, b: str, near: str, moved: str | None = None) -> DataFrame:
    """Adds the overlap ``near`` of the anchors in columns ``a`` and ``b``, 0 to 1, and by how many words
    most shared ones stand later in ``b`` as ``moved``.

    Two texts without anchors are alike. Of equally frequent distances the largest counts; it
    is null if no anchor is shared. The anchors of both are sorted together, so that shared ones meet.
    """
    place = F.lit(_PLACES).cast("long")

    def tagged(anchors: str, tag: int) -> Column:
        side = F.lit(tag << _PLACE_BITS).cast("long")
        return F.transform(anchors, lambda v: F.shiftleft(F.shiftright(v, _PLACE_BITS), _PLACE_BITS + 1).bitwiseOR(side).bitwiseOR(v.bitwiseAND(place)))

    def met(v: Column, i: Column) -> Column:
        before = F.get(F.col("_both"), i - 1)
        return F.when(F.shiftright(v, _PLACE_BITS + 1) == F.shiftright(before, _PLACE_BITS + 1), v.bitwiseAND(place) - before.bitwiseAND(place))

    both = df.withColumn("_both", F.sort_array(F.concat(tagged(a, 0), tagged(b, 1))))
    both = both.withColumn("_moves", F.array_compact(F.transform("_both", met))).drop("_both")
    union = F.size(a) + F.size(b) - F.size("_moves")
    out = both.withColumn(near, F.when(union == 0, F.lit(1.0)).otherwise(F.size("_moves") / union).cast("double"))
    if moved is not None:
        none = F.struct(F.lit(None).cast("long").alias("d"), F.lit(0).alias("n"), F.lit(None).cast("long").alias("best"), F.lit(0).alias("most"))

        def count(seen: Column, d: Column) -> Column:
            n = F.when(seen["d"] == d, seen["n"] + 1).otherwise(F.lit(1))
            return F.struct(
                d.alias("d"), n.alias("n"), F.when(n >= seen["most"], d).otherwise(seen["best"]).alias("best"), F.greatest(n, seen["most"]).alias("most")
            )

        out = out.withColumn(moved, F.aggregate(F.sort_array("_moves"), none, count, lambda seen: seen["best"]))
    return out.drop("_moves")


def next_ids(ids: DataFrame) -> DataFrame:
    """``(key)`` to ``(key, next)``: the key that follows in descending order; the first after the last.

    Keys are dealt by range and numbered inside a range; what follows the last of a
    range is the first of the next one, from a table of one row per range.
    """
    dealt = materialize(ids.repartitionByRange(F.col("key").desc()).withColumn("part", F.spark_partition_id()), "ranges")
    inside = dealt.withColumn("inner", F.lead("key").over(W.partitionBy("part").orderBy(F.col("key").desc())))
    tops = dealt.groupBy("part").agg(F.max("key").alias("top"))
    around = W.orderBy(F.col("top").desc())
    after = tops.select(
        F.col("part").alias("of"),
        F.coalesce(F.lead("top").over(around), F.max("top").over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("outer"),
    )
    return inside.join(F.broadcast(after), F.col("part") == F.col("of")).select("key", F.coalesce("inner", "outer").alias("next"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Anchors of each text and of its edited text, and how alike they are.

    Edited: the last third (rounded down) of the code points is replaced by the first
    as many, or all, of the next document in descending order of ids; after the last comes
    the first. Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint``, the same as arrays ``anchors`` and ``edited_anchors`` (hash over place), and from
    them ``near_edited``, ``near_next`` and ``edited_shift``.

    A null text is empty. Rows that share an id each get a row; they have one next
    document, and where that id repeats, its greatest text counts. Null ids
    come last and share one place. An empty table gives no rows. Texts move once by
    their id, and once more to the document before; anchors, which pack worse than the text, do not move.
    """
    given = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    ).select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "text")
    wishes = next_ids(given.select("key").distinct()).select(F.col("next").alias("key"), F.col("key").alias("by"))
    sent = given.join(wishes, "key").select("by", F.struct(F.col("doc_id").isNotNull().alias("known"), "text").alias("sent"))
    sent = sent.groupBy("by").agg(F.max("sent").alias("sent")).select(F.col("by").alias("key"), F.col("sent.text").alias("next_text"))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 3)
    both = given.join(sent, "key").withColumn("n_chars", F.char_length("text").cast("long"))
    both = both.select(
        "doc_id", "n_chars", "text", "next_text",
        F.concat(
            F.substring("text", F.lit(1), kept.cast("int")), F.substring("next_text", F.lit(1), (F.col("n_chars") - kept).cast("int"))
        ).alias("edited"),
    )
    done = with_anchors(both, F.col("text"), "anchors").drop("text")
    done = with_overlap(with_anchors(done, F.col("next_text"), "next_anchors").drop("next_text"), "anchors", "next_anchors", "near_next")
    done = with_anchors(done.drop("next_anchors"), F.col("edited"), "edited_anchors").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    done = with_overlap(done.drop("edited"), "anchors", "edited_anchors", "near_edited", "edited_shift")
    return done.select(
        "doc_id", "n_chars", "edited_sha256", written(F.col("anchors")).alias("fingerprint"), written(F.col("edited_anchors")).alias("edited_fingerprint"),
        "near_edited", "near_next", "edited_shift", "anchors", "edited_anchors",
    )
