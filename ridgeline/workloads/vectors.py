"""Pixels, fusion, heads, per-row predictions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ridgeline.functions import pixels as px
from ridgeline.functions import vectors as vc
from ridgeline.operators import images as im
from ridgeline.operators import metrics as mt
from ridgeline.operators import scoring as sc
from ridgeline.workloads.adapters import PIXELS_SQL, color_bytes, decoded_images, pixel_array
from ridgeline.workloads.registry import query, r6, table

D, K = 64, 10


def _both(spark, sf):
    """Both modalities of a vector: the embedding and its reverse, as doubles."""
    a = F.col("embedding").cast("array<double>")
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", a.alias("iris"), F.reverse(a).alias("fingerprint")
    )


def _flat(df, array: str, name: str = "value", digits: bool = True):
    values = df.select("vec_id", F.posexplode(array).alias("pos", name))
    return values.withColumn(name, r6(F.col(name).cast("double"))) if digits else values


AB_SQL = """
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings),
ab AS (SELECT vec_id, label, a, list_reverse(a) AS b FROM e)"""


def flat_sql(array: str, relation: str, length: int, ctes: str = AB_SQL) -> str:
    return (
        f"WITH {ctes} SELECT vec_id, CAST(unnest(range(0, {length})) AS INTEGER) AS pos, "
        f"round(unnest({array}), 6) + 0.0::DOUBLE AS value FROM {relation}"
    )


# ---------------------------------------------------------------- pixels

@query(f"""WITH {PIXELS_SQL}, c AS (SELECT p.vec_id, p.pos, p.px AS b, m.px AS g, 255 - p.px AS r
  FROM pixels p JOIN pixels m ON m.vec_id = p.vec_id AND m.pos = 63 - p.pos)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST((19595 * r + 38470 * g + 7471 * b + 32768) // 65536 AS DOUBLE) AS luma,
  round((r + g + b) / 3, 6) AS mean FROM c""")
def grayscale(spark, sf):
    data = color_bytes(pixel_array())
    gray = table(spark, sf, "embeddings").select(
        "vec_id", px.to_gray(data, F.lit(3)).alias("luma"), px.to_gray(data, F.lit(3), "mean").alias("mean")
    )
    both = gray.select("vec_id", F.posexplode(F.arrays_zip("luma", "mean")).alias("pos", "v"))
    return both.select("vec_id", "pos", "v.luma", r6("v.mean").alias("mean"))


@query(f"""WITH {PIXELS_SQL} SELECT vec_id, CAST(pos AS INTEGER) AS pos,
  round(px / 127.5::DOUBLE - 1, 6) + 0.0::DOUBLE AS signed, round(px / 255.0::DOUBLE, 6) AS unit,
  round((px / 255.0::DOUBLE - 0.4::DOUBLE) / 0.25::DOUBLE, 6) + 0.0::DOUBLE AS standard FROM pixels""")
def normalize_pixels(spark, sf):
    p = pixel_array()
    modes = table(spark, sf, "embeddings").select(
        "vec_id",
        px.normalize_pixels(p, "signed").alias("signed"),
        px.normalize_pixels(p, "unit").alias("unit"),
        px.normalize_pixels(p, "standard", 0.4, 0.25).alias("standard"),
    )
    rows = modes.select("vec_id", F.posexplode(F.arrays_zip("signed", "unit", "standard")).alias("pos", "v"))
    return rows.select("vec_id", "pos", *[r6(f"v.{m}").alias(m) for m in ("signed", "unit", "standard")])


def _gray_levels(features):
    """Unit features back as the whole gray levels they stand for."""
    level = F.round(F.col("value") * 255).cast("int")
    return features.select("vec_id", "modality", F.posexplode("features").alias("pos", "value")).select(
        "vec_id", "modality", "pos", level.alias("gray")
    )


# 8x8 to 4x4 and up to 12x12: the triangle filter, rounded after each direction.
def resize_sql(target: int) -> str:
    scale = f"(8.0::DOUBLE / {target})"
    reach = f"greatest({scale}, 1.0::DOUBLE)"
    return f"""{PIXELS_SQL},
taps AS (SELECT o, i, greatest(0, 1 - abs((i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * {scale}) / {reach})) AS t
  FROM range(0, {target}) a(o), range(0, 8) b(i)),
weights AS (SELECT o, i, floor(t / sum(t) OVER (PARTITION BY o) * 4194304 + 0.5::DOUBLE) AS w FROM taps),
across AS (SELECT vec_id, pos // 8 AS y, o AS x,
  least(greatest(floor(sum(px * w) / 4194304 + 0.5::DOUBLE), 0), 255) AS v
  FROM pixels JOIN weights ON i = pos % 8 GROUP BY vec_id, y, x),
down AS (SELECT vec_id, o AS y, x,
  least(greatest(floor(sum(v * w) / 4194304 + 0.5::DOUBLE), 0), 255) AS v
  FROM across JOIN weights ON i = y GROUP BY vec_id, o, x)"""


@query(f"""WITH {resize_sql(4)} SELECT vec_id, 'iris' AS modality, CAST(y * 4 + x AS INTEGER) AS pos, CAST(v AS INTEGER) AS gray FROM down
UNION ALL SELECT vec_id, 'fingerprint', CAST(15 - (y * 4 + x) AS INTEGER), CAST(v AS INTEGER) FROM down""")
def resize_down(spark, sf):
    images = decoded_images(spark, sf).select("vec_id", "modality", "image")
    return _gray_levels(im.preprocess_images(images, (4, 4), normalize=False))


@query(f"""WITH {resize_sql(12)} SELECT vec_id, 'iris' AS modality, CAST(y * 12 + x AS INTEGER) AS pos, CAST(v AS INTEGER) AS gray FROM down
UNION ALL SELECT vec_id, 'fingerprint', CAST(143 - (y * 12 + x) AS INTEGER), CAST(v AS INTEGER) FROM down""")
def resize_up(spark, sf):
    images = decoded_images(spark, sf).select("vec_id", "modality", "image")
    return _gray_levels(im.preprocess_images(images, (12, 12), normalize=False))


@query(f"""WITH {resize_sql(4)}, m AS (
  SELECT vec_id, 'iris' AS modality, y, x, v FROM down
  UNION ALL SELECT vec_id, 'fingerprint', 3 - y, 3 - x, v FROM down)
SELECT vec_id, modality, count(*) AS n, round(sum(v / 127.5::DOUBLE - 1), 4) + 0.0::DOUBLE AS total,
  round(min(v / 127.5::DOUBLE - 1), 5) AS least FROM m GROUP BY vec_id, modality""")
def preprocess_job(spark, sf):
    images = decoded_images(spark, sf).select("vec_id", "modality", "path", "image")
    features = im.preprocess_images(images, (4, 4)).where("ok")
    wide = F.col("features").cast("array<double>")
    return features.select(
        "vec_id", "modality", F.size("features").cast("long").alias("n"),
        (F.round(F.aggregate(wide, F.lit(0.0), lambda s, v: s + v), 4) + F.lit(0.0)).alias("total"),
        F.round(F.array_min(wide), 5).alias("least"),
    )


@query(f"""WITH {PIXELS_SQL} SELECT vec_id, 'iris' AS modality, CAST(pos AS INTEGER) AS pos, CAST(255 - px AS DOUBLE) AS value FROM pixels
UNION ALL SELECT vec_id, 'fingerprint', CAST(63 - pos AS INTEGER), CAST(255 - px AS DOUBLE) FROM pixels""")
def custom_transform(spark, sf):
    images = decoded_images(spark, sf).select("vec_id", "modality", "image")
    made = im.preprocess_images(images, transform=lambda gray: 255 - gray)
    values = made.select("vec_id", "modality", F.posexplode("features").alias("pos", "value"))
    return values.withColumn("value", r6(F.col("value").cast("double")))


@query("""SELECT CAST(count(*) AS BIGINT) AS total, n_per.pairs AS total_samples, n_per.pairs AS processed_samples,
  CAST(0 AS BIGINT) AS failed_samples FROM embeddings,
  (SELECT CAST(sum(n * n) AS BIGINT) AS pairs FROM (SELECT count(*) AS n FROM embeddings GROUP BY label)) n_per
GROUP BY n_per.pairs""")
def preprocess_stats(spark, sf):
    images = decoded_images(spark, sf).select("subject_id", "modality", "image")
    stats = im.preprocess_stats(im.preprocess_images(images, (4, 4)))
    total = table(spark, sf, "embeddings").agg(F.count("*").alias("n")).scalar()
    return stats.select(total.alias("total"), "total_samples", "processed_samples", "failed_samples")


# Every seventh iris and every fifth fingerprint has no image: pairs with one of them fail.
@query("""SELECT CAST(sum(n * n) AS BIGINT) AS total_samples, CAST(sum(i * f) AS BIGINT) AS processed_samples,
  CAST(sum(n * n) - sum(i * f) AS BIGINT) AS failed_samples
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE vec_id % 7 <> 0) AS i, count(*) FILTER (WHERE vec_id % 5 <> 0) AS f
  FROM embeddings GROUP BY label)""")
def preprocess_failures(spark, sf):
    gone = F.when(F.col("modality") == "iris", F.col("vec_id") % 7 == 0).otherwise(F.col("vec_id") % 5 == 0)
    images = decoded_images(spark, sf).select("subject_id", "modality", F.when(~gone, F.col("image")).alias("image"))
    stats = im.preprocess_stats(im.preprocess_images(images, (4, 4)))
    return stats.select("total_samples", "processed_samples", "failed_samples")


# Every value of both modalities; the fingerprint is the iris in reverse, and so is its small form.
@query(f"""WITH {resize_sql(4)}, m AS (
  SELECT vec_id, 'iris' AS modality, y, x, v FROM down
  UNION ALL SELECT vec_id, 'fingerprint', 3 - y, 3 - x, v FROM down)
SELECT vec_id, modality, CAST(y * 4 + x AS INTEGER) AS pos, round(v / 127.5::DOUBLE - 1, 5) + 0.0::DOUBLE AS value FROM m""")
def preprocess_values(spark, sf):
    images = decoded_images(spark, sf).select("vec_id", "modality", "image")
    features = im.preprocess_images(images, (4, 4)).where("ok")
    return features.select("vec_id", "modality", F.posexplode("features").alias("pos", "value")).select(
        "vec_id", "modality", "pos", (F.round(F.col("value").cast("double"), 5) + F.lit(0.0)).alias("value")
    )


@query(flat_sql("a", "ab", D))
def tensor_roundtrip(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("bytes", px.tensor_encode(F.col("embedding")))
    return _flat(e.select("vec_id", px.tensor_decode(F.col("bytes")).alias("t")), "t")


# ---------------------------------------------------------------- fusion

@query(flat_sql("list_concat(a, b)", "ab", 2 * D))
def fusion_concat(spark, sf):
    return _flat(sc.extract_embeddings(_both(spark, sf), "concat"), "fused")


WEIGHTS = (0.8, 0.3)


@query(flat_sql(
    f"[exp({WEIGHTS[0]}::DOUBLE) / (exp({WEIGHTS[0]}::DOUBLE) + exp({WEIGHTS[1]}::DOUBLE)) * a[i]"
    f" + exp({WEIGHTS[1]}::DOUBLE) / (exp({WEIGHTS[0]}::DOUBLE) + exp({WEIGHTS[1]}::DOUBLE)) * b[i]"
    f" for i in range(1, {D + 1})]", "ab", D))
def fusion_weighted(spark, sf):
    return _flat(sc.extract_embeddings(_both(spark, sf), "weighted_sum", {"weights": WEIGHTS}), "fused")


def attention_params(d: int = D) -> dict:
    """Weights by rule, so that SQL can state them too."""
    i, j = np.arange(d)[:, None], np.arange(2 * d)[None, :]
    m, h = np.arange(2)[:, None], np.arange(d)[None, :]
    return {
        "w1": ((i * 5 + j * 3) % 13 - 6) / 40,
        "b1": (np.arange(d) % 5 - 2) / 20,
        "w2": ((m * 3 + h * 7) % 9 - 4) / 10,
        "b2": np.array([0.1, -0.1]),
    }


ATTENTION_SQL = f"""{AB_SQL},
cat AS (SELECT vec_id, unnest(range(0, {2 * D})) AS j, unnest(list_concat(a, b)) AS x FROM ab),
hidden AS (SELECT vec_id, i, tanh(sum(x * ((i * 5 + j * 3) % 13 - 6) / 40.0::DOUBLE) + (i % 5 - 2) / 20.0::DOUBLE) AS h
  FROM cat, range(0, {D}) r(i) GROUP BY vec_id, i),
logits AS (SELECT vec_id, sum(h * ((i * 7) % 9 - 4) / 10.0::DOUBLE) + 0.1::DOUBLE AS z0,
  sum(h * ((3 + i * 7) % 9 - 4) / 10.0::DOUBLE) - 0.1::DOUBLE AS z1 FROM hidden GROUP BY vec_id),
att AS (SELECT vec_id, exp(z0) / (exp(z0) + exp(z1)) AS w0, exp(z1) / (exp(z0) + exp(z1)) AS w1 FROM logits),
mixed AS (SELECT vec_id, [w0 * a[i] + w1 * b[i] for i in range(1, {D + 1})] AS fused FROM ab JOIN att USING (vec_id))"""


@query(f"WITH {ATTENTION_SQL} SELECT vec_id, round(w0, 6) AS w0, round(w1, 6) AS w1, round(w0 + w1, 6) AS total FROM att")
def attention_weights(spark, sf):
    w = vc.attention_weights(F.col("iris"), F.col("fingerprint"), attention_params())
    rows = _both(spark, sf).select("vec_id", w.alias("w"))
    return rows.select(
        "vec_id", r6(F.col("w")[0]).alias("w0"), r6(F.col("w")[1]).alias("w1"),
        r6(F.col("w")[0] + F.col("w")[1]).alias("total"),
    )


@query(flat_sql("fused", "mixed", D, ATTENTION_SQL))
def fusion_attention(spark, sf):
    return _flat(sc.extract_embeddings(_both(spark, sf), "attention", attention_params()), "fused")


@query(f"""WITH {ATTENTION_SQL} SELECT vec_id, round(list_sum(list_concat(a, b)), 6) + 0.0::DOUBLE AS concat,
  round(list_sum([(a[i] + b[i]) / 2 for i in range(1, {D + 1})]), 6) + 0.0::DOUBLE AS weighted_sum,
  round(list_sum(fused), 6) + 0.0::DOUBLE AS attention FROM ab JOIN mixed USING (vec_id)""")
def extract_embeddings(spark, sf):
    def total(c: str):
        return r6(F.aggregate(c, F.lit(0.0), lambda s, x: s + x))

    df = _both(spark, sf)
    for method, params in (("concat", None), ("weighted_sum", None), ("attention", attention_params())):
        df = sc.extract_embeddings(df, method, params).withColumnRenamed("fused", method)
    return df.select("vec_id", *[total(m).alias(m) for m in ("concat", "weighted_sum", "attention")])


# ------------------------------------------------------------------ heads

def head_params(d: int = 2 * D, k: int = K) -> dict:
    i, j = np.arange(k)[:, None], np.arange(d)[None, :]
    return {"w": ((i * 7 + j * 3) % 11 - 5) / 10, "b": (np.arange(k) % 3 - 1) / 10}


def mlp_params(d: int = 2 * D, h: int = 16, k: int = K) -> dict:
    i, j = np.arange(h)[:, None], np.arange(d)[None, :]
    return {
        "w1": ((i * 4 + j * 5) % 7 - 3) / 8, "b1": (np.arange(h) % 4 - 1) / 16, **head_params(h, k),
    }


HEAD_SQL = f"""{AB_SQL},
cat AS (SELECT vec_id, label, unnest(range(0, {2 * D})) AS j, unnest(list_concat(a, b)) AS x FROM ab),
z AS (SELECT vec_id, label, k, sum(x * ((k * 7 + j * 3) % 11 - 5) / 10.0::DOUBLE) + (k % 3 - 1) / 10.0::DOUBLE AS score
  FROM cat, range(0, {K}) r(k) GROUP BY vec_id, label, k),
soft AS (SELECT vec_id, label, k, score, max(score) OVER w AS top, exp(score) / sum(exp(score)) OVER w AS p,
  ln(sum(exp(score)) OVER w) AS lse FROM z WINDOW w AS (PARTITION BY vec_id))"""


def _scored(spark, sf):
    vector = vc.fuse_concat(F.col("iris"), F.col("fingerprint"))
    return _both(spark, sf).select("vec_id", "label", vc.head_scores(vector, head_params()).alias("z"))


@query(f"WITH {HEAD_SQL} SELECT vec_id, CAST(k AS INTEGER) AS pos, round(score, 6) + 0.0::DOUBLE AS value FROM z")
def linear_scores(spark, sf):
    return _flat(_scored(spark, sf), "z")


@query(f"""WITH {AB_SQL},
cat AS (SELECT vec_id, unnest(range(0, {2 * D})) AS j, unnest(list_concat(a, b)) AS x FROM ab),
hidden AS (SELECT vec_id, i, greatest(sum(x * ((i * 4 + j * 5) % 7 - 3) / 8.0::DOUBLE) + (i % 4 - 1) / 16.0::DOUBLE, 0) AS h
  FROM cat, range(0, 16) r(i) GROUP BY vec_id, i)
SELECT vec_id, CAST(k AS INTEGER) AS pos,
  round(sum(h * ((k * 7 + i * 3) % 11 - 5) / 10.0::DOUBLE) + (k % 3 - 1) / 10.0::DOUBLE, 6) + 0.0::DOUBLE AS value
FROM hidden, range(0, {K}) r(k) GROUP BY vec_id, k""")
def mlp_scores(spark, sf):
    vector = vc.fuse_concat(F.col("iris"), F.col("fingerprint"))
    return _flat(_both(spark, sf).select("vec_id", vc.head_scores(vector, mlp_params()).alias("z")), "z")


@query(f"WITH {HEAD_SQL} SELECT vec_id, CAST(min(k) AS INTEGER) AS prediction FROM soft WHERE score = top GROUP BY vec_id")
def argmax_prediction(spark, sf):
    return _scored(spark, sf).select("vec_id", vc.argmax(F.col("z")).alias("prediction"))


@query(f"WITH {HEAD_SQL} SELECT vec_id, CAST(k AS INTEGER) AS pos, round(p, 6) AS p, "
       "round(max(p) OVER (PARTITION BY vec_id), 6) AS confidence FROM soft")
def softmax_confidence(spark, sf):
    z = F.col("z")
    rows = _scored(spark, sf).select(
        "vec_id", F.posexplode(vc.softmax(z)).alias("pos", "p"), vc.confidence(z).alias("confidence")
    )
    return rows.select("vec_id", "pos", r6("p").alias("p"), r6("confidence").alias("confidence"))


@query(f"""WITH {HEAD_SQL}, hits AS (SELECT vec_id, min(k) AS prediction FROM soft WHERE score = top GROUP BY vec_id)
SELECT label, round(avg(lse - score), 6) AS loss, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) AS n FROM soft JOIN hits USING (vec_id) WHERE k = label GROUP BY label""")
def cross_entropy(spark, sf):
    return mt.cross_entropy(_scored(spark, sf), "z", "label", ["label"]).select(
        "label", r6("loss").alias("loss"), r6("accuracy").alias("accuracy"), "n"
    )
