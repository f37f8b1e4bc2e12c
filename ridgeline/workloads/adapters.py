"""The given tables read as corpora, images, histories and version logs.

Each concept stands here twice, as DataFrame and as SQL, in the same words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators.running import numbered, numbered_by_range
from ridgeline.runtime import materialize
from ridgeline.workloads.registry import table

# ---------------------------------------------------------------- corpus
# Every event is a file: of two modalities for most users, of one for some. A name
# starts with three digits of the user, which are the subject; its prefix is the user.

FILES_SQL = """
files AS (
  SELECT event_id, modality,
    lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || 'u' || user_id
      || '_' || CASE WHEN event_id % 2 = 0 THEN 'L' ELSE 'R' END
      || CASE WHEN modality = 'fingerprint'
         THEN '_' || CASE event_id % 5 WHEN 0 THEN 'thumb' WHEN 1 THEN 'index' WHEN 2 THEN 'middle'
              WHEN 3 THEN 'ring' ELSE 'little' END ELSE '' END
      || '_' || lpad(CAST(event_id AS VARCHAR), 12, '0') || '.bmp' AS name
  FROM (SELECT *, CASE WHEN user_id % 7 = 0 THEN 'iris' WHEN user_id % 5 = 0 THEN 'fingerprint'
    WHEN event_type IN ('view', 'error') THEN 'fingerprint' ELSE 'iris' END AS modality FROM events)
)"""

SIDES_SQL = FILES_SQL + """,
sided AS (
  SELECT modality, modality || '/' || name AS path, substr(name, 1, 3) AS subject_id FROM files
),
iris AS (SELECT subject_id, path FROM sided WHERE modality = 'iris'),
fingerprint AS (SELECT subject_id, path FROM sided WHERE modality = 'fingerprint')"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, modality, name, path)``."""
    e, user = F.col("event_id"), F.col("user_id")
    modality = (
        F.when(user % 7 == 0, "iris").when(user % 5 == 0, "fingerprint")
        .when(F.col("event_type").isin("view", "error"), "fingerprint").otherwise("iris")
    )
    fingers = F.array(*[F.lit(x) for x in ("thumb", "index", "middle", "ring", "little")])
    name = F.concat(
        F.lpad((user % 1000).cast("string"), 3, "0"), F.lit("u"), user,
        F.lit("_"), F.when(e % 2 == 0, "L").otherwise("R"),
        F.when(modality == "fingerprint", F.concat(F.lit("_"), fingers[(e % 5).cast("int")])).otherwise(""),
        F.lit("_"), F.lpad(e.cast("string"), 12, "0"), F.lit(".bmp"),
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", modality.alias("modality"), name.alias("name"))
        .withColumn("path", F.concat_ws("/", "modality", "name"))
    )


# ---------------------------------------------------------------- images
# Embeddings as 8x8 gray images: 64 pixels in 0..255.

PIXELS_SQL = """
pixels AS (
  SELECT vec_id, label, unnest(range(0, 64)) AS pos,
    CAST(floor((CAST(unnest(embedding) AS DOUBLE) + 1) * 127.5) AS INTEGER) AS px
  FROM embeddings
)"""


def pixel_array(c: Column | str = "embedding") -> Column:
    return F.transform(c, lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int"))


def _bytes(values: Column) -> Column:
    """An array of 0..255 as bytes."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


def decoded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the image source gives them, both modalities of each embedding.

    The fingerprint of a vector is its pixels in reverse.
    """
    px = pixel_array()
    both = F.inline(F.array(
        F.struct(F.lit("iris").alias("modality"), px.alias("px")),
        F.struct(F.lit("fingerprint").alias("modality"), F.reverse(px).alias("px")),
    ))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", both)
    name = F.concat(F.lpad(F.col("vec_id").cast("string"), 12, "0"), F.lit(".bmp"))
    path = F.concat_ws("/", "modality", name)
    return rows.select(
        "vec_id",
        F.col("label").cast("string").alias("subject_id"),
        "modality",
        path.alias("path"),
        F.struct(
            path.alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"),
            F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), _bytes(F.col("px")).alias("data"),
        ).alias("image"),
        "px",
    )


def color_bytes(px: Column) -> Column:
    """Interleaved B, G, R: the pixel, its mirror image, and its complement."""
    triples = F.zip_with(px, F.reverse(px), lambda b, g: F.array(b, g, 255 - b))
    return _bytes(F.flatten(triples))


# -------------------------------------------------- labels and predictions

TRUE_PRED_SQL = """
scored AS (
  SELECT l_returnflag AS y,
    CASE WHEN l_linenumber % 4 = 0 THEN 'N' WHEN l_linestatus = 'O' THEN 'R' ELSE l_returnflag END AS p
  FROM lineitem
)"""


def true_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("l_returnflag")
    p = F.when(F.col("l_linenumber") % 4 == 0, "N").when(F.col("l_linestatus") == "O", "R").otherwise(y)
    return table(spark, sf_dir, "lineitem").select(y.alias("y"), p.alias("p"))


# ----------------------------------------------------------------- drift

DRIFT_CUT = "1998-01-01"
DRIFT_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "price_shifted")
CATEGORIES = ("l_linestatus", "l_returnflag")

DRIFT_SQL = """
drift AS (
  SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END AS is_ref,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN l_extendedprice
         ELSE l_extendedprice * 1.05::DOUBLE END AS price_shifted
  FROM lineitem
),
long AS (
  SELECT is_ref, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'price_shifted']) AS feature,
    unnest([l_quantity, l_extendedprice, l_discount, l_tax, price_shifted]) AS value
  FROM drift
),
sizes AS (
  SELECT feature, sum(is_ref)::DOUBLE AS n, sum(1 - is_ref)::DOUBLE AS m FROM long GROUP BY feature
),
counts AS (
  SELECT feature, value, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM long GROUP BY feature, value
),
gaps AS (
  SELECT feature, value, n, m,
    lead(value) OVER (PARTITION BY feature ORDER BY value) AS next_value,
    sum(r) OVER (PARTITION BY feature ORDER BY value) / n
      - sum(c) OVER (PARTITION BY feature ORDER BY value) / m AS gap
  FROM counts JOIN sizes USING (feature)
),
ks AS (
  SELECT feature, max(abs(gap)) AS d, any_value(n) AS n, any_value(m) AS m FROM gaps GROUP BY feature
)"""


def ks_p_sql(x: str) -> str:
    """The p-value series in SQL at ``x``."""
    tail = f"list_sum([2.0 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * ({x}) * ({x})) for k in range(1, 11)])"
    body = f"(sqrt(2 * pi()) / ({x})) * list_sum([exp(-((2 * k - 1) * (2 * k - 1)) * pi() * pi() / 8 / (({x}) * ({x}))) for k in range(1, 11)])"
    return f"least(greatest(CASE WHEN ({x}) >= 1 THEN {tail} WHEN ({x}) > 0 THEN 1.0 - {body} ELSE 1.0 END, 0.0), 1.0)"


_ROOT = "sqrt(n * m / (n + m))"
KS_SQL = ks_p_sql(f"(d * {_ROOT})")


def chi_tail_sql(statistic: str, df: str) -> str:
    """Upper tail of chi-square: one minus the series of the incomplete gamma function."""
    t, a = f"(({statistic}) / 2)", f"(({df}) / 2.0::DOUBLE)"
    series = f"list_sum([exp(({a} + k) * ln({t}) - {t} - lgamma({a} + k + 1)) for k in range(0, 1500)])"
    return f"CASE WHEN ({df}) = 0 OR ({statistic}) <= 0 THEN 1.0 WHEN {t} > 500 THEN 0.0 ELSE greatest(1 - {series}, 0.0) END"


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference and current rows of lineitem; the price column of the latter is shifted."""
    li = table(spark, sf_dir, "lineitem")
    old = F.col("l_shipdate") < F.lit(DRIFT_CUT).cast("timestamp_ntz")
    kept = [*DRIFT_COLUMNS[:4], *CATEGORIES]
    price = F.col("l_extendedprice")
    return (
        li.where(old).select(*kept, price.alias("price_shifted")),
        li.where(~old).select(*kept, (price * 1.05).alias("price_shifted")),
    )


METRICS_SQL = """
baseline AS (
  SELECT event_type AS metric, avg(value) AS value FROM events
  WHERE ts < TIMESTAMP '2024-01-16' GROUP BY event_type
),
present AS (
  SELECT event_type AS metric, avg(value) AS value FROM events
  WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY event_type
)"""


def metric_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Average value per event type: the first 15 days and the rest."""
    ev = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return tuple(
        ev.where(side).groupBy(F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
        for side in (early, ~early)
    )


# --------------------------------------------------------------- history

HISTORY_SQL = """
runs AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS epoch,
    value AS loss
  FROM events
)"""

EVENTS_PER_SEGMENT = 100_000


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, epoch, loss)``: a user's events in order are the epochs of a run."""
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "event_id", F.col("value").alias("loss")
    )
    segment = F.floor(F.col("event_id") / EVENTS_PER_SEGMENT)
    return numbered(ev, ["run_id"], segment, ["event_id"], "epoch").drop("event_id")


def stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs as a written table, for jobs that read them several times."""
    return materialize(runs(spark, sf_dir), "runs")


def long_history(history: DataFrame) -> DataFrame:
    """``(run_id, epoch, metric, value)`` with four metrics per epoch of ``runs``."""
    loss = F.col("loss")
    rows = [
        ("train_loss", loss * 0.9), ("train_acc", 1 / (1 + loss * 0.9)),
        ("val_loss", loss), ("val_acc", 1 / (1 + loss)),
    ]
    return history.select("run_id", "epoch", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in rows
    ])))


# -------------------------------------------------------------- versions

LOG_SQL = """
log AS (
  SELECT o_custkey AS model,
    CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS version,
    o_orderdate AS event_ts,
    CASE o_orderstatus WHEN 'P' THEN 'champion' WHEN 'O' THEN 'challenger' ELSE 'archived' END AS alias,
    floor(o_totalprice / 60) / 10000 AS f1,
    o_orderpriority AS priority
  FROM orders
),
holders AS (
  SELECT model, alias, version, f1, event_ts FROM log
  QUALIFY row_number() OVER (PARTITION BY model, alias ORDER BY event_ts DESC, version DESC) = 1
),
finalists AS (
  SELECT model,
    max(version) FILTER (WHERE alias = 'champion') AS champion,
    max(version) FILTER (WHERE alias = 'challenger') AS challenger,
    max(f1) FILTER (WHERE alias = 'champion') AS champion_f1,
    max(f1) FILTER (WHERE alias = 'challenger') AS challenger_f1
  FROM holders GROUP BY model
)"""


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version log as a written table, for jobs that read it several times."""
    return materialize(version_log(spark, sf_dir), "version-log")


def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders in time are the versions of a model."""
    status = F.col("o_orderstatus")
    alias = F.when(status == "P", "champion").when(status == "O", "challenger").otherwise("archived")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("model"),
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("event_ts"),
        alias.alias("alias"),
        F.create_map(F.lit("alias"), alias, F.lit("priority"), F.col("o_orderpriority")).alias("tags"),
        F.create_map(F.lit("f1_macro"), F.floor(F.col("o_totalprice") / 60) / 10000).alias("metrics"),
    )
    log = numbered_by_range(rows, ["model"], ["event_ts", "o_orderkey"], "version")
    return log.select(
        "model", F.col("version").cast("int").alias("version"), "event_ts",
        F.lit(0).cast("long").alias("seq"), "alias", "tags", "metrics",
    )


# ------------------------------------------------------------- centroids

CENTROID_SQL = """
coords AS (
  SELECT vec_id, label, unnest(range(0, 64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
),
centroids AS (
  SELECT label AS class, pos, avg(x) AS c FROM coords WHERE {fit} GROUP BY label, pos
),
bias AS (SELECT class, sum(c * c) / 2 AS half FROM centroids GROUP BY class),
z AS (
  SELECT vec_id, label, class, sum(x * c) - any_value(half) AS score
  FROM coords JOIN centroids USING (pos) JOIN bias USING (class)
  WHERE {use} GROUP BY vec_id, label, class
),
best AS (
  SELECT vec_id, label, class AS prediction, score AS top FROM z
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) = 1
),
predictions AS (
  SELECT best.vec_id, any_value(best.label) AS label, any_value(prediction) AS prediction,
    1 / sum(exp(score - top)) AS confidence
  FROM best JOIN z USING (vec_id) GROUP BY best.vec_id
)"""


def split_sql(relation: str, key: str, seed: int = 42) -> str:
    """CTE ``parts``: the key with its split by hash order."""
    return f"""
ranked AS (
  SELECT {key}, row_number() OVER (ORDER BY md5('{seed}:' || {key})) AS pos, count(*) OVER () AS total
  FROM {relation}
),
parts AS (
  SELECT {key}, CASE
    WHEN pos <= floor(total * 0.7::DOUBLE) THEN 'train'
    WHEN pos <= floor(total * 0.7::DOUBLE) + floor(total * 0.15::DOUBLE) THEN 'val'
    ELSE 'test' END AS split
  FROM ranked
)"""
