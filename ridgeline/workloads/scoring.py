"""Classifiers, batch scoring, evaluation, exports, streams."""

from __future__ import annotations

from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from ridgeline.functions.bitmaps import raw_pixels
from ridgeline.functions.pixels import to_gray
from ridgeline.operators import classifier as cl
from ridgeline.operators import drift as dr
from ridgeline.operators import labels as lb
from ridgeline.operators import metrics as mt
from ridgeline.operators import scoring as sc
from ridgeline.operators import versions as vs
from ridgeline.operators.splits import exact_split
from ridgeline.plans import corpus_jobs as jobs
from ridgeline.plans import daily
from ridgeline.plans import monitoring as mon
from ridgeline.plans import retraining as rt
from ridgeline.plans.evaluation import centroid_experiment
from ridgeline.runtime import materialize, scratch_path
from ridgeline.sources import corpus as cp
from ridgeline.sources import tables as tb
from ridgeline.streaming.scoring import stream_score as run_stream_score
from ridgeline.workloads.adapters import (
    CENTROID_SQL,
    TRUE_PRED_SQL,
    decoded_images,
    drift_sides,
    pixel_array,
    split_sql,
    true_pred,
)
from ridgeline.workloads.bitmaps import write_bitmaps
from ridgeline.workloads.drift import DATA_DRIFT_SQL, PAIR_FEATURES_SQL, _NAMES, _pair_features
from ridgeline.workloads.metrics import PER_CLASS_SQL, RECORD_SQL, rounded_record
from ridgeline.workloads.registry import arriving, query, r6, table

ALL_SQL = CENTROID_SQL.format(fit="true", use="true")


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").withColumn("subject_id", F.col("vec_id").cast("string"))


def _centroids(df):
    return sc.centroid_scorer(sc.centroid_fit(df, "embedding"))


_ROWS = "round(confidence, 6) AS confidence, prediction = label AS correct"


@query(f"""WITH {ALL_SQL} SELECT CAST(vec_id AS VARCHAR) AS subject_id, prediction, label, {_ROWS} FROM predictions""")
def centroid_classify(spark, sf):
    df = _vectors(spark, sf)
    return sc.score_table(df, _centroids(df)).withColumn("confidence", r6("confidence"))


# Labels come from the dictionary of training, embeddings ride along.
@query(f"""WITH {ALL_SQL}, sums AS (SELECT vec_id, sum(x) AS total FROM coords GROUP BY vec_id)
SELECT CAST(vec_id AS VARCHAR) AS subject_id, prediction, label, {_ROWS}, round(total, 5) + 0.0::DOUBLE AS embedding_sum
FROM predictions JOIN sums USING (vec_id)""")
def score_table(spark, sf):
    df = _vectors(spark, sf)
    dictionary = df.select("subject_id", "label")
    scored = sc.score_table(df, _centroids(df), labels=dictionary, with_embeddings=True)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return scored.select(
        "subject_id", "prediction", "label", r6("confidence").alias("confidence"), "correct",
        (F.round(total, 5) + F.lit(0.0)).alias("embedding_sum"),
    )


_SPLIT_CENTROIDS = CENTROID_SQL.format(
    fit="vec_id IN (SELECT vec_id FROM parts WHERE split = 'train')",
    use="vec_id IN (SELECT vec_id FROM parts WHERE split = '{split}')",
)


def _experiment_sql(split: str) -> str:
    scored = f"{split_sql('embeddings', 'vec_id')}, {_SPLIT_CENTROIDS.format(split=split)}, scored AS (SELECT label AS y, prediction AS p FROM predictions)"
    return f"WITH {PER_CLASS_SQL.replace(TRUE_PRED_SQL, scored)} SELECT {RECORD_SQL} FROM record"


@query(_experiment_sql("test"))
def evaluate_split(spark, sf):
    # An unknown split means test.
    return rounded_record(centroid_experiment(
        table(spark, sf, "embeddings"), "vec_id", "embedding", split="holdout"
    ))


@query(_experiment_sql("val"))
def evaluate_val_split(spark, sf):
    return rounded_record(centroid_experiment(
        table(spark, sf, "embeddings"), "vec_id", "embedding", split="val"
    ))


@query(f"""WITH {ALL_SQL}, bad AS (
  SELECT vec_id, CASE WHEN label = 3 THEN NULL ELSE prediction END AS prediction,
    CASE WHEN label = 4 THEN confidence + 1 ELSE confidence END AS confidence FROM predictions
  UNION ALL SELECT vec_id, prediction + 100, confidence FROM predictions WHERE label = 5)
SELECT 'null_value' AS rule, count(*) FILTER (WHERE prediction IS NULL) AS violations FROM bad
UNION ALL SELECT 'confidence_range', count(*) FILTER (WHERE confidence > 1) FROM bad
UNION ALL SELECT 'unknown_label', count(*) FILTER (WHERE prediction >= 100) FROM bad
UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT vec_id) FROM bad""")
def validate_predictions(spark, sf):
    df = _vectors(spark, sf)
    # Checks run on a written prediction table.
    good = materialize(sc.score_table(df, _centroids(df)), "predictions")
    label = F.col("label")
    broken = good.withColumns({
        "prediction": F.when(label != 3, F.col("prediction")),
        "confidence": F.when(label == 4, F.col("confidence") + 1).otherwise(F.col("confidence")),
    })
    repeated = good.where(label == 5).withColumn("prediction", F.col("prediction") + 100)
    dictionary = df.select("label").distinct()
    return sc.validate_predictions(broken.unionByName(repeated), dictionary)


# -------------------------------------------------------------- Spark ML

# A fit is certified, not compared: the gradient at its optimum is zero, and a second one predicts the same.
@query("""SELECT count(*) AS rows, count(DISTINCT label) AS classes, true AS at_optimum, CAST(0 AS BIGINT) AS changed,
  true AS confident FROM embeddings WHERE label IS NOT NULL""")
def train_classifier(spark, sf):
    df = _vectors(spark, sf)
    model, again = (cl.train_classifier(df, max_iter=200) for _ in range(2))
    first = cl.model_scores(df, model).select("subject_id", "prediction", F.col("confidence").alias("first"))
    both = cl.model_scores(df, again).select("subject_id", F.col("prediction").alias("second"), "confidence").join(first, "subject_id")
    seen = both.agg(
        F.count_if(F.col("prediction") != F.col("second")).alias("changed"),
        F.bool_and(F.col("confidence").between(0.0, 1.0)).alias("confident"),
    )
    return cl.gradient_norm(df, model).select("rows", "classes", (F.col("norm") < 1e-3).alias("at_optimum")).crossJoin(seen)


# Fewer steps than to an optimum: the loss must be below that of guessing, and a seeded repeat the same.
@query("SELECT count(*) AS rows, true AS learned, CAST(0 AS BIGINT) AS changed FROM embeddings")
def train_perceptron(spark, sf):
    df = _vectors(spark, sf)
    model, again = (cl.train_classifier(df, kind="perceptron", hidden=32, max_iter=20) for _ in range(2))
    first = cl.model_scores(df, model).select("subject_id", "prediction")
    both = cl.model_scores(df, again).select("subject_id", F.col("prediction").alias("second")).join(first, "subject_id")
    guess = F.log(df.agg(F.count_distinct("label").cast("double")).scalar())
    seen = both.agg(F.count("*").alias("rows"), F.count_if(F.col("prediction") != F.col("second")).alias("changed"))
    return cl.cross_entropy_of(df, model).select((F.col("loss") < guess).alias("learned")).crossJoin(seen)


@query("SELECT true AS goes_on, true AS same_start FROM (SELECT count(*) FROM embeddings)")
def model_resume(spark, sf):
    """Training resumed from a stored model: no step starts where it ended, more steps end lower."""
    df = _vectors(spark, sf)
    path = scratch_path(spark, "model")
    cl.save_model(cl.train_classifier(df, kind="perceptron", hidden=16, max_iter=5), path)
    stored = cl.load_model(path)
    more = cl.train_classifier(df, kind="perceptron", hidden=16, max_iter=15, start=stored)
    loss = [cl.cross_entropy_of(df, m).select(F.col("loss").alias(n)) for m, n in ((stored, "before"), (more, "after"))]
    fresh = cl.train_classifier(df, kind="perceptron", hidden=16, max_iter=1).stages[-1].weights
    one = cl.train_classifier(df, kind="perceptron", hidden=16, max_iter=1, start=stored).stages[-1].weights
    near = float(one.squared_distance(stored.stages[-1].weights)) < float(one.squared_distance(fresh))
    return loss[0].crossJoin(loss[1]).select((F.col("after") < F.col("before")).alias("goes_on"), F.lit(near).alias("same_start"))


# A stored model must predict as before.
@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed FROM embeddings")
def model_roundtrip(spark, sf):
    df = _vectors(spark, sf)
    model = cl.train_classifier(df, max_iter=5)
    path = scratch_path(spark, "model")
    cl.save_model(model, path)
    before = cl.model_scores(df, model).withColumnRenamed("prediction", "before")
    after = cl.model_scores(before.drop("confidence"), cl.load_model(path))
    return after.agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("before")).alias("changed")
    )


# ------------------------------------------------------- written and read

@query(f"""WITH {ALL_SQL} SELECT CAST(vec_id AS VARCHAR) AS subject_id, prediction, label, {_ROWS} FROM predictions""")
def prediction_export(spark, sf):
    df = _vectors(spark, sf)
    scored = sc.score_table(df, _centroids(df))
    path = scratch_path(spark, "predictions")
    tb.export_predictions(scored, path, "csv")
    back = spark.read.schema(scored.schema).csv(path, header=True)
    return back.withColumn("confidence", r6("confidence"))


@query(f"""WITH {ALL_SQL} SELECT CAST(vec_id AS VARCHAR) AS subject_id, prediction, label, {_ROWS} FROM predictions""")
def prediction_export_parquet(spark, sf):
    df = _vectors(spark, sf)
    path = scratch_path(spark, "predictions")
    tb.export_predictions(sc.score_table(df, _centroids(df)), path)
    return spark.read.parquet(path).withColumn("confidence", r6("confidence"))


@query("""SELECT CAST(label AS VARCHAR) AS subject_id, m.modality,
  m.modality || '/' || lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.bmp' AS path,
  array_to_string(CASE m.modality WHEN 'iris' THEN px ELSE list_reverse(px) END, ' ') AS pixels
FROM (SELECT *, [CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER) for x in embedding] AS px FROM embeddings),
  (SELECT unnest(['iris', 'fingerprint']) AS modality) m""")
def feature_roundtrip(spark, sf):
    """Every value of both modalities, written and read."""
    rows = decoded_images(spark, sf)
    features = rows.select("subject_id", "modality", F.col("px").cast("array<float>").alias("features"), "path")
    path = scratch_path(spark, "features")
    tb.write_features(features, path)
    return tb.read_features(spark, path, ["subject_id", "modality", "path", "features"]).select(
        "subject_id", "modality", "path", F.array_join(F.col("features").cast("array<int>"), " ").alias("pixels")
    )


@query("""SELECT CAST(label AS VARCHAR) AS subject_id, CAST(row_number() OVER (ORDER BY CAST(label AS VARCHAR)) - 1
  AS INTEGER) AS label FROM (SELECT DISTINCT label FROM embeddings)""")
def feature_label_map(spark, sf):
    rows = decoded_images(spark, sf).select("subject_id", "path", "px")
    path = scratch_path(spark, "features")
    tb.write_features(rows, path)
    return tb.feature_labels(tb.read_features(spark, path))


@query(f"""WITH {PAIR_FEATURES_SQL} SELECT CAST(label AS VARCHAR) AS subject_id, {', '.join(_NAMES)}
FROM iris_stats JOIN finger_stats USING (label)""")
def reference_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "reference")
    tb.write_reference(_pair_features(spark, sf), path)
    return tb.read_reference(spark, path).select("subject_id", *[r6(c).alias(c) for c in _NAMES])


@query(f"WITH {PER_CLASS_SQL} SELECT {RECORD_SQL} FROM record")
def report_json(spark, sf):
    record = mt.evaluate(true_pred(spark, sf), "y", "p")
    path = scratch_path(spark, "report")
    tb.write_report(record, path)
    return rounded_record(tb.read_report(spark, path, record.schema))


CORPUS_SQL = """WITH px AS (SELECT vec_id, unnest([CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER)
  for x in embedding]) AS px FROM embeddings),
sums AS (SELECT vec_id, sum(px) AS total FROM px GROUP BY vec_id)"""


def _bitmaps(spark, sf) -> str:
    """The images as files, written by tasks to the shared folder."""
    root = scratch_path(spark, "corpus")
    write_bitmaps(decoded_images(spark, sf).select("path", "image"), root)
    return root


@query(f"""{CORPUS_SQL} SELECT m.modality, lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.bmp' AS name,
  8 AS height, 8 AS width, CAST(total AS DOUBLE) AS total FROM sums,
  (SELECT unnest(['iris', 'fingerprint']) AS modality) m""")
def corpus_scan(spark, sf):
    images = cp.scan_corpus(spark, _bitmaps(spark, sf))
    gray = to_gray(F.col("image.data"), F.col("image.nChannels"))
    return images.select(
        "modality", "name", F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.aggregate(gray, F.lit(0.0), lambda s, v: s + v).alias("total"),
    )


@query(f"""{CORPUS_SQL} SELECT m.modality, lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.bmp' AS name,
  CAST(246 AS BIGINT) AS length, CAST(total AS BIGINT) AS total FROM sums,
  (SELECT unnest(['iris', 'fingerprint']) AS modality) m""")
def corpus_tree(spark, sf):
    """Many folders, listed level by level in tasks; the files found are read by a plan of bytes."""
    root = scratch_path(spark, "corpus-tree")
    folder = F.format_string("%02d/%03d/", F.col("number") % 7, F.col("number") % 200)
    images = decoded_images(spark, sf).withColumn("number", F.regexp_extract("path", r"(\d+)[.]bmp$", 1).cast("long"))
    write_bitmaps(images.select(F.concat(folder, "path").alias("path"), "image"), root)
    listed = cp.list_files(spark, root)
    read = cp.read_manifest(listed, target_bytes=8 << 20).select("path", raw_pixels("content").alias("pixels"))
    total = F.aggregate("pixels", F.lit(0).cast("long"), lambda s, v: s + v.cast("long")).alias("total")
    return listed.join(read.select("path", total), "path").select("modality", "name", "length", "total")


@query("SELECT count(*) AS iris, count(*) AS fingerprint, count(*) > 0 AS valid FROM embeddings")
def corpus_scan_verify(spark, sf):
    return cp.verify_corpus(cp.list_corpus(spark, _bitmaps(spark, sf)))


# ------------------------------------------------------------ corpus jobs

def _subject_bitmaps(spark, sf) -> str:
    """The same with names that begin with the subject: three digits of its label."""
    root = scratch_path(spark, "corpus")
    subject = F.lpad(F.col("subject_id"), 3, "0")
    name = F.concat("modality", F.lit("/"), subject, F.lit("_L_"), F.lpad(F.col("vec_id").cast("string"), 12, "0"), F.lit(".bmp"))
    write_bitmaps(decoded_images(spark, sf).select(name.alias("path"), "image"), root)
    return root


_FILE_NAME = "lpad(CAST(label AS VARCHAR), 3, '0') || '_L_' || lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.bmp'"


@query(f"""WITH {PAIR_FEATURES_SQL} SELECT {_FILE_NAME} AS name, lpad(CAST(label AS VARCHAR), 3, '0') AS subject_id, {', '.join(_NAMES)}
FROM iris_stats JOIN finger_stats USING (label)""")
def corpus_features(spark, sf):
    made = jobs.corpus_features(spark, _subject_bitmaps(spark, sf))
    return made.select(F.substring_index("path", "/", -1).alias("name"), "subject_id", *[r6(c).alias(c) for c in _NAMES])


@query(f"""WITH {PAIR_FEATURES_SQL} SELECT {_FILE_NAME} AS name, lpad(CAST(label AS VARCHAR), 3, '0') AS subject_id, {', '.join(_NAMES)}
FROM iris_stats JOIN finger_stats USING (label)""")
def corpus_manifest(spark, sf):
    """The same from a table of paths, without a listing."""
    root = _subject_bitmaps(spark, sf)
    paths = cp.list_corpus(spark, root).select("path")
    made = jobs.corpus_features(spark, materialize(paths, "manifest"))
    return made.select(F.substring_index("path", "/", -1).alias("name"), "subject_id", *[r6(c).alias(c) for c in _NAMES])


# A corpus against itself has no drift; the model lost a fifth.
@query("""SELECT false AS data_drift, 0.0::DOUBLE AS data_score, true AS model_drift, 'critical' AS overall_status
FROM (SELECT count(*) AS n FROM embeddings) WHERE n > 0""")
def monitor_corpus(spark, sf):
    root = _subject_bitmaps(spark, sf)
    path = scratch_path(spark, "reference")
    tb.write_reference(jobs.corpus_features(spark, root), path)
    metrics = [spark.createDataFrame([("f1_macro", v)], "metric string, value double") for v in (0.8, 0.64)]
    report = jobs.monitor_corpus(spark, root, tb.read_reference(spark, path), *metrics)
    return report.select("data_drift", "data_score", "model_drift", "overall_status")


_LIKE_DRIFT = DATA_DRIFT_SQL[DATA_DRIFT_SQL.index("sizes AS"):]


@query(f"""WITH {PAIR_FEATURES_SQL}, rows AS (SELECT label, {', '.join(_NAMES)} FROM iris_stats JOIN finger_stats USING (label)),
sides AS (SELECT 1 AS is_ref, * FROM rows WHERE label < 5 UNION ALL SELECT 0, * FROM rows),
long AS (SELECT is_ref, unnest([{', '.join(repr(n) for n in _NAMES)}]) AS feature, unnest([{', '.join(_NAMES)}]) AS value FROM sides),
{_LIKE_DRIFT}
SELECT k / n > 0.2 AS data_drift, round(k / n, 6) AS data_score, false AS model_drift, 0.0::DOUBLE AS model_score FROM verdict""")
def monitor_corpus_shifted(spark, sf):
    """A reference of half of the classes: what a folder of all of them drifted by."""
    root = _subject_bitmaps(spark, sf)
    path = scratch_path(spark, "reference")
    tb.write_reference(jobs.corpus_features(spark, root).where("subject_id < '005'"), path)
    metrics = [spark.createDataFrame([("f1_macro", 0.8)], "metric string, value double") for _ in range(2)]
    report = jobs.monitor_corpus(spark, root, tb.read_reference(spark, path), *metrics)
    return report.select("data_drift", r6("data_score").alias("data_score"), "model_drift", r6("model_score").alias("model_score"))


# The features of an image are its 64 pixels over 255; both images of a vector are fused by their mean, that is
# (px + reversed px) / 510, and the nearest centroid of the first fingerprint's pairs is asked for.
SCORE_CORPUS_SQL = f"""WITH px AS (
  SELECT vec_id, label, [CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER) for x in embedding] AS px FROM embeddings
),
firsts AS (SELECT label, min(vec_id) AS vec_id FROM px GROUP BY label),
fingers AS (SELECT firsts.label, list_reverse(px) AS fx FROM firsts JOIN px USING (vec_id)),
pairs AS (SELECT vec_id, px.label, px, fx FROM px JOIN fingers ON fingers.label = px.label),
fused AS (
  SELECT vec_id, label, unnest(range(0, 128)) AS pos, unnest(list_concat(px, fx)) / 255.0::DOUBLE AS x FROM pairs
),
centroids AS (SELECT label AS class, pos, avg(x) AS c FROM fused GROUP BY label, pos),
bias AS (SELECT class, sum(c * c) / 2 AS half FROM centroids GROUP BY class),
z AS (
  SELECT vec_id, label, class, sum(x * c) - any_value(half) AS score FROM fused JOIN centroids USING (pos) JOIN bias USING (class)
  GROUP BY vec_id, label, class
),
best AS (SELECT vec_id, label, class, score AS top FROM z QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) = 1)
SELECT {_FILE_NAME} AS name, lpad(CAST(label AS VARCHAR), 3, '0') AS subject_id, prediction, label,
  round(confidence, 4) AS confidence, prediction = label AS correct
FROM (SELECT best.vec_id, any_value(best.label) AS label, any_value(best.class) AS prediction, 1 / sum(exp(score - top)) AS confidence
  FROM best JOIN z USING (vec_id) GROUP BY best.vec_id)"""


@query(SCORE_CORPUS_SQL)
def score_corpus(spark, sf):
    """Folder to exported prediction table: decode, pair, fuse, score by a stored model and dictionary."""
    root = _subject_bitmaps(spark, sf)
    pairs = spark.read.parquet(f"{sf}/embeddings.parquet")
    px = F.transform(pixel_array(), lambda v: v / F.lit(255.0))
    rows = pairs.select("vec_id", "label", px.alias("iris"))
    first = rows.groupBy("label").agg(F.min_by(F.reverse("iris"), "vec_id").alias("finger"))
    fused = rows.join(first, "label").select("label", F.concat("iris", "finger").alias("fused"))
    model = sc.centroid_scorer(sc.centroid_fit(fused, "fused"))
    labels = scratch_path(spark, "labels")
    named = pairs.select(F.lpad(F.col("label").cast("string"), 3, "0").alias("subject_id"), "label").distinct()
    lb.save_labels(named, labels)
    out = scratch_path(spark, "predictions")
    made = jobs.score_corpus(
        spark, root, model, lb.load_labels(spark, labels), size=(8, 8), normalize=False, export=out, keep=["iris_path"]
    )
    exported = spark.read.parquet(out).groupBy("subject_id", "prediction").agg(F.count("*").alias("n"))
    same = made.groupBy("subject_id", "prediction").agg(F.count("*").alias("m")).join(exported, ["subject_id", "prediction"]).where("n = m")
    return made.join(same.select("subject_id", "prediction"), ["subject_id", "prediction"]).select(
        F.substring_index("iris_path", "/", -1).alias("name"), "subject_id", "prediction", "label",
        F.round("confidence", 4).alias("confidence"), "correct",
    )


# ------------------------------------------------------------- retraining

def _half_sql(rows: str) -> str:
    scored = f"{split_sql('embeddings', 'vec_id')}, {CENTROID_SQL.format(fit='vec_id IN (' + rows + ')', use=_TEST)}, scored AS (SELECT label AS y, prediction AS p FROM predictions)"
    return f"WITH {PER_CLASS_SQL.replace(TRUE_PRED_SQL, scored)}"


_TEST = "vec_id IN (SELECT vec_id FROM parts WHERE split = 'test')"
_TRAIN = "SELECT vec_id FROM parts WHERE split = 'train'"
_FEW = f"{_TRAIN} AND vec_id % 10 = 0"
AT = datetime(2030, 1, 1)


def _logged_champion(spark, sf):
    """Vectors, and a log whose champion was fitted on a tenth of the training rows."""
    df = _vectors(spark, sf)
    few = exact_split(df, "vec_id").where("split = 'train' and vec_id % 10 = 0")
    model = sc.centroid_scorer(sc.centroid_fit(few, "embedding"))
    log = spark.createDataFrame(
        [("m", 1, datetime(2029, 1, 1), 0, "archived", {}, {}), ("m", 2, datetime(2029, 1, 2), 0, "champion", {"model_path": model.path}, {})],
        "model string, version int, event_ts timestamp, seq long, alias string, tags map<string,string>, metrics map<string,double>",
    )
    return df, log


@query(f"""SELECT *, CASE WHEN promoted THEN 3 ELSE 2 END AS holder, CASE WHEN promoted THEN 0 ELSE 1 END AS challengers FROM (
  SELECT round(a, 6) AS champion_value, round(b, 6) AS challenger_value,
    CASE WHEN a > 0 THEN (b - a) / a ELSE 'inf'::DOUBLE END > 0.01 AS promoted, 'f1_macro' AS metric
  FROM (SELECT ({_half_sql(_FEW)} SELECT f1_macro FROM record) AS a, ({_half_sql(_TRAIN)} SELECT f1_macro FROM record) AS b))""")
def retrain_pipeline(spark, sf):
    df, log = _logged_champion(spark, sf)
    done = rt.retrain_pipeline(df, log, "m", "vec_id", "embedding", AT)
    holders = materialize(vs.alias_holders(done.log), "holders")
    holder = holders.where("alias = 'champion'").select("version").scalar()
    challengers = holders.where("alias = 'challenger'").agg(F.count("*").cast("int")).scalar()
    return done.comparison.select(
        r6("champion_value").alias("champion_value"), r6("challenger_value").alias("challenger_value"), "promoted", "metric",
        holder.alias("holder"), challengers.alias("challengers"),
    )


@query(f"""SELECT *, CASE WHEN promoted THEN 3 ELSE 2 END AS holder FROM (
  SELECT round(a, 6) AS champion_value, round(b, 6) AS challenger_value, round(b, 6) AS stored_value,
    CASE WHEN a > 0 THEN (b - a) / a ELSE 'inf'::DOUBLE END > 0.01 AS promoted
  FROM (SELECT ({_half_sql(_FEW)} SELECT f1_macro FROM record) AS a, ({_half_sql(_TRAIN)} SELECT f1_macro FROM record) AS b))""")
def retrain_head(spark, sf):
    """A challenger of another kind: head parameters, whose rows are the class means, against stored centroids."""
    df, log = _logged_champion(spark, sf)

    def fit(train):
        # Ten classes by the table's definition.
        means = np.array([r.centroid for r in sc.centroid_fit(train, "embedding").orderBy("label").collect()])
        return {"w": means, "b": -(means**2).sum(axis=1) / 2}

    done = rt.retrain_pipeline(df, log, "m", "vec_id", "embedding", AT, fit=fit, store=scratch_path(spark, "store"))
    after = materialize(done.log, "version-log")
    holder = vs.alias_holders(after).where("alias = 'champion'").select("version").scalar()
    again = rt.evaluate_from_log(df, after, "m", "vec_id", "embedding", AT, version=3)
    return done.comparison.select(
        r6("champion_value").alias("champion_value"), r6("challenger_value").alias("challenger_value"),
        again.select(r6("f1_macro")).scalar().alias("stored_value"), "promoted", holder.alias("holder"),
    )


@query(f"SELECT *, 2 AS version, true AS stored FROM ({_half_sql(_FEW)} SELECT {RECORD_SQL} FROM record)")
def evaluate_from_log(spark, sf):
    df, log = _logged_champion(spark, sf)
    record = rt.evaluate_from_log(df, log, "m", "vec_id", "embedding", AT)
    extra = record.select("version", F.col("model_path").isNotNull().alias("stored"))
    return rounded_record(record).crossJoin(extra)


# With one place for each of four groups, the best class shares are those of the group: the loss is their entropy.
@query("""WITH cells AS (SELECT vec_id % 4 AS g, label, count(*) AS n FROM embeddings GROUP BY ALL),
shares AS (SELECT n, n / sum(n) OVER (PARTITION BY g) AS p FROM cells)
SELECT CAST(sum(n) AS BIGINT) AS rows, (SELECT count(DISTINCT label) FROM cells) AS classes, round(-sum(n * ln(p)) / sum(n), 3) AS loss FROM shares""")
def train_closed_form(spark, sf):
    """A case whose optimum is known: the fitted loss is a number SQL can tell."""
    group = F.array(*[(F.col("vec_id") % 4 == g).cast("double") for g in range(4)])
    rows = table(spark, sf, "embeddings").select(group.alias("x"), "label")
    model = cl.train_classifier(rows, "x", reg=0.0, max_iter=200)
    loss = cl.cross_entropy_of(rows, model, "x").select(F.round("loss", 3)).scalar()
    return cl.gradient_norm(rows, model, "x", reg=0.0).select("rows", "classes", loss.alias("loss"))


@query(f"""WITH {DATA_DRIFT_SQL}, facts AS (
  SELECT (SELECT k / n FROM verdict) AS data_score, ({_half_sql(_FEW)} SELECT f1_macro FROM record) AS f1,
    ({_half_sql(_FEW)} SELECT count(*) FROM predictions) AS scored, ({_half_sql(_FEW)} SELECT count(*) FROM predictions WHERE prediction = 3) AS unknown
)
SELECT 2 AS version, scored, unknown AS violations, data_score > 0.2 AS data_drift, round(data_score, 6) AS data_score,
  1 - f1 > 0.05 AS model_drift, round(1 - f1, 6) + 0.0::DOUBLE AS model_score FROM facts""")
def daily_run(spark, sf):
    """The champion of the log scores the test split; a dictionary without one class; drift against a stored profile."""
    df, log = _logged_champion(spark, sf)
    log = log.withColumn("metrics", F.create_map(F.lit("f1_macro"), F.lit(1.0)))
    ref, cur = drift_sides(spark, sf)
    path = scratch_path(spark, "profile")
    mon.save_profile(dr.feature_profile(ref), path)
    rows = exact_split(df, "vec_id").where("split = 'test'")
    known = df.select("label").distinct().where("label <> 3")
    done = daily.daily_run(rows, log, "m", "embedding", scratch_path(spark, "predictions"), known, mon.load_profile(spark, path), cur)
    scored, violations = done.predictions.agg(F.count("*")).scalar(), done.violations.agg(F.sum("violations").cast("long")).scalar()
    return done.report.select(
        F.lit(done.version).alias("version"), scored.alias("scored"), violations.alias("violations"), "data_drift",
        r6("data_score").alias("data_score"), "model_drift", r6("model_score").alias("model_score"),
    )


# ---------------------------------------------------------------- streams

@query(f"""WITH {ALL_SQL} SELECT CAST(vec_id AS VARCHAR) AS subject_id, prediction, label, {_ROWS} FROM predictions""")
def stream_score(spark, sf):
    df = _vectors(spark, sf)
    model = _centroids(df)
    source = arriving(spark, sf, "embeddings").withColumn("subject_id", F.col("vec_id").cast("string"))
    sink, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    run_stream_score(source, lambda rows: sc.score_table(rows, model), sink, checkpoint).awaitTermination()
    return spark.read.parquet(sink).withColumn("confidence", r6("confidence"))
