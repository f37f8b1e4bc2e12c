"""Classification metrics, losses, meters, model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions.change import relative_change, winner
from ridgeline.operators import metrics as mt
from ridgeline.workloads.adapters import METRICS_SQL, TRUE_PRED_SQL, metric_sides, true_pred
from ridgeline.workloads.registry import query, r6, table

PER_CLASS_SQL = TRUE_PRED_SQL + """,
classes AS (SELECT y AS class FROM scored UNION SELECT p FROM scored),
tallies AS (
  SELECT class, count(*) FILTER (WHERE y = class) AS support,
    count(*) FILTER (WHERE p = class) AS predicted, count(*) FILTER (WHERE y = class AND p = class) AS tp
  FROM classes JOIN scored ON y = class OR p = class GROUP BY class
),
rates AS (
  SELECT class, support, coalesce(tp / nullif(predicted, 0), 0)::DOUBLE AS p,
    coalesce(tp / nullif(support, 0), 0)::DOUBLE AS r FROM tallies
),
per_class AS (
  SELECT class, support, p AS precision, r AS recall,
    CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM rates
),
record AS (
  SELECT (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) FROM scored) AS accuracy,
    avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
    sum(precision * support) / sum(support) AS precision_weighted,
    sum(recall * support) / sum(support) AS recall_weighted,
    sum(f1 * support) / sum(support) AS f1_weighted,
    CAST(count(*) AS INTEGER) AS num_classes, CAST(sum(support) AS BIGINT) AS num_samples
  FROM per_class
)"""

RECORD_FIELDS = (
    "accuracy", "precision_macro", "recall_macro", "f1_macro",
    "precision_weighted", "recall_weighted", "f1_weighted",
)
RECORD_SQL = ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in RECORD_FIELDS) + ", num_classes, num_samples"


def rounded_record(df):
    return df.select(*[r6(c).alias(c) for c in RECORD_FIELDS], "num_classes", "num_samples")


@query(f"""WITH {TRUE_PRED_SQL} SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  count(*) AS num_samples FROM scored""")
def accuracy(spark, sf):
    return mt.accuracy(true_pred(spark, sf), "y", "p").select(r6("accuracy").alias("accuracy"), "num_samples")


@query(f"""WITH {TRUE_PRED_SQL}, classes AS (SELECT y AS c FROM scored UNION SELECT p FROM scored),
cells AS (SELECT y, p, count(*) AS n FROM scored GROUP BY y, p)
SELECT a.c AS label, b.c AS prediction, coalesce(n, 0) AS n FROM classes a CROSS JOIN classes b
LEFT JOIN cells ON y = a.c AND p = b.c""")
def confusion_matrix(spark, sf):
    return mt.confusion_matrix(true_pred(spark, sf), "y", "p", dense=True)


@query(f"WITH {TRUE_PRED_SQL} SELECT y AS label, p AS prediction, count(*) AS n FROM scored GROUP BY y, p")
def confusion_cells(spark, sf):
    return mt.confusion_matrix(true_pred(spark, sf), "y", "p")


# Every fifth line has no prediction: a sample that was missed, and no class of its own.
MISSED_SQL = """
missed AS (
  SELECT l_returnflag AS y, CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'R' ELSE l_returnflag END AS p
  FROM lineitem
)"""


@query(f"""WITH {PER_CLASS_SQL.replace(TRUE_PRED_SQL, MISSED_SQL).replace('scored', 'missed')
    .replace('SELECT p FROM missed', 'SELECT p FROM missed WHERE p IS NOT NULL')}
SELECT {RECORD_SQL}, (SELECT count(*) FROM missed WHERE p IS NULL) AS missed FROM record""")
def missing_predictions(spark, sf):
    line = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("y"),
        F.when(line % 5 == 0, None).when(F.col("l_linestatus") == "O", "R").otherwise(F.col("l_returnflag")).alias("p"),
    )
    cells = mt.confusion_matrix(rows, "y", "p").where("prediction is null").agg(F.sum("n").alias("missed"))
    plain = mt.accuracy(rows, "y", "p").select(r6("accuracy").alias("plain"), F.col("num_samples").alias("samples"))
    record = rounded_record(mt.evaluate(rows, "y", "p"))
    # Both ways to accuracy agree.
    return record.join(plain, (record.accuracy == plain.plain) & (record.num_samples == plain.samples)).select(
        *record.columns, cells.scalar().alias("missed")
    )


@query(f"""WITH {PER_CLASS_SQL} SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, support FROM per_class""")
def per_class_metrics(spark, sf):
    return mt.per_class_metrics(true_pred(spark, sf), "y", "p").select(
        "class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def _averages(how: str) -> str:
    return ", ".join(f"round({m}_{how}, 6) AS {m}_{how}" for m in ("precision", "recall", "f1"))


@query(f"WITH {PER_CLASS_SQL} SELECT {_averages('macro')} FROM record")
def macro_metrics(spark, sf):
    df = mt.averaged_metrics(true_pred(spark, sf), "y", "p", "macro")
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query(f"WITH {PER_CLASS_SQL} SELECT {_averages('weighted')} FROM record")
def weighted_metrics(spark, sf):
    df = mt.averaged_metrics(true_pred(spark, sf), "y", "p", "weighted")
    return df.select(*[r6(c).alias(c) for c in df.columns])


@query(f"""WITH {PER_CLASS_SQL}, report AS (
SELECT 'flag ' || class AS row, precision, recall, f1, support FROM per_class
UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, num_samples FROM record
UNION ALL SELECT 'macro avg', precision_macro, recall_macro, f1_macro, num_samples FROM record
UNION ALL SELECT 'weighted avg', precision_weighted, recall_weighted, f1_weighted, num_samples FROM record)
SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""")
def classification_report(spark, sf):
    scored = true_pred(spark, sf)
    names = scored.select(F.col("y").alias("class")).distinct().withColumn(
        "name", F.concat(F.lit("flag "), "class")
    )
    return mt.classification_report(scored, "y", "p", names).select(
        "row", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query(f"WITH {PER_CLASS_SQL} SELECT {RECORD_SQL} FROM record")
def evaluation_record(spark, sf):
    return rounded_record(mt.evaluate(true_pred(spark, sf), "y", "p"))


# Whole cents: sums are exact, so both sides must agree to the last bit.
_METER = "round(value * 100) AS v, event_id % 8 + 1 AS n"


def _meter(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.round(F.col("value") * 100).alias("v"), (F.col("event_id") % 8 + 1).alias("n")
    )


@query(f"""WITH m AS (SELECT event_id, event_type, {_METER} FROM events)
SELECT event_type, arg_max(v, event_id) AS val, sum(v * n) AS sum, CAST(sum(n) AS BIGINT) AS count,
  sum(v * n) / sum(n) AS avg FROM m GROUP BY event_type""")
def weighted_meter(spark, sf):
    return mt.weighted_meter(_meter(spark, sf), "v", "n", "event_id", ["event_type"])


@query(f"""WITH m AS (SELECT event_id, event_type, {_METER} FROM events)
SELECT event_id, sum(v * n) OVER w / sum(n) OVER w AS running_avg FROM m
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def running_average(spark, sf):
    segment = F.floor(F.col("event_id") / 100_000)
    df = mt.running_average(_meter(spark, sf), "v", "n", "event_id", ["event_type"], segment)
    return df.select("event_id", "running_avg")


@query("""SELECT event_type, round(sum(value) / count(DISTINCT event_id // 64), 6) AS inference_time_ms
FROM events GROUP BY event_type""")
def batch_latency(spark, sf):
    timed = table(spark, sf, "events").withColumn("batch", F.floor(F.col("event_id") / 64))
    return mt.batch_latency(timed, "value", "batch", ["event_type"]).select(
        "event_type", r6("inference_time_ms").alias("inference_time_ms")
    )


@query(f"""WITH {METRICS_SQL}, pairs AS (SELECT metric, baseline.value AS a, present.value AS b
  FROM baseline JOIN present USING (metric))
SELECT metric, CASE WHEN b > a THEN 'B' ELSE 'A' END AS winner,
  round(CASE WHEN b > a THEN CASE WHEN a > 0 THEN (b - a) / a * 100 ELSE 'inf'::DOUBLE END
       ELSE -(CASE WHEN b > 0 THEN (a - b) / b * 100 ELSE 0 END) END, 6) + 0.0::DOUBLE AS signed_percent,
  round(CASE WHEN a > 0 THEN (b - a) / a ELSE 0 END, 6) + 0.0::DOUBLE AS ratio,
  round(CASE WHEN a > 0 THEN (b - a) / a ELSE 'inf'::DOUBLE END, 6) + 0.0::DOUBLE AS ratio_or_inf
FROM pairs""")
def model_compare_abc(spark, sf):
    baseline, present = metric_sides(spark, sf)
    a, b = F.col("a"), F.col("b")
    both = baseline.withColumnRenamed("value", "a").join(present.withColumnRenamed("value", "b"), "metric")
    return both.select(
        "metric", winner(a, b).alias("winner"),
        *[r6(relative_change(a, b, v)).alias(v) for v in ("signed_percent", "ratio", "ratio_or_inf")],
    )
