"""Data drift, model drift, health, monitoring."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ridgeline.functions.rows import inline_rows
from ridgeline.operators import drift as dr
from ridgeline.operators import stats as st
from ridgeline.plans import monitoring as mon
from ridgeline.runtime import scratch_path
from ridgeline.sources.tables import read_report, write_report
from ridgeline.streaming import drift as sd
from ridgeline.streaming import sketches as sk
from ridgeline.workloads.adapters import (
    CATEGORIES,
    DRIFT_SQL,
    KS_SQL,
    METRICS_SQL,
    PIXELS_SQL,
    chi_tail_sql,
    decoded_images,
    drift_sides,
    metric_sides,
    pixel_array,
)
from ridgeline.workloads.registry import arriving, query, r6, table

# Nine statistics of the pixels of one image, in SQL over (key, px) rows.

def stats_sql(prefix: str = "") -> str:
    """Nine aggregates over ``px``; shape moments from raw powers."""
    parts = {
        "mean": "avg(px)",
        "std": "stddev_pop(px)",
        "min": "min(px)::DOUBLE",
        "max": "max(px)::DOUBLE",
        "median": "quantile_cont(px, 0.5)",
        "q25": "quantile_cont(px, 0.25)",
        "q75": "quantile_cont(px, 0.75)",
        "skewness": "avg(pow(px - mu, 3)) / nullif(pow(stddev_pop(px), 3), 0)",
        "kurtosis": "avg(pow(px - mu, 4)) / nullif(pow(stddev_pop(px), 4), 0) - 3",
    }
    return ", ".join(f"round({e}, 6) + 0.0::DOUBLE AS {prefix}{n}" for n, e in parts.items())


@query(f"""WITH {PIXELS_SQL}, centred AS (SELECT vec_id, px, avg(px) OVER (PARTITION BY vec_id) AS mu FROM pixels)
SELECT vec_id, {stats_sql()} FROM centred GROUP BY vec_id""")
def image_stats(spark, sf):
    images = table(spark, sf, "embeddings").select("vec_id", pixel_array().alias("px"))
    return st.image_stats(images, "px").select("vec_id", *[r6(c).alias(c) for c in st.STATISTICS])


PAIR_FEATURES_SQL = f"""{PIXELS_SQL},
centred AS (SELECT vec_id, label, px, avg(px) OVER (PARTITION BY vec_id) AS mu FROM pixels),
iris_stats AS (SELECT vec_id, any_value(label) AS label, {stats_sql('iris_')} FROM centred GROUP BY vec_id),
first AS (SELECT label, min(vec_id) AS vec_id FROM pixels GROUP BY label),
finger_stats AS (SELECT label, {stats_sql('fingerprint_')} FROM centred
  WHERE vec_id IN (SELECT vec_id FROM first) GROUP BY label)"""


def _pair_features(spark, sf):
    images = decoded_images(spark, sf).select(
        "subject_id", "path", "modality", F.col("px").alias("pixels")
    )
    return st.pair_features(images.where("modality = 'iris'"), images.where("modality = 'fingerprint'"))


_NAMES = [f"{side}_{s}" for side in ("iris", "fingerprint") for s in st.STATISTICS]


@query(f"""WITH {PAIR_FEATURES_SQL}
SELECT 'iris/' || lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.bmp' AS path,
  CAST(label AS VARCHAR) AS subject_id, {', '.join(_NAMES)}
FROM iris_stats JOIN finger_stats USING (label)""")
def pair_features(spark, sf):
    return _pair_features(spark, sf).select("path", "subject_id", *[r6(c).alias(c) for c in _NAMES])


@query(f"WITH {DRIFT_SQL} SELECT feature, round(d, 6) AS ks_statistic FROM ks")
def ks_statistic(spark, sf):
    df = dr.ks_statistic(dr.value_counts(*drift_sides(spark, sf)))
    return df.select("feature", r6("ks_statistic").alias("ks_statistic"))


@query(f"""WITH {DRIFT_SQL} SELECT feature, round({KS_SQL}, 6) AS p_value, {KS_SQL} < 0.1 AS drifted FROM ks""")
def ks_pvalue(spark, sf):
    return dr.ks_test(*drift_sides(spark, sf)).select("feature", r6("p_value").alias("p_value"), "drifted")


DATA_DRIFT_SQL = f"""{DRIFT_SQL},
tests AS (SELECT feature, d, {KS_SQL} AS p FROM ks),
verdict AS (SELECT count(*) FILTER (WHERE p < 0.1) AS k, count(*) AS n FROM tests)"""


@query(f"""WITH {DATA_DRIFT_SQL} SELECT k / n > 0.2 AS drift_detected, round(k / n, 6) AS drift_score,
  n AS total_features, k AS drifted_features FROM verdict""")
def data_drift(spark, sf):
    return dr.data_drift(dr.ks_test(*drift_sides(spark, sf))).select(
        "drift_detected", r6("drift_score").alias("drift_score"), "total_features", "drifted_features"
    )


@query(f"""WITH {DATA_DRIFT_SQL} SELECT feature, round(d, 6) AS ks_statistic, round(p, 6) AS p_value,
  p < 0.1 AS drifted, (SELECT string_agg(feature, ',' ORDER BY feature) FROM tests WHERE p < 0.1)
    AS drifted_features FROM tests""")
def drift_details(spark, sf):
    d = dr.drift_details(dr.ks_test(*drift_sides(spark, sf)))
    flat = d.select(
        F.explode("feature_scores").alias("feature", "s"),
        F.array_join("drifted_features", ",").alias("drifted_features"),
    )
    return flat.select(
        "feature", r6("s.ks_statistic").alias("ks_statistic"), r6("s.p_value").alias("p_value"),
        "s.drifted", "drifted_features",
    )


WASSERSTEIN_SQL = f"""{DRIFT_SQL},
spread AS (SELECT feature, stddev_pop(value) AS s FROM long WHERE is_ref = 1 GROUP BY feature),
far AS (
  SELECT feature, coalesce(sum(abs(gap) * (next_value - value)), 0) / greatest(any_value(s), 0.001) AS distance
  FROM gaps JOIN spread USING (feature) GROUP BY feature
)"""


@query(f"WITH {WASSERSTEIN_SQL} SELECT feature, round(distance, 6) AS distance FROM far")
def wasserstein_drift(spark, sf):
    return dr.wasserstein(*drift_sides(spark, sf)).select("feature", r6("distance").alias("distance"))


CATEGORY_SQL = """
cat_long AS (
  SELECT is_ref, unnest(['l_returnflag', 'l_linestatus']) AS feature,
    unnest([l_returnflag, l_linestatus]) AS category FROM drift
),
cat_counts AS (
  SELECT feature, category, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM cat_long GROUP BY feature, category
),
shares AS (
  SELECT feature, r / sum(r) OVER (PARTITION BY feature) AS p, c / sum(c) OVER (PARTITION BY feature) AS q,
    c, sum(c) OVER (PARTITION BY feature) AS m FROM cat_counts
),
js AS (
  SELECT feature, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS distance
  FROM shares GROUP BY feature
),
chi AS (
  SELECT feature, sum((c - p * m) * (c - p * m) / (p * m)) AS statistic, count(*) - 1 AS df
  FROM shares GROUP BY feature
),
two AS (
  SELECT feature, count(*) AS categories, arg_max(r, category)::DOUBLE AS r, arg_max(c, category)::DOUBLE AS c,
    sum(r)::DOUBLE AS n, sum(c)::DOUBLE AS m FROM cat_counts GROUP BY feature
),
proportions AS (
  SELECT feature, (r / n - c / m) / sqrt((r + c) / (n + m) * (1 - (r + c) / (n + m)) * (1 / n + 1 / m)) AS z
  FROM two WHERE categories = 2
)"""


@query(f"""WITH {DRIFT_SQL}, {CATEGORY_SQL}
SELECT feature, round(js.distance, 6) + 0.0::DOUBLE AS distance, round(statistic, 4) AS statistic, df,
  round({chi_tail_sql('statistic', 'df')}, 6) + 0.0::DOUBLE AS p_value FROM js JOIN chi USING (feature)""")
def categorical_drift(spark, sf):
    ref, cur = drift_sides(spark, sf)
    js, chi = dr.js_distance(ref, cur, CATEGORIES), dr.chi_square(ref, cur, CATEGORIES)
    return js.join(chi, "feature").select(
        "feature", r6("distance").alias("distance"), F.round("statistic", 4).alias("statistic"),
        "df", r6("p_value").alias("p_value"),
    )


COLUMN_DRIFT_SQL = f"""{WASSERSTEIN_SQL}, {CATEGORY_SQL},
columns AS (
  SELECT feature, 'wasserstein' AS method, distance AS score, distance >= 0.1 AS drifted FROM far
  UNION ALL SELECT feature, 'jensen_shannon', distance, distance >= 0.1 FROM js
)"""


@query(f"WITH {COLUMN_DRIFT_SQL} SELECT feature, method, round(score, 6) + 0.0::DOUBLE AS score, drifted FROM columns")
def column_drift(spark, sf):
    return dr.column_drift(*drift_sides(spark, sf)).select(
        "feature", "method", r6("score").alias("score"), "drifted"
    )


@query(f"""WITH {DRIFT_SQL}, {CATEGORY_SQL}
SELECT feature, round(z, 6) + 0.0::DOUBLE AS statistic, round({chi_tail_sql('z * z', '1')}, 6) + 0.0::DOUBLE AS p_value FROM proportions""")
def proportion_drift(spark, sf):
    df = dr.proportion_test(*drift_sides(spark, sf), CATEGORIES)
    return df.select("feature", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"))


TESTS_SQL = f"""{DRIFT_SQL}, {CATEGORY_SQL},
columns AS (
  SELECT feature, 'ks' AS method, {KS_SQL} AS score FROM ks
  UNION ALL SELECT feature, 'proportion', {chi_tail_sql('z * z', '1')} FROM proportions
  UNION ALL SELECT feature, 'chi_square', {chi_tail_sql('statistic', 'df')} FROM chi WHERE df > 1
)"""


@query(f"WITH {TESTS_SQL} SELECT feature, method, round(score, 6) + 0.0::DOUBLE AS score, score < 0.05 AS drifted FROM columns")
def column_drift_tests(spark, sf):
    return dr.column_drift(*drift_sides(spark, sf), "tests").select(
        "feature", "method", r6("score").alias("score"), "drifted"
    )


@query(f"""WITH {TESTS_SQL}, share AS (SELECT count(*) FILTER (WHERE score < 0.05) / count(*) AS s FROM columns)
SELECT s >= 0.5 AS data_drift, round(s, 6) AS data_score, CASE WHEN s >= 0.5 THEN 'warning' ELSE 'healthy' END AS overall_status
FROM share""")
def monitoring_share(spark, sf):
    """The monitoring report with the verdict by shares of columns."""
    report = mon.run_monitoring(*drift_sides(spark, sf), column_share="tests")
    return report.select("data_drift", r6("data_score").alias("data_score"), "overall_status")


@query(f"""WITH {COLUMN_DRIFT_SQL} SELECT count(*) FILTER (WHERE drifted) / count(*) >= 0.5 AS drift_detected,
  round(count(*) FILTER (WHERE drifted) / count(*), 6) AS drift_score, count(*) AS number_of_columns,
  count(*) FILTER (WHERE drifted) AS number_of_drifted_columns FROM columns""")
def column_share_drift(spark, sf):
    df = dr.column_share_drift(*drift_sides(spark, sf))
    return df.withColumn("drift_score", r6("drift_score"))


CHANGE_SQL = f"""{METRICS_SQL},
changes AS (
  SELECT baseline.metric, baseline.value AS baseline, coalesce(present.value, 0) AS current
  FROM baseline LEFT JOIN present USING (metric)
)"""


@query(f"""WITH {CHANGE_SQL} SELECT metric, round(baseline, 6) AS baseline, round(current, 6) AS current,
  round(CASE WHEN baseline > 0 THEN (current - baseline) / baseline * 100 ELSE 0 END, 6) + 0.0::DOUBLE AS change_pct
  FROM changes""")
def metric_change(spark, sf):
    return dr.metric_change(*metric_sides(spark, sf)).select(
        "metric", *[r6(c).alias(c) for c in ("baseline", "current", "change_pct")]
    )


PRIMARY = "purchase"
MODEL_SQL = f"""{CHANGE_SQL},
lost AS (
  SELECT baseline, current, CASE WHEN baseline = 0 THEN 0 ELSE (baseline - current) / baseline END AS score
  FROM changes WHERE metric = '{PRIMARY}'
)"""


@query(f"""WITH {MODEL_SQL} SELECT '{PRIMARY}' AS primary_metric, score > 0.05 AS drift_detected,
  round(score, 6) + 0.0::DOUBLE AS drift_score, round(baseline, 6) AS baseline, round(current, 6) AS current,
  round(score * 100, 6) + 0.0::DOUBLE AS degradation_pct FROM lost""")
def model_drift(spark, sf):
    return dr.model_drift(*metric_sides(spark, sf), primary=PRIMARY).select(
        "primary_metric", "drift_detected",
        *[r6(c).alias(c) for c in ("drift_score", "baseline", "current", "degradation_pct")],
    )


# The sum of all averages stands for the primary metric, the baseline a fifth higher.
@query(f"""WITH {CHANGE_SQL}, scores AS (SELECT (sum(baseline) * 1.2::DOUBLE - sum(current)) / (sum(baseline) * 1.2::DOUBLE)
  AS score FROM changes)
SELECT false AS data_drift, score > 0.05 AS model_drift, round(score, 6) AS model_score,
  CASE WHEN score > 0.1 THEN 'critical' WHEN score > 0.05 THEN 'warning' ELSE 'healthy' END AS overall_status,
  CASE WHEN score > 0.05 THEN printf('{dr.ADVICE_MODEL}', score * 100)
    ELSE '{dr.ADVICE_NONE}' END AS recommendations FROM scores""")
def health_status(spark, sf):
    baseline, current = metric_sides(spark, sf)
    total = F.lit("f1_macro").alias("metric")
    verdict = dr.model_drift(
        baseline.agg((F.sum("value") * 1.2).alias("value")).select(total, "value"),
        current.agg(F.sum("value").alias("value")).select(total, "value"),
    )
    return dr.health_status(model=verdict).select(
        "data_drift", "model_drift", r6("model_score").alias("model_score"), "overall_status",
        F.array_join("recommendations", " | ").alias("recommendations"),
    )


# Both verdicts: what the columns say, and the loss of the primary metric.
@query(f"""WITH {DATA_DRIFT_SQL}, {MODEL_SQL}, facts AS (SELECT k / n > 0.2 AS d, k / n AS ds, score > 0.05 AS mdl, score AS ms FROM verdict CROSS JOIN lost)
SELECT d AS data_drift, mdl AS model_drift, round(ds, 6) AS data_score, round(ms, 6) + 0.0::DOUBLE AS model_score,
  CASE WHEN (d OR mdl) AND ms > 0.1 THEN 'critical' WHEN d OR mdl THEN 'warning' ELSE 'healthy' END AS overall_status FROM facts""")
def health_both(spark, sf):
    status = dr.health_status(
        dr.data_drift(dr.ks_test(*drift_sides(spark, sf))), dr.model_drift(*metric_sides(spark, sf), primary=PRIMARY)
    )
    return status.select(
        "data_drift", "model_drift", r6("data_score").alias("data_score"), r6("model_score").alias("model_score"), "overall_status"
    )


@query(f"""WITH {PAIR_FEATURES_SQL}, {METRICS_SQL}, rows AS (
  SELECT {', '.join(f'avg({c}) AS {c}' for c in _NAMES)} FROM iris_stats JOIN finger_stats USING (label)),
features AS (UNPIVOT rows ON {', '.join(_NAMES)} INTO NAME metric VALUE value)
SELECT 'features' AS part, metric, round(value, 4) + 0.0::DOUBLE AS value FROM features
UNION ALL SELECT 'metrics', metric, round(value, 4) FROM baseline
UNION ALL SELECT 'metrics', unnest(['accuracy', 'f1_macro', 'f1_weighted']), 0.0::DOUBLE""")
def baseline_create(spark, sf):
    images = decoded_images(spark, sf).select(
        "subject_id", "path", "modality", F.col("px").alias("pixels")
    )
    features, metrics = mon.create_baseline(
        images.where("modality = 'iris'"), images.where("modality = 'fingerprint'"),
        metric_sides(spark, sf)[0],
    )
    means = features.agg(*[F.avg(c).alias(c) for c in _NAMES]).unpivot([], _NAMES, "metric", "value")
    return means.select(F.lit("features").alias("part"), "metric", "value").unionByName(
        metrics.select(F.lit("metrics").alias("part"), "metric", "value")
    ).select("part", "metric", (F.round("value", 4) + F.lit(0.0)).alias("value"))


MONITORING_SQL = f"""WITH {DATA_DRIFT_SQL}, {MODEL_SQL}, facts AS (SELECT k / n > 0.2 AS d, k / n AS ds,
  score > 0.05 AS mdl, score AS ms FROM verdict CROSS JOIN lost)
SELECT d AS data_drift, round(ds, 6) AS data_score, mdl AS model_drift, round(ms, 6) + 0.0::DOUBLE AS model_score,
  CASE WHEN (d OR mdl) AND ms > 0.1 THEN 'critical' WHEN d OR mdl THEN 'warning' ELSE 'healthy' END AS overall_status,
  concat_ws(' | ', CASE WHEN d THEN '{dr.ADVICE_DATA}' END,
    CASE WHEN mdl THEN printf('{dr.ADVICE_MODEL}', ms * 100) END,
    CASE WHEN NOT (d OR mdl) THEN '{dr.ADVICE_NONE}' END) AS recommendations
FROM facts"""


def _report(report):
    return report.select(
        "data_drift", r6("data_score").alias("data_score"), "model_drift",
        r6("model_score").alias("model_score"), "overall_status",
        F.array_join("recommendations", " | ").alias("recommendations"),
    )


@query(MONITORING_SQL)
def monitoring_report(spark, sf):
    return _report(mon.run_monitoring(*drift_sides(spark, sf), *metric_sides(spark, sf), primary=PRIMARY))


@query(MONITORING_SQL)
def monitoring_from_profile(spark, sf):
    """The same from the reference's stored profile, made of two halves."""
    ref, cur = drift_sides(spark, sf)
    even = F.pmod(F.xxhash64("l_extendedprice"), F.lit(2)) == 0
    path = scratch_path(spark, "profile")
    mon.save_profile(dr.merge_profiles(*[dr.feature_profile(ref.where(part)) for part in (even, ~even)]), path)
    return _report(mon.monitor_against_profile(mon.load_profile(spark, path), cur, *metric_sides(spark, sf), primary=PRIMARY))


@query(f"""WITH {DRIFT_SQL} SELECT feature, count(*) AS distinct_values, CAST(sum(n) AS BIGINT) AS n, CAST(max(n) AS BIGINT) AS most,
  round(sum(value * n), 4) AS total FROM (SELECT feature, value, count(*) AS n FROM long GROUP BY feature, value) GROUP BY feature""")
def profile_merge(spark, sf):
    """Profiles of both sides, kept and merged, are the profile of all rows."""
    kept = []
    for side in drift_sides(spark, sf):
        kept.append(scratch_path(spark, "profile"))
        mon.save_profile(dr.feature_profile(side), kept[-1])
    whole = dr.merge_profiles(*[mon.load_profile(spark, k) for k in kept])
    return whole.groupBy("feature").agg(
        F.count("*").alias("distinct_values"), F.sum("n").alias("n"), F.max("n").alias("most"), F.round(F.sum(F.col("value") * F.col("n")), 4).alias("total")
    )


@query(f"""WITH {DATA_DRIFT_SQL}, {MODEL_SQL}
SELECT 'data' AS part, feature AS name, round(d, 6) AS first, round(p, 6) AS second FROM tests
UNION ALL SELECT 'model', metric, round(baseline, 6), round(current, 6) FROM changes
UNION ALL SELECT 'verdict', 'data', round(k / n, 6), k::DOUBLE FROM verdict
UNION ALL SELECT 'verdict', 'model', round(score, 6) + 0.0::DOUBLE, round(score * 100, 6) + 0.0::DOUBLE FROM lost""")
def monitoring_record(spark, sf):
    """The stored report, read back from JSON and laid out flat."""
    report = mon.monitoring_record(
        datetime(2024, 2, 1), *drift_sides(spark, sf), *metric_sides(spark, sf), primary=PRIMARY
    )
    path = scratch_path(spark, "monitoring")
    write_report(report, path)
    back = read_report(spark, path, report.schema)
    data, model = F.col("data_drift"), F.col("model_drift")

    def row(part, name, first, second):
        return [F.lit(part), F.lit(name) if isinstance(name, str) else name, r6(first), r6(second)]

    names = ["part", "name", "first", "second"]
    verdicts = back.select(inline_rows(
        names,
        row("verdict", "data", data["drift_score"], data["metrics"]["drifted_features"]),
        row("verdict", "model", model["drift_score"], model["metrics"]["degradation_pct"]),
    ))
    scores = back.select(F.explode("data_drift.details.feature_scores").alias("name", "s")).select(
        *[c.alias(n) for n, c in zip(names, row("data", F.col("name"), F.col("s.ks_statistic"), F.col("s.p_value")))]
    )
    changes = back.select(F.explode("model_drift.details.metric_changes").alias("name", "s")).select(
        *[c.alias(n) for n, c in zip(names, row("model", F.col("name"), F.col("s.baseline"), F.col("s.current")))]
    )
    return verdicts.unionByName(scores).unionByName(changes)


WINDOWS_SQL = f"""WITH ref AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'),
cur AS (SELECT date_trunc('day', ts) AS w, value FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
days AS (SELECT DISTINCT w FROM cur),
tagged AS (SELECT w, value, 1 AS r, 0 AS c FROM days CROSS JOIN ref UNION ALL SELECT w, value, 0, 1 FROM cur),
cells AS (SELECT w, value, sum(r) AS r, sum(c) AS c FROM tagged GROUP BY w, value),
sizes AS (SELECT w, sum(r)::DOUBLE AS n, sum(c)::DOUBLE AS m FROM cells GROUP BY w),
gaps AS (SELECT w, n, m, abs(sum(r) OVER (PARTITION BY w ORDER BY value) / n
  - sum(c) OVER (PARTITION BY w ORDER BY value) / m) AS gap FROM cells JOIN sizes USING (w)),
ks AS (SELECT w, any_value(n) AS n, any_value(m) AS m, max(gap) AS d FROM gaps GROUP BY w)
SELECT strftime(w, '%Y-%m-%d') AS day, 'value' AS feature, round(d, 6) AS ks_statistic,
  CAST(n AS BIGINT) AS n_ref, CAST(m AS BIGINT) AS n_cur, round({KS_SQL}, 6) AS p_value,
  {KS_SQL} < 0.1 AS drifted FROM ks"""


def _event_sides(spark, sf):
    """The first 15 days and the rest."""
    ev = table(spark, sf, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return ev.where(early), ~early


def _windows(df):
    return df.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature",
        r6("ks_statistic").alias("ks_statistic"), "n_ref", "n_cur", r6("p_value").alias("p_value"), "drifted",
    )


@query(WINDOWS_SQL)
def windowed_drift(spark, sf):
    ref, late = _event_sides(spark, sf)
    cur = table(spark, sf, "events").where(late)
    return _windows(sd.windowed_drift(ref, cur, "ts", "1 day", ["value"]))


# A window is tested once the watermark, an hour behind the last event, has passed it.
@query(f"{WINDOWS_SQL} WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def stream_windowed_drift(spark, sf):
    ref, late = _event_sides(spark, sf)
    sink, checkpoint = scratch_path(spark, "stream-drift"), scratch_path(spark, "stream-checkpoint")
    sd.stream_windowed_drift(
        ref, arriving(spark, sf, "events").where(late), sink, checkpoint, "ts", "1 day", "1 hour", ["value"]
    ).awaitTermination()
    return _windows(spark.read.parquet(sink))


# Finer than any of the given tables: as many points as reference values, more places than a day has values.
_FINE = {"k": 16_384, "points": 200_000}


@query(WINDOWS_SQL)
def sketched_drift(spark, sf):
    """Windows as sketches; at this fineness the statistic is exact."""
    ref, late = _event_sides(spark, sf)
    cur = table(spark, sf, "events").where(late)
    return _windows(sk.sketched_drift(ref, cur, "ts", "1 day", ["value"], **_FINE))


@query(f"{WINDOWS_SQL} WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def stream_sketched_drift(spark, sf):
    """The stream keeps one sketch a window."""
    ref, late = _event_sides(spark, sf)
    sink, checkpoint = scratch_path(spark, "stream-sketches"), scratch_path(spark, "stream-checkpoint")
    sk.stream_sketched_drift(ref, arriving(spark, sf, "events").where(late), sink, checkpoint, "ts", "1 day", "1 hour", ["value"], **_FINE).awaitTermination()
    return _windows(spark.read.parquet(sink))
