import math
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeline.operators import drift as dr
from ridgeline.plans import monitoring as mon
from ridgeline.streaming import drift as sd
from ridgeline.workloads.adapters import decoded_images

SF = "/root/testdata/sf0.001"


def ks_brute(a, b):
    points = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max()


def wasserstein_brute(a, b):
    points = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points[:-1], side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points[:-1], side="right") / len(b)
    return (np.abs(fa - fb) * np.diff(points)).sum() / max(a.std(), 0.001)


def column(df, values, name="x"):
    return df([(float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize("a,b", [
    (np.arange(100.0), np.arange(100.0)),
    (np.arange(50.0), np.arange(1000.0, 1030.0)),
    (np.zeros(40), np.zeros(7)),
    (np.r_[np.zeros(90), np.arange(10.0)], np.r_[np.zeros(20), np.arange(40.0)]),  # hot value
    (np.random.default_rng(0).normal(size=700), np.random.default_rng(1).normal(0.3, 2, size=300)),
])
def test_distances_equal_brute_force(df, a, b):
    ref, cur = column(df, a), column(df, b)
    assert dr.ks_statistic(dr.value_counts(ref, cur)).first().ks_statistic == pytest.approx(ks_brute(a, b))
    assert dr.wasserstein(ref, cur).first().distance == pytest.approx(wasserstein_brute(a, b), abs=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(-5, 5), min_size=1, max_size=40), st.lists(st.integers(-5, 5), min_size=1, max_size=40),
)
def test_ks_on_any_ties(df, a, b):
    ref, cur = column(df, a), column(df, b)
    got = dr.ks_statistic(dr.value_counts(ref, cur)).first().ks_statistic
    assert got == pytest.approx(ks_brute(np.array(a, float), np.array(b, float)))


def test_p_value_at_known_points(df):
    # Limiting distribution: P(K > 1.3581) = 0.05, P(K > 1.2238) = 0.1, P(K > 0.8276) = 0.5.
    rows = df([(1.3581,), (1.2238,), (0.8276,), (0.2,), (0.0,), (9.0,)], "d double")
    one = F.lit(2.0)  # n = m = 2 makes the root 1
    got = [r[0] for r in rows.select(dr.ks_pvalue(F.col("d"), one, one)).collect()]
    assert got == pytest.approx([0.05, 0.1, 0.5, 1.0, 1.0, 0.0], abs=1e-4)


def test_both_series_meet(df):
    rows = df([(1.0 - 1e-12,), (1.0,)], "d double")
    low, high = [r[0] for r in rows.select(dr.ks_pvalue(F.col("d"), F.lit(2.0), F.lit(2.0))).collect()]
    assert low == pytest.approx(high, abs=1e-9)


def test_nulls_nans_and_missing_columns(df):
    ref = df([(1.0, None, 1.0, "a"), (float("nan"), None, 2.0, "b"), (3.0, None, None, "c")],
             "x double, empty double, only_ref double, s string")
    cur = df([(1.0, 2.0), (None, 3.0), (3.0, 4.0)], "x double, empty double")
    tests = dr.ks_test(ref, cur)
    row = tests.collect()
    assert [(r.feature, r.n_ref, r.n_cur, r.ks_statistic) for r in row] == [("x", 2, 2, 0.0)]
    nothing = dr.ks_test(ref, cur, ["empty", "gone"])
    assert nothing.count() == 0
    verdict = dr.data_drift(nothing).first()
    assert (verdict.drift_detected, verdict.drift_score, verdict.total_features) == (False, 0.0, 0)


def test_dataset_verdict_needs_more_than_a_fifth(df):
    def verdict(drifted, total):
        rows = [(f"f{i}", 0.5, 10, 10, 0.01, i < drifted) for i in range(total)]
        return dr.data_drift(df(rows, dr._KS_SCHEMA)).first()

    assert not verdict(1, 5).drift_detected
    assert verdict(2, 5).drift_detected
    details = dr.drift_details(df([("b", 0.5, 1, 1, 0.01, True), ("a", 0.1, 1, 1, 0.9, False)], dr._KS_SCHEMA)).first()
    assert details.drifted_features == ["b"] and set(details.feature_scores) == {"a", "b"}


def test_categories(df):
    ref = df([("a",)] * 60 + [("b",)] * 40, "c string")
    cur = df([("a",)] * 30 + [("b",)] * 20, "c string")
    assert dr.js_distance(ref, cur, ["c"]).first().distance == pytest.approx(0.0, abs=1e-9)
    assert dr.chi_square(ref, cur, ["c"]).first().p_value == pytest.approx(1.0, abs=0.05)
    other = df([("z",)] * 10, "c string")
    assert dr.js_distance(ref, other, ["c"]).first().distance == pytest.approx(math.sqrt(math.log(2)))
    unseen = dr.chi_square(ref, other, ["c"]).first()
    assert (unseen.statistic, unseen.p_value) == (math.inf, 0.0)
    # chi-square 3.841 with one degree of freedom is the 5 % point.
    skew = df([("a",)] * 50 + [("b",)] * 50, "c string")
    got = dr.chi_square(ref, skew, ["c"]).first()
    assert got.statistic == pytest.approx(10**2 / 60 + 10**2 / 40) and got.p_value == pytest.approx(math.erfc(math.sqrt(got.statistic / 2)))


# Tabulated upper tails: (statistic, degrees of freedom, probability).
TAILS = [
    (3.841459, 1, 0.05), (6.634897, 1, 0.01), (0.015791, 1, 0.9), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (11.344867, 3, 0.01),
    (18.307038, 10, 0.05), (24.995790, 15, 0.05), (43.772972, 30, 0.05), (124.342113, 100, 0.05), (149.448528, 100, 0.001),
]


def test_chi_square_tails_to_six_digits(df):
    rows = df([(float(x), int(k), float(p)) for x, k, p in TAILS], "x double, k int, p double")
    got = [(r.p, r.q) for r in rows.select("p", dr.chi_square_tail(F.col("x"), F.col("k")).alias("q")).collect()]
    assert [q for _, q in got] == pytest.approx([p for p, _ in got], abs=1e-6)
    one = df([(x / 7,) for x in range(1, 400)], "x double")
    for r in one.select("x", dr.chi_square_tail(F.col("x"), F.lit(1)).alias("q")).collect():
        assert r.q == pytest.approx(math.erfc(math.sqrt(r.x / 2)), rel=1e-9)
    # 0.0528 at one degree, where an approximation gave 0.0499.
    x = 3.75
    assert df([(x,)], "x double").select(dr.chi_square_tail(F.col("x"), F.lit(1))).first()[0] == pytest.approx(0.052808, abs=1e-6)


def test_plain_p_value_gives_the_exact_verdict_for_equal_sizes(df):
    """Exact two-sided probability by reflection: 2 * sum (-1)^(k-1) C(2n, n - k h) / C(2n, n), h = n D."""
    rows, exact = [], {}
    for n in (5, 10, 20, 50, 100, 150, 200):
        whole = math.comb(2 * n, n)
        for h in range(1, n + 1):
            p = 2 * sum((-1) ** (k - 1) * math.comb(2 * n, n - k * h) for k in range(1, n // h + 1)) / whole
            exact[n, h] = p
            rows.append((n, h, h / n))
    table = df(rows, "n int, h int, d double")
    got = {(r.n, r.h): r.p for r in table.select("n", "h", dr.ks_pvalue(F.col("d"), F.col("n"), F.col("n")).alias("p")).collect()}
    assert [k for k in got if (got[k] < dr.P_THRESHOLD) != (exact[k] < dr.P_THRESHOLD)] == []


def test_proportions_are_pooled(df):
    ref, cur = df([("a",)] * 60 + [("b",)] * 40, "c string"), df([("a",)] * 50 + [("b",)] * 50, "c string")
    got = dr.proportion_test(ref, cur, ["c"]).first()
    z = (0.4 - 0.5) / math.sqrt(0.45 * 0.55 * (1 / 100 + 1 / 100))
    assert got.statistic == pytest.approx(z) and got.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    alone = df([("a",)] * 5, "c string")
    assert dr.proportion_test(alone, alone, ["c"]).first().p_value == 1.0
    three = df([("a",), ("b",), ("z",)], "c string")
    assert dr.proportion_test(three, three, ["c"]).count() == 0


@pytest.fixture
def small_ranges(spark):
    """Ranges as a large table has them: small ones are not merged."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_values_leave_the_ranges_even(spark, small_ranges):
    """99 of 100 rows have one value: the ranges are drawn over distinct values all the same."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 100 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    sizes = [r["count"] for r in dr.value_counts(rows, rows).counts.groupBy("segment").count().collect()]
    assert len(sizes) > 2 and sum(sizes) == 2001 and max(sizes) < 3 * 2001 / len(sizes)


def test_drifted_windows_spread_over_ranges(spark, small_ranges, monkeypatch):
    from ridgeline.operators import running as rn

    seen = []
    kept = rn.materialize
    monkeypatch.setattr(rn, "materialize", lambda df, kind, session=None: seen.append(kept(df, kind, session)) or seen[-1])
    ref = spark.range(1000).select((F.col("id") / 1000).alias("x"))
    cur = spark.range(20_000).select((F.col("id") + 100.0).alias("x"), F.lit("2024-01-01 05:00:00").cast("timestamp").alias("ts"))
    assert sd.windowed_drift(ref, cur, "ts").first().ks_statistic == 1.0
    for part in seen:
        sizes = [r["count"] for r in part.groupBy("_range").count().collect()]
        assert max(sizes) < 0.6 * sum(sizes)


def test_the_caller_chooses_tests_or_distances(df):
    rng = np.random.default_rng(7)
    rows = [(float(v), int(v > 0), "a" if v > 1 else "b", "xyz"[i % 3]) for i, v in enumerate(rng.normal(size=200))]
    small = df(rows, "x double, flag int, c string, d string")
    got = {r.feature: (r.method, r.drifted) for r in dr.column_drift(small, small, "tests", ["flag"]).collect()}
    assert got == {"x": ("ks", False), "flag": ("proportion", False), "c": ("proportion", False), "d": ("chi_square", False)}
    moved = small.withColumn("x", F.col("x") + 1).withColumn("c", F.lit("b"))
    got = {r.feature: (r.method, r.drifted) for r in dr.column_drift(small, moved, "distances", ["flag"]).collect()}
    assert got == {"x": ("wasserstein", True), "flag": ("jensen_shannon", False), "c": ("jensen_shannon", True), "d": ("jensen_shannon", False)}
    assert {r.method for r in dr.column_drift(small, moved, columns=["flag"]).collect()} == {"wasserstein"}
    verdict = dr.column_share_drift(small, moved, "distances", ["flag"]).first()
    assert (verdict.drift_detected, verdict.number_of_columns, verdict.number_of_drifted_columns) == (True, 4, 2)
    with pytest.raises(ValueError):
        dr.column_drift(small, small, "size")


def metrics(df, **values):
    return df([(k, float(v)) for k, v in values.items()], "metric string, value double")


def test_model_drift_and_changes(df):
    base, cur = metrics(df, f1_macro=0.8, accuracy=0.0), metrics(df, f1_macro=0.7)
    d = dr.model_drift(base, cur).first()
    assert d.drift_detected and d.drift_score == pytest.approx(0.125)
    changes = {r.metric: (r.current, r.change_pct) for r in dr.metric_change(base, cur).collect()}
    assert changes["accuracy"] == (0.0, 0.0)
    assert changes["f1_macro"] == (0.7, pytest.approx(-12.5))
    zero = dr.model_drift(metrics(df, accuracy=1.0), cur).first()
    assert (zero.drift_detected, zero.drift_score) == (False, 0.0)


@pytest.mark.parametrize("data,model,status,advice", [
    (None, (True, 0.2), "critical", ["Model performance degraded by 20.0%! Trigger retraining pipeline."]),
    (True, (False, 0.0), "warning", [dr.ADVICE_DATA]),
    (True, (True, 0.11), "critical", [dr.ADVICE_DATA, "Model performance degraded by 11.0%! Trigger retraining pipeline."]),
    (False, (True, 0.07), "warning", ["Model performance degraded by 7.0%! Trigger retraining pipeline."]),
    (False, None, "healthy", [dr.ADVICE_NONE]),
])
def test_health(df, data, model, status, advice):
    schema = "drift_detected boolean, drift_score double"
    d = None if data is None else df([(data, 0.5)], schema)
    m = None if model is None else df([model], schema)
    got = dr.health_status(d, m).first()
    assert (got.overall_status, got.recommendations) == (status, advice)


def test_baseline_round_trip(spark, df, tmp_path):
    images = decoded_images(spark, SF).select("subject_id", "path", "modality", F.col("px").alias("pixels"))
    iris, finger = images.where("modality = 'iris'"), images.where("modality = 'fingerprint'")
    features, zeros = mon.create_baseline(iris, finger)
    assert {r.metric: r.value for r in zeros.collect()} == {"accuracy": 0.0, "f1_macro": 0.0, "f1_weighted": 0.0}
    _, known = mon.create_baseline(iris, finger, metrics(df, f1_macro=0.9))
    assert {r.metric: r.value for r in known.collect()} == {"accuracy": 0.0, "f1_macro": 0.9, "f1_weighted": 0.0}
    mon.save_baseline(features, known, str(tmp_path / "base"))
    ref, base = mon.load_baseline(spark, str(tmp_path / "base"))
    assert ref.count() == iris.count() and base.count() == 3
    report = mon.run_monitoring(ref, ref, base, metrics(df, f1_macro=0.5)).first()
    assert (report.data_drift, report.model_drift, report.overall_status) == (False, True, "critical")
    with pytest.raises(ValueError):
        mon.run_monitoring()


def test_windows_equal_brute_force(spark, df):
    rng = np.random.default_rng(8)
    ref = rng.integers(0, 30, 200).astype(float)
    cur = rng.integers(0, 40, 120).astype(float)
    days = rng.integers(1, 5, 120)
    rows = spark.createDataFrame([(f"2024-01-{d:02d} 05:00:00", float(v)) for d, v in zip(days, cur)], "t string, x double")
    rows = rows.withColumn("ts", F.to_timestamp("t"))
    got = {r.window_start.day: r.ks_statistic for r in sd.windowed_drift(column(df, ref), rows, "ts").collect()}
    assert got == pytest.approx({d: ks_brute(ref, cur[days == d]) for d in set(days.tolist())})


def test_stored_report_has_only_the_given_parts(spark, df):
    at = datetime(2024, 1, 1)
    base, cur = metrics(df, f1_macro=0.8), metrics(df, f1_macro=0.4)
    report = mon.monitoring_record(at, baseline=base, current=cur)
    assert report.columns == ["model_drift", "overall_status", "recommendations", "timestamp"]
    row = report.first()
    assert row.overall_status == "critical" and row.timestamp == at.isoformat()
    assert (row.model_drift.drift_type, row.model_drift.threshold) == ("model", 0.05)
    assert row.model_drift.details.metric_changes["f1_macro"].change_pct == pytest.approx(-50.0)
    both = mon.monitoring_record(at, column(df, range(9)), column(df, range(9)), base, base).first()
    assert both.overall_status == "healthy" and both.data_drift.metrics["total_features"] == 1.0
    assert set(both.data_drift.details.feature_scores) == {"x"}
