"""Tables stored by subject, stored reference profiles, and the daily chain."""

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.operators import classifier as cl
from ridgeline.operators import drift as dr
from ridgeline.operators import scoring as sc
from ridgeline.operators import versions as vs
from ridgeline.plans import daily
from ridgeline.plans import monitoring as mon
from ridgeline.plans import retraining as rt
from ridgeline.sources import bucketed as bk


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_join_without_an_exchange(spark, df, tmp_path):
    rows = df([(f"s{i % 40}", i) for i in range(1000)], "subject_id string, n int")
    labels = df([(f"s{i}", i) for i in range(0, 50, 2)], "subject_id string, label int")
    a = bk.write_bucketed(rows, "rows_by_subject", str(tmp_path / "rows"), "subject_id", 4)
    b = bk.write_bucketed(labels, "labels_by_subject", str(tmp_path / "labels"), "subject_id", 4)
    for how in ("inner", "left"):
        joined = bk.joined_in_place(a, b, "subject_id", how)
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
        assert sorted(map(str, joined.collect())) == sorted(map(str, rows.join(labels, "subject_id", how).collect()))
    counted = bk.joined_in_place(a, b, "subject_id").groupBy("subject_id").count()
    assert "Exchange" not in plan_of(counted) and counted.count() == 20
    spark.sql("DROP TABLE rows_by_subject")
    again = bk.open_bucketed(spark, "rows_again", str(tmp_path / "rows"), "subject_id string, n int", "subject_id", 4)
    assert "Exchange" not in plan_of(bk.joined_in_place(again, b, "subject_id")) and again.count() == 1000
    assert bk.bucket_count(0) == 1 and bk.bucket_count((256 << 20) + 1) == 2


@pytest.fixture
def sides(df):
    rng = np.random.default_rng(4)
    make = lambda n, by: df([(float(round(x, 1)), float(y) if y > -1 else None, "c") for x, y in zip(rng.normal(by, 1, n), rng.normal(0, 1, n))], "a double, b double, c string")
    return make(700, 0.0), make(300, 0.5), make(500, 0.0)


def test_profiles_stand_for_their_rows(spark, sides, tmp_path):
    ref, cur, more = sides
    mon.save_profile(dr.feature_profile(ref), str(tmp_path / "ref"))
    mon.save_profile(dr.feature_profile(more), str(tmp_path / "more"))
    one, two = (mon.load_profile(spark, str(tmp_path / p)) for p in ("ref", "more"))
    merged, whole = dr.merge_profiles(one, two), dr.feature_profile(ref.union(more))
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0
    for profile, rows in ((one, ref), (merged, ref.union(more))):
        values = dr.profile_counts(profile, dr.feature_profile(cur), ["a", "b"])
        got = {r.feature: (r.ks_statistic, r.p_value, r.n_ref, r.n_cur) for r in dr.ks_test(cur, cur, values=values).collect()}
        want = {r.feature: (r.ks_statistic, r.p_value, r.n_ref, r.n_cur) for r in dr.ks_test(rows, cur).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_monitoring_never_reads_the_reference(spark, sides, tmp_path, monkeypatch):
    ref, cur, _ = sides
    ref.write.parquet(str(tmp_path / "reference"))
    ref = spark.read.parquet(str(tmp_path / "reference"))
    mon.save_profile(dr.feature_profile(ref), str(tmp_path / "profile"))
    read = []
    written = dr.materialize
    monkeypatch.setattr(dr, "materialize", lambda d, kind, *a: read.extend(d.inputFiles()) or written(d, kind, *a))
    profile = mon.load_profile(spark, str(tmp_path / "profile"))
    report = mon.monitor_against_profile(profile, cur, keep=str(tmp_path / "day")).first()
    assert read and not any("/reference/" in f for f in read) and any("/profile/" in f for f in read)
    want = mon.run_monitoring(ref, cur).first()
    assert (report.data_drift, report.data_score, report.overall_status) == (want.data_drift, want.data_score, want.overall_status)
    kept = mon.load_profile(spark, str(tmp_path / "day"))
    assert kept.exceptAll(dr.feature_profile(cur)).count() == 0
    # A table without numbers, and one whose columns the reference lacks.
    assert not mon.monitor_against_profile(profile, cur.select("c")).first().data_drift
    assert mon.monitor_against_profile(profile, cur.select(F.col("a").alias("z"))).first().data_score == 0


VECTORS = "id int, subject_id string, v array<double>, label int"
LOG = "model string, version int, event_ts timestamp, seq long, alias string, tags map<string,string>, metrics map<string,double>"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"s{i}", (rng.normal(size=3) + 3 * np.eye(3)[i % 3]).tolist(), i % 3) for i in range(240)]
    return spark.createDataFrame(rows, VECTORS).cache()


def test_retraining_with_models_of_any_kind(spark, vectors, tmp_path):
    empty = spark.createDataFrame([], LOG)
    store = str(tmp_path / "models")
    fitted = lambda train: cl.train_classifier(train, "v", reg=1e-3, max_iter=30)
    first = rt.retrain_pipeline(vectors, empty, "m", "id", "v", datetime(2024, 1, 1), fit=fitted, store=store)
    assert first.comparison.first().promoted
    # A poor head does not replace the stored classifier; stored centroids are compared with it too.
    poor = {"w": [[0.0, 0.0, 0.0]] * 3, "b": [1.0, 0.0, 0.0]}
    second = rt.retrain_pipeline(vectors, first.log, "m", "id", "v", datetime(2024, 1, 2), fit=lambda train: poor, store=store)
    record = second.comparison.first()
    assert not record.promoted and record.champion_value == first.comparison.first().challenger_value > record.challenger_value
    third = rt.retrain_pipeline(vectors, second.log, "m", "id", "v", datetime(2024, 1, 3), force=True, store=store)
    state = {r.version: (r.alias, r.tags["model_path"]) for r in vs.current_versions(third.log).collect()}
    assert [state[v][0] for v in (1, 2, 3)] == ["archived", None, "champion"] and all(p.startswith(store) for _, p in state.values())
    # Every version can be loaded and evaluated again.
    for version in (1, 2, 3):
        again = rt.evaluate_from_log(vectors, third.log, "m", "id", "v", datetime(2024, 1, 4), version=version).first()
        logged = vs.current_versions(third.log).where(F.col("version") == version).first().metrics
        assert again.f1_macro == pytest.approx(logged["f1_macro"])


def test_the_daily_chain_uses_the_champion_of_the_day(spark, vectors, tmp_path):
    good = sc.centroid_scorer(sc.centroid_fit(vectors, "v"), path=str(tmp_path / "centroids-1"))
    head = sc.store_model(spark, {"w": [[0.0] * 3] * 3, "b": [0.0, 9.0, 0.0]}, str(tmp_path))
    log = spark.createDataFrame([
        ("m", 1, datetime(2024, 1, 1), 0, "champion", {"model_path": good.path}, {"f1_macro": 0.9, "accuracy": 0.9}),
        ("m", 2, datetime(2024, 1, 2), 0, "challenger", {"model_path": head}, {"f1_macro": 0.95}),
    ], LOG)
    known = vectors.select("label").distinct()
    profile = dr.feature_profile(vectors.select(F.col("id").cast("double").alias("x")))
    features = vectors.select((F.col("id") + 500.0).alias("x"))
    done = daily.daily_run(vectors, log, "m", "v", str(tmp_path / "day1"), known, profile, features)
    assert done.version == 1 and done.predictions.count() == 240 and done.violations.agg(F.sum("violations")).first()[0] == 0
    assert (done.report.first().data_drift, done.report.first().model_drift) == (True, False)
    promoted = vs.promote(log, None, datetime(2023, 1, 1))
    next_day = daily.daily_run(vectors, promoted, "m", "v", str(tmp_path / "day2"), known.where("label <> 1"))
    assert next_day.version == 2 and {r.rule: r.violations for r in next_day.violations.collect()}["unknown_label"] == 240
    assert next_day.report.first().model_drift and next_day.report.first().overall_status == "critical"
    with pytest.raises(ValueError):
        daily.current_model(log, "other")
    # The stream resolves the champion when it starts.
    vectors.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(vectors.schema).parquet(str(tmp_path / "in"))
    for i, (events, want) in enumerate([(log, 3), (promoted, 1)]):
        daily.score_arrivals(source, events, "m", "v", str(tmp_path / f"out{i}"), str(tmp_path / f"check{i}")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"out{i}")).select("prediction").distinct().count() == want


def test_gradient_parts_are_one_row_a_partition(spark, vectors):
    model = cl.train_classifier(vectors, "v", reg=1e-2, max_iter=100)
    fitted = model.stages[-1]
    w, b = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    rows = vectors.repartition(9).select(F.col("label").alias("y"), F.col("v").alias("x"))
    assert cl._gradient_parts(rows, w, b).count() == 9
    x, y = np.array([r.v for r in vectors.collect()]), np.array([r.label for r in vectors.collect()])
    z = np.exp(x @ w.T + b)
    r = z / z.sum(axis=1, keepdims=True) - np.eye(3)[y]
    want = max(np.abs(r.mean(axis=0)).max(), np.abs(r.T @ x / len(x) + 1e-2 * w).max())
    for parts in (1, 9):
        got = cl.gradient_norm(vectors.repartition(parts), model, "v", reg=1e-2).first()
        assert (got.rows, got.classes) == (240, 3) and got.norm == pytest.approx(want, abs=1e-9) and got.norm < 1e-3
    unlabelled = vectors.withColumn("label", F.when(F.col("id") < 120, F.col("label")))
    assert cl.gradient_norm(unlabelled, model, "v", reg=1e-2).first().rows == 120
