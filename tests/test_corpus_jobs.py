from datetime import datetime

import numpy as np
import pytest
from images import bitmap_bytes, put
from pyspark.sql import functions as F

from ridgeline.functions import bitmaps
from ridgeline.operators import labels as lb
from ridgeline.operators import scoring as sc
from ridgeline.operators import versions as vs
from ridgeline.operators.stats import STATISTICS
from ridgeline.plans import corpus_jobs as jobs
from ridgeline.plans import retraining as rt
from ridgeline.sources import corpus as cp
from ridgeline.sources import tables as tb


@pytest.fixture
def corpus(tmp_path):
    rng = np.random.default_rng(1)
    gray = {}
    for s in range(3):
        for i in range(2):
            for name in (f"iris/{s:03d}_L_0{i}.bmp", f"fingerprint/{s:03d}_L_thumb_0{i}.BMP"):
                gray[name] = rng.integers(0, 256, (12, 10), dtype=np.uint8)
                put(tmp_path, name, bitmap_bytes(gray[name]))
    put(tmp_path, "iris/000_R_09.bmp", b"BM broken")
    return tmp_path, gray


def test_features_of_a_folder_decode_each_image_once(spark, corpus, tmp_path, monkeypatch):
    root, gray = corpus
    calls = str(tmp_path / "calls.txt")

    def counted(content, decode=bitmaps.decode_bitmap):
        def logging(blob):
            with open(calls, "a") as f:
                f.write("x")
            return decode(blob)

        return bitmaps.raw_pixels(content, logging)

    monkeypatch.setattr(jobs, "raw_pixels", counted)
    made = {r.path.rsplit("/", 1)[1]: r for r in jobs.corpus_features(spark, str(root)).collect()}
    assert len(open(calls).read()) == len(gray) + 1
    assert set(made) == {n.split("/")[1] for n in gray if n.startswith("iris/")}
    for name, r in made.items():
        x, f = gray[f"iris/{name}"].astype(float), gray[f"fingerprint/{name[:3]}_L_thumb_00.BMP"].astype(float)
        assert (r.iris_mean, r.iris_std, r.fingerprint_median) == pytest.approx((x.mean(), x.std(), np.median(f)))


def test_manifest_equals_listing(spark, corpus, df):
    root, gray = corpus
    paths = cp.list_corpus(spark, str(root)).select("path").union(df([(f"file://{root}/iris/999_L_00.bmp",)], "path string"))
    files = cp.read_manifest(paths)
    assert files.where("content is null").select("name").collect() == [("999_L_00.bmp",)]
    listed = cp.read_corpus(spark, str(root)).select("modality", "name", "content")
    assert files.where("content is not null").select("modality", "name", "content").exceptAll(listed).count() == 0
    assert files.count() == listed.count() + 1
    assert cp.read_manifest(paths, modality="iris").where("modality <> 'iris'").count() == 0
    names = [f"{s}_{n}" for s in ("iris", "fingerprint") for n in STATISTICS]
    assert jobs.corpus_features(spark, paths).select(names).exceptAll(jobs.corpus_features(spark, str(root)).select(names)).count() == 0


def test_monitoring_a_folder(spark, corpus, df, tmp_path):
    root, _ = corpus
    reference = jobs.corpus_features(spark, str(root))
    tb.write_reference(reference, str(tmp_path / "ref"))
    report = jobs.monitor_corpus(spark, str(root), tb.read_reference(spark, str(tmp_path / "ref"))).first()
    assert (report.data_drift, report.overall_status) == (False, "healthy")
    moved = reference.select("subject_id", *[(F.col(c) + 500).alias(c) for c in tb.REFERENCE_SCHEMA.names[:-1]])
    assert jobs.monitor_corpus(spark, str(root), moved, column_share="distances").first().data_drift


def test_folder_to_exported_predictions(spark, corpus, df, tmp_path):
    root, _ = corpus
    labels = df([("000", 0), ("001", 1)], "subject_id string, label int")
    lb.save_labels(labels, str(tmp_path / "labels"))
    rng = np.random.default_rng(2)
    scorer = sc.linear_scorer(rng.normal(size=(3, 32)), np.zeros(3))
    out = str(tmp_path / "out")
    made = jobs.score_corpus(spark, str(root), scorer, lb.load_labels(spark, str(tmp_path / "labels")), size=(4, 4), export=out, fmt="csv")
    rows = made.collect()
    assert len(rows) == 6 and {r.subject_id: r.label for r in rows} == {"000": 0, "001": 1, "002": None}
    assert spark.read.csv(out, header=True).count() == 6
    every = jobs.score_corpus(spark, str(root), scorer, labels, size=(4, 4), first_match=False, fusion="concat")
    assert every.count() == 12


def test_retraining_without_a_champion_promotes(spark, df):
    rows = df([(i, [float(i % 2), 1.0], i % 2) for i in range(60)], "id int, v array<double>, label int")
    empty = spark.createDataFrame([], "model string, version int, event_ts timestamp, seq long, alias string, tags map<string,string>, metrics map<string,double>")
    at = datetime(2024, 1, 1)
    first = rt.retrain_pipeline(rows, empty, "m", "id", "v", at)
    record = first.comparison.first()
    assert record.promoted and record.champion_value is None and record.challenger_value == 1.0
    assert (record.metric, record.threshold, record.timestamp) == ("f1_macro", 0.01, at.isoformat())
    assert [(r.alias, r.version) for r in vs.alias_holders(first.log).collect()] == [("champion", 1)]
    # An equal challenger does not replace it, unless forced.
    again = rt.retrain_pipeline(rows, first.log, "m", "id", "v", datetime(2024, 1, 2))
    assert not again.comparison.first().promoted
    assert {r.alias: r.version for r in vs.alias_holders(again.log).collect()} == {"champion": 1, "challenger": 2}
    forced = rt.retrain_pipeline(rows, again.log, "m", "id", "v", datetime(2024, 1, 3), force=True)
    assert {r.alias: r.version for r in vs.alias_holders(forced.log).where("alias <> 'archived'").collect()} == {"champion": 3}
    done = rt.evaluate_from_log(rows, forced.log, "m", "id", "v", at).first()
    assert done.version == 3 and done.accuracy == 1.0 and "centroids" in done.model_path
    with pytest.raises(ValueError):
        rt.evaluate_from_log(rows, forced.log, "other", "id", "v", at)
