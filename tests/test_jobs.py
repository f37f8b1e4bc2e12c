import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline import runtime
from ridgeline.operators import classifier as cl
from ridgeline.operators import metrics as mt
from ridgeline.operators import scoring as sc
from ridgeline.plans.evaluation import evaluate_split
from ridgeline.sources import tables as tb
from ridgeline.streaming import drift as sd
from ridgeline.streaming.scoring import stream_score

SF = "/root/testdata/sf0.001"


@pytest.fixture
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").withColumn("subject_id", F.col("vec_id").cast("string"))


class FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = f"file:{path}/app"


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = FakeContext(master), conf


def test_shared_folder_is_the_named_one():
    assert runtime.shared_dir(FakeSession("spark://x", **{"spark.checkpoint.dir": "/shared/"})) == "/shared"
    with pytest.raises(RuntimeError):
        runtime.shared_dir(FakeSession("spark://x"))
    local = FakeSession("local[2]")
    assert runtime.shared_dir(local) == runtime.shared_dir(local) != ""


def test_materialize_keeps_rows_and_types(spark):
    rows = spark.range(5).withColumn("t", F.lit("2024-01-01").cast("timestamp_ntz"))
    kept = runtime.materialize(rows, "t")
    assert kept.dtypes == rows.dtypes and kept.exceptAll(rows).count() == 0
    assert runtime.shared_dir(spark).split(":")[-1].rstrip("/") in kept.inputFiles()[0]


def test_features_read_only_asked_columns(spark, df, tmp_path):
    path = str(tmp_path / "f")
    rows = df([("b", [1.0], "x"), ("a", [2.0], "y")], "subject_id string, iris_features array<float>, iris_path string")
    tb.write_features(rows, path)
    assert any(name.endswith(".snappy.parquet") for name in os.listdir(path))
    got = tb.read_features(spark, path, ["subject_id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<subject_id:string>" in plan
    assert {r.subject_id: r.label for r in tb.feature_labels(got).collect()} == {"a": 0, "b": 1}
    with pytest.raises(PySparkException):
        tb.write_features(rows, path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_export(spark, df, tmp_path, fmt):
    rows = df([("a", 1, 1, 0.5, True)], "subject_id string, prediction int, label int, confidence double, correct boolean")
    path = str(tmp_path / "out")
    tb.export_predictions(rows, path, fmt)
    back = spark.read.schema(rows.schema).option("header", True).format(fmt).load(path)
    assert back.collect() == rows.collect()
    with pytest.raises(ValueError):
        tb.export_predictions(rows, path + "2", "delta")


def test_report_round_trip(spark, df, tmp_path):
    record = mt.evaluate(df([(1, 1), (0, 1)], "y int, p int"), "y", "p")
    record = mt.with_run(record, datetime(2024, 1, 2), 1.5)
    path = str(tmp_path / "r")
    tb.write_report(record, path)
    assert tb.read_report(spark, path, record.schema).collect() == record.collect()
    rows = {r.metric: r.value for r in tb.metric_rows(record).collect()}
    assert rows["accuracy"] == 0.5 and rows["num_samples"] == 2.0 and "model_path" not in rows
    assert rows["inference_time_ms"] == 1.5


def test_tables_schema_is_explicit():
    assert [f.dataType for f in tb.REFERENCE_SCHEMA][:18] == [T.DoubleType()] * 18


def test_stream_equals_batch(spark, vectors, tmp_path):
    scorer = sc.centroid_scorer(sc.centroid_fit(vectors, "embedding"))
    arriving = tmp_path / "in"
    vectors.repartition(4).write.parquet(str(arriving))

    def run():
        source = spark.readStream.schema(vectors.schema).option("maxFilesPerTrigger", 1).parquet(str(arriving))
        stream_score(source, lambda r: sc.score_table(r, scorer), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    run()
    want = sc.score_table(vectors, scorer)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(want).count() == 0
    run()  # nothing new: nothing added
    assert spark.read.parquet(str(tmp_path / "out")).count() == vectors.count()


def test_closed_windows_equal_batch(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    ref, cur = ev.where(early), ev.where(~early)
    cur.repartitionByRange(6, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(cur.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    sink = str(tmp_path / "out")
    sd.stream_windowed_drift(ref, source, sink, str(tmp_path / "cp"), "ts", delay="30 days", columns=["value"]).awaitTermination()
    # With a long delay nothing closes; a second source of later rows closes it all.
    later = cur.limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp_ntz"))
    later.write.mode("append").parquet(str(tmp_path / "in"))
    last = sd.stream_windowed_drift(ref, source, sink, str(tmp_path / "cp"), "ts", delay="30 days", columns=["value"])
    last.awaitTermination()
    assert sd.late_rows(last) == 0
    batch = sd.windowed_drift(ref, cur, "ts", columns=["value"])
    got = {r.window_start: (r.ks_statistic, r.n_cur, r.drifted) for r in spark.read.parquet(sink).collect()}
    assert got == {r.window_start: (r.ks_statistic, r.n_cur, r.drifted) for r in batch.collect()}
    # Rows of a window long closed change nothing, but are counted.
    cur.limit(1).write.mode("append").parquet(str(tmp_path / "in"))
    late = sd.stream_windowed_drift(ref, source, sink, str(tmp_path / "cp"), "ts", delay="30 days", columns=["value"])
    late.awaitTermination()
    assert sd.late_rows(late) == 1


def test_late_rows_of_batches_no_longer_remembered(spark, tmp_path):
    import os

    ref = spark.range(50).selectExpr("cast(id as double) as value", "timestamp_ntz'2024-01-01 00:00:00' as ts")
    for i, day in enumerate(["2024-01-01", "2030-01-01", "2030-01-02", "2024-01-02", "2030-01-03", "2024-01-03", "2030-01-04", "2030-01-05"]):
        part = spark.range(i + 1).coalesce(1).selectExpr("cast(id as double) as value", f"timestamp_ntz'{day} 00:00:00' as ts")
        part.write.parquet(str(tmp_path / f"in{i}"))
        for file in (tmp_path / f"in{i}").glob("part-*"):
            os.utime(file, (1_700_000_000 + 10 * i,) * 2)
    source = spark.readStream.schema("value double, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))
    name = "spark.sql.streaming.numRecentProgressUpdates"
    # Spark keeps one less than that.
    spark.conf.set(name, "2")
    try:
        query = sd.stream_windowed_drift(ref, source, str(tmp_path / "out"), str(tmp_path / "cp"), "ts", columns=["value"])
        query.awaitTermination()
        # The fourth and the sixth file came late, with four and six values.
        assert len(query.recentProgress) == 1
        assert sd.late_rows(query) == sd.late_rows(query) == 4 + 6, query.late_by_batch
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("kind", ["logistic", "perceptron"])
def test_model_round_trip(vectors, tmp_path, kind):
    model = cl.train_classifier(vectors, kind=kind, max_iter=5, hidden=8)
    path = str(tmp_path / "model")
    cl.save_model(model, path)
    before = cl.model_scores(vectors, model).select("vec_id", "prediction", "confidence")
    after = cl.model_scores(vectors, cl.load_model(path)).select("vec_id", "prediction", "confidence")
    assert before.exceptAll(after).count() == 0
    assert before.where("confidence < 0 or confidence > 1").count() == 0
    with pytest.raises(PySparkException):
        cl.load_model(str(tmp_path / "nowhere"))
    with pytest.raises(ValueError):
        cl.train_classifier(vectors, kind="forest")


def test_training_learns_and_repeats(df):
    rows = df([([float(i % 3), float(i % 3) ** 2], i % 3) for i in range(90)], "embedding array<double>, label int")
    runs = [cl.model_scores(rows, cl.train_classifier(rows, seed=1)) for _ in range(2)]
    assert mt.accuracy(runs[0], "label", "prediction").first().accuracy == 1.0
    assert runs[0].exceptAll(runs[1]).count() == 0


def test_unknown_split_means_test(df):
    rows = df([(1, 1, "test"), (0, 1, "val"), (1, 0, "train")], "label int, prediction int, split string")
    record = evaluate_split(rows, lambda r: r, "holdout").first()
    assert (record.num_samples, record.accuracy) == (1, 1.0)
    assert evaluate_split(rows, lambda r: r, "val").first().accuracy == 0.0


def test_discarded_tables_are_gone(spark):
    with runtime.discarding(spark):
        kept = runtime.materialize(spark.range(3), "t")
        place = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert kept.count() == 3 and os.path.exists(place)
    assert not os.path.exists(place)
