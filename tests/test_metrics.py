import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import vectors as vc
from ridgeline.functions.change import relative_change, winner
from ridgeline.functions.pixels import normalize_pixels, tensor_decode, tensor_encode
from ridgeline.operators import metrics as mt
from ridgeline.operators import scoring as sc
from ridgeline.operators.classifier import train_classifier
from ridgeline.operators.stats import STATISTICS, image_stats


def brute(pairs):
    classes = sorted({c for pair in pairs for c in pair})
    out = {}
    for c in classes:
        tp = sum(y == p == c for y, p in pairs)
        predicted, support = sum(p == c for _, p in pairs), sum(y == c for y, _ in pairs)
        pr = tp / predicted if predicted else 0.0
        rc = tp / support if support else 0.0
        out[c] = (pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, support)
    return out


# 3 is never predicted, 4 is never true.
PAIRS = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0), (3, 2), (3, 4), (2, 2)]


def test_class_metrics_with_empty_classes(df):
    rows = df(PAIRS, "y int, p int")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in mt.per_class_metrics(rows, "y", "p").collect()}
    want = brute(PAIRS)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == pytest.approx(want[c])
    record = mt.evaluate(rows, "y", "p").first()
    assert record.accuracy == sum(y == p for y, p in PAIRS) / len(PAIRS)
    assert record.f1_macro == pytest.approx(np.mean([v[2] for v in want.values()]))
    assert record.f1_weighted == pytest.approx(sum(v[2] * v[3] for v in want.values()) / len(PAIRS))
    assert (record.num_classes, record.num_samples) == (5, 8)


def test_confusion_matrix_is_dense(df):
    rows = df(PAIRS, "y int, p int")
    cells = {(r.label, r.prediction): r.n for r in mt.confusion_matrix(rows, "y", "p", dense=True).collect()}
    assert len(cells) == 25 and sum(cells.values()) == 8
    assert cells[1, 1] == 2 and cells[4, 4] == 0
    assert mt.confusion_matrix(rows, "y", "p").count() == 7


def test_missing_predictions_are_missed_samples(df):
    rows = df([(1, 1), (1, None), (0, None), (0, 0), (None, 1)], "y int, p int")
    assert tuple(mt.accuracy(rows, "y", "p").first()) == (0.5, 4)
    record = mt.evaluate(rows, "y", "p").first()
    assert (record.accuracy, record.num_classes, record.num_samples) == (0.5, 2, 4)
    assert record.precision_macro == 1.0 and record.recall_macro == 0.5
    sparse = {(r.label, r.prediction): r.n for r in mt.confusion_matrix(rows, "y", "p").collect()}
    assert sparse == {(1, 1): 1, (1, None): 1, (0, None): 1, (0, 0): 1}
    dense = {(r.label, r.prediction): r.n for r in mt.confusion_matrix(rows, "y", "p", dense=True).collect()}
    assert dense == {**sparse, (0, 1): 0, (1, 0): 0}
    assert {r.row: r.support for r in mt.classification_report(rows, "y", "p").collect()}["accuracy"] == 4


def test_report_names_and_summary(df):
    rows = df(PAIRS, "y int, p int")
    names = df([(0, "zero"), (1, "one")], "class int, name string")
    report = {r.row: r for r in mt.classification_report(rows, "y", "p", names).collect()}
    assert set(report) == {"zero", "one", "2", "3", "4", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"].precision is None and report["accuracy"].support == 8


def test_evaluation_of_nothing(df):
    empty = df([], "y int, p int")
    assert mt.evaluate(empty, "y", "p").first().accuracy == 0.0
    assert mt.confusion_matrix(empty, "y", "p", dense=True).count() == 0


def test_meter(df):
    rows = df([(1, 10.0, 2), (2, 20.0, 3)], "t int, v double, n int")
    m = mt.weighted_meter(rows, "v", "n", "t").first()
    assert (m.avg, m["count"], m.val) == (16.0, 5, 20.0)
    plain = df([(i, 10.0 * (i + 1), 1) for i in range(3)], "t int, v double, n int")
    assert mt.weighted_meter(plain, "v", "n", "t").first().avg == 20.0
    steps = mt.running_average(plain.withColumn("r", F.lit(0)), "v", "n", "t", ["r"], F.col("t"))
    assert [r.running_avg for r in steps.orderBy("t").collect()] == [10.0, 15.0, 20.0]


def test_cross_entropy(df):
    z = [[2.0, 1.0, 0.0], [0.0, 3.0, 0.0], [1000.0, 0.0, 0.0]]
    rows = df([(z[0], 0), (z[1], 2), (z[2], 0)], "z array<double>, y int")
    got = mt.cross_entropy(rows, "z", "y").first()
    want = [math.log(sum(math.exp(v - max(r)) for v in r)) + max(r) - r[y] for r, y in zip(z, (0, 2, 0))]
    assert got.loss == pytest.approx(sum(want) / 3)
    assert got.accuracy == pytest.approx(2 / 3)
    some = df([(z[0], 0), (z[1], None), (None, 1)], "z array<double>, y int")
    assert mt.cross_entropy(some, "z", "y").first()["n"] == 1
    for bad in (3, -1):
        with pytest.raises(Exception, match="has no score"):
            mt.cross_entropy(df([(z[0], 0), (z[1], bad)], "z array<double>, y int"), "z", "y").collect()


def test_latency(df):
    rows = df([(1, 3.0), (1, 5.0), (2, 4.0)], "b int, ms double")
    assert mt.batch_latency(rows, "ms", "b").first()[0] == 6.0


@pytest.mark.parametrize("a,b,who,percent,ratio,inf", [
    (0.8, 0.9, "B", 12.5, 0.125, 0.125),
    (0.9, 0.8, "A", -12.5, -1 / 9, -1 / 9),
    (0.5, 0.5, "A", 0.0, 0.0, 0.0),
    (0.0, 0.5, "B", math.inf, 0.0, math.inf),
    (0.5, 0.0, "A", 0.0, -1.0, -1.0),
])
def test_relative_change(df, a, b, who, percent, ratio, inf):
    x, y = F.col("a"), F.col("b")
    row = df([(a, b)], "a double, b double").select(
        winner(x, y), *[relative_change(x, y, v) for v in ("signed_percent", "ratio", "ratio_or_inf")]
    ).first()
    assert row[0] == who
    assert tuple(row[1:]) == pytest.approx((percent, ratio, inf))
    with pytest.raises(ValueError):
        relative_change(x, y, "other")


def test_argmax_and_softmax(df):
    rows = df([([1.0, 3.0, 3.0],), ([-800.0, -900.0],), (None,)], "z array<double>")
    z = F.col("z")
    got = rows.select(vc.argmax(z).alias("a"), vc.softmax(z).alias("s"), vc.confidence(z).alias("c")).collect()
    assert [r.a for r in got] == [1, 0, None]
    assert sum(got[0].s) == pytest.approx(1.0) and max(got[0].s) == pytest.approx(got[0].c)
    assert got[1].c == pytest.approx(1.0)


@pytest.mark.parametrize("d", [4, 64])
def test_fusion(df, d):
    rng = np.random.default_rng(d)
    a, b = rng.normal(size=(4, d)), rng.normal(size=(4, d))
    params = {"w1": rng.normal(size=(d, 2 * d)), "b1": rng.normal(size=d), "w2": rng.normal(size=(2, d)), "b2": np.zeros(2)}
    rows = df([(x.tolist(), y.tolist()) for x, y in zip(a, b)] + [(None, b[0].tolist())],
              "iris array<double>, fingerprint array<double>")
    x, y = F.col("iris"), F.col("fingerprint")
    got = rows.select(vc.attention_weights(x, y, params).alias("w"), vc.fuse_attention(x, y, params).alias("f")).collect()
    assert got[4].w is None and got[4].f is None
    for i in range(4):
        assert len(got[i].w) == 2 and sum(got[i].w) == pytest.approx(1.0)
        assert got[i].f == pytest.approx((got[i].w[0] * a[i] + got[i].w[1] * b[i]).tolist())
    assert len(sc.extract_embeddings(rows, "concat").first().fused) == 2 * d
    half = sc.extract_embeddings(rows, "weighted_sum").first().fused
    assert half == pytest.approx(((a[0] + b[0]) / 2).tolist())
    with pytest.raises(ValueError):
        sc.extract_embeddings(rows, "sum")


def test_head_relu(df):
    params = {"w1": [[1.0, 0.0], [0.0, 1.0]], "b1": [0.0, 0.0], "w": [[1.0, 1.0], [2.0, 0.0]], "b": [0.5, 0.0]}
    rows = df([([1.0, -5.0],), (None,)], "v array<double>")
    got = rows.select(vc.head_scores(F.col("v"), params).alias("z")).collect()
    assert got[0].z == [1.5, 2.0] and got[1].z is None


def test_pixels(df):
    rows = df([([0.0, 127.5, 255.0],)], "p array<double>")
    one = rows.select(normalize_pixels(F.col("p")).alias("s"), normalize_pixels(F.col("p"), "standard").alias("t")).first()
    assert one.s == [-1.0, 0.0, 1.0] == one.t
    back = rows.select(tensor_decode(tensor_encode(F.col("p").cast("array<float>"))).alias("p")).first()
    assert back.p == [0.0, 127.5, 255.0]
    with pytest.raises(ValueError):
        normalize_pixels(F.col("p"), "other")


def test_image_stats(df):
    rng = np.random.default_rng(0)
    images = [rng.integers(0, 256, n).tolist() for n in (64, 64, 100)] + [[7] * 9, [], None]
    rows = df([(i, p) for i, p in enumerate(images)], "i int, p array<int>")
    got = {r.i: r for r in image_stats(rows, "p").collect()}
    for i in range(3):
        x = np.array(images[i], float)
        m, s = x.mean(), x.std()
        want = [m, s, x.min(), x.max(), np.median(x), np.percentile(x, 25), np.percentile(x, 75),
                ((x - m) ** 3).mean() / s**3, ((x - m) ** 4).mean() / s**4 - 3]
        assert [got[i][k] for k in STATISTICS] == pytest.approx(want)
    assert (got[3]["std"], got[3].skewness, got[3].kurtosis) == (0.0, None, None)
    assert got[4]["mean"] is None and got[5]["mean"] is None


def test_score_blocks_equal_one_block(df):
    rng = np.random.default_rng(5)
    w, b = rng.normal(size=(11, 6)), rng.normal(size=11)
    rows = df([(i, rng.normal(size=6).tolist()) for i in range(50)], "subject_id int, v array<double>")
    whole = sc.score(rows, sc.linear_scorer(w, b), "v").orderBy("subject_id").collect()
    parts = sc.score(rows, sc.linear_scorer(w, b, block_classes=3), "v").orderBy("subject_id").collect()
    assert [r.prediction for r in whole] == [r.prediction for r in parts]
    assert [r.confidence for r in whole] == pytest.approx([r.confidence for r in parts])


def test_ties_go_to_the_smallest_label_across_blocks(df):
    rows = df([(1, [1.0])], "subject_id int, v array<double>")
    for size in (1, 2, 9):
        scorer = sc.linear_scorer([[0.0], [1.0], [1.0], [1.0]], [0.0] * 4, block_classes=size)
        assert sc.score(rows, scorer, "v").first().prediction == 1


def test_centroids_in_blocks(df):
    rng = np.random.default_rng(6)
    rows = df([(i, i % 7, (rng.normal(size=4) + i % 7).tolist()) for i in range(140)], "subject_id int, label int, v array<double>")
    centroids = sc.centroid_fit(rows, "v")
    one = sc.score(rows, sc.centroid_scorer(centroids), "v").orderBy("subject_id").collect()
    many = sc.score(rows, sc.centroid_scorer(centroids, block_classes=2), "v").orderBy("subject_id").collect()
    assert [r.prediction for r in one] == [r.prediction for r in many]
    x = np.array([r.v for r in one])
    y = np.array([r.label for r in one])
    c = np.array([x[y == k].mean(axis=0) for k in range(7)])
    assert [r.prediction for r in one] == ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1).tolist()
    with pytest.raises(ValueError):
        sc.centroid_scorer(centroids.where("label > 99"))


def test_sparse_long_labels_and_hot_ties(df):
    """Labels all over the long range: blocks follow their order, not their values."""
    labels = [-(2**62), -5, 0, 7, 2**40, 2**62]
    centroids = df([(l, [float(i // 2), 0.0], 1) for i, l in enumerate(labels)], "label long, centroid array<double>, n long")
    rows = df([(i, [float(i), 0.0]) for i in range(3)] + [(9, None)], "id int, v array<double>")
    for size in (1, 2, 4, 100):
        scorer = sc.centroid_scorer(centroids, block_classes=size)
        assert scorer.blocks == -(-6 // size)
        got = {r.id: r.prediction for r in sc.score(rows, scorer, "v", "long").collect()}
        assert got == {0: labels[0], 1: labels[2], 2: labels[4], 9: None}
    assert sc.load_scorer(rows.sparkSession, scorer.path) == scorer


def test_a_block_of_classes_is_read_once_for_a_block_of_rows(df, monkeypatch):
    """Fifty blocks, eight batches: each block is read once, or once for each row block that fits the bound."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    centroids = df([(i, rng.normal(size=3).tolist(), 1) for i in range(100)], "label long, centroid array<double>, n long")
    scorer = sc.centroid_scorer(centroids, block_classes=2)
    assert scorer.blocks == 50
    batches = [pa.array([v.tolist() for v in rng.normal(size=(700, 3))] + [None], pa.list_(pa.float64())) for _ in range(8)]
    reads = []
    read = sc._read_block
    monkeypatch.setattr(sc, "_read_block", lambda path, i: reads.append(i) or read(path, i))
    once = pa.concat_arrays(list(sc.best_classes(iter(batches), scorer)))
    assert sorted(reads) == list(range(50)) and len(once) == 8 * 701
    reads.clear()
    monkeypatch.setattr(sc, "ROW_BLOCK_BYTES", 2 * batches[0].nbytes)
    assert pa.concat_arrays(list(sc.best_classes(iter(batches), scorer))) == once and len(reads) == 4 * 50
    table = {r.label: r.centroid for r in centroids.collect()}
    names, c = list(table), np.array(list(table.values()))
    for r, v in zip(once.to_pylist()[:700], batches[0].to_pylist()):
        d = ((c - v) ** 2).sum(axis=1)
        share = np.exp(-d / 2 + d.min() / 2)
        assert r["label"] == names[d.argmin()] and r["confidence"] == pytest.approx(1 / share.sum())


def test_any_model_is_stored_and_loaded(spark, df, tmp_path):
    rng = np.random.default_rng(9)
    rows = df([(str(i), (rng.normal(size=2) + 4 * (i % 3)).tolist(), i % 3) for i in range(60)], "subject_id string, v array<double>, label int").cache()
    models = [
        sc.centroid_scorer(sc.centroid_fit(rows, "v"), path=str(tmp_path / "centroids-1")),
        {"w": [[0.5, -1.0], [1.0, 0.0], [0.0, 0.2]], "b": [0.0, 0.1, 0.0]}, train_classifier(rows, "v", max_iter=5),
    ]
    for model in models:
        path = sc.store_model(spark, model, str(tmp_path / "store"))
        loaded = sc.load_stored(spark, path)
        assert path.startswith(str(tmp_path))
        assert sc.scored_by(rows, loaded, "v").collect() == sc.scored_by(rows, model, "v").collect()
    with pytest.raises(ValueError):
        sc.store_model(spark, sc.linear_scorer([[0.0]], [0.0]), str(tmp_path))


def test_head_parameters_score_like_the_head(df):
    rows = df([("a", [1.0, 2.0], 0), ("b", [3.0, 0.5], 1)], "subject_id string, v array<double>, label int")
    params = {"w": [[0.5, -1.0], [1.0, 0.0], [0.0, 0.2]], "b": [0.0, 0.1, 0.0]}
    got = sc.score_table(rows, params, "v").orderBy("subject_id").collect()
    for r, v in zip(got, ([1.0, 2.0], [3.0, 0.5])):
        z = np.array(params["w"]) @ v + params["b"]
        assert r.prediction == z.argmax() and r.confidence == pytest.approx((np.exp(z) / np.exp(z).sum()).max())


def test_validation(df):
    rows = df([("a", 0, 0.5), ("a", 1, 1.5), (None, 0, 0.1), ("b", 9, None), ("c", None, -0.1)],
              "subject_id string, prediction int, confidence double")
    labels = df([(0,), (1,)], "label int")
    got = {r.rule: r.violations for r in sc.validate_predictions(rows, labels).collect()}
    assert got == {"null_value": 3, "confidence_range": 2, "unknown_label": 1, "duplicate_key": 1}
    assert {r.violations for r in sc.validate_predictions(rows.limit(0), labels).collect()} == {0}


def test_validation_reads_the_predictions_once(spark, df, tmp_path):
    rows = df([("a", 0, 0.5), ("a", 1, 1.5)], "subject_id string, prediction int, confidence double")
    rows.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    checked = sc.validate_predictions(stored, df([(0,)], "label int"))
    assert checked._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert {r.rule: r.violations for r in checked.collect()} == {"null_value": 0, "confidence_range": 1, "unknown_label": 1, "duplicate_key": 1}


def test_tensor_bytes_keep_nulls_and_slices(df):
    rows = df([([1.0, -2.5],), (None,), ([],), ([3.0, None],), ([float(i) for i in range(100)],)], "x array<float>").coalesce(1)
    got = rows.select("x", tensor_encode(F.col("x")).alias("b")).select("x", "b", tensor_decode(F.col("b")).alias("y")).collect()
    assert [None if r.b is None else len(r.b) for r in got] == [8, None, 0, 8, 400]
    assert got[0].y == [1.0, -2.5] and got[1].y is None and got[2].y == [] and math.isnan(got[3].y[1]) and got[4].y == got[4].x
    assert got[0].b == np.array([1.0, -2.5], "<f4").tobytes()
    with pytest.raises(Exception, match="no whole floats"):
        df([(b"abc",)], "b binary").select(tensor_decode(F.col("b"))).collect()


def test_gray_of_mixed_channels(df):
    from ridgeline.functions.pixels import gray_from_bgr, to_gray

    images = [(bytes(range(12)), 3), (None, 3), (bytes(range(4)), 1), (bytes(range(8)), 4), (b"", 3), (bytes(range(3)), None)]
    rows = df(images, "data binary, n int").coalesce(1)
    for method in ("luma", "mean"):
        got = [r[0] for r in rows.select(to_gray(F.col("data"), F.col("n"), method)).collect()]
        for (data, n), g in zip(images, got):
            want = None if data is None or n is None else gray_from_bgr(np.frombuffer(data, np.uint8).reshape(-1, n), method).astype(float).tolist()
            assert g == want
