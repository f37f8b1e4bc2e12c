import numpy as np
import pytest
from images import bitmap_bytes, flat, palette_bitmap, put, small_corpus
from pyspark.sql import functions as F

from ridgeline.functions.bitmaps import decode_bitmap
from ridgeline.functions.names import name_attributes, subject_id_prefix, subject_id_strict
from ridgeline.functions.pixels import gray_from_bgr
from ridgeline.operators import images as im
from ridgeline.operators import labels as lb
from ridgeline.operators import pairing as pr
from ridgeline.plans.preprocessing import image_feature_job, pair_table
from ridgeline.sources import corpus as cp


def test_names_follow_their_rules(df):
    rows = df([("0011_x.bmp",), ("001_L_02.bmp",), ("12_L_1.bmp",), ("005_R_index_07.BMP",)], "name string")
    got = name_attributes(rows, "name").select(
        "name", subject_id_strict("name").alias("strict"), subject_id_prefix("name").alias("prefix"),
        "side", "finger", "sample_number",
    ).collect()
    assert [tuple(r) for r in got] == [
        ("0011_x.bmp", "001", "0011", None, None, None),
        ("001_L_02.bmp", "001", "001", "L", None, 2),
        ("12_L_1.bmp", None, "12", "L", None, 1),
        ("005_R_index_07.BMP", "005", "005", "R", "index", 7),
    ]


def test_scan_counts_and_verifies(spark, tmp_path):
    small_corpus(tmp_path, 3)
    put(tmp_path, "iris/notes.txt", b"x")
    put(tmp_path, "iris/003_L_01.BMP", flat(1))  # iris names are lower case only
    put(tmp_path, "fingerprint/004_L_thumb_01.bmp", flat(1))
    files = cp.list_corpus(spark, str(tmp_path))
    assert tuple(cp.verify_corpus(files).first()) == (3, 4, True)
    assert cp.scan_corpus(spark, str(tmp_path)).count() == 7


def test_many_small_files_are_few_tasks(spark, tmp_path, monkeypatch):
    small_corpus(tmp_path, 30)
    monkeypatch.setattr(cp, "TASKS_PER_CORE", 0)
    confs = {"spark.sql.files.openCostInBytes": str(4 << 20), "spark.sql.files.maxPartitionBytes": str(4 << 20)}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        for read in (cp.scan_corpus, cp.list_corpus, cp.read_corpus):
            files = read(spark, str(tmp_path))
            assert files.rdd.getNumPartitions() == -(-60 // cp.SHARES_PER_TASK) and files.select("path").distinct().count() == 60
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_nested_empty_and_missing_folders(spark, tmp_path):
    small_corpus(tmp_path / "nested" / "archive", 2)
    assert cp.verify_corpus(cp.list_corpus(spark, str(tmp_path / "nested"))).first().valid
    (tmp_path / "empty" / "iris").mkdir(parents=True)
    (tmp_path / "empty" / "fingerprint").mkdir()
    for root in (tmp_path / "empty", tmp_path / "nowhere"):
        assert tuple(cp.verify_corpus(cp.list_corpus(spark, str(root))).first()) == (0, 0, False)
        assert cp.scan_corpus(spark, str(root)).count() == 0
        assert cp.read_corpus(spark, str(root)).count() == 0


def test_five_subjects_two_files_make_twenty_pairs(spark, tmp_path):
    files = cp.with_subject(cp.list_corpus(spark, str(small_corpus(tmp_path, 5, 2))))
    pairs = pr.pair_samples(*cp.split_modalities(files))
    assert pairs.count() == 20
    counts = pr.corpus_counts(files).first()
    assert (counts.pairs, counts.num_classes) == (20, 5)
    labels = lb.build_label_index(pairs, "subject_id").orderBy("label").collect()
    assert [tuple(r) for r in labels] == [(f"{i:03d}", i) for i in range(5)]


@pytest.mark.parametrize("hot", [4, 20, 35, 1000])
def test_salted_pairs_equal_plain_join(df, hot):
    # One subject holds most of each side, another only of the fingerprints.
    iris = df([("a", f"i{k}") for k in range(40)] + [("b", "ib"), ("c", "ic")], "subject_id string, path string")
    finger = df([("a", f"f{k}") for k in range(30)] + [("b", f"fb{k}") for k in range(25)] + [("d", "fd")],
                "subject_id string, path string")
    got = sorted(tuple(r) for r in pr.pair_samples(iris, finger, min_hot_rows=hot).collect())
    want = [("a", f"i{i}", f"f{j}") for i in range(40) for j in range(30)]
    want += [("b", "ib", f"fb{k}") for k in range(25)]
    assert got == sorted(want)


def test_hot_subjects_get_a_grid(df):
    iris = df([("a", f"i{k}") for k in range(40)] + [("b", "ib")], "subject_id string, path string")
    finger = df([("a", f"f{k}") for k in range(9)] + [("c", f"c{k}") for k in range(5)], "subject_id string, path string")
    assert sorted(tuple(r) for r in pr._grid(iris, finger, 4).collect()) == [("a", 10, 3), ("c", 1, 2)]


def test_cells_are_bounded_by_their_pairs(df, monkeypatch):
    sizes = {"a": (40, 30), "b": (1, 25), "c": (5, 50), None: (30, 30)}
    iris, finger = (
        df([(s, f"{side}{s}{k}") for s, n in sizes.items() for k in range(n[at])], "subject_id string, path string")
        for at, side in enumerate("if")
    )
    monkeypatch.setattr(pr, "CELL_PAIRS", 100)
    grid = pr._grid(iris, finger, 1000).where("subject_id is not null")
    assert sorted(tuple(r) for r in grid.collect()) == [("a", 4, 3), ("c", 1, 3)]
    want = iris.withColumnRenamed("path", "iris_path").join(finger.withColumnRenamed("path", "fingerprint_path"), "subject_id")
    # Tasks by the pairs, 1475 of them, not by the bytes of the rows.
    for most, tasks in ((1475, None), (1474, 4), (60, 25)):
        monkeypatch.setattr(pr, "PAIRS_PER_TASK", most)
        made = pr.pair_samples(iris, finger)
        assert tasks is None or made.rdd.getNumPartitions() == tasks
        assert made.count() == 1475 and made.exceptAll(want).count() == 0


def test_tasks_for_pairs_do_not_grow_without_end(df):
    counts = df([("a", 10**6, 10**6), ("b", 1, 1), (None, 10**9, 10**9)], "subject_id string, iris long, fingerprint long")
    assert pr._tasks(counts) == pr.MAX_TASKS
    assert pr._tasks(counts.where("subject_id = 'b'")) is None


def test_many_pairs_are_not_made_by_a_broadcast(spark, df, tmp_path, monkeypatch, capsys):
    for side in "if":
        df([("a", f"{side}{k}") for k in range(9)], "subject_id string, path string").write.parquet(f"{tmp_path}/{side}")
    iris, finger = (spark.read.parquet(f"{tmp_path}/{side}") for side in "if")
    monkeypatch.setattr(pr, "PAIRS_PER_TASK", 80)
    made = pr.pair_samples(iris, finger)
    made.explain()
    plan = capsys.readouterr().out
    # Small tables, but only the grid of hot subjects is broadcast, once to each side.
    assert (plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")) == (1, 2)
    assert made.count() == 81


def test_label_rank_is_global(spark):
    ids = spark.range(5000).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("subject_id"))
    labels = lb.build_label_index(ids.union(ids), "subject_id")
    assert labels.where(F.col("label") != F.substring("subject_id", 2, 6).cast("int")).count() == 0
    assert labels.count() == 5000


def reference_resize(gray, size):
    """The filter by its definition, one output pixel at a time."""

    def axis(values, target):
        source = len(values)
        scale, out = source / target, []
        reach = max(scale, 1.0)
        for o in range(target):
            centre = (o + 0.5) * scale
            low, high = max(int(centre - reach + 0.5), 0), min(int(centre + reach + 0.5), source)
            w = [max(0.0, 1 - abs((i + 0.5 - centre) / reach)) for i in range(low, high)]
            total = sum(w)
            fixed = [int(x / total * (1 << 22) + 0.5) for x in w]
            acc = sum(int(v) * f for v, f in zip(values[low:high], fixed))
            out.append(min(max((acc + (1 << 21)) >> 22, 0), 255))
        return out

    if gray.shape[1] != size[1]:
        gray = np.array([axis(row, size[1]) for row in gray])
    if gray.shape[0] != size[0]:
        gray = np.array([axis(col, size[0]) for col in gray.T]).T
    return gray


@pytest.mark.parametrize("shape,size", [((20, 30), (8, 8)), ((7, 5), (13, 11)), ((9, 9), (9, 4)), ((16, 16), (16, 16))])
def test_resize_equals_definition(shape, size):
    gray = np.random.default_rng(1).integers(0, 256, shape, dtype=np.uint8)
    assert (im.resize_bilinear(gray, size) == reference_resize(gray, size)).all()


def test_resize_keeps_flat_and_ramp():
    assert (im.resize_bilinear(np.full((100, 100), 77, np.uint8), (64, 64)) == 77).all()
    ramp = np.tile(np.arange(0, 200, 2, dtype=np.uint8), (100, 1))
    small = im.resize_bilinear(ramp, (50, 50)).astype(int)
    assert (np.diff(small[0]) >= 3).all() and (np.diff(small[0]) <= 5).all()
    assert (small == small[0]).all()


def test_bitmap_depths_decode_alike():
    gray = np.random.default_rng(2).integers(0, 256, (5, 7), dtype=np.uint8)
    assert (decode_bitmap(bitmap_bytes(gray)) == gray).all()
    assert (decode_bitmap(palette_bitmap(gray)) == gray).all()
    for broken in (b"", b"BM", palette_bitmap(gray)[:-30], b"XX" + palette_bitmap(gray)[2:]):
        with pytest.raises(ValueError):
            decode_bitmap(broken)


def test_luma_is_the_integer_formula():
    rng = np.random.default_rng(3)
    pixels = rng.integers(0, 256, (500, 3), dtype=np.uint8)
    pixels[:2] = [[0, 0, 0], [255, 255, 255]]
    b, g, r = pixels.T.astype(int)
    assert (gray_from_bgr(pixels) == (19595 * r + 38470 * g + 7471 * b + 32768) >> 16).all()


def test_both_decoders_agree_and_count_failures(spark, tmp_path):
    rng = np.random.default_rng(4)
    for s in range(4):
        gray = rng.integers(0, 256, (40 + s, 50), dtype=np.uint8)
        put(tmp_path, f"iris/{s:03d}_L_01.bmp", bitmap_bytes(gray))
        put(tmp_path, f"fingerprint/{s:03d}_L_thumb_01.BMP", palette_bitmap(gray))
    put(tmp_path, "iris/000_R_01.bmp", b"BM not an image")
    root = str(tmp_path)
    fast = im.preprocess_images(cp.read_corpus(spark, root), (16, 16))
    slow = im.preprocess_images(cp.scan_corpus(spark, root), (16, 16))

    def by_name(rows):
        return {(r.modality, r.name): (r.ok, r.features) for r in rows.collect()}

    assert by_name(fast) == by_name(slow)
    assert fast.where("not ok").select("name").collect() == [("000_R_01.bmp",)]
    values = [v for ok, f in by_name(fast).values() if ok for v in f]
    assert -1.0 <= min(values) < max(values) <= 1.0
    stats = im.preprocess_stats(cp.with_subject(fast), 2.0).first()
    assert (stats.total_samples, stats.processed_samples, stats.failed_samples) == (5, 4, 1)
    assert stats.throughput == 2.0


@pytest.mark.parametrize("side,size", [(100, 64), (200, 32)])
def test_feature_shape_and_range(spark, tmp_path, side, size):
    put(tmp_path, "iris/001_L_01.bmp", flat(255, side, side))
    row = im.preprocess_images(cp.read_corpus(spark, str(tmp_path)), (size, size)).first()
    assert (len(row.features), row.height, row.width) == (size * size, size, size)
    assert set(row.features) == {1.0}


def test_job_writes_one_row_per_image_and_pairs_later(spark, tmp_path):
    features, stats = image_feature_job(spark, str(small_corpus(tmp_path, 3, 2)), size=(8, 8))
    assert features.count() == 12
    assert stats.first().processed_samples == 12
    table = pair_table(features)
    assert table.count() == 12
    row = table.first()
    assert len(row.iris_features) == len(row.fingerprint_features) == 64


def test_failing_transform_is_counted(spark, tmp_path):
    small_corpus(tmp_path, 2)

    def transform(gray):
        if gray[0, 0] == 50:
            raise RuntimeError("no")
        return gray[:2, :2] / 255

    out = im.preprocess_images(cp.read_corpus(spark, str(tmp_path)), transform=transform)
    assert out.where("ok").count() == 3
    assert out.where("ok").first().height is None


def test_stored_pairs_have_buckets_by_their_number(spark, df, tmp_path, monkeypatch):
    from ridgeline.workloads import QUERIES, corpus

    assert [corpus.pair_buckets(n) for n in (0, 80_000_000, 80_000_001, 10**12)] == [8, 8, 9, 1000]
    rows = [(i, i % 20, "view" if i % 3 else "click") for i in range(300)]
    df(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(corpus, "PAIRS_PER_BUCKET", 60)
    made = QUERIES["pair_samples_bucketed"](spark, str(tmp_path))
    want = QUERIES["pair_samples"](spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == -(-want.count() // 60) > 8
    assert made.exceptAll(want).count() == want.exceptAll(made).count() == 0


def test_stored_pairs_of_a_hot_subject_are_in_many_buckets(spark, df, tmp_path, monkeypatch, capsys):
    from ridgeline.workloads import QUERIES, corpus

    # Subject 011 makes 2,500 of 2,600 pairs, subject 012 has no fingerprint.
    rows = [(i, 11, "view" if i % 2 else "click") for i in range(100)] + [(i + 100, 12, "click") for i in range(30)]
    rows += [(i + 200, 13, "view" if i % 2 else "click") for i in range(20)]
    df(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(corpus, "PAIRS_PER_BUCKET", 100)
    made = QUERIES["pair_samples_bucketed"](spark, str(tmp_path))
    made.explain()
    assert "Exchange" not in capsys.readouterr().out
    parts = [r["n"] for r in made.where("subject_id = '011'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(parts) == 2500 and len(parts) > 4 and max(parts) < 1000
    want = QUERIES["pair_samples"](spark, str(tmp_path))
    assert made.count() == 2600 and made.exceptAll(want).count() == want.exceptAll(made).count() == 0
