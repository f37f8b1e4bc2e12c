"""Files read by a stored plan, and folders listed in tasks."""

import tracemalloc

import pytest
from images import flat, put
from pyspark.sql import functions as F

from ridgeline.sources import corpus as cp
from ridgeline.sources import planned as pl


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for d in range(80):
        for i in range(25):
            put(root, f"a b/{d % 8}/{d}/iris/{i:03d}_L é.bmp", bytes([i]) * (10 * i + 1))
    put(root, "fingerprint/001_L_thumb.BMP", flat(1))
    put(root, "_hidden/iris/001.bmp", b"x")
    put(root, "iris/.001.bmp", b"x")
    put(root, "iris/002_R.BMP", b"x")
    return root


def test_listing_equals_the_sources(spark, tree):
    made = pl.list_tree(spark, str(tree), folders_per_task=3)
    theirs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tree)).select("path", "length")
    assert made.count() == theirs.count() == 2002
    assert made.exceptAll(theirs).count() == 0
    files = cp.list_files(spark, str(tree))
    assert files.exceptAll(cp.list_corpus(spark, str(tree))).count() == 0 and files.count() == 2001
    for root in (f"file:{tree}/fingerprint", f"file://{tree}/fingerprint"):
        assert [r.length for r in pl.list_tree(spark, root).collect()] == [len(flat(1))]


def test_a_folder_is_listed_piece_by_piece(tmp_path):
    """The entries of one folder are handed on as they are found, not gathered first."""
    put(tmp_path, "iris/sub/x.bmp", b"12")
    for i in range(2500):
        put(tmp_path, f"iris/{i:04d}.bmp", b"z" * (i % 7))
    (tmp_path / "iris" / "gone.bmp").symlink_to(tmp_path / "nowhere")
    store, name = pl.open_store(f"{tmp_path}/iris")
    tracemalloc.start()
    found = pl._entries(store, name)
    assert next(found)[0].startswith(f"{tmp_path}/iris/") and tracemalloc.get_traced_memory()[1] < 100_000
    tracemalloc.stop()
    rows = {path.rsplit("/", 1)[1]: (size, folder) for path, size, folder in pl._entries(store, name)}
    assert len(rows) == 2502 and rows["sub"] == (0, True) and rows["gone.bmp"] == (0, False)
    assert all(rows[f"{i:04d}.bmp"] == (i % 7, False) for i in range(2500))


def test_small_files_are_many_to_a_task(spark, tree):
    """Two thousand files below a kilobyte are no hundred tasks of 8 MB."""
    files = cp.list_files(spark, str(tree)).where("length < 1000")
    read = pl.read_planned(files, 8 << 20)
    assert read.rdd.getNumPartitions() <= 20 and read.count() == 2000
    many = pl.read_planned(files, 1 << 20)
    assert many.rdd.getNumPartitions() > 100 and many.count() == 2000


def test_missing_and_empty_folders(spark, tmp_path):
    assert pl.list_tree(spark, str(tmp_path)).count() == 0
    assert pl.list_tree(spark, str(tmp_path / "nowhere")).count() == 0
    assert cp.read_tree(spark, str(tmp_path)).count() == 0


def test_tasks_follow_the_bytes(spark, tree):
    """Two thousand small rows: as many tasks as their bytes ask for, each within the target."""
    files = cp.list_files(spark, str(tree)).where("length < 1000")
    total = files.agg(F.sum("length")).first()[0]
    for target in (total // 40, total // 7, 10 * total):
        read = pl.read_planned(files, target, open_bytes=0)
        tasks = read.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).collect()
        asked = -(-total // target)
        assert asked - 1 <= read.rdd.getNumPartitions() <= asked and len(tasks) == read.rdd.getNumPartitions()
        assert max(t.bytes for t in tasks) <= target + files.agg(F.max("length")).first()[0]
        assert sum(t.n for t in tasks) == 2000 and read.where("octet_length(content) <> length").count() == 0


def test_files_larger_than_the_target(df, tmp_path):
    for i, n in enumerate([5000, 10, 10, 7000, 10]):
        put(tmp_path, f"iris/{i:03d}.bmp", b"z" * n)
    files = df([(f"{tmp_path}/iris/{i:03d}.bmp", n) for i, n in enumerate([5000, 10, 10, 7000, 10])], "path string, length long")
    read = pl.read_planned(files, 1000, 0)
    assert read.count() == 5 and {len(r.content) for r in read.collect()} == {10, 5000, 7000}
    dealt = pl.deal_by_bytes(files, "length", ["path"], 1000)
    # Five rows in the three bins that have any; no task without rows.
    assert dealt.rdd.getNumPartitions() == dealt.select(F.spark_partition_id()).distinct().count() == 3
    assert sorted(tuple(r) for r in dealt.collect()) == sorted(tuple(r) for r in files.collect())
    assert pl.deal_by_bytes(files.limit(0), "length", ["path"], 1000).count() == 0


def test_ranges_missing_files_and_null_paths(df, tmp_path):
    put(tmp_path, "x", bytes(range(100)))
    rows = [(f"{tmp_path}/x", 0, 10), (f"{tmp_path}/x", 90, 50), (f"{tmp_path}/x", 90, 50), (f"{tmp_path}/none", 0, 5), ("nostore://x", 0, 1), (None, 0, 1)]
    read = pl.read_planned(df(rows, "path string, start long, length long"), 20, 0)
    got = sorted((r.path, r.start, None if r.content is None else bytes(r.content)) for r in read.collect())
    assert got == sorted([
        (f"{tmp_path}/x", 0, bytes(range(10))), (f"{tmp_path}/x", 90, bytes(range(90, 100))), (f"{tmp_path}/x", 90, bytes(range(90, 100))),
        (f"{tmp_path}/none", 0, None), ("nostore://x", 0, None),
    ], key=lambda r: (r[0], r[1]))
    assert pl.read_planned(df([], "path string, length long")).count() == 0


def test_a_manifest_with_lengths_reads_files_as_they_are(spark, df, tmp_path):
    put(tmp_path, "iris/001.bmp", b"12345")
    for lengths in ([("length", 1)], [("length", None)], []):
        frame = df([(f"{tmp_path}/iris/001.bmp", *[v for _, v in lengths])], ", ".join(["path string", *[f"{n} long" for n, _ in lengths]]))
        assert [bytes(r.content) for r in cp.read_manifest(frame).collect()] == [b"12345"]


def test_the_package_reaches_the_workers(spark):
    import sys
    import zipfile

    from ridgeline.runtime import ship_package

    ship_package(spark)
    sent = [f for f in spark.sparkContext.listFiles if f.endswith("ridgeline-package.zip")]
    assert len(sent) == 1 and spark.sparkContext._ridgeline_shipped

    def imported(batches):
        import pandas as pd

        for _ in batches:
            from ridgeline import runtime

            yield pd.DataFrame({"path": [runtime.__file__]})

    assert spark.range(1).mapInPandas(imported, "path string").first().path.endswith("runtime.py")
    names = zipfile.ZipFile(next(p for p in sys.path if p.endswith("ridgeline-package.zip"))).namelist()
    assert {"ridgeline/runtime.py", "ridgeline/__init__.py", "ridgeline/operators/drift.py"} <= set(names)
