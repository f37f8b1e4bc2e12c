from collections import Counter

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import splits as sp
from ridgeline.operators.running import numbered, running
from ridgeline.operators.skew import lookup


@pytest.mark.parametrize("n,ratios,sizes", [
    (10, (0.6, 0.2, 0.2), (6, 2, 2)),
    (100, (0.7, 0.15, 0.15), (70, 15, 15)),
    (3, (0.7, 0.15, 0.15), (2, 0, 1)),
    (1, (0.7, 0.15, 0.15), (0, 0, 1)),
    (5000, (0.7, 0.15, 0.15), (3500, 750, 750)),
])
def test_split_sizes_are_exact(spark, n, ratios, sizes):
    got = Counter(r.split for r in sp.exact_split(spark.range(n), "id", ratios).collect())
    assert tuple(got[s] for s in sp.SPLITS) == sizes


def test_repeated_keys_have_no_exact_split(spark):
    rows = spark.range(100).select((F.col("id") % 5).alias("k"))
    with pytest.raises(ValueError, match="repeat"):
        sp.exact_split(rows, "k")


def test_keys_are_never_written_alike(df):
    rows = df([("a:b", "c"), ("a", "b:c"), ("a\\", ":b:c"), ("a", None), ("a", "\\N"), (None, "a"), ("a", "")], "x string, y string")
    hashes = [r[0] for r in rows.select(sp.order_hash(1, "x", "y")).collect()]
    assert len(set(hashes)) == len(hashes)
    assert sp.exact_split(rows, ["x", "y"]).count() == 7


def test_same_seed_same_split(spark):
    rows = spark.range(300)
    first = sp.exact_split(rows, "id", seed=7).where("split = 'train'")
    again = sp.exact_split(rows.repartition(5), "id", seed=7).where("split = 'train'")
    other = sp.exact_split(rows, "id", seed=8).where("split = 'train'")
    assert first.exceptAll(again).count() == 0
    assert first.exceptAll(other).count() > 0


def test_groups_stay_together_under_a_hot_group(spark):
    rows = spark.range(900).withColumn("g", F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 20))
    parted = sp.grouped_split(rows, "g")
    assert parted.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    groups = Counter(r.split for r in parted.select("g", "split").distinct().collect())
    assert groups == {"train": 14, "val": 3, "test": 3}


def test_batches(spark):
    rows = spark.range(25)
    kept = sp.assign_batches(rows, "id", 8, drop_last=True)
    assert Counter(r.batch_id for r in kept.collect()) == {0: 8, 1: 8, 2: 8}
    every = sp.assign_batches(rows, "id", 8)
    assert Counter(r.batch_id for r in every.collect()) == {0: 8, 1: 8, 2: 8, 3: 1}
    assert sp.assign_batches(rows, "id", 32, drop_last=True).count() == 0
    orders = {e: tuple(r.id for r in sp.assign_batches(rows, "id", 8, epoch=e).orderBy("batch_id", "id").collect())
              for e in (1, 2)}
    assert orders[1] != orders[2]


def test_batches_within_splits_drop_their_own_rest(spark):
    rows = spark.range(30).withColumn("split", F.when(F.col("id") < 20, "train").otherwise("val"))
    kept = sp.assign_batches(rows, "id", 8, within=["split"], drop_last=True)
    assert Counter((r.split, r.batch_id) for r in kept.collect()) == {("train", 0): 8, ("train", 1): 8, ("val", 0): 8}


def test_collate_keeps_rows_and_order(df):
    rows = df([(0, 2, "b", [3.0]), (0, 1, "a", [1.0]), (1, 3, "c", [5.0])], "batch_id long, k int, s string, x array<double>")
    got = {r.batch_id: r for r in sp.collate(rows, ["batch_id"], "k").collect()}
    assert [x.k for x in got[0].rows] == [1, 2] and got[0].n == 2
    assert got[1].rows[0].s == "c"


def test_sample_cap(spark):
    rows = spark.range(50)
    assert [r.id for r in sp.sample_cap(rows, "id", 3).collect()] == [0, 1, 2]
    assert sp.sample_cap(rows, "id", None).count() == 50


@pytest.mark.parametrize("before", [False, True])
def test_running_equals_one_window(spark, before):
    # A hot key over many segments, a small one in a single segment.
    rows = spark.range(400).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"),
        F.col("id").alias("t"), (F.col("id") * 37 % 101).cast("double").alias("v"),
    )
    out = running(rows, ["k"], F.floor(F.col("t") / 13), ["t"], {
        "s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v")),
    }, before=before).toPandas().sort_values(["k", "t"])
    plain = rows.toPandas().sort_values(["k", "t"])
    by = plain.groupby("k").v
    want = {"s": by.cumsum(), "lo": by.cummin(), "hi": by.cummax()}
    for name, values in want.items():
        if before:
            values = values.groupby(plain.k).shift()
        assert out[name].fillna(-1).tolist() == values.fillna(-1).tolist()


def test_numbered_without_keys(spark):
    out = numbered(spark.range(1000), [], F.floor(F.col("id") / 77), ["id"], "n")
    assert out.where("n != id + 1").count() == 0


def test_null_keys_are_refused(df):
    rows = df([(None, 1), ("a", 2)], "k string, t int")
    with pytest.raises(Exception, match="key or segment is NULL"):
        numbered(rows, ["k"], F.lit(0), ["t"], "n").collect()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_plain_join(df, how):
    rows = df([("hot", i) for i in range(60)] + [("a", 1), ("b", 2), (None, 3)], "k string, i int")
    names = df([("hot", "H"), ("a", "A"), ("z", "Z")], "k string, name string")
    got = lookup(rows, names, "k", ["i"], how, min_hot_rows=7)
    want = rows.join(names, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_totals(df):
    rows = df([("a", i) for i in range(10)] + [("b", 1)], "k string, t int")
    out = running(rows, ["k"], F.floor(F.col("t") / 3), ["t"], {"n": ("sum", F.lit(1))}, totals=True)
    assert {(r.k, r.n_total) for r in out.collect()} == {("a", 10), ("b", 1)}
