"""Windows kept as sketches against the exact form."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ridgeline.operators.drift import reference_profiles
from ridgeline.streaming import drift as sd
from ridgeline.streaming import sketches as sk

START = datetime(2024, 1, 1)


def rows(n, days, seed, shift=0.0):
    draw = random.Random(seed)
    return [
        (START + timedelta(days=draw.randrange(days), seconds=draw.randrange(86_400)), draw.choice([0.0, 0.0, 5.0, draw.gauss(shift, 3)]), draw.random() if draw.random() < 0.9 else None)
        for _ in range(n)
    ] + [(START, float("nan"), None)]


SCHEMA = "ts timestamp, a double, b double"


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(rows(4000, 1, 1), SCHEMA).cache(), spark.createDataFrame(rows(30_000, 3, 2, 0.4), SCHEMA).cache()


def by_window(made):
    return {(r.window_start, r.feature): r for r in made.collect()}


@pytest.mark.parametrize("k,points", [(64, 20), (512, 200), (4096, 1000)])
def test_error_stays_within_the_bound(sides, k, points):
    ref, cur = sides
    exact = by_window(sd.windowed_drift(ref, cur, "ts", "1 day", ["a", "b"]))
    near = by_window(sk.sketched_drift(ref, cur, "ts", "1 day", ["a", "b"], k=k, points=points))
    assert set(near) == set(exact) and len(near) == 6
    for key, r in near.items():
        assert r.error == pytest.approx(sk.rank_error(k) + 1 / points)
        assert abs(r.ks_statistic - exact[key].ks_statistic) <= r.error
        assert (r.n_ref, r.n_cur) == (exact[key].n_ref, exact[key].n_cur)


def test_fine_enough_is_exact(spark, sides):
    ref, _ = sides
    cur = spark.createDataFrame(rows(900, 3, 3, 1.0), SCHEMA)
    exact = by_window(sd.windowed_drift(ref, cur, "ts", "1 day", ["a", "b"]))
    near = by_window(sk.sketched_drift(ref, cur, "ts", "1 day", ["a", "b"], k=2048, points=100_000))
    for key, r in near.items():
        assert r.ks_statistic == pytest.approx(exact[key].ks_statistic, abs=1e-12) and r.p_value == pytest.approx(exact[key].p_value, abs=1e-9)


def test_grid_is_bounded_and_ends_at_the_largest_value(sides):
    ref, _ = sides
    profiles = reference_profiles(ref, ["a", "b"])
    for g, name in zip(sk.reference_grid(ref, profiles, 50), "ab"):
        assert len(g.places) == len(g.heights) <= 2 * 51 and list(g.heights) == sorted(g.heights) and g.heights[-1] == 1.0
        assert g.places[-1] == ref.where(~F.isnan(name)).agg(F.max(name)).first()[0]


def test_state_does_not_grow_with_the_values(spark, sides):
    ref, _ = sides
    profiles = reference_profiles(ref, ["b"])
    size = []
    for n in (2_000, 20_000, 100_000):
        cur = spark.range(n).select(F.lit(START).alias("ts"), F.lit(0.0).alias("a"), F.rand(1).alias("b"))
        made = sk.window_sketches(cur, profiles, "ts", "1 day", 128).select(F.octet_length("sketch"), "n").collect()
        assert [r.n for r in made] == [n]
        size.append(made[0][0])
    assert size[2] < 1.5 * size[0] < 128 * 8 * 8


def test_merged_sketches_stand_for_all_values(spark, sides):
    ref, cur = sides
    profiles = reference_profiles(ref, ["a", "b"])
    halves = [sk.window_sketches(cur.where(F.hash("a", "b") % 2 == i), profiles, "ts", "1 day", 4096) for i in (0, 1, -1)]
    merged = sk.merged_sketches(*halves)
    near = by_window(sk.sketched_ks(sk.reference_grid(ref, profiles), merged, profiles, k=4096))
    exact = by_window(sd.windowed_drift(ref, cur, "ts", "1 day", ["a", "b"]))
    assert all(r.n_cur == exact[k].n_cur and abs(r.ks_statistic - exact[k].ks_statistic) <= r.error for k, r in near.items()) and len(near) == 6


def test_stream_equals_batch(spark, sides, tmp_path):
    ref, _ = sides
    late = [(START + timedelta(days=9), 0.0, 0.0)]
    spark.createDataFrame(rows(800, 3, 4) + late, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    sk.stream_sketched_drift(ref, stream, str(tmp_path / "out"), str(tmp_path / "check"), "ts", columns=["a", "b"]).awaitTermination()
    got = by_window(spark.read.parquet(str(tmp_path / "out")))
    want = by_window(sk.sketched_drift(ref, spark.read.parquet(str(tmp_path / "in")), "ts", columns=["a", "b"]))
    assert got == {k: v for k, v in want.items() if k[0] < START + timedelta(days=9)} and len(got) == 6
