from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import history as hs
from ridgeline.operators import versions as vs

START = datetime(2024, 1, 1)
AT = datetime(2025, 1, 1)
SCHEMA = "model string, version int, event_ts timestamp, seq long, alias string, tags map<string,string>, metrics map<string,double>"


@pytest.fixture
def log(df):
    def make(*events):
        rows = [
            (m, v, START + timedelta(hours=i), 0, alias, {"alias": alias or "none"}, {} if f1 is None else {"f1_macro": f1})
            for i, (m, v, alias, f1) in enumerate(events)
        ]
        return df(rows, SCHEMA)
    return make


def state(events):
    return {(r.model, r.version): r.alias for r in vs.current_versions(events).collect()}


def test_register_numbers_on_and_merges_tags(df, log):
    old = log(("m", 4, "champion", 0.5))
    new = df([("m", START, 1, {"team": "x", "alias": "mine"}, {"f1": 0.123456}), ("m", AT, 1, None, {"acc": 1.0}),
              ("n", START, 1, None, {})],
             "model string, event_ts timestamp, run int, tags map<string,string>, metrics map<string,double>")
    got = {(r.model, r.version): r for r in vs.register(old, new, "run").collect()}
    assert set(got) == {("m", 5), ("m", 6), ("n", 1)}
    assert got["m", 5].tags["metric_f1"] == "0.1235" and got["m", 5].tags["alias"] == "mine"
    assert got["m", 5].tags["team"] == "x" and got["m", 6].tags["alias"] == "challenger"
    assert got["n", 1].alias == "challenger"
    assert {(r.model, r.alias): r.version for r in vs.alias_holders(vs.registered(old, new, "run")).collect()} == {
        ("m", "champion"): 4, ("m", "challenger"): 6, ("n", "challenger"): 1}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_registration_at_one_time_follows_the_tie_break(df, log, parts):
    rows = [("m", START, i, {"n": str(i)}, {}) for i in range(40, 0, -1)]
    new = df(rows, "model string, event_ts timestamp, run int, tags map<string,string>, metrics map<string,double>").repartition(parts)
    after = vs.registered(log(("m", 2, "challenger", 0.5)), new, "run")
    got = {r.version: (r.tags.get("n"), r.alias) for r in vs.current_versions(after).collect()}
    assert got == {2: (None, None), **{i + 2: (str(i), "challenger" if i == 40 else None) for i in range(1, 41)}}
    assert {r.alias: r.version for r in vs.alias_holders(after).collect()} == {"challenger": 42}


def test_promotion_leaves_no_challenger(df, log):
    events = log(("m", 1, "champion", 0.5), ("m", 2, "challenger", 0.6), ("m", 3, "challenger", 0.7))
    once = vs.promote(events, vs.should_promote(events), AT)
    assert {r.alias: r.version for r in vs.alias_holders(once).where("alias <> 'archived'").collect()} == {"champion": 3}
    again = vs.should_promote(once)
    assert [(r.promote, r.reason) for r in again.collect()] == [(False, "no challenger")]
    twice = vs.promote(once, again.withColumn("promote", F.lit(True)), AT)
    assert vs.alias_holders(twice).where("alias = 'challenger'").count() == 0


def test_steps_at_one_time_follow_each_other(log):
    events = log(("m", 1, "archived", 0.4), ("m", 2, "champion", 0.5), ("m", 3, "challenger", 0.7))
    after = vs.rollback(vs.promote(events, vs.should_promote(events), AT), AT)
    # Promotion archived version 2, which going back takes up again.
    assert state(after) == {("m", 1): "archived", ("m", 2): "champion", ("m", 3): "archived"}


def test_steps_dated_back_act_like_others(df, log):
    early = START - timedelta(days=9)
    events = log(("m", 1, "champion", 0.5), ("m", 2, "challenger", 0.7))
    after = vs.promote(events, None, early)
    holders = {r.alias: (r.version, r.event_ts) for r in vs.alias_holders(after).collect()}
    assert holders == {"champion": (2, early), "archived": (1, early)}
    back = vs.rollback(after, early)
    assert {r.alias: r.version for r in vs.alias_holders(back).collect()} == {"champion": 1, "archived": 2}
    assert [(r.version, r.done) for r in vs.rollback_outcome(after).collect()] == [(1, True)]
    # Each step has its own number, so the log can be read as it stood.
    assert state(vs.as_of(back, 0)) == state(events) and state(vs.as_of(back, 1)) == state(after)


def test_late_registration_takes_the_alias(df, log):
    events = log(("m", 1, "champion", 0.5), ("m", 2, "challenger", 0.7))
    new = df([("m", START - timedelta(days=9), 1, None, {}), ("m", START - timedelta(days=99), 2, None, {})],
             "model string, event_ts timestamp, run int, tags map<string,string>, metrics map<string,double>")
    after = vs.registered(events, new, "run")
    assert {r.alias: r.version for r in vs.alias_holders(after).collect()} == {"champion": 1, "challenger": 4}
    assert state(after)["m", 2] is None and vs.pick_model(after, alias="challenger").first().version == 4
    again = vs.registered(after, new.limit(1), "run")
    assert {r.alias: r.version for r in vs.alias_holders(again).collect()} == {"champion": 1, "challenger": 5}


def test_unknown_rollback_target_changes_nothing(df, log):
    events = log(("a", 1, "archived", 0.4), ("a", 2, "champion", 0.5), ("b", 1, "champion", 0.1))
    targets = df([("a", 9), ("b", 1), ("c", 1)], "model string, version int")
    assert state(vs.rollback(events, AT, targets)) == state(events)
    assert {r.model: r.done for r in vs.rollback_outcome(events, targets).collect()} == {"a": False, "b": True, "c": False}


def test_alias_moves_to_the_latest(log):
    events = log(("m", 1, "champion", 0.5), ("m", 2, "champion", 0.6), ("m", 1, "archived", 0.5))
    holders = {r.alias: r.version for r in vs.alias_holders(events).collect()}
    assert holders == {"champion": 2, "archived": 1}
    # The last one given the alias moved on: nobody falls back into it.
    gone = log(("m", 1, "champion", 0.5), ("m", 2, "champion", 0.6), ("m", 2, "archived", 0.6))
    assert {r.alias: r.version for r in vs.alias_holders(gone).collect()} == {"archived": 2}
    assert [r.version for r in vs.by_tag(events, "alias", "champion").collect()] == [2]


def test_listing(log):
    events = log(*[("m", v, "archived" if v == 2 else None, 0.1) for v in range(1, 6)])
    assert [r.version for r in vs.list_versions(events).orderBy("position").collect()] == [5, 4, 3, 1]
    assert [r.version for r in vs.list_versions(events, True, 2).orderBy("position").collect()] == [5, 4]
    many = log(*[("m", v, None, 0.1) for v in range(1, 251)])
    assert [(r.version, r.position) for r in vs.list_versions(many).orderBy("position").collect()] == [(251 - i, i) for i in range(1, 251)]


def test_compare(df, log):
    events = log(("m", 1, None, 0.5), ("m", 2, None, 0.6), ("m", 3, None, None))
    pairs = df([("m", 1, 2), ("m", 1, 1), ("m", 3, 1), ("m", 1, 9)], "model string, version_a int, version_b int")
    got = {(r.version_a, r.version_b): (r.winner, r.improvement) for r in vs.compare_versions(events, pairs).collect()}
    assert got == {(1, 2): ("B", pytest.approx(0.2)), (1, 1): ("A", 0.0), (3, 1): ("B", 0.0)}


def test_no_join_of_versions_is_a_broadcast(df, log):
    """Versions and models grow with the log, however small Spark thinks their files."""
    events = log(("m", 1, "archived", 0.5), ("m", 2, "champion", 0.6), ("m", 3, "challenger", 0.7))
    pairs = df([("m", 1, 2)], "model string, version_a int, version_b int")
    targets = df([("m", 1)], "model string, version int")
    holders = vs.alias_holders(events).withColumn("value", F.col("metrics.f1_macro"))
    for made in (
        vs.compare_versions(events, pairs), vs.rollback(events, AT, targets), vs.rollback_outcome(events, targets), vs.alias_holders(events),
        vs.promote(events, None, AT), vs.pick_model(events), vs.retrain_decision(holders, holders),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_promotion_rules(log):
    events = log(
        ("none", 1, "champion", 0.5), ("first", 1, "challenger", 0.1),
        ("better", 1, "champion", 0.5), ("better", 2, "challenger", 0.6),
        ("same", 1, "champion", 0.5), ("same", 2, "challenger", 0.504),
        ("zero", 1, "champion", 0.0), ("zero", 2, "challenger", 0.9),
    )
    decisions = vs.should_promote(events)
    assert {r.model: (r.promote, r.reason) for r in decisions.collect()} == {
        "none": (False, "no challenger"), "first": (True, "no champion"), "better": (True, "improved"),
        "same": (False, "not improved"), "zero": (False, "not improved"),
    }
    after = vs.promote(events, decisions, AT)
    assert state(after) == {
        ("none", 1): "champion", ("first", 1): "champion", ("better", 1): "archived", ("better", 2): "champion",
        ("same", 1): "champion", ("same", 2): "challenger", ("zero", 1): "champion", ("zero", 2): "challenger",
    }
    new = vs.current_versions(after).where("model = 'better' and version = 2").first()
    assert new.tags["previous_alias"] == "challenger" and new.tags["alias"] == "champion"
    assert new.metrics == {"f1_macro": 0.6}
    assert vs.alias_holders(after).where("alias = 'challenger'").select("model").distinct().count() == 2


def test_rollback(df, log):
    events = log(("a", 1, "archived", 0.4), ("a", 2, "archived", 0.5), ("a", 3, "champion", 0.6), ("b", 1, "champion", 0.1))
    assert state(vs.rollback(events, AT)) == {
        ("a", 1): "archived", ("a", 2): "champion", ("a", 3): "archived", ("b", 1): "champion"}
    target = df([("a", 1)], "model string, version int")
    assert state(vs.rollback(events, AT, target))["a", 1] == "champion"
    same = df([("a", 3)], "model string, version int")
    assert state(vs.rollback(events, AT, same))["a", 3] == "champion"


def test_retrain_decisions(df):
    champion = df([("better", 0.5), ("worse", 0.5), ("zero", 0.0)], "model string, value double")
    challenger = df([("better", 0.6), ("worse", 0.4), ("zero", 0.1), ("new", 0.3)], "model string, value double")
    got = {r.model: (r.winner, r.promoted, r.improvement) for r in vs.retrain_decision(champion, challenger).collect()}
    assert got == {
        "better": ("challenger", True, pytest.approx(20.0)), "worse": ("champion", False, pytest.approx(-20.0)),
        "zero": ("challenger", True, float("inf")), "new": ("challenger", True, float("inf")),
    }
    forced = {r.model: (r.promoted, r.improvement) for r in vs.retrain_decision(champion, challenger, force=True).collect()}
    assert set(forced.values()) == {(True, 0.0)}


def test_archives_and_picks(df, log):
    archives = df([("m", "champion_20240101"), ("m", "champion_20240301"), ("n", "champion_20230101")], "model string, name string")
    assert {r.model: r.name for r in vs.choose_archive(archives).collect()} == {
        "m": "champion_20240301", "n": "champion_20230101"}
    named = {r.model: r.found for r in vs.choose_archive(archives, "champion_20240101").collect()}
    assert named == {"m": True, "n": False}
    assert vs.choose_archive(archives.limit(0)).count() == 0
    events = log(("m", 1, "champion", 0.5), ("m", 2, "challenger", 0.6), ("n", 1, None, 0.1), ("n", 2, None, 0.1))
    assert {r.model: r.version for r in vs.pick_model(events).collect()} == {"m": 1, "n": 2}
    assert vs.current_versions(events).columns == list(vs.LOG_COLUMNS)
    assert {r.model: r.version for r in vs.pick_model(events, alias="challenger").collect()} == {"m": 2}
    assert {r.model: r.version for r in vs.pick_model(events, version=2).collect()} == {"m": 2, "n": 2}


def stop_brute(losses, patience, delta):
    best, at, waited = float("inf"), 0, 0
    for epoch, loss in enumerate(losses, 1):
        if loss < best - delta:
            best, at, waited = loss, epoch, 0
        else:
            waited += 1
        if waited >= patience:
            return at, best, epoch, True
    return at, best, len(losses), False


def test_early_stop_equals_the_loop(df):
    import random

    rnd = random.Random(3)
    curves = {
        0: [1.0, 0.9, 0.95, 0.9, 0.9, 0.9, 0.9], 1: [3.0], 2: [1 / i for i in range(1, 60)],
        3: [1 - 0.0004 * i for i in range(40)], 4: [5.0] * 30,
        **{k: [rnd.choice([rnd.random(), 0.5, 0.4995]) for _ in range(rnd.randint(1, 80))] for k in range(5, 40)},
    }
    rows = df([(k, e, v) for k, c in curves.items() for e, v in enumerate(c, 1)], "run_id int, epoch long, loss double")
    for patience, delta in ((3, 0.001), (10, 0.05)):
        got = {r.run_id: (r.best_epoch, r.best_loss, r.last_epoch, r.stopped_early)
               for r in hs.early_stop(rows, patience, delta).collect()}
        assert got == {k: stop_brute(c, patience, delta) for k, c in curves.items()}


def test_long_runs_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(hs, "SEGMENT_BLOCKS", 2)
    losses = [1 / (1 + i % 50 + i / 100) for i in range(200)]
    rows = spark.createDataFrame([(1, e, v) for e, v in enumerate(losses, 1)], "run_id int, epoch long, loss double")
    got = hs.early_stop(rows, 25).first()
    assert tuple(got)[1:] == stop_brute(losses, 25, hs.MIN_DELTA)


def test_long_flat_run_is_cut_before_it_is_gathered(spark):
    rows = spark.range(1, 5001).select(F.lit(1).alias("run_id"), F.col("id").alias("epoch"), (1 - F.col("id") / 1e6).alias("loss"))
    kept = hs._until_stopped(rows, 10, 0.001, "run_id")
    assert kept.agg(F.max("epoch")).first()[0] == 40
    assert tuple(hs.early_stop(rows).first())[1:] == stop_brute([1 - i / 1e6 for i in range(1, 5001)], 10, 0.001)


def test_slowly_falling_run_is_folded_in_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    rows = spark.range(1, 200_001).select(F.lit(1).alias("run_id"), F.col("id").alias("epoch"), (300 - F.col("id") * 0.0011).alias("loss"))
    got = hs.early_stop(rows).first()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert tuple(got)[1:] == stop_brute([300 - i * 0.0011 for i in range(1, 200_001)], 10, 0.001)


def test_history_and_final_metrics(df):
    rows = df([("r", e, m, v) for e, m, v in [
        (1, "val_loss", 0.9), (1, "val_acc", 0.5), (1, "train_loss", 1.0), (1, "train_acc", 0.4), (1, "lr", 0.1),
        (2, "val_loss", 0.5), (2, "val_acc", 0.7)]], "run_id string, epoch long, metric string, value double")
    wide = hs.history_pivot(rows)
    assert wide.columns == ["run_id", "epoch", *hs.METRICS]
    best = hs.early_stop(wide.select("run_id", "epoch", F.col("val_loss").alias("loss")))
    final = hs.final_metrics(wide, best).first()
    assert tuple(final) == ("r", 2, 0.5, 0.7, 0.0)
