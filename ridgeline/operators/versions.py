"""Model versions as an append-only log of events.

A log has two times. ``seq`` is when a row was appended and decides the state: each step
appends rows behind all rows of its model. ``event_ts`` is when the step is said to have
happened; it is shown, and orders only rows of one ``seq``, such as a log that came without
numbers. So a promotion entered late, or dated back, acts like any other.

A row ``(model, version, event_ts, seq, alias, tags, metrics)`` says what a version is from
then on; state is always the last row. An alias belongs to the version that was given it
last, and to nobody once that version has another. All operators work over any number of
models at once, and reduce by aggregates that combine before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridgeline.functions.change import relative_change, winner
from ridgeline.functions.rows import row_array
from ridgeline.operators.drift import PRIMARY_METRIC
from ridgeline.operators.running import numbered_by_range
from ridgeline.operators.skew import lookup, merged
from ridgeline.runtime import materialize

# The aliases a version can hold.
CHAMPION, CHALLENGER, ARCHIVED = "champion", "challenger", "archived"

LOG_COLUMNS = ("model", "version", "event_ts", "seq", "alias", "tags", "metrics")
PROMOTION_THRESHOLD = 0.01


# What orders the rows of a model.
_ORDER = ("seq", "event_ts")


def as_of(log: DataFrame, seq: int) -> DataFrame:
    """The log as it stood once the row number ``seq`` of each model was in."""
    return log.where(F.col("seq") <= seq)


def current_versions(log: DataFrame) -> DataFrame:
    """The last row of every version."""
    state = F.max_by(F.struct("alias", "tags", "metrics"), F.struct(*_ORDER))
    return log.groupBy("model", "version").agg(
        F.max(F.struct(*_ORDER)).alias("t"), state.alias("s")
    ).select("model", "version", "t.event_ts", "t.seq", "s.alias", "s.tags", "s.metrics")


def snapshot(log: DataFrame) -> DataFrame:
    """:func:`current_versions` with ``holds``: the version holds its alias. Written, since steps read it several times."""
    given = F.struct(*_ORDER, "version")
    last = log.where("alias is not null").groupBy("model", "alias").agg(F.max(given).alias("t")).select(
        "model", "alias", "t.version", F.lit(True).alias("holds")
    )
    joined = merged(current_versions(log), last, ["model", "version", "alias"], "left")
    return materialize(joined.select(*LOG_COLUMNS, F.coalesce("holds", F.lit(False)).alias("holds")), "versions", log.sparkSession)


def register(
    log: DataFrame, new_versions: DataFrame, tie_break: str, alias: str = CHALLENGER, framework: str = "spark-ml"
) -> DataFrame:
    """Log rows for new versions, numbered on from each model's highest version.

    ``new_versions``: model, event_ts, tags, metrics, and a column ``tie_break`` that
    parts versions of a model registered at one time. Tags are the defaults, then
    the given ones, then ``metric_<name>`` with the value rounded to 4 digits. Of several
    new versions of a model the last holds the alias, the others have passed it on.
    """
    highest = log.groupBy("model").agg(F.max("version").alias("_highest"), F.max("seq").alias("_last"))
    nth = numbered_by_range(new_versions, ["model"], ["event_ts", tie_break], "_nth", totals=True)
    placed = lookup(nth, highest, "model", ["_nth"], "left")
    defaults = F.create_map(
        F.lit("alias"), F.lit(alias),
        F.lit("registered_at"), F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("framework"), F.lit(framework),
    )
    measured = F.transform_values(
        F.transform_keys("metrics", lambda k, _: F.concat(F.lit("metric_"), k)),
        lambda _, v: F.round(v, 4).cast("string"),
    )
    given = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    # Later maps win over earlier ones, key by key.
    merged = F.map_concat(
        F.map_filter(defaults, lambda k, _: ~F.map_contains_key(given, k)), given
    )
    merged = F.map_concat(F.map_filter(merged, lambda k, _: ~F.map_contains_key(measured, k)), measured)
    return placed.select(
        "model",
        (F.coalesce("_highest", F.lit(0)) + F.col("_nth")).cast("int").alias("version"),
        "event_ts",
        (F.coalesce("_last", F.lit(-1)) + F.col("_nth")).cast("long").alias("seq"),
        F.when(F.col("_nth") == F.col("_nth_total"), F.lit(alias)).alias("alias"),
        merged.alias("tags"),
        "metrics",
    )


def registered(
    log: DataFrame, new_versions: DataFrame, tie_break: str, alias: str = CHALLENGER, framework: str = "spark-ml"
) -> DataFrame:
    """The log with new versions appended; who held their alias before ends without one."""
    fresh = register(log, new_versions, tie_break, alias, framework)
    since = fresh.where(F.col("alias").isNotNull()).select("model", F.col("event_ts").alias("since"), F.col("seq").alias("after"))
    held = merged(alias_holders(log).where(F.col("alias") == alias).select("model", "version"), since, "model")
    ended = merged(held, current_versions(log), ["model", "version"]).select(
        "model", "version", F.col("since").alias("event_ts"), F.col("after").alias("seq"),
        F.lit(None).cast("string").alias("alias"), "tags", "metrics",
    )
    return log.select(*LOG_COLUMNS).unionByName(fresh).unionByName(ended)


def alias_holders(log: DataFrame) -> DataFrame:
    """The one holder of each alias: the version that was given it last, if it still has it.

    An alias whose last holder moved on has none; no earlier version takes its place.
    """
    given = F.struct(*_ORDER, "version")
    last = log.where("alias is not null").groupBy("model", "alias").agg(F.max(given).alias("t")).select(
        "model", "alias", "t.version"
    )
    return merged(last, current_versions(log), ["model", "version", "alias"]).select(
        "model", "alias", "version", "event_ts", "seq", "metrics"
    )


def by_tag(log: DataFrame, key: str, value: str) -> DataFrame:
    """The highest version of each model whose tag has the value."""
    return (
        current_versions(log).where(F.col("tags")[key] == value)
        .groupBy("model").agg(F.max("version").alias("version"))
    )


def list_versions(log: DataFrame, include_archived: bool = False, limit: int | None = None) -> DataFrame:
    """Versions of each model with their place, newest first; all of them, or the first ``limit``.

    With a limit Spark applies it before the shuffle too, so a model of many versions
    sends few rows; without one, versions are numbered by range, so that it spreads.
    """
    versions = current_versions(log)
    if not include_archived:
        versions = versions.where(~F.col("alias").eqNullSafe(ARCHIVED))
    if limit is None:
        ranked = numbered_by_range(versions.withColumn("_down", -F.col("version")), ["model"], ["_down"], "position")
        return ranked.drop("_down").withColumn("position", F.col("position").cast("int"))
    position = F.row_number().over(W.partitionBy("model").orderBy(F.desc("version")))
    return versions.withColumn("position", position).where(F.col("position") <= limit)


def compare_versions(log: DataFrame, pairs: DataFrame, metric: str = PRIMARY_METRIC) -> DataFrame:
    """Compares ``version_a`` with ``version_b`` of a model; a missing metric is 0.

    Pairs with an unknown version drop out. B wins only if strictly greater.
    """
    value = F.coalesce(F.try_element_at("metrics", F.lit(metric)), F.lit(0.0))
    known = current_versions(log).select("model", "version", value.alias("value"))
    a = known.select("model", F.col("version").alias("version_a"), F.col("value").alias("value_a"))
    b = known.select("model", F.col("version").alias("version_b"), F.col("value").alias("value_b"))
    change = relative_change(F.col("value_a"), F.col("value_b"), "ratio")
    return merged(merged(pairs, a, ["model", "version_a"]), b, ["model", "version_b"]).select(
        "model", "version_a", "version_b", F.lit(metric).alias("metric"), "value_a", "value_b",
        change.alias("improvement"),
        (change * 100).alias("improvement_pct"),
        winner(F.col("value_a"), F.col("value_b")).alias("winner"),
    )


def _finalists(holders: DataFrame) -> DataFrame:
    """Champion and challenger of each model side by side, from one aggregate."""
    def of(alias: str, what: str) -> Column:
        return F.max_by(what, F.when(F.col("alias") == alias, F.col("seq")))

    return holders.withColumn("v", F.struct("version", "metrics")).groupBy("model").agg(
        of(CHAMPION, "v").alias("champion"), of(CHALLENGER, "v").alias("challenger")
    )


def should_promote(
    log: DataFrame, metric: str = PRIMARY_METRIC, threshold: float = PROMOTION_THRESHOLD
) -> DataFrame:
    """Per model: may the challenger become champion, and why.

    Without a challenger no, without a champion yes, else if it improves the
    metric by more than ``threshold``.
    """
    return _decisions(alias_holders(log), metric, threshold)


def _decisions(holders: DataFrame, metric: str, threshold: float) -> DataFrame:
    def value(side: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(f"{side}.metrics"), F.lit(metric)), F.lit(0.0))

    a, b = F.col("champion.version"), F.col("challenger.version")
    change = relative_change(value("champion"), value("challenger"), "ratio")
    improvement = F.when(a.isNotNull() & b.isNotNull(), change)
    return _finalists(holders).select(
        "model",
        a.alias("champion"),
        b.alias("challenger"),
        improvement.alias("improvement"),
        F.when(b.isNull(), False).when(a.isNull(), True).otherwise(change > threshold).alias("promote"),
        F.when(b.isNull(), "no challenger").when(a.isNull(), "no champion")
        .when(change > threshold, "improved").otherwise("not improved").alias("reason"),
    )


def _events(moves: DataFrame, versions: DataFrame, at: datetime) -> DataFrame:
    """Log rows for ``moves`` (model, version, alias, extra tags), behind all rows of the model: state carried on."""
    last = versions.groupBy("model").agg((F.max("seq") + 1).alias("seq"))
    state = versions.select("model", "version", "tags", "metrics")
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    set_now = F.map_concat(F.create_map(F.lit("alias"), F.col("alias")), F.col("extra"))
    kept = F.map_filter(tags, lambda k, _: ~F.map_contains_key(set_now, k))
    return merged(merged(moves, last, "model"), state, ["model", "version"]).select(
        "model", "version", F.lit(at).cast("timestamp").alias("event_ts"), "seq", "alias",
        F.map_concat(kept, set_now).alias("tags"), "metrics",
    )


def _moves(*steps: list[Column]) -> Column:
    """Generator of (version, alias, extra tags), skipping steps without a version."""
    rows = row_array(["version", "alias", "extra"], *steps)
    return F.inline(F.filter(rows, lambda s: s["version"].isNotNull()))


def promote(
    log: DataFrame, decisions: DataFrame | None, at: datetime, metric: str = PRIMARY_METRIC, threshold: float = PROMOTION_THRESHOLD,
) -> DataFrame:
    """The log with promotions appended.

    For each model with ``promote`` true in ``decisions`` (see
    :func:`should_promote`; None decides by ``metric`` and ``threshold``): the champion is
    archived, the challenger becomes champion, and no challenger is left. ``at`` may lie before other
    events: it is the time that is shown.
    """
    versions = snapshot(log)
    if decisions is None:
        decisions = _decisions(versions.where("holds"), metric, threshold)
    stamp = F.lit(at.isoformat())
    step = _moves(
        [F.col("champion"), F.lit(ARCHIVED), F.create_map(F.lit("archived_at"), stamp)],
        [F.col("challenger"), F.lit(CHAMPION), F.create_map(
            F.lit("previous_alias"), F.lit(CHALLENGER), F.lit("promoted_at"), stamp)],
    )
    moves = decisions.where("promote").select("model", step)
    return log.select(*LOG_COLUMNS).unionByName(_events(moves, versions, at))


def rollback_outcome(log: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """``(model, version, done)``: per model the version a rollback goes to, and whether it can."""
    return _targets(current_versions(log), targets)


def _targets(versions: DataFrame, targets: DataFrame | None) -> DataFrame:
    if targets is None:
        return versions.where(F.col("alias") == ARCHIVED).groupBy("model").agg(
            F.max("version").alias("version"), F.lit(True).alias("done")
        )
    known = versions.select("model", "version", F.lit(True).alias("done"))
    return merged(targets.select("model", "version").distinct(), known, ["model", "version"], "left").fillna(False, ["done"])


def rollback(log: DataFrame, at: datetime, targets: DataFrame | None = None) -> DataFrame:
    """The log with rollbacks appended.

    ``targets`` (model, version) names versions; without it each model goes back
    to its highest archived version, and models without one stay as they are.
    The present champion is archived first. A target that is no version of its
    model changes nothing; :func:`rollback_outcome` tells which those are. ``at`` is as in :func:`promote`.
    """
    versions = snapshot(log)
    goals = _targets(versions, targets).where("done")
    champion = versions.where(F.col("holds") & (F.col("alias") == CHAMPION)).select(
        "model", F.col("version").alias("champion")
    )
    stamp = F.lit(at.isoformat())
    replaced = F.col("champion").isNotNull() & (F.col("champion") != F.col("target"))
    step = _moves(
        [F.when(replaced, F.col("champion")), F.lit(ARCHIVED), F.create_map(F.lit("archived_at"), stamp)],
        [F.col("target"), F.lit(CHAMPION), F.create_map(F.lit("rolled_back_at"), stamp)],
    )
    moves = merged(goals.select("model", F.col("version").alias("target")), champion, "model", "left").select("model", step)
    return log.select(*LOG_COLUMNS).unionByName(_events(moves, versions, at))


def retrain_decision(
    champion: DataFrame, challenger: DataFrame, threshold: float = PROMOTION_THRESHOLD,
    force: bool = False,
) -> DataFrame:
    """Outcome of a retraining per model, from ``(model, value)`` of both sides.

    Without a champion the challenger is promoted with infinite improvement;
    forced promotions count as improvement 0.
    """
    a, b = F.col("champion_value"), F.col("challenger_value")
    change = relative_change(a, b, "ratio_or_inf")
    wins = F.lit(True) if force else a.isNull() | (change > threshold)
    gain = (
        F.lit(0.0) if force
        else F.when(a.isNull(), F.lit(float("inf"))).otherwise(change * 100)
    )
    new = challenger.select("model", F.col("value").alias("challenger_value"))
    held = champion.select("model", F.col("value").alias("champion_value"))
    return merged(new, held, "model", "left").select(
        "model", "champion_value", "challenger_value",
        F.when(wins, CHALLENGER).otherwise(CHAMPION).alias("winner"),
        wins.alias("promoted"),
        gain.alias("improvement"),
    )


def choose_archive(archives: DataFrame, name: str | None = None) -> DataFrame:
    """The archive to restore per model: the named one, else the latest by name.

    ``found`` is false where the named one is missing.
    """
    if name is None:
        return archives.groupBy("model").agg(F.max("name").alias("name")).select(
            "model", "name", F.lit(True).alias("found")
        )
    found = F.bool_or(F.col("name") == name)
    return archives.groupBy("model").agg(found.alias("found")).select(
        "model", F.when(F.col("found"), name).alias("name"), "found"
    )


def pick_model(log: DataFrame, alias: str | None = None, version: int | None = None) -> DataFrame:
    """The version to load per model: by alias or number, else champion, else latest."""
    if alias is not None:
        return alias_holders(log).where(F.col("alias") == alias).select("model", "version")
    if version is not None:
        return current_versions(log).where(F.col("version") == version).select("model", "version")
    champions = alias_holders(log).where(F.col("alias") == CHAMPION).select("model", F.col("version").alias("champion"))
    latest = log.groupBy("model").agg(F.max("version").alias("version"))
    return merged(latest, champions, "model", "left").select("model", F.coalesce("champion", "version").alias("version"))
