"""Data drift and model drift.

Distribution distances work on *distinct values with their counts*, combined
before the shuffle, so a value that fills a third of the table is one row. The
counts are dealt by ranges of the values and written once; every distance and
test reads them there. Each range is summed up on its own, and a few totals per
range put the pieces together. No task ever holds a whole column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.rows import inline_rows
from ridgeline.runtime import materialize

# Thresholds, states and texts of the monitoring rules.
P_THRESHOLD = 0.1
SHARE_THRESHOLD = 0.2
DEGRADATION_THRESHOLD = 0.05
CRITICAL_SCORE = 0.1
PRIMARY_METRIC = "f1_macro"
STATUSES = ("healthy", "warning", "critical")
ADVICE_DATA = "Data drift detected! Consider retraining the model with recent data."
ADVICE_MODEL = "Model performance degraded by %.1f%%! Trigger retraining pipeline."
ADVICE_NONE = "No significant drift detected. Model is healthy."

_SERIES_TERMS = 10
_TAIL_TERMS = 60


# ------------------------------------------------------------- alignment

def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def align_features(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns to compare: the given or all numeric ones of ``ref`` that ``cur`` has too."""
    wanted = list(columns) if columns is not None else numeric_columns(ref)
    return [c for c in wanted if c in ref.columns and c in cur.columns]


@dataclass(frozen=True)
class ColumnProfile:
    """Sizes of both sides of a numeric column, and the deviation of the reference."""

    name: str
    n_ref: int
    n_cur: int
    std_ref: float


@dataclass(frozen=True)
class ValueCounts:
    """``counts``: written rows ``(feature_no, value, n_ref, n_cur, segment)``, one per distinct
    value; ``segment`` grows with the value. ``profiles`` are in the order of ``feature_no``,
    with None for columns that lack values on a side."""

    counts: DataFrame
    profiles: tuple[ColumnProfile | None, ...]

    @property
    def known(self) -> list[ColumnProfile]:
        return [p for p in self.profiles if p]


def numeric_value(name: str) -> Column:
    """The column as double, NULL for NaN."""
    v = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(v), v)


def _sides(ref: DataFrame, cur: DataFrame, names: Sequence[str]) -> DataFrame:
    values = [numeric_value(c).alias(c) for c in names]
    return ref.select(*values, F.lit(1).alias("_ref")).unionByName(
        cur.select(*values, F.lit(0).alias("_ref"))
    )


def per_feature(values: Sequence, kind: str) -> Column:
    """The entry of ``feature_no`` in a literal list."""
    return F.array(*[F.lit(v).cast(kind) for v in values])[F.col("feature_no")]


def long_values(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``(*keep, feature_no, value)``: one row per non-null value of the named columns."""
    numbered = df.select(*keep, *[F.col(f"`{n}`").alias(str(i)) for i, n in enumerate(names)])
    long = numbered.unpivot(list(keep), [str(i) for i in range(len(names))], "feature_no", "value")
    return long.where("value is not null").withColumn("feature_no", F.col("feature_no").cast("int"))


def value_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None) -> ValueCounts | None:
    """Reads both sides once; None if no column is to be compared.

    Ranges are drawn over distinct values, so a hot value weighs as much as any.
    """
    names = align_features(ref, cur, columns)
    if not names:
        return None
    counted = long_values(_sides(ref, cur, names), names, ["_ref"]).groupBy("feature_no", "value").agg(
        F.sum(F.col("_ref")).alias("n_ref"), F.sum(1 - F.col("_ref")).alias("n_cur")
    )
    return _profiled(counted, names)


def _profiled(counted: DataFrame, names: Sequence[str]) -> ValueCounts:
    """Counts ``(feature_no, value, n_ref, n_cur)`` dealt by ranges and written, with the profile of each column."""
    dealt = counted.repartitionByRange("feature_no", "value").withColumn("segment", F.spark_partition_id())
    counts = materialize(dealt, "value-counts")
    mean = counts.groupBy("feature_no").agg(
        F.sum("n_ref").alias("n"), F.sum("n_cur").alias("m"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("mean"),
    )
    # One row per column.
    off = F.col("value") - F.col("mean")
    facts = counts.join(F.broadcast(mean), "feature_no").groupBy("feature_no").agg(
        F.first("n").alias("n"), F.first("m").alias("m"), F.sum(F.col("n_ref") * off * off).alias("squares")
    )
    known = {r.feature_no: r for r in facts.collect()}

    def profile(i: int, name: str) -> ColumnProfile | None:
        r = known.get(i)
        return ColumnProfile(name, r.n, r.m, math.sqrt(r.squares / r.n)) if r and r.n and r.m else None

    return ValueCounts(counts, tuple(profile(i, n) for i, n in enumerate(names)))


def feature_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(feature, value, n)``: the distinct values of numeric columns and how often each occurs.

    All that the tests of this module need of a side. Profiles of parts add up
    (:func:`merge_profiles`), so a day is counted once and folded in.
    """
    names = align_features(df, df, columns)
    values = df.select(*[numeric_value(c).alias(c) for c in names])
    name = per_feature(names, "string").alias("feature")
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, value double, n long")
    return long_values(values, names, []).groupBy("feature_no", "value").agg(F.count("*").alias("n")).select(name, "value", "n")


def merge_profiles(*parts: DataFrame) -> DataFrame:
    """The profile of all parts together."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("feature", "value").agg(F.sum("n").alias("n"))


def profile_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> ValueCounts | None:
    """:func:`value_counts` of two profiles. Columns without values on a side are not compared."""
    if not columns:
        return None
    number = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")).cast("int") - 1
    zero = F.lit(0).cast("long")
    both = ref.select("feature", "value", F.col("n").alias("n_ref"), zero.alias("n_cur")).unionByName(
        cur.select("feature", "value", zero.alias("n_ref"), F.col("n").alias("n_cur"))
    )
    numbered = both.select(number.alias("feature_no"), "value", "n_ref", "n_cur").where("feature_no >= 0")
    counted = numbered.groupBy("feature_no", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    return _profiled(counted, columns)


def reference_profiles(ref: DataFrame, columns: Sequence[str] | None = None) -> list[ColumnProfile]:
    """Sizes of the reference alone, for data still to come."""
    names = align_features(ref, ref, columns)
    if not names:
        return []
    row = ref.agg(*[F.count(numeric_value(c)).alias(f"r{i}") for i, c in enumerate(names)]).first()
    return [ColumnProfile(c, row[f"r{i}"], 0, 0.0) for i, c in enumerate(names) if row[f"r{i}"]]


def _numbers(values: ValueCounts, attribute: str, kind: str) -> Column:
    return per_feature([getattr(p, attribute) if p else None for p in values.profiles], kind)


def _local_gaps(values: ValueCounts) -> DataFrame:
    """Adds ``gap``: difference of both distribution functions within the segment."""
    upto = W.partitionBy("feature_no", "segment").orderBy("value").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    n, m = _numbers(values, "n_ref", "double"), _numbers(values, "n_cur", "double")
    return values.counts.where(n.isNotNull()).withColumn(
        "gap", F.sum("n_ref").over(upto) / n - F.sum("n_cur").over(upto) / m
    ).withColumns({"n": n, "m": m})


def _segment_offsets(segments: DataFrame) -> Column:
    """The gap reached before a segment, from the totals of earlier ones."""
    before = W.partitionBy("feature_no").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("total").over(before), F.lit(0.0))


def ks_statistic(values: ValueCounts) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of each column.

    Inside a segment the gap is the local one plus a constant, so its largest
    size needs only the local extremes: segments send one row each.
    """
    segments = _local_gaps(values).groupBy("feature_no", "segment").agg(
        F.max("gap").alias("high"),
        F.min("gap").alias("low"),
        (F.sum("n_ref") / F.first("n") - F.sum("n_cur") / F.first("m")).alias("total"),
    )
    at = segments.withColumn("before", _segment_offsets(segments))
    largest = F.greatest(F.abs(F.col("before") + F.col("high")), F.abs(F.col("before") + F.col("low")))
    return at.groupBy("feature_no").agg(F.max(largest).alias("ks_statistic")).select(
        _numbers(values, "name", "string").alias("feature"),
        "ks_statistic",
        _numbers(values, "n_ref", "long").alias("n_ref"),
        _numbers(values, "n_cur", "long").alias("n_cur"),
    )


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value of a KS statistic: the limiting distribution at ``D * sqrt(nm / (n + m))``.

    Below 1 the alternating series converges badly, so its theta-function twin
    is summed there.
    """
    x = d * F.sqrt(n * m / (n + m))
    tail = sum(
        (F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * x * x) for k in range(1, _SERIES_TERMS + 1)),
        F.lit(0.0),
    )
    body = F.try_divide(F.lit(math.sqrt(2 * math.pi)), x) * sum(
        (
            F.exp(F.try_divide(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8), x * x))
            for k in range(1, _SERIES_TERMS + 1)
        ),
        F.lit(0.0),
    )
    p = F.when(x >= 1, tail).when(x > 0, 1.0 - body).otherwise(1.0)
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


_KS_SCHEMA = (
    "feature string, ks_statistic double, n_ref long, n_cur long, p_value double, drifted boolean"
)


def ks_test(
    ref: DataFrame,
    cur: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = P_THRESHOLD,
    values: ValueCounts | None = None,
) -> DataFrame:
    """KS statistic, p-value and verdict (p below ``threshold``) of each column."""
    values = value_counts(ref, cur, columns) if values is None else values
    if values is None or not values.known:
        return ref.sparkSession.createDataFrame([], _KS_SCHEMA)
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    return ks_statistic(values).withColumn("p_value", p).withColumn(
        "drifted", F.col("p_value") < threshold
    )


def _verdict(share: float) -> list[Column]:
    drifted = F.count_if("drifted")
    ratio = F.coalesce(F.try_divide(drifted, F.count("*")), F.lit(0.0))
    return [
        (ratio > share).alias("drift_detected"),
        ratio.alias("drift_score"),
        F.count("*").alias("total_features"),
        drifted.alias("drifted_features"),
    ]


def data_drift(tests: DataFrame, share: float = SHARE_THRESHOLD) -> DataFrame:
    """Dataset verdict: more than ``share`` of the tested columns drifted."""
    return tests.agg(*_verdict(share))


def drift_details(tests: DataFrame) -> DataFrame:
    """Scores per feature as a map, and the sorted names of drifted features."""
    score = F.struct("ks_statistic", "p_value", "drifted")
    return tests.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", score))).alias("feature_scores"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features"),
    )


def _record(kind: str, threshold: float, at: datetime, measures: Sequence[str], details: Sequence[Column]) -> Column:
    """A drift result in one struct: verdict, measures by name, and details."""
    named = [F.struct(F.lit(m).alias("key"), F.col(m).cast("double").alias("value")) for m in measures]
    return F.struct(
        "drift_detected",
        "drift_score",
        F.lit(kind).alias("drift_type"),
        F.map_from_entries(F.array(*named)).alias("metrics"),
        F.lit(threshold).alias("threshold"),
        F.lit(at.isoformat()).alias("timestamp"),
        F.struct(*details).alias("details"),
    )


def data_drift_record(
    tests: DataFrame, at: datetime, share: float = SHARE_THRESHOLD, threshold: float = P_THRESHOLD
) -> DataFrame:
    """Verdict and details of the tests as one struct ``record``."""
    details = drift_details(tests)
    return data_drift(tests, share).select(_record(
        "data", threshold, at, ("total_features", "drifted_features"),
        [details.select(F.struct("*")).scalar()["feature_scores"].alias("feature_scores"),
         details.select(F.struct("*")).scalar()["drifted_features"].alias("drifted_features")],
    ).alias("record"))


# --------------------------------------------------------- column distances

def wasserstein(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, values: ValueCounts | None = None,
) -> DataFrame:
    """Wasserstein distance of each column over the reference deviation.

    The area between both distribution functions. A segment needs the gap before
    it and the first value after it; both come from the segment totals.
    """
    values = value_counts(ref, cur, columns) if values is None else values
    if values is None or not values.known:
        return ref.sparkSession.createDataFrame([], "feature string, distance double")
    gaps = _local_gaps(values)
    segments = gaps.groupBy("feature_no", "segment").agg(
        F.min("value").alias("first_value"),
        (F.sum("n_ref") / F.first("n") - F.sum("n_cur") / F.first("m")).alias("total"),
    )
    in_order = W.partitionBy("feature_no").orderBy("segment")
    around = segments.select(
        "feature_no", "segment",
        _segment_offsets(segments).alias("before"),
        F.lead("first_value").over(in_order).alias("after"),
    )
    inner = W.partitionBy("feature_no", "segment").orderBy("value")
    steps = gaps.withColumn("next", F.lead("value").over(inner)).join(around, ["feature_no", "segment"])
    width = F.coalesce("next", "after") - F.col("value")
    area = F.sum(F.abs(F.col("before") + F.col("gap")) * width)
    norm = F.greatest(_numbers(values, "std_ref", "double"), F.lit(0.001))
    return steps.groupBy("feature_no").agg(F.coalesce(area, F.lit(0.0)).alias("area")).select(
        _numbers(values, "name", "string").alias("feature"),
        (F.col("area") / norm).alias("distance"),
    )


def _category_counts(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of both sides per category, with the totals of the feature."""
    def long(df: DataFrame, r: int, c: int) -> DataFrame:
        entries = [[F.lit(name), F.col(f"`{name}`").cast("string")] for name in columns]
        return df.select(
            inline_rows(["feature", "category"], *entries), F.lit(r).alias("r"), F.lit(c).alias("c")
        )

    counts = (
        long(ref, 1, 0).unionByName(long(cur, 0, 1)).where("category is not null")
        .groupBy("feature", "category").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("all_ref"), F.sum("n_cur").alias("all_cur"))
    # One row per column compared.
    return counts.join(F.broadcast(totals), "feature").where("all_ref > 0 and all_cur > 0")


def js_distance(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (natural log) between the category shares."""
    p, q = F.col("n_ref") / F.col("all_ref"), F.col("n_cur") / F.col("all_cur")
    mid = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x / mid)).otherwise(0.0)

    divergence = F.sum(part(p) + part(q)) / 2
    return _category_counts(ref, cur, columns).groupBy("feature").agg(
        F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("distance")
    )


def chi_square_tail(statistic: Column, df: Column) -> Column:
    """Probability of a chi-square variable with ``df`` degrees of freedom above ``statistic``.

    Finite sums: a Poisson sum for even degrees; for odd ones the tail of one degree,
    which is ``erfc``, and a like sum. Terms are kept as logarithms, so none underflows.
    """
    t = statistic / 2
    odd = df % 2 == 1
    # erfc(sqrt(t)): the series of its complement where that is small, else a continued fraction from its end.
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TAIL_TERMS)), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda a, n: F.struct((a["term"] * t / (n + 0.5)).alias("term"), (a["total"] + a["term"] * t / (n + 0.5)).alias("total")),
    )["total"]
    below = 2 * F.sqrt(t / math.pi) * F.exp(-t) * series
    # e**-t / sqrt(pi) / (z + (1/2) / (z + 1 / (z + (3/2) / ...))) with z = sqrt(t), from far enough out for any t above two.
    z = F.sqrt(t)
    fraction = F.aggregate(F.sequence(F.lit(2 * _TAIL_TERMS), F.lit(1), F.lit(-1)), z, lambda a, n: z + n / 2 / a)
    above = F.exp(-t) / math.sqrt(math.pi) / fraction
    one = F.when(t <= 2, 1.0 - below).otherwise(above)
    count = F.floor(F.when(odd, df - 1).otherwise(df) / 2).cast("int")
    # Terms t**(j + shift) / Gamma(j + shift + 1): whole steps from 0, or from one half.
    shift = F.when(odd, 0.5).otherwise(0.0)
    first = F.when(odd, 0.5 * F.log(t) - math.log(math.sqrt(math.pi) / 2)).otherwise(0.0) - t
    rest = F.aggregate(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        F.struct(first.alias("log"), F.lit(0.0).alias("total")),
        lambda a, j: F.struct((a["log"] + F.log(t) - F.log(j + shift)).alias("log"), (a["total"] + F.exp(a["log"])).alias("total")),
    )["total"]
    p = F.when(odd, one).otherwise(0.0) + F.when(count > 0, rest).otherwise(0.0)
    return F.when(df <= 0, 1.0).when(statistic == math.inf, 0.0).when(statistic <= 0, 1.0).otherwise(F.least(p, F.lit(1.0)))


def chi_square(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chi-square test of current counts against the reference shares.

    A category the reference lacks makes the statistic infinite.
    """
    expected = F.col("n_ref") / F.col("all_ref") * F.col("all_cur")
    off = F.col("n_cur") - expected
    term = F.when(expected > 0, off * off / expected).otherwise(math.inf)
    return _category_counts(ref, cur, columns).groupBy("feature").agg(
        F.sum(term).alias("statistic"), (F.count("*") - 1).alias("df")
    ).withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("df")))


def proportion_test(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sided test that both sides share one proportion, for columns of two categories.

    The proportion is pooled over both samples. Columns of more categories have no row; one
    of a single category has the p-value 1.
    """
    counts = _category_counts(ref, cur, columns).groupBy("feature").agg(
        F.count("*").alias("categories"), F.max_by("n_ref", "category").alias("r"), F.max_by("n_cur", "category").alias("c"),
        F.first("all_ref").alias("n"), F.first("all_cur").alias("m"),
    ).where("categories <= 2")
    n, m = F.col("n"), F.col("m")
    pooled = (F.col("r") + F.col("c")) / (n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    z = F.coalesce(F.try_divide(F.col("r") / n - F.col("c") / m, spread), F.lit(0.0))
    return counts.select("feature", z.alias("statistic")).withColumn(
        "p_value", chi_square_tail(F.col("statistic") * F.col("statistic"), F.lit(1))
    )


@dataclass(frozen=True)
class ShareParams:
    """Thresholds of :func:`column_share_drift`."""

    p_threshold: float = 0.05
    distance_threshold: float = 0.1
    dataset_share: float = 0.5


def column_drift(
    ref: DataFrame, cur: DataFrame, method: str = "distances", categorical: Sequence[str] = (),
    params: ShareParams = ShareParams(), columns: Sequence[str] | None = None,
) -> DataFrame:
    """One drift score per column, by its type and the method the caller chooses.

    ``tests``: KS for numbers, the proportion test for two categories, chi-square for
    more (drifted below the p threshold). ``distances``: Wasserstein and
    Jensen-Shannon (drifted from the distance threshold on). Numeric columns named in
    ``categorical`` count as categories, like all that are not numeric.
    """
    if method not in ("tests", "distances"):
        raise ValueError(f"unknown method: {method}")
    names = align_features(ref, cur, columns if columns is not None else ref.columns)
    numeric = set(numeric_columns(ref)) - set(categorical)
    spread, groups = [c for c in names if c in numeric], [c for c in names if c not in numeric]

    def scored(df: DataFrame, how: str, score: str, drifted: Column) -> DataFrame:
        return df.select("feature", F.lit(how).alias("method"), F.col(score).alias("score"), drifted.alias("drifted"))

    low = F.col("p_value") < params.p_threshold
    far = F.col("distance") >= params.distance_threshold
    parts = []
    if spread and method == "tests":
        parts.append(scored(ks_test(ref, cur, spread, params.p_threshold), "ks", "p_value", low))
    elif spread:
        parts.append(scored(wasserstein(ref, cur, spread), "wasserstein", "distance", far))
    if groups and method == "tests":
        two = scored(proportion_test(ref, cur, groups), "proportion", "p_value", low)
        more = scored(chi_square(ref, cur, groups).where("df > 1"), "chi_square", "p_value", low)
        parts += [two, more]
    elif groups:
        parts.append(scored(js_distance(ref, cur, groups), "jensen_shannon", "distance", far))
    if not parts:
        return ref.sparkSession.createDataFrame([], "feature string, method string, score double, drifted boolean")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def column_share_drift(
    ref: DataFrame, cur: DataFrame, method: str = "distances", categorical: Sequence[str] = (),
    params: ShareParams = ShareParams(), columns: Sequence[str] | None = None,
) -> DataFrame:
    """Dataset verdict: at least ``dataset_share`` of the columns drifted."""
    drifted = F.count_if("drifted")
    share = F.coalesce(F.try_divide(drifted, F.count("*")), F.lit(0.0))
    return column_drift(ref, cur, method, categorical, params, columns).agg(
        (share >= params.dataset_share).alias("drift_detected"),
        share.alias("drift_score"),
        F.count("*").alias("number_of_columns"),
        drifted.alias("number_of_drifted_columns"),
    )


# ------------------------------------------------------------- model drift

def metric_change(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Every baseline metric with its current value (0 if missing) and change in percent."""
    now = current.select("metric", F.col("value").alias("current"))
    base = F.col("baseline")
    return (
        baseline.select("metric", F.col("value").alias("baseline"))
        .join(now, "metric", "left")
        .withColumn("current", F.coalesce("current", F.lit(0.0)))
        .withColumn(
            "change_pct",
            F.when(base > 0, F.try_divide(F.col("current") - base, base) * 100).otherwise(0.0),
        )
    )


def model_drift(
    baseline: DataFrame, current: DataFrame, primary: str = PRIMARY_METRIC,
    threshold: float = DEGRADATION_THRESHOLD,
) -> DataFrame:
    """Loss of the primary metric against the baseline; a missing metric is 0."""
    def side(df: DataFrame, name: str) -> DataFrame:
        wanted = F.when(F.col("metric") == primary, F.col("value"))
        return df.select(F.lit(name).alias("side"), wanted.alias("value"))

    def of(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == name, F.col("value"))), F.lit(0.0))

    both = side(baseline, "baseline").unionByName(side(current, "current"))
    lost = F.coalesce(F.try_divide(F.col("baseline") - F.col("current"), F.col("baseline")), F.lit(0.0))
    return both.agg(of("baseline").alias("baseline"), of("current").alias("current")).select(
        F.lit(primary).alias("primary_metric"),
        (lost > threshold).alias("drift_detected"),
        lost.alias("drift_score"),
        "baseline",
        "current",
        (lost * 100).alias("degradation_pct"),
    )


def model_drift_record(
    baseline: DataFrame, current: DataFrame, at: datetime, primary: str = PRIMARY_METRIC,
    threshold: float = DEGRADATION_THRESHOLD,
) -> DataFrame:
    """Verdict on the model and the change of every metric as one struct ``record``."""
    change = F.struct("baseline", "current", "change_pct")
    changes = metric_change(baseline, current).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", change))).alias("metric_changes")
    )
    return model_drift(baseline, current, primary, threshold).select(_record(
        "model", threshold, at, ("baseline", "current", "degradation_pct"),
        [F.col("primary_metric"), changes.scalar().alias("metric_changes")],
    ).alias("record"))


def health_status(data: DataFrame | None = None, model: DataFrame | None = None) -> DataFrame:
    """Status and recommendations from either verdict or both.

    ``critical`` if anything was detected and the model lost more than a tenth,
    ``warning`` if anything was detected, else ``healthy``.
    """
    given = [
        df.select(F.lit(kind).alias("kind"), "drift_detected", "drift_score")
        for kind, df in (("data", data), ("model", model)) if df is not None
    ]
    if not given:
        raise ValueError("health_status needs a data or a model verdict")
    verdicts = given[0] if len(given) == 1 else given[0].unionByName(given[1])

    def detected(kind: str) -> Column:
        return F.coalesce(F.bool_or((F.col("kind") == kind) & F.col("drift_detected")), F.lit(False))

    facts = verdicts.agg(
        detected("data").alias("data_drift"),
        detected("model").alias("model_drift"),
        F.max(F.when(F.col("kind") == "data", F.col("drift_score"))).alias("data_score"),
        F.max(F.when(F.col("kind") == "model", F.col("drift_score"))).alias("model_score"),
    )
    found = F.col("data_drift") | F.col("model_drift")
    worse = F.coalesce(F.col("model_score") > CRITICAL_SCORE, F.lit(False))
    healthy, warning, critical = STATUSES
    advice = F.array_compact(F.array(
        F.when(F.col("data_drift"), ADVICE_DATA),
        F.when(F.col("model_drift"), F.format_string(ADVICE_MODEL, F.col("model_score") * 100)),
        F.when(~found, ADVICE_NONE),
    ))
    return facts.select(
        "data_drift", "data_score", "model_drift", "model_score",
        F.when(found & worse, critical).when(found, warning).otherwise(healthy).alias("overall_status"),
        advice.alias("recommendations"),
    )
