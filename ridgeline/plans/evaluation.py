"""Split, score and evaluate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ridgeline.operators.metrics import evaluate
from ridgeline.operators.scoring import centroid_fit, centroid_scorer, score
from ridgeline.operators.splits import RATIOS, SPLITS, exact_split


def evaluate_split(
    df: DataFrame, scorer: Callable[[DataFrame], DataFrame], split: str = "test", label: str = "label"
) -> DataFrame:
    """Evaluation record of ``scorer`` on one split; an unknown split means test.

    ``df`` has a ``split`` column; ``scorer`` adds ``prediction``.
    """
    chosen = split if split in SPLITS else "test"
    return evaluate(scorer(df.where(df["split"] == chosen)), label, "prediction")


def centroid_experiment(
    df: DataFrame, key: str, vec: str, label: str = "label",
    split: str = "test", ratios: Sequence[float] = RATIOS, seed: int = 42,
) -> DataFrame:
    """Fit nearest-centroid on the training split and evaluate it on another."""
    parted = exact_split(df, key, ratios, seed)
    model = centroid_scorer(centroid_fit(parted.where("split = 'train'"), vec, label))
    return evaluate_split(parted, lambda rows: score(rows, model, vec), split, label)
