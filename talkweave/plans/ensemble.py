"""Stored runs of one class to a combined label and its report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators import joins, prompts, scoring
from ..operators.evaluate import classification_report
from ..sources.predictions import load_predictions


def expert_prompts(
    rows: DataFrame, preds: DataFrame, runs: Sequence[str], key: str = "row_id"
) -> DataFrame:
    """Prompts of ``rows(key, prompt, ...)`` rewritten to ask about every run's answer."""
    wide = joins.pivot_predictions(preds, runs, key)
    asked = joins.join_on_index(rows, wide, key)
    return asked.withColumn("prompt", prompts.ensemble_prompt("prompt", runs)).drop(*runs)


def voted(
    truth: DataFrame,
    preds: DataFrame,
    class_name: str | None = None,
    weights: Mapping[str, float] | None = None,
    key: str = "row_id",
) -> DataFrame:
    """``truth(key, label)`` with the runs' (weighted) majority as ``predicted``."""
    if class_name is not None:
        preds = load_predictions(preds, class_name)
    combined = scoring.vote(preds, key, weights=weights, out="predicted")
    return truth.join(combined, key)


def vote_report(*args, **kwargs) -> DataFrame:
    return classification_report(voted(*args, **kwargs), "label", "predicted")
