"""Running a caller's model over rows, and combining several runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import text_batches

Scorer = Callable[[pd.Series], pd.Series]


def batch_function(make: Callable[[], Scorer], returns: T.DataType | str):
    """Column function around a batch model.

    ``make()`` runs once per Python worker task, not per batch, so a model is loaded lazily on the
    executor. Only the input column crosses to Python, as Arrow batches. The call is declared
    non-deterministic so that no optimizer rule repeats it, e.g. for a filter on its result;
    give retry-safe models all the same.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for batch in batches:
            if model is None:
                model = make()
            yield model(batch)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, returnType=returns).asNondeterministic()


def score(
    df: DataFrame,
    text: Column | str,
    make: Callable[[], Scorer],
    returns: T.DataType | str = "string",
    out: str = "response",
) -> DataFrame:
    """Add a caller-supplied model's answer (text, label or per-class scores) to every row.

    A worker holds one batch of texts, however long the table is.
    """
    text_batches(df.sparkSession)
    return df.withColumn(out, batch_function(make, returns)(text))


def vote(
    preds: DataFrame,
    key: str = "row_id",
    label: str = "label",
    run: str = "run_id",
    weights: Mapping[str, float] | None = None,
    out: str = "label",
) -> DataFrame:
    """Label with the largest (weighted) number of runs per row; smallest label on ties.

    A row's votes are brought together once; summing them per label and picking the best both
    use that partitioning. Rows without any label get NULL.
    """
    weight = F.lit(1.0)
    if weights:
        for name, w in weights.items():
            weight = F.when(F.col(run) == name, F.lit(float(w))).otherwise(weight)
    per_label = preds.repartition(F.col(key)).groupBy(key, label).agg(F.sum(weight).alias("__w"))
    rank = F.when(F.col(label).isNotNull(), F.struct((-F.round("__w", 9)).alias("w"), F.col(label).alias("l")))
    return per_label.groupBy(key).agg(F.min(rank)["l"].alias(out))
