"""How far apart two labelled sets of vectors are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import as_class
from ..session import written
from .explore import sample_rows
from .schema import align_schemas


def label_means(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, mean): one mergeable vector aggregate per label."""
    v = array_to_vector(F.transform(vector, lambda x: x.cast("double")))
    return (
        df.filter(F.col(vector).isNotNull())
        .groupBy(as_class(label).alias("label"))
        .agg(vector_to_array(Summarizer.mean(v)).alias("mean"))
    )


def label_mean_distances(a: DataFrame, b: DataFrame, label: str, vector: str) -> DataFrame:
    """Euclidean distance between every label mean of ``a`` and of ``b``.

    Only the means, one row per label, meet: they are joined by dimension and summed up.
    """
    def by_dim(df: DataFrame, name: str) -> DataFrame:
        m = label_means(df, label, vector)
        return m.select(F.col("label").alias(name), F.posexplode("mean").alias("dim", f"x_{name}"))

    both = by_dim(a, "label_a").join(by_dim(b, "label_b"), "dim")
    gap = F.col("x_label_a") - F.col("x_label_b")
    return both.groupBy("label_a", "label_b").agg(F.sqrt(F.sum(gap * gap)).alias("distance"))


def _projections(df: DataFrame, vector: str, directions: int) -> DataFrame:
    """(direction, value): each vector's length along fixed pseudo-random directions."""

    def along(d: int) -> Column:
        part = lambda i: F.sin((i + 1) * F.lit(12.9898 * (d + 1)))
        dot = F.aggregate(F.transform(vector, lambda x, i: x.cast("double") * part(i)), F.lit(0.0), lambda s, x: s + x)
        norm = F.aggregate(F.transform(vector, lambda _, i: part(i) * part(i)), F.lit(0.0), lambda s, x: s + x)
        return dot / F.sqrt(norm)

    kept = df.filter(F.col(vector).isNotNull())
    return kept.select(F.posexplode(F.array(*[along(d) for d in range(directions)])).alias("direction", "value"))


def energy_distance(a: DataFrame, b: DataFrame, vector: str, directions: int = 16) -> DataFrame:
    """Sliced energy distance of two sets of vectors, over all rows: one row, ``distance``.

    Along one direction the energy distance 2E|x-y| - E|x-x'| - E|y-y'| is twice the integral of the
    squared gap between the two distribution functions, so one sort replaces all pairs. The mean over
    fixed directions is zero for equal distributions and grows with their gap; it is not comparable with a
    transport cost. Equal values are counted before they are sorted. The sorted counts are written once, range-partitioned;
    each part then needs only one row of totals from the parts before it. NULL if a side has no vector.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = _projections(a, vector, directions).select("*", one.alias("a"), none.alias("b"))
    both = both.unionAll(_projections(b, vector, directions).select("*", none.alias("a"), one.alias("b")))
    counts = both.groupBy("direction", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = written(counts.repartitionByRange("direction", "value").withColumn("part", F.spark_partition_id()), "projections")
    parts = counts.groupBy("direction", "part").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("value").alias("least"))
    whole = Window.partitionBy("direction")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("direction"),
        F.col("part"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("a", "b")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("a", "b")],
        F.lead("least").over(whole.orderBy("part")).alias("after"),
    )
    inside = Window.partitionBy("direction", "part").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    seen = counts.select(
        "direction", "part", "value", F.sum("a").over(upto).alias("a_here"), F.sum("b").over(upto).alias("b_here"),
        F.lead("value").over(inside).alias("next"),
    ).join(parts, ["direction", "part"])
    gap = F.try_divide(F.col("a_before") + F.col("a_here"), F.col("a_all")) - F.try_divide(
        F.col("b_before") + F.col("b_here"), F.col("b_all")
    )
    width = F.coalesce("next", "after", "value") - F.col("value")
    return seen.agg((2 * F.sum(gap * gap * width) / directions).alias("distance"))


def _mean_distance(x: DataFrame, y: DataFrame, vector: str) -> DataFrame:
    """Mean Euclidean distance over all pairs of two samples, as a one-row frame; ``y``'s rows are bounded by the sample."""
    held = np.stack(y.select(vector).toPandas()[vector].to_numpy()).astype("float64")
    shared = x.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            if b.empty:
                continue
            rows = np.stack(b[vector].to_numpy()).astype("float64")
            total = 0.0
            for i in range(0, len(rows), 64):
                part = rows[i : i + 64]
                d2 = ((part[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
                total += float(np.sqrt(d2).sum())
            yield pd.DataFrame({"total": [total], "n": [len(rows) * len(m)]})

    tasks = x.sparkSession.sparkContext.defaultParallelism
    parts = x.select(vector).repartition(tasks).mapInPandas(run, "total double, n bigint")
    return parts.agg((F.sum("total") / F.sum("n")).alias("d"))


def sampled_energy_distance(
    a: DataFrame, b: DataFrame, key: str, vector: str, sample: int = 10_000, seed: int = 42
) -> DataFrame:
    """2E|x-y| - E|x-x'| - E|y-y'| over all pairs of two seeded samples of ``sample`` rows, one row.

    A sampling operator: for all rows use :func:`energy_distance`. ``sample`` bounds what is broadcast.
    Each sample is drawn once.
    """
    sa, sb = (
        written(sample_rows(df.filter(F.col(vector).isNotNull()).select(key, vector), key, sample, seed), "sample") for df in (a, b)
    )
    parts = [
        _mean_distance(x, y, vector).select((F.col("d") * w).alias("d"))
        for x, y, w in ((sa, sb, 2.0), (sa, sa, -1.0), (sb, sb, -1.0))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).agg(F.sum("d").alias("distance"))


def compare_sets(
    a: DataFrame, b: DataFrame, targets: Sequence[str], vector: str
) -> DataFrame:
    """Label-mean and energy distances for each target label column.

    ``(target, label_a, label_b, distance)``; the energy distance does not depend on labels and
    comes once, with NULL labels and target.
    """
    a, b = align_schemas(a, b)
    out = energy_distance(a, b, vector).select(
        *[F.lit(None).cast("string").alias(c) for c in ("target", "label_a", "label_b")], "distance"
    )
    for t in targets:
        out = out.unionAll(
            label_mean_distances(a, b, t, vector).select(
                F.lit(t).alias("target"), "label_a", "label_b", "distance"
            )
        )
    return out
