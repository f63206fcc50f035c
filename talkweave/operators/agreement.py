"""Agreement between raters."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import row_mode
from .schema import quoted


def majority_label(df: DataFrame, raters: Sequence[str], out: str) -> DataFrame:
    """The raters' most frequent label as a new column, the rater columns dropped."""
    return df.withColumn(out, row_mode([quoted(r) for r in raters])).drop(*raters)


def pairwise_kappa(df: DataFrame, raters: Sequence[str], missing: str = "nan") -> DataFrame:
    """Cohen's kappa of every rater pair, NULL where undefined; a missing label is a category.

    Each row fans out to its rater pairs and is counted at once into (pair, label, label)
    cells on the map side; everything after that works on the cells. Agreement and both
    marginals come from one further grouping, without joins.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(a).alias("rater_a"),
                F.lit(b).alias("rater_b"),
                F.coalesce(F.col(quoted(a)).cast("string"), F.lit(missing)).alias("la"),
                F.coalesce(F.col(quoted(b)).cast("string"), F.lit(missing)).alias("lb"),
            )
            for a, b in combinations(raters, 2)
        ]
    )
    cells = (
        df.select(F.inline(pairs))
        .groupBy("rater_a", "rater_b", "la", "lb")
        .agg(F.count("*").cast("double").alias("n"))
    )
    zero, n = F.lit(0.0), F.col("n")
    sides = F.array(
        F.struct(
            F.col("la").alias("label"),
            n.alias("a"),
            zero.alias("b"),
            F.when(F.col("la") == F.col("lb"), n).otherwise(zero).alias("agree"),
        ),
        F.struct(F.col("lb").alias("label"), zero.alias("a"), n.alias("b"), zero.alias("agree")),
    )
    marginals = (
        cells.select("rater_a", "rater_b", F.inline(sides))
        .groupBy("rater_a", "rater_b", "label")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("agree").alias("agree"))
    )
    total = F.sum("a")
    stats = marginals.groupBy("rater_a", "rater_b").agg(
        total.cast("bigint").alias("n"),
        (F.sum("agree") / total).alias("observed"),
        (F.sum(F.col("a") * F.col("b")) / (total * total)).alias("expected"),
    )
    gain = F.col("observed") - F.col("expected")
    # within rounding of 1 the chance agreement leaves nothing to explain
    room = F.when(F.col("expected") < 1 - 1e-12, 1 - F.col("expected"))
    return stats.withColumn("kappa", gain / room)


def rater_conflicts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Label pairs of rows that only one of two raters coded, with their counts."""
    a, b = F.nullif(F.col(quoted(first)), F.lit("")), F.nullif(F.col(quoted(second)), F.lit(""))
    return (
        df.select(a.alias("first_label"), b.alias("second_label"))
        .filter(F.col("first_label").isNull() != F.col("second_label").isNull())
        .groupBy("first_label", "second_label")
        .agg(F.count("*").alias("count"))
    )
