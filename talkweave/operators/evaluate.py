"""Classification metrics from one confusion count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import as_class


def confusion(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """(y, p, n): the only step that reads rows; the rest works on class pairs."""
    n = F.sum(weight) if weight else F.count("*")
    return df.groupBy(as_class(truth).alias("y"), as_class(predicted).alias("p")).agg(
        n.cast("double").alias("n")
    )


def class_metrics(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class seen as truth or prediction; 0 for 0/0."""
    n, zero = F.col("n"), F.lit(0.0)
    hit = F.when(F.col("y") == F.col("p"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y").alias("class"), n.alias("t"), zero.alias("g"), hit.alias("hit")),
        F.struct(F.col("p").alias("class"), zero.alias("t"), n.alias("g"), zero.alias("hit")),
    )
    per = (
        confusion(df, truth, predicted, weight)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("t").alias("support"), F.sum("g").alias("guessed"), F.sum("hit").alias("hit"))
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return per.select(
        "class",
        ratio(F.col("hit"), F.col("guessed")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"),
        "support",
        "hit",
    )


def _weighted(c: str) -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0))


def summary_metrics(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall, F1."""
    return class_metrics(df, truth, predicted, weight).agg(
        F.coalesce(F.try_divide(F.sum("hit"), F.sum("support")), F.lit(0.0)).alias("accuracy"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1").alias("f1"),
    )


def classification_report(
    df: DataFrame, truth: str, predicted: str, weight: str | None = None
) -> DataFrame:
    """Class rows plus accuracy, macro and weighted averages, from a single pass.

    A rollup adds the grand total to the class rows, and the total fans out to the three
    summary rows; nothing is computed twice.
    """
    measures = ("precision", "recall", "f1")
    rolled = (
        class_metrics(df, truth, predicted, weight)
        .rollup("class")
        .agg(
            F.grouping("class").alias("total"),
            F.sum("support").alias("support"),
            F.sum("hit").alias("hit"),
            *[F.avg(m).alias(m) for m in measures],
            *[_weighted(m).alias("w_" + m) for m in measures],
        )
    )

    def line(name: Column, kind: str, values: list[Column]) -> Column:
        return F.struct(
            name.alias("class"),
            F.lit(kind).alias("kind"),
            *[v.alias(m) for m, v in zip(measures, values)],
            F.col("support").cast("bigint").alias("support"),
        )

    plain = [F.col(m) for m in measures]
    none = F.lit(None).cast("double")
    accuracy = F.try_divide(F.col("hit"), F.col("support"))
    summary = F.array(
        line(F.lit("accuracy"), "summary", [none, none, accuracy]),
        line(F.lit("macro avg"), "summary", plain),
        line(F.lit("weighted avg"), "summary", [F.col("w_" + m) for m in measures]),
    )
    single = F.array(line(F.col("class"), "class", plain))
    return rolled.select(F.inline(F.when(F.col("total") == 1, summary).otherwise(single)))


def accuracy_by_null(
    df: DataFrame, truth: str, predicted: str, missing: str = "NaN", weight: str | None = None
) -> DataFrame:
    """Accuracy over all rows, labelled rows and unlabelled rows.

    A missing label is compared as the class ``missing``, so naming it counts as right.
    """
    n = F.col(weight) if weight else F.lit(1)
    right = F.coalesce(F.col(truth), F.lit(missing)).eqNullSafe(F.col(predicted)).cast("int")
    scope = F.when(F.col(truth).isNull(), "unlabelled").otherwise("labelled")
    rolled = (
        df.select(scope.alias("scope"), (right * n).alias("right"), n.alias("n"))
        .rollup("scope")
        .agg(F.sum("n").alias("rows"), F.sum("right").alias("right"))
    )
    return rolled.select(
        F.coalesce("scope", F.lit("all")).alias("scope"),
        "rows",
        (F.col("right") / F.col("rows")).alias("accuracy"),
    )
