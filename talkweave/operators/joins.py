"""Equi-joins of the pipeline. Strategy and skew handling are left to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_context(
    df: DataFrame,
    context: DataFrame,
    key: str = "row_id",
    num_docs: int = 2,
    out: str = "context",
) -> DataFrame:
    """First ``num_docs`` passages per row as an array, best first; [] where there are none.

    ``context`` is long: ``(key, rank, text)``. At most ``num_docs`` rows per key are gathered.
    """
    top = (
        context.filter(F.col("rank") <= num_docs)
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("__c"))
        .select(key, F.transform("__c", lambda x: x["text"]).alias(out))
    )
    joined = df.join(top, key, "left")
    return joined.withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def pivot_predictions(
    preds: DataFrame, runs: Sequence[str], key: str = "row_id", run: str = "run_id", label: str = "label"
) -> DataFrame:
    """One column per run. Naming the runs saves a pass over the data to find them."""
    return preds.groupBy(key).pivot(run, list(runs)).agg(F.first(label, ignorenulls=True))


def join_on_index(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return a.join(b, [key] if isinstance(key, str) else list(key), "inner")


def join_on_text(
    a: DataFrame,
    b: DataFrame,
    text: str,
    left: Sequence[str] = (),
    right: Sequence[str] = (),
    weight: str = "pairs",
) -> DataFrame:
    """Inner join on message text, where repeated messages match many to many.

    Equal rows of either side are first counted, then joined on a hash of the text and the text
    itself, and carry the product of the counts as ``weight``. The result stands for every pair of
    rows a plain join would give, without writing a copied message out n times m.
    """
    def counted(df: DataFrame, columns: Sequence[str], n: str) -> DataFrame:
        return (
            df.filter(F.col(text).isNotNull())
            .groupBy(text, *columns)
            .agg(F.count("*").alias(n))
            .withColumn("__h", F.xxhash64(text))
        )

    joined = counted(a, left, "__na").join(counted(b, right, "__nb"), ["__h", text], "inner")
    return joined.select(text, *left, *right, (F.col("__na") * F.col("__nb")).alias(weight))


def exclude_examples(df: DataFrame, examples: DataFrame, text: str) -> DataFrame:
    """Rows whose text is not one of the examples; a missing text is kept."""
    ex = examples.select(F.xxhash64(text).alias("__h"), F.col(text).alias("__t")).distinct()
    h = df.withColumn("__h", F.xxhash64(text))
    on = (h["__h"] == ex["__h"]) & (h[text] == ex["__t"])
    return h.join(ex, on, "left_anti").drop("__h")


def stack_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append by column name; a column absent from one source is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def lookup(df: DataFrame, table: DataFrame, key: str, keep_missing: bool = True) -> DataFrame:
    """Map a label or id through a table with one row per key."""
    return df.join(table, key, "left" if keep_missing else "inner")
