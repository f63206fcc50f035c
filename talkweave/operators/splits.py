"""Reproducible splits. Every assignment depends on the row key and the seed alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import as_class
from .blocks import row_position
from .explore import seeded_order

HOLD_OUT = {"train": 0.6, "validation": 0.2, "test": 0.2}
TWO_STEP = {"train": 0.56, "validation": 0.24, "test": 0.2}


def _edges(total: Column, fractions: Mapping[str, float]) -> list[tuple[str, Column]]:
    """Last rank of each split but the final one."""
    out, upto = [], 0.0
    for name in list(fractions)[:-1]:
        upto += fractions[name]
        out.append((name, F.floor(total * F.lit(round(upto, 9)) + 0.5)))
    return out


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    fractions: Mapping[str, float] = HOLD_OUT,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Exact shares per label: rows are ranked by a seeded hash inside their label.

    Only keys and labels are ranked, in 4096 hash blocks per label, so one label holding most
    rows is ranked by many tasks. What comes back is the last hash of each split per label, one row
    per label; the rows meet it in a join that is broadcast or skew-split at run time.
    """
    if abs(sum(fractions.values()) - 1) > 1e-9:
        raise ValueError("fractions must add up to 1")
    h, last_name = seeded_order(key, seed), list(fractions)[-1]
    hashed = df.withColumn("__h", h).withColumn("__l", as_class(label))
    block = F.conv(F.substring("__h", 1, 3), 16, 10).cast("bigint")
    pos, n = F.col("__pos"), F.col("__n")
    ranked = row_position(hashed.select("__l", "__h", F.col(key)), ["__l"], ["__h", key], block, "__pos", group_size="__n")
    edges = _edges(n, fractions)
    at_edge = F.lit(False)
    for _, edge in edges:
        at_edge = at_edge | (pos == edge)
    me = F.struct(F.col("__h").alias("h"), F.col(key).alias("k"))
    cuts = (
        ranked.filter(at_edge)
        .groupBy("__l")
        .agg(*[F.max(F.when(pos == e, me)).alias(f"__c{i}") for i, (_, e) in enumerate(edges)])
    )
    split = F.lit(last_name)
    for i, (name, _) in reversed(list(enumerate(edges))):
        split = F.when(me <= F.col(f"__c{i}"), name).otherwise(split)
    placed = hashed.join(cuts, "__l", "left").withColumn(out, split)
    return placed.select(*[c for c in df.columns if c != out], out)


def random_split(
    df: DataFrame,
    key: str,
    fractions: Mapping[str, float] | None = None,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Unstratified split by hash threshold: row-local, unmoved by repartitioning."""
    fractions = fractions or {"train": 0.8, "validation": 0.2}
    share = F.conv(F.substring(seeded_order(key, seed), 1, 8), 16, 10).cast("double") / 2.0**32
    names, upto, out_col = list(fractions), 1.0, None
    for name in reversed(names):
        out_col = F.lit(name) if out_col is None else F.when(share < round(upto, 9), name).otherwise(out_col)
        upto -= fractions[name]
    return df.withColumn(out, out_col)


def merge_splits(
    df: DataFrame, parts: Sequence[str] = ("train", "validation"), into: str = "train", out: str = "split"
) -> DataFrame:
    return df.withColumn(out, F.when(F.col(out).isin(*parts), into).otherwise(F.col(out)))


def apply_index_split(df: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Rows named by a saved ``(key, split)`` table, with their split."""
    return df.join(index.select(key, "split"), key, "inner")
