"""Ordered work on groups of any size.

A window puts one partition-by group into one task. A conversation, source or label may hold a
large part of all rows, so groups are cut along their order into *blocks*: a block number that
never decreases with the order and depends on the row alone, hence is the same on every retry.

Two results then need no more than one block at a time:

* bounded look-back (lag, last k rows): :func:`with_halo` repeats the last k rows before a block
  in front of it, marked, to be filtered out after the window;
* running totals and row numbers: :func:`running_total` puts one carry row in front of each
  block holding what all earlier blocks add up to.

Only one row set per block (k rows, or one total) meets in a per-group window, so that window is
smaller than the group by the block size.

``block`` is a width in units of the first order column (seconds for times), a column, or
``AUTO``, which takes boundaries from quantiles of the data; ``None`` keeps the plain window for groups known to be
short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK, HALO, CARRY = "__block", "__halo", "__carry"
AUTO = "auto"
#: boundaries, rows of a sample for them, and rows of a block from which there are more
SPLITS, SAMPLE, BLOCK_ROWS = 1024, 65_536, 1_000_000
PLAIN = {"bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz"}
Block = Column | float | str | None


def order_block(df: DataFrame, order: str, width: float) -> Column:
    """Block number of a row from its order column: integers by value, times by seconds."""
    kind = df.schema[order].dataType
    c = F.col(order)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_seconds(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.StringType):
        raise TypeError(f"{order}: a text order needs a block column, or None for short groups")
    return F.floor(c / F.lit(width)).cast("bigint")


def add_quantile_block(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """As block, how many boundaries a row has reached in the whole ``order``, compared as one value.

    The boundaries are quantiles of a sample of ``SAMPLE`` rows: those with the smallest hash of order and other plain columns, so a task that
    runs again draws the same. There are ``SPLITS`` of them, or one for each ``BLOCK_ROWS`` rows if that is more; the number of rows follows from how small
    the sample's hashes are. Texts, common beginnings and coarse first columns are cut like numbers: only rows with
    equal order stay together. One top-k to a single small row; a row is placed by two short searches.
    """
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    plain = [c for c, kind in df.dtypes if kind in PLAIN and c not in order]
    luck = F.xxhash64(*order, *plain)
    drawn = df.select(key.alias("k"), luck.alias("luck")).orderBy("luck").limit(SAMPLE)
    held = drawn.agg(F.array_sort(F.collect_list("k")).alias("k"), F.count(F.lit(1)).alias("n"), F.max("luck").alias("top"))
    reached_share = (F.col("top").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    rows = F.when(F.col("n") < SAMPLE, F.col("n")).otherwise(F.col("n") / F.greatest(reached_share, F.lit(1e-18)))
    wanted = F.least(F.size("k"), F.greatest(F.lit(SPLITS), F.ceil(rows / BLOCK_ROWS))).cast("int")
    held = held.select("k", wanted.alias("n"))
    at = lambda i: F.get("k", F.floor(i * F.size("k") / F.col("n")).cast("int"))
    held = held.select(F.when(F.col("n") > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("n") - 1), at))).alias("all"))
    step = F.ceil(F.sqrt(F.size("all").cast("double"))).cast("int")
    held = held.withColumn("step", step)
    points = held.select(F.struct(F.filter("all", lambda _, i: i % F.col("step") == F.col("step") - 1).alias("few"), "all", "step").alias("s"))
    found = F.col("__points")  # a column of its own: no subquery may stand inside a lambda
    reached = found["step"] * F.size(F.filter(found["few"], lambda b: b <= key))
    rest = F.size(F.filter(F.slice(found["all"], reached + 1, found["step"]), lambda b: b <= key))
    block = F.coalesce(F.when(found["all"].isNotNull(), reached + rest), F.lit(0)).cast("bigint")
    return df.withColumn("__points", points.scalar()).withColumn(BLOCK, block).drop("__points")


def add_block(df: DataFrame, order: Sequence[str], block: Block) -> DataFrame:
    if block is None:
        return df.withColumn(BLOCK, F.lit(0).cast("bigint"))
    if isinstance(block, str):
        if block != AUTO:
            raise ValueError(f"block {block!r}")
        return add_quantile_block(df, order)
    if isinstance(block, (int, float)):
        block = order_block(df, order[0], block)
    return df.withColumn(BLOCK, block)


def with_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    k: int,
    block: Block,
    needed: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` plus, in front of each block, the ``k`` rows that precede it in its group.

    ``needed`` names the columns the caller's window reads besides keys and order; the others
    are NULL in halo rows, which keeps them small.
    """
    cut = add_block(df, order, block).withColumn(HALO, F.lit(False))
    if block is None:
        return cut
    needed = [c for c in (df.columns if needed is None else needed) if c not in (*keys, *order)]
    payload = [*order, *needed]
    in_block = Window.partitionBy(*keys, BLOCK)
    tails = (
        _in_long_groups(cut.select(*keys, BLOCK, *payload), keys)
        .withColumn("__back", F.row_number().over(in_block.orderBy(*[F.desc(o) for o in order])))
        .filter(F.col("__back") <= k)
        .groupBy(*keys, BLOCK)
        .agg(F.array_sort(F.collect_list(F.struct(*payload))).alias("__tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(-k, -1)
    halo = (
        tails.withColumn("__tail", F.flatten(F.collect_list("__tail").over(earlier)))
        .withColumn("__row", F.explode(_last("__tail", k)))
        .select(*keys, BLOCK, F.lit(True).alias(HALO), "__row.*")
    )
    return cut.unionByName(halo, allowMissingColumns=True)


def _in_long_groups(cut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leave out rows of groups that lie within one block and need no halo.

    Only groups that span blocks stay in the table of spans, one row each; rows meet it in a
    semi-join, broadcast or skew-split at run time.
    """
    if not keys:
        return cut
    named = [F.col(k).alias(f"__span_{i}") for i, k in enumerate(keys)]
    spans = cut.groupBy(*named).agg(F.min(BLOCK).alias("__a"), F.max(BLOCK).alias("__b"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__span_{i}"))
    return cut.join(spans.filter("__a < __b"), same, "left_semi")


def _last(array: str, k: int) -> Column:
    return F.slice(array, F.greatest(F.size(array) - k + 1, F.lit(1)), k)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO, BLOCK)


def block_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def running_total(
    df: DataFrame,
    value: Column,
    keys: Sequence[str],
    order: Sequence[str],
    block: Block,
    out: str,
    group_total: str | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` per group, and optionally the whole group's sum."""
    cut = add_block(df, order, block).withColumn("__v", value.cast("bigint"))
    carry_cols = [CARRY, "__v", "__all"]
    carry = carry_rows(cut.groupBy(*keys, BLOCK).agg(F.sum("__v").alias("__v")), keys)
    rows = cut.withColumn(CARRY, F.lit(1)).withColumn("__all", F.lit(None).cast("bigint"))
    inside = Window.partitionBy(*keys, BLOCK)
    upto = inside.orderBy(CARRY, *order).rowsBetween(Window.unboundedPreceding, 0)
    done = rows.unionByName(carry, allowMissingColumns=True).withColumn(
        out, F.sum("__v").over(upto)
    )
    if group_total:
        done = done.withColumn(group_total, F.max("__all").over(upto))
    return done.filter(F.col(CARRY) == 1).drop(BLOCK, *carry_cols)


def carry_rows(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From one total ``__v`` per block to the row that opens the block with what came before.

    ``__v`` becomes the sum over the earlier blocks of the group, ``__all`` the group's sum.
    """
    group = Window.partitionBy(*keys)
    before = group.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys,
        BLOCK,
        F.lit(0).alias(CARRY),
        F.coalesce(F.sum("__v").over(before), F.lit(0)).alias("__v"),
        F.sum("__v").over(group).alias("__all"),
    )


def row_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Block,
    out: str,
    group_size: str | None = None,
) -> DataFrame:
    """1-based ``row_number`` per group without bringing a group into one task."""
    return running_total(df, F.lit(1), keys, order, block, out, group_size)
