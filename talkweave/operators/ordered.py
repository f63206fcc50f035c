"""Look-back over conversations: runs, history, previous message, pivots.

``within`` names the columns that never interleave (a source file, a conversation id); ``order``
the columns that sort rows inside it; ``run_keys`` further columns whose change starts a new
conversation, with NULLs equal and a returning key starting afresh.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import literal_map
from .blocks import (
    AUTO,
    BLOCK,
    CARRY,
    HALO,
    Block,
    block_window,
    carry_rows,
    drop_halo,
    with_halo,
)


def _changed(run_keys: Sequence[str], w) -> Column:
    """1 where a row starts a new run inside the window, else 0."""
    key = F.struct(*run_keys)
    first = F.lag(F.lit(True)).over(w).isNull()
    return (first | ~F.lag(key).over(w).eqNullSafe(key)).cast("int")


def conversation_runs(
    df: DataFrame,
    run_keys: Sequence[str],
    order: Sequence[str],
    within: Sequence[str],
    block: Block = AUTO,
    out: str = "run",
) -> DataFrame:
    """Number the runs of equal adjacent keys, from 1 in each ``within`` group.

    A first pass over the key columns alone counts the starts of each block. In the second the
    whole rows move once and meet their block's halo row and carry row.
    """
    w = block_window(within, order)
    if block is None:
        cut = with_halo(df, within, order, 1, None)
        starts = cut.withColumn("__start", _changed(run_keys, w))
        running = F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))
        return drop_halo(starts.withColumn(out, running)).drop("__start")
    keys = list(dict.fromkeys([*within, *order, *run_keys]))
    flags = with_halo(df.select(*keys), within, order, 1, block)
    flags = flags.withColumn("__start", _changed(run_keys, w)).filter(~F.col(HALO))
    totals = flags.groupBy(*within, BLOCK).agg(F.sum("__start").alias("__v"))
    carry = carry_rows(totals, within).drop("__all").withColumn(HALO, F.lit(True))
    rows = with_halo(df, within, order, 1, block, needed=run_keys).withColumn(CARRY, F.lit(1))
    w = Window.partitionBy(*within, BLOCK).orderBy(CARRY, *order)
    # the carry row holds a count, a halo row adds nothing, a row adds 1 where its key is new
    key = F.struct(CARRY, *run_keys)
    new = (~F.coalesce(F.lag(key).over(w).eqNullSafe(key), F.lit(False))).cast("int")
    adds = F.when(F.col(CARRY) == 0, F.col("__v")).when(~F.col(HALO), F.col("__new")).otherwise(0)
    done = (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn("__new", new)
        .withColumn("__v", adds)
        .withColumn(out, F.sum("__v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return drop_halo(done).drop("__new", "__v", CARRY)


def history(
    df: DataFrame,
    text: str,
    order: Sequence[str],
    within: Sequence[str],
    k: int = 6,
    label: str | None = None,
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
    out: str = "history",
) -> DataFrame:
    """Up to ``k`` earlier turns of the same conversation as ``array<struct<text,label>>``.

    Turns and labels travel in one struct, so a missing label stays aligned with its text.
    ``k <= 0`` means every earlier turn. That output grows with the square of the
    conversation, whatever computes it, so it suits conversations known to be short.
    """
    item = F.struct(F.col(text).alias("text"), (F.col(label) if label else F.lit(None).cast("string")).alias("label"))
    needed = [c for c in (text, label, *run_keys) if c]
    if k <= 0:
        block, frame_start = None, Window.unboundedPreceding
    else:
        frame_start = -k
    # one halo row more than k shows whether the oldest turn starts a run
    haloed = with_halo(df, within, order, k + 1, block, needed=needed)
    w = block_window(within, order)
    frame = w.rowsBetween(frame_start, -1)
    if not run_keys:
        return drop_halo(haloed.withColumn(out, F.collect_list(item).over(frame)))
    local_run = F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0))
    tagged = (
        haloed.withColumn("__start", _changed(run_keys, w))
        .withColumn("__run", local_run)
        .withColumn(out, F.collect_list(F.struct(F.col("__run"), item.alias("item"))).over(frame))
    )
    same = F.filter(F.col(out), lambda x: x["__run"] == F.col("__run"))
    return drop_halo(tagged.withColumn(out, F.transform(same, lambda x: x["item"]))).drop(
        "__start", "__run"
    )


def label_history(df: DataFrame, text: str, label: str, *args, **kwargs) -> DataFrame:
    """:func:`history` with labels; the label column must exist."""
    if not label or label not in df.columns:
        raise ValueError("past labels need an existing label column")
    return history(df, text, *args, label=label, **kwargs)


def _look_back(
    df: DataFrame,
    columns: Mapping[str, Column],
    needed: Sequence[str],
    order: Sequence[str],
    within: Sequence[str],
    run_keys: Sequence[str],
    block: Block,
) -> DataFrame:
    """Add previous-row values, NULL at the start of a conversation."""
    w = block_window(within, order)
    out = with_halo(df, within, order, 1, block, needed=[*needed, *run_keys])
    same = ~_changed(run_keys, w).cast("boolean") if run_keys else F.lit(True)
    for name, value in columns.items():
        out = out.withColumn(name, F.when(same, F.lag(value).over(w)))
    return drop_halo(out)


def prev_message(
    df: DataFrame,
    text: str,
    order: Sequence[str],
    within: Sequence[str],
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
    out: str = "prev_message",
) -> DataFrame:
    """Text before this one in the conversation, '' at its start."""
    done = _look_back(df, {out: F.col(text)}, [text], order, within, run_keys, block)
    return done.withColumn(out, F.coalesce(out, F.lit("")))


def prev_categories(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    within: Sequence[str],
    k: int = 3,
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
    out: str = "prev_categories",
) -> DataFrame:
    """The last ``k`` ``a-b-c`` descriptions joined by bars, oldest first, '' at the start."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    kept = df.columns
    described = df.withColumn("__d", F.concat_ws("-", *parts))
    done = history(described, "__d", order, within, k, None, run_keys, block, out="__h")
    joined = F.array_join(F.transform("__h", lambda x: x["text"]), "|")
    return done.select(*kept, joined.alias(out))


def check_pivot(
    df: DataFrame,
    kind: str,
    start: str,
    end: str,
    order: Sequence[str],
    within: Sequence[str],
    collapse: Mapping[str, str] | None = None,
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
) -> DataFrame:
    """Compare a coded pivot with the previous and current type.

    Adds ``guess_from``, ``guess_to`` and ``pivot_check``: ``corrected`` when both ends agree,
    ``misplaced`` when not, NULL when nothing is coded, the row opens a conversation, or a
    type lies outside ``collapse``.
    """
    done = _look_back(df, {"__prev": F.col(kind)}, [kind], order, within, run_keys, block)
    if collapse:
        mapped = literal_map(collapse)
        guess_from = F.try_element_at(mapped, F.col("__prev"))
        guess_to = F.try_element_at(mapped, F.col(kind))
    else:
        guess_from, guess_to = F.col("__prev"), F.col(kind)
    known = (
        F.col(start).isNotNull()
        & F.col(end).isNotNull()
        & guess_from.isNotNull()
        & guess_to.isNotNull()
    )
    agrees = (F.col(start) == guess_from) & (F.col(end) == guess_to)
    return (
        done.withColumn("guess_from", F.when(known, guess_from))
        .withColumn("guess_to", F.when(known, guess_to))
        .withColumn(
            "pivot_check", F.when(known, F.when(agrees, "corrected").otherwise("misplaced"))
        )
        .drop("__prev")
    )


def check_pivot_contains(
    df: DataFrame,
    kind: str,
    pivot: str,
    order: Sequence[str],
    within: Sequence[str],
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
) -> DataFrame:
    """Looser form: does the pivot text name both the previous and the current type?"""
    done = _look_back(df, {"__prev": F.col(kind)}, [kind], order, within, run_keys, block)
    named = F.contains(pivot, F.col("__prev")) & F.contains(pivot, F.col(kind))
    coded = F.col(pivot).isNotNull()
    return done.withColumn(
        "pivot_named", F.when(coded, F.coalesce(named, F.lit(False)))
    ).drop("__prev")


def pivot_check_summary(checked: DataFrame) -> DataFrame:
    """One row: how many pivots agree, how many do not, and the agreeing share."""
    good = F.count_if(F.col("pivot_check") == "corrected")
    bad = F.count_if(F.col("pivot_check") == "misplaced")
    return checked.agg(
        good.alias("corrected"),
        bad.alias("misplaced"),
        F.try_divide(good, good + bad).alias("share"),
    )


def derive_pivot(
    df: DataFrame,
    kind: str,
    order: Sequence[str],
    within: Sequence[str],
    run_keys: Sequence[str] = (),
    block: Block = AUTO,
) -> DataFrame:
    """Pivot guessed wherever the type changes inside a conversation, else NULL ends."""
    done = _look_back(df, {"__prev": F.col(kind)}, [kind], order, within, run_keys, block)
    moved = F.col("__prev") != F.col(kind)
    return (
        done.withColumn("from_pivot", F.when(moved, F.col("__prev")))
        .withColumn("to_pivot", F.when(moved, F.col(kind)))
        .drop("__prev")
    )
