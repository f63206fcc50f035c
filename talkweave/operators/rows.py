"""Row filters and row generators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentences, strip
from .blocks import AUTO, Block, row_position


def keep_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose value starts with ``prefix``; NULL counts as ''. Pushed to the scan."""
    return df.filter(F.col(column).startswith(prefix)) if prefix else df


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_ne(df: DataFrame, column: str, value) -> DataFrame:
    """Rows that differ from ``value``; a missing value differs."""
    return df.filter(F.col(column).isNull() | (F.col(column) != F.lit(value)))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def outside_allow_list(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows an allow-list would change: a value is given and not listed."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def with_row_id(
    df: DataFrame,
    order: Sequence[str],
    per: Sequence[str] = (),
    block: Block = AUTO,
    out: str = "row_id",
) -> DataFrame:
    """0-based position in ``order``, per source; stable across runs for a unique order."""
    return row_position(df, per, order, block, out).withColumn(out, F.col(out) - 1)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps, which have no hash of their own, as text."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in df.dtypes])


def drop_tail(
    df: DataFrame, n: int, order: Sequence[str], per: Sequence[str] = ()
) -> DataFrame:
    """Drop exactly the last ``n`` rows of each source, or all of a shorter one.

    Rows with equal ``order`` are told apart by a hash of the whole row; of rows alike in every
    column it does not matter which go, so they are counted. The row_number filter is pushed
    below the shuffle as a group limit: at most ``n`` key rows per source and task are moved to find the
    cut. The rows meet only the cut, one per source, in an equi-join that is broadcast or
    skew-split at run time.
    """
    if n <= 0:
        return df
    at = F.struct(*order, row_hash(df).alias("__hash"))
    keyed = df.withColumn("__at", at)
    last = Window.partitionBy(*per).orderBy(F.desc("__at"))
    tail = keyed.select(*per, "__at").withColumn("__back", F.row_number().over(last)).filter(F.col("__back") <= n)
    named = [F.col(p).alias(f"__{p}") for p in per]
    cut = (
        tail.groupBy(*per, "__at")
        .agg(F.count("*").alias("__n"))
        .groupBy(*named)
        .agg(F.min(F.struct(F.col("__at"), F.col("__n"))).alias("__cut"))
    )
    if per:
        same = F.lit(True)
        for p in per:
            same = same & F.col(p).eqNullSafe(F.col(f"__{p}"))
        met = keyed.join(cut, same)
    else:
        met = keyed.withColumn("__cut", cut.select("__cut").scalar())
    before = met.filter(F.col("__at") < F.col("__cut.__at")).select(*df.columns)
    # of the rows at the cut, alike in every column, those beyond the tail's stay
    level = met.filter(F.col("__at") == F.col("__cut.__at")).groupBy(*df.columns)
    left = level.agg((F.count("*") - F.max("__cut.__n")).alias("__left")).filter("__left > 0")
    again = left.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__left")))).select(*df.columns)
    return before.unionByName(again)


def split_multilabel(
    df: DataFrame,
    column: str,
    message: str = "message",
    divide_also: Sequence[str] = (),
    take_last_of: Sequence[str] = (),
    change_to: str | None = None,
    mode: str = "change",
    part: str = "part_no",
    cut: Callable[[Column | str], Column] = sentences,
) -> DataFrame:
    """Split rows whose label cell lists several labels separated by commas.

    * as many sentences as labels: one row per (label, sentence); ``divide_also`` cells with the
      same number of parts are divided too, ``take_last_of`` cells stay on the last row only;
    * all labels equal: that label, one row;
    * otherwise ``change_to`` on one row, or with ``mode='duplicate'`` one row per label with
      the whole message.

    Labels are trimmed before they are compared. ``cut`` makes the sentences; one that knows abbreviations is
    :func:`talkweave.operators.abbreviations.sentences`. Row-local: arrays and one ``inline``, no shuffle.
    """
    if mode not in ("change", "duplicate"):
        raise ValueError(f"mode {mode!r}")
    kinds = dict(df.dtypes)
    listed = F.coalesce(F.contains(F.col(column), F.lit(",")), F.lit(False))
    # a projection of their own: computed once per row, and only where labels are listed
    ready = df.withColumns(
        {
            "__labels": F.when(listed, F.transform(F.split(column, ","), strip)),
            "__pieces": F.when(listed, cut(message)),
        }
    )
    labels, pieces = F.col("__labels"), F.col("__pieces")
    is_split = F.coalesce(listed & (F.size(pieces) == F.size(labels)), F.lit(False))
    is_equal = F.size(F.array_distinct(labels)) == 1
    is_repeat = listed & ~is_equal if mode == "duplicate" else F.lit(False)

    def row(label: Column, text: Column, i: Column | None, n: Column | None) -> Column:
        fields = []
        for c in df.columns:
            value = F.col(c)
            if c == column:
                value = label
            elif c == message:
                value = text
            elif i is not None and c in take_last_of:
                value = F.when(i == n - 1, value)
            elif i is not None and c in divide_also:
                cells = F.split(value.cast("string"), ",")
                value = F.when(F.size(cells) == n, strip(F.get(cells, i))).otherwise(value)
            fields.append(value.cast(kinds[c]).alias(c))
        number = F.lit(0) if i is None else i
        return F.struct(*fields, number.cast("int").alias(part))

    n = F.size(labels)
    parted = F.transform(labels, lambda x, i: row(x, F.get(pieces, i), i, n))
    repeated = F.transform(labels, lambda x, i: row(x, F.col(message), i, n))
    one_label = (
        F.when(~listed, F.col(column)).when(is_equal, F.get(labels, F.lit(0))).otherwise(F.lit(change_to))
    )
    single = F.array(row(one_label, F.col(message), None, None))
    rows = F.when(is_split, parted).when(is_repeat, repeated).otherwise(single)
    return ready.select(F.inline(rows))


def apply_corrections(
    df: DataFrame,
    corrections: Sequence[tuple[str, int, str, str]],
    message: str,
    label: str,
    order: Sequence[str],
    part: str = "part_no",
) -> DataFrame:
    """Replace hand-picked messages by hand-made labelled parts.

    ``corrections`` is a hand-written list ``(prefix, seq, new_text, new_label)``. Of all rows
    whose message starts with a prefix, only the first in ``order`` is replaced; ties are broken by
    a hash of the row, and of rows alike in every column one is replaced. The list is literal, so matching is a row-local expression, not a join on a condition.
    """
    prefixes = list(dict.fromkeys(p for p, *_ in corrections))
    if not prefixes:
        return df.withColumn(part, F.lit(0))
    which, parts = F.lit(None).cast("int"), F.lit(None)
    for i in reversed(range(len(prefixes))):
        hit = F.col(message).startswith(prefixes[i])
        new = [
            F.struct(F.lit(t).alias("t"), F.lit(lab).alias("l"))
            for p, _, t, lab in sorted(corrections, key=lambda r: r[1])
            if p == prefixes[i]
        ]
        which = F.when(hit, F.lit(i)).otherwise(which)
        parts = F.when(F.col("__which") == i, F.array(*new)).otherwise(parts)
    tagged = df.withColumn("__which", which).withColumn("__at", F.struct(*order, row_hash(df).alias("__hash")))
    hit = F.col("__which").isNotNull()
    first = tagged.filter(hit).groupBy("__which").agg(F.min("__at").alias("__first"))
    # at most one row per prefix of the given list, hence safe to broadcast
    met = tagged.join(F.broadcast(first), "__which", "left")
    is_first = F.coalesce(F.col("__at") == F.col("__first"), F.lit(False))
    # of rows alike in every column one is replaced: only those are numbered
    alike = Window.partitionBy("__which").orderBy("__at")
    numbered = met.filter(is_first).withColumn("__i", F.row_number().over(alike))
    rows = met.filter(~is_first).withColumn("__i", F.lit(0)).unionByName(numbered)
    kept = F.array(F.struct(F.col(message).alias("t"), F.col(label).alias("l")))
    chosen = F.when(F.col("__i") == 1, parts).otherwise(kept)
    rest = [c for c in df.columns if c not in (message, label)]
    return (
        rows.select(*rest, F.posexplode(chosen).alias(part, "__p"))
        .select(*rest, F.col("__p.t").alias(message), F.col("__p.l").alias(label), part)
        .select(*df.columns, part)
    )


def apply_correction_table(
    df: DataFrame,
    corrections: DataFrame,
    message: str,
    label: str,
    order: Sequence[str],
    part: str = "part_no",
) -> DataFrame:
    """:func:`apply_corrections` with a table of any size: ``corrections(prefix, place, seq, text, label)``.

    Of several prefixes a message starts with, the one of the smallest ``place`` counts (then the first in the alphabet). Messages are hashed once for each length a prefix has, so
    prefixes and messages meet in one equi-join, and ``startswith`` confirms; only what orders a row and its message travel for that. The
    joins sort and merge: a planner that goes by the size of the files would broadcast the hashed messages, many for each row. The
    plan does not depend on how many corrections there are. NULL messages and NULL or empty prefixes match nothing.
    """
    known = corrections.filter(F.length("prefix") > 0)
    parts = known.groupBy("prefix").agg(
        F.min("place").alias("place"),
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "text", "label"))), lambda p: F.struct(p["text"].alias("t"), p["label"].alias("l"))).alias("__parts"),
    )
    sizes = known.agg(F.coalesce(F.collect_set(F.length("prefix")), F.array().cast("array<int>")).alias("s"))
    keyed = df.withColumn("__at", F.struct(*order, row_hash(df).alias("__hash")))
    sized = keyed.select("__at", F.col(message).alias("__m")).withColumn("__sizes", sizes.scalar())
    mine = F.filter("__sizes", lambda n: n <= F.length("__m"))
    probes = sized.select("__at", "__m", F.explode(mine).alias("__n"))
    probes = probes.withColumn("__key", F.xxhash64("__n", F.substring(F.col("__m"), F.lit(1), F.col("__n"))))
    keys = parts.select("prefix", "place", F.xxhash64(F.length("prefix"), "prefix").alias("__key"))
    hits = probes.join(keys.hint("merge"), "__key").filter(F.col("__m").startswith(F.col("prefix")))
    taken = hits.groupBy("__at").agg(F.min(F.struct("place", "prefix")).alias("p")).select("__at", F.col("p.prefix").alias("prefix"))
    first = taken.groupBy("prefix").agg(F.min("__at").alias("__first")).join(parts.select("prefix", "__parts").hint("merge"), "prefix").drop("prefix")
    met = keyed.join(first.hint("merge"), F.col("__at") == F.col("__first"), "left")
    rest = [c for c in df.columns if c not in (message, label)]
    unit = F.array(F.struct(F.col(message).alias("t"), F.col(label).alias("l")))
    untouched = met.filter(F.col("__parts").isNull()).select(*df.columns, unit.alias("__p"))
    # rows alike in every column: one is replaced, the others are given back as often as they stood
    alike = met.filter(F.col("__parts").isNotNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"), F.first("__parts").alias("__new"))
    replaced = alike.select(*df.columns, F.col("__new").alias("__p"))
    again = alike.filter("__n > 1").withColumn("__i", F.explode(F.sequence(F.lit(2).cast("bigint"), F.col("__n"))))
    rows = untouched.unionByName(replaced).unionByName(again.select(*df.columns, unit.alias("__p")))
    return (
        rows.select(*rest, F.posexplode("__p").alias(part, "__q"))
        .select(*rest, F.col("__q.t").alias(message), F.col("__q.l").alias(label), part)
        .select(*df.columns, part)
    )
