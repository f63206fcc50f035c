"""Column-level operators. Only the two duplicate checks read data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import backfill


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_prefixed(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    keep = [c for c in df.columns if not c.startswith(tuple(prefixes))]
    return df.select(*map(quoted, keep))


def equal_column_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per pair of same-typed columns and whether all their values agree.

    All pairs are decided in one scan with map-side partial aggregation; NULL equals NULL.
    """
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    pairs = [(a, b) for a, b in combinations(names, 2) if kinds[a] == kinds[b]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, equal boolean")
    same = [
        F.struct(
            F.lit(a).alias("col_a"),
            F.lit(b).alias("col_b"),
            F.coalesce(F.bool_and(F.col(quoted(a)).eqNullSafe(F.col(quoted(b)))), F.lit(True)).alias("equal"),
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*same).alias("pairs")).select(F.inline("pairs"))


def drop_equal_columns(df: DataFrame) -> DataFrame:
    """Drop each column whose content equals an earlier one's.

    One aggregate per column first: the sum over rows of a hash of the value tied to a hash of the
    whole row. Equal columns have equal sums, so only columns of one type and sum are
    compared value by value, in a second scan that a table without twins does not need.
    """
    row = F.xxhash64(*map(quoted, df.columns))
    sums = df.select(row.alias("__row"), *map(quoted, df.columns)).agg(
        *[F.sum(F.xxhash64("__row", F.hash(quoted(c))).cast("decimal(38,0)")).alias(f"s{i}") for i, c in enumerate(df.columns)]
    ).first()
    alike: dict[tuple, list[str]] = {}
    for (name, kind), total in zip(df.dtypes, sums):
        alike.setdefault((kind, total), []).append(name)
    gone = set()
    for names in alike.values():
        if len(names) > 1:
            twins = equal_column_report(df, names).filter("equal").select("col_b").distinct()
            gone |= {r["col_b"] for r in twins.collect()}  # at most one row per column of the table
    return df.select(*[quoted(c) for c in df.columns if c not in gone])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def camel_columns(df: DataFrame) -> DataFrame:
    """``response number`` -> ``ResponseNumber``; later letters keep their case."""
    return df.toDF(*["".join(w[0].upper() + w[1:] for w in c.split()) for c in df.columns])


def _suffix_pairs(df: DataFrame, suffix: str) -> list[tuple[str, str]]:
    have = set(df.columns)
    return [
        (c[: -len(suffix)], c)
        for c in df.columns
        if c.endswith(suffix) and c[: -len(suffix)] in have
    ]


def suffix_duplicate_report(df: DataFrame, suffix: str = ".1") -> DataFrame:
    """Per duplicated column: rows where only the duplicate holds a value."""
    counts = [
        F.struct(
            F.lit(a).alias("column"),
            F.count_if(F.col(quoted(a)).isNull() & F.col(quoted(b)).isNotNull()).alias("only_in_duplicate"),
        )
        for a, b in _suffix_pairs(df, suffix)
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, only_in_duplicate bigint")
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def drop_suffix_duplicates(df: DataFrame, suffix: str = ".1") -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not c.endswith(suffix)])


def rater_pairs(
    columns: Sequence[str], first: str = "R1", second: str = "R2", binary: str = "Binary"
) -> list[tuple[str, str]]:
    """(first-rater, second-rater) columns that differ only in the rater mark."""
    have = set(columns)
    pairs = []
    for prefix in ("", binary):
        lead = prefix + first
        for c in columns:
            if c.startswith(lead) and prefix + second + c[len(lead) :] in have:
                pairs.append((c, prefix + second + c[len(lead) :]))
    return pairs


def backfill_report(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Per pair: rows where the second rater is missing or empty and the first is set."""
    counts = [
        F.struct(
            F.lit(a).alias("first"),
            F.lit(b).alias("second"),
            F.count_if(
                (F.col(quoted(b)).isNull() | (F.col(quoted(b)) == "")) & F.col(quoted(a)).isNotNull()
            ).alias("missing"),
        )
        for a, b in pairs
    ]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def backfill_pairs(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    only: Sequence[str] = ("Pivot", "Upta", "Question"),
) -> DataFrame:
    """Fill the second rater from the first where the column name holds one of ``only``."""
    return df.withColumns(
        {
            b: backfill(F.col(quoted(b)), F.col(quoted(a)))
            for a, b in pairs
            if any(word in b for word in only)
        }
    )


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns; dirty values become NULL unless ``strict``, missing values stay NULL."""
    return df.withColumns(
        {
            c: F.col(quoted(c)).cast(kind) if strict else F.col(quoted(c)).try_cast(kind)
            for c, kind in types.items()
        }
    )


def align_schemas(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to their common columns, in the order of the first."""
    common = [quoted(c) for c in a.columns if c in set(b.columns)]
    return a.select(*common), b.select(*common)


def select_columns(
    df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    names = [c for c in (keep or df.columns) if c not in set(drop)]
    return df.select(*map(quoted, names))
