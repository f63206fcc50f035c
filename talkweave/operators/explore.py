"""Counts, shares, histograms, terms. Each is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import NO_LABEL, time_parts
from ..functions.text import tokens, words
from ..session import written
from .schema import quoted


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    if dropna:
        df = df.filter(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count("*").alias("count"))


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Count and share of all rows per value, the missing value included."""
    counts = value_counts(df, column, dropna=False)
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


def top_n_counts(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The ``n`` most frequent values; equal counts by value."""
    return value_counts(df, column).orderBy(F.desc("count"), column).limit(n)


def counts_over_time(df: DataFrame, ts: str, units: Sequence[str]) -> DataFrame:
    """Rows per combination of time parts, e.g. ('date',) or ('hour', 'minute')."""
    parts = time_parts(ts, units)
    return df.filter(F.col(ts).isNotNull()).groupBy(*parts).agg(F.count("*").alias("count"))


def counts_by_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One count table over several columns; a missing value counts as 'None'.

    The columns are turned into rows inside one scan instead of one scan per column.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.coalesce(F.col(quoted(c)).cast("string"), F.lit(NO_LABEL)).alias("value"),
            )
            for c in columns
        ]
    )
    return (
        df.select(F.inline(cells)).groupBy("column", "value").agg(F.count("*").alias("count"))
    )


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Exact equal-width bins over the whole range; the last bin is closed."""
    x = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    low, high = x.agg(F.min("x")).scalar(), x.agg(F.max("x")).scalar()
    width = (high - low) / F.lit(float(bins))
    slot = F.coalesce(F.floor(F.try_divide(F.col("x") - low, width)), F.lit(0))
    return (
        x.groupBy(F.least(slot, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("count"), F.min("x").alias("min_x"), F.max("x").alias("max_x"))
    )


def length_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    return histogram(df, F.length(column), bins)


def extreme_tokens(df: DataFrame, column: str) -> DataFrame:
    """Longest and shortest token of all texts, alphabetically first among equals."""
    t = df.select(F.explode(F.array_distinct(tokens(column))).alias("t"))
    n = F.length("t")
    return t.agg(
        F.min(F.struct((-n).alias("n"), F.col("t")))["t"].alias("longest"),
        F.min(F.struct(n.alias("n"), F.col("t")))["t"].alias("shortest"),
    )


def term_frequencies(
    df: DataFrame, column: str, stop_words: Sequence[str] = (), n: int | None = None
) -> DataFrame:
    """Word counts without stop words, all or the ``n`` most frequent."""
    terms = df.select(F.explode(words(column)).alias("term"))
    counts = _without(terms, stop_words).groupBy("term").agg(F.count("*").alias("count"))
    counts = counts.filter(F.col("term").rlike(r"[\p{L}\p{N}]"))
    return counts if n is None else counts.orderBy(F.desc("count"), "term").limit(n)


def _without(terms: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    return terms.filter(~F.col("term").isin(*stop_words)) if stop_words else terms


def row_term_counts(
    df: DataFrame, column: str, keep: Sequence[str], terms: Column | None = None
) -> DataFrame:
    """``(*keep, term, n)``: terms of each row with their number in that row.

    Equal terms are counted by sorting inside the row, so nothing is shuffled on (row, term).
    """
    ready = df.select(*keep, F.sort_array(words(column) if terms is None else terms).alias("__s"))
    s, starts, n = F.col("__s"), F.col("__at"), F.size("__s")
    # where a run of equal terms begins; a test on n as a filter would be pushed below this
    # projection and compute the terms twice
    ready = ready.withColumn(
        "__at",
        F.when(
            n > 0,
            F.filter(
                F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
            ),
        ),
    )
    runs = F.transform(
        starts,
        lambda p, j: F.struct(
            F.get(s, p).alias("term"), (F.coalesce(F.get(starts, j + 1), n) - p).cast("bigint").alias("n")
        ),
    )
    return ready.select(*keep, F.inline_outer(runs)).filter(F.col("term").isNotNull())


def first_n_per_class(
    df: DataFrame, label: str, order: Sequence[str], n: int = 5, missing: str = "NaN"
) -> DataFrame:
    """First ``n`` rows per class in ``order``; a missing label is a class of its own.

    The rank filter reaches the scan side of the shuffle as a group limit, so a class holding
    most of the data sends ``n`` rows per task.
    """
    w = Window.partitionBy(label).orderBy(*order)
    return (
        df.withColumn(label, F.coalesce(F.col(label).cast("string"), F.lit(missing)))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
    )


def tfidf(
    df: DataFrame,
    column: str,
    doc: str | None = None,
    stop_words: Sequence[str] = (),
    doc_is_row: bool = False,
) -> DataFrame:
    """Smoothed, L2-normalised tf-idf per (document, term).

    idf = ln((1 + N) / (1 + df)) + 1. Without ``doc`` the whole table is one document, so idf
    is 1 for every term. Terms are alphanumeric tokens of two characters or more, unstemmed.
    ``doc_is_row`` promises one row per document and saves the grouping by document. Texts are cut into terms
    once: the counts are written to the shared folder, where both the document frequencies and the weights read them.
    """
    if doc is None:
        terms = _without(df.select(F.explode(words(column, 2)).alias("term")), stop_words)
        tf = terms.groupBy("term").agg(F.count("*").alias("tf"))
        norm = tf.agg(F.sqrt(F.sum(F.col("tf").cast("double") * F.col("tf")))).scalar()
        return tf.withColumn("tfidf", F.col("tf") / norm)
    tf = _without(row_term_counts(df, column, [doc], words(column, 2)), stop_words)
    if doc_is_row:
        tf = tf.withColumnRenamed("n", "tf")
        docs = df.agg(F.count("*")).scalar()
    else:
        tf = tf.groupBy(doc, "term").agg(F.sum("n").alias("tf"))
        docs = df.agg(F.count_distinct(doc)).scalar()
    tf = written(tf.select(doc, "term", "tf"), "term-counts")
    seen = tf.groupBy("term").agg(F.count("*").alias("docs"))
    idf = seen.select("term", (F.log((docs + 1.0) / (F.col("docs") + 1.0)) + 1.0).alias("idf"))
    weighted = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return weighted.select(doc, "term", "tf", (F.col("w") / norm).alias("tfidf"))


def tfidf_top(
    df: DataFrame,
    column: str,
    n: int = 20,
    doc: str | None = None,
    stop_words: Sequence[str] = (),
    doc_is_row: bool = False,
) -> DataFrame:
    """The ``n`` heaviest terms of the table, or of each document."""
    scored = tfidf(df, column, doc, stop_words, doc_is_row)
    score = F.round("tfidf", 12)
    if doc is None:
        return scored.orderBy(score.desc(), "term").limit(n)
    w = Window.partitionBy(doc).orderBy(score.desc(), "term")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def distinct_values(df: DataFrame, column: str, order: str | None = None) -> DataFrame:
    """Unique values; with ``order`` also where each is first seen."""
    if order is None:
        return df.select(column).distinct()
    return df.groupBy(column).agg(F.min(order).alias("first_seen"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null and null counts. One aggregation."""
    rows = F.count(F.lit(1))
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            rows.alias("rows"),
            F.count(F.col(quoted(name))).alias("non_null"),
            (rows - F.count(F.col(quoted(name)))).alias("nulls"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def seeded_order(key: str | Sequence[str], seed: int) -> Column:
    """A pseudo-random, reproducible sort key that any engine with md5 can repeat."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def sample_rows(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows, the same on every run.

    Rows are counted by the first five digits of their sort key, at most 16**5 groups. The running
    count tells which digits the first ``n`` rows cannot exceed, so that only about ``n`` rows,
    not ``n`` from every task, are sorted.
    """
    h = seeded_order(key, seed)
    digits = F.substring(h, 1, 5)
    counts = df.groupBy(digits.alias("d")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
    cut = counts.withColumn("c", upto).filter(F.col("c") >= n).agg(F.min("d")).scalar()
    return df.filter(digits <= F.coalesce(cut, F.lit("g"))).orderBy(h).limit(n)


def longest_text(df: DataFrame, column: str, key: str) -> DataFrame:
    """Longest text; the smallest key among equals."""
    best = F.max_by(
        F.struct(F.col(key), F.col(column)), F.struct(F.length(column), (-F.col(key)).alias("k"))
    )
    return df.agg(best.alias("b")).select(
        f"b.{key}", f"b.{column}", F.length(f"b.{column}").alias("length")
    )


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)
