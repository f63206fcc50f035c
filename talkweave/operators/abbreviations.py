"""Sentence boundaries that know the corpus's own abbreviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, _col, strip

#: a run of letters and inner full stops, and the full stop after it if there is one
TYPE = r"[\p{L}\p{M}]+(?:\.[\p{L}\p{M}]+)*\.?"


def period_counts(df: DataFrame, text: str) -> DataFrame:
    """(type, n, dotted): how often each type occurs, in lower case, and how often with a full stop after it."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TYPE), F.lit(0))
    words = df.select(F.explode(found).alias("word"))
    dotted = F.col("word").endswith(".")
    return words.groupBy(F.rtrim("word", F.lit(".")).alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(dotted, True)).alias("dotted")
    )


def _log_likelihood(p: Column, hits: Column, n: Column) -> Column:
    return hits * F.log(p) + (n - hits) * F.log(1 - p)


def abbreviation_scores(df: DataFrame, text: str, always: float = 0.99) -> DataFrame:
    """(type, n, dotted, score): how much a type behaves like an abbreviation.

    Twice the log likelihood ratio of two explanations of the full stops after the type: that it draws them with probability ``always``,
    or as often as any word. Short types, inner full stops and few occurrences without one raise the score.
    One aggregate over the corpus; the totals are a row.
    """
    counts = period_counts(df, text).filter(F.col("dotted") > 0)
    share = period_counts(df, text).agg((F.sum("dotted") / F.sum("n")).alias("p")).scalar()
    counts = counts.withColumn("p", F.least(F.lit(1 - 1e-9), share))
    n, dotted = F.col("n").cast("double"), F.col("dotted").cast("double")
    ratio = -2 * (_log_likelihood(F.col("p"), dotted, n) - _log_likelihood(F.lit(always), dotted, n))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = F.length("type") - inner
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(F.lit(1.0) / letters, n - dotted)
    return counts.select("type", "n", "dotted", score.alias("score"))


def learn_abbreviations(df: DataFrame, text: str, least: float = 0.3, most: int = 20_000) -> list[str]:
    """The types that score ``least``, in order. They become literals of an expression, so more than ``most`` are an error."""
    found = abbreviation_scores(df, text).filter(F.col("score") >= least).select("type").limit(most + 1).toPandas()["type"]
    if len(found) > most:
        raise ValueError(f"more than {most} abbreviations: raise the score asked for")
    return sorted(found)


def sentences(c: Column | str, abbreviations: list[str]) -> Column:
    """Break after . ! or ? before white space, but not after the full stop of an abbreviation.

    An abbreviation ends a sentence only at the end of the text.
    """
    parts = F.split(strip(_col(c)), rf"(?<=[.!?])(?={SPACE})")
    if abbreviations:
        last = lambda s: F.rtrim(F.lower(F.regexp_extract(s, rf"({TYPE})\z", 1)), F.lit("."))
        stays = lambda s: s.endswith(".") & last(s).isin(*abbreviations)
        glue = lambda done, s: F.when(
            (F.size(done) > 0) & stays(F.element_at(done, -1)),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.concat(F.element_at(done, -1), s))),
        ).otherwise(F.concat(done, F.array(s)))
        parts = F.aggregate(parts, F.array().cast("array<string>"), glue)
    return F.filter(F.transform(parts, strip), lambda s: s != "")
