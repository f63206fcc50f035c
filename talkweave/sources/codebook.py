"""The label codebook."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def read_codebook(raw: DataFrame, term: str = "Term") -> DataFrame:
    """Split ``Class:Term`` and trim the term; other columns keep their values, in lower case."""
    parts = F.split(F.col(term), ":")
    rest = [F.col(c).alias(c.lower()) for c in raw.columns if c != term]
    return raw.select(
        F.get(parts, F.lit(0)).alias("class"),
        strip(F.get(parts, F.lit(1))).alias("term"),
        *rest,
    )
