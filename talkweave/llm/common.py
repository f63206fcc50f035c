"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import text_batches, written  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

#: one blank, and what is not blank: ASCII only
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is. A text of ASCII alone takes the short way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(key: str | Column, n: int) -> Column:
    """crc32 of a key written as text, modulo ``n``; a null key counts as an empty one."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % n


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns called ``names`` in any case: an operator's own columns replace them."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def map_texts(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` over rows that hold whole texts, in small batches."""
    text_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` bytes of text, one row at least.

    Small slices keep what a worker builds around them small; memory that a slice leaves unused goes back.
    """
    pool = pa.default_memory_pool()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        pool.release_unused()


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Words between ASCII blanks: how many each text has, and all of them in a row."""
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = parts.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(real).as_py():
        seen = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
        counts = np.diff(seen[parts.offsets.to_numpy() - parts.offsets[0].as_py()])
        return counts, flat.filter(real)
    return np.diff(parts.offsets.to_numpy()).astype(np.int64), flat
