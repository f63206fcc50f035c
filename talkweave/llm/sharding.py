"""A uniform shuffle of all rows into shards of exact size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import fresh, load, without, written
from .registry import query

#: numpy draws hypergeometric numbers below this total
SMALL = 1_000_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` draws without return are good, exact for any total.

    Beyond numpy's limit: the cumulative distribution over 12 standard deviations on both sides of the mode, from
    ratios of neighbours.
    """
    total = good + bad
    if total < SMALL:
        return int(rng.hypergeometric(good, bad, sample)) if sample else 0
    low, high = max(0, sample - bad), min(good, sample)
    mode = int((sample + 1) * (good + 1) // (total + 2))
    spread = int(12 * np.sqrt(sample * (good / total) * (bad / total) * ((total - sample) / (total - 1)))) + 20
    low, high = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], "right"))


def deal(rng: np.random.Generator, columns: np.ndarray, sample: int) -> np.ndarray:
    """How ``sample`` rows drawn without return from ``columns`` (rows wanted by each) divide over them."""
    total = int(columns.sum())
    if total < SMALL:
        return rng.multivariate_hypergeometric(columns, sample, method="marginals")
    if len(columns) == 1:
        return np.array([sample])
    half = len(columns) // 2
    left = int(columns[:half].sum())
    first = hypergeometric(rng, left, total - left, sample)
    return np.concatenate([deal(rng, columns[:half], first), deal(rng, columns[half:], sample - first)])


def matrix_row(part: int, rows: np.ndarray, columns: np.ndarray, seed: int) -> np.ndarray:
    """One row of the communication matrix: how many rows partition ``part`` sends to each column.

    ``rows`` and ``columns`` are the sums of the matrix. The partitions are halved again and again, and the columns'
    numbers are dealt to the halves with a generator that belongs to the node; every task walks
    down to its own partition and finds the same matrix as all others, without anyone holding it whole.
    """
    low, high, node, mine = 0, len(rows), 1, columns
    before = np.concatenate([[0], np.cumsum(rows)])
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, node])
        left = deal(rng, mine, int(before[middle] - before[low]))
        if part < middle:
            mine, high, node = left, middle, 2 * node
        else:
            mine, low, node = mine - left, middle, 2 * node + 1
    return mine


def even_parts(total: int, parts: int) -> np.ndarray:
    """``total`` in ``parts`` numbers at most one apart, the larger ones first."""
    return np.full(parts, total // parts, dtype=np.int64) + (np.arange(parts) < total % parts)


def shard(docs: DataFrame, shards: int = 8, seed: int = 29, block_rows: int = 50_000, block_bytes: int = 32_000_000) -> DataFrame:
    """``docs`` in uniformly random order: ``shard`` (0 to ``shards`` - 1, sizes at most one apart) and ``slot`` (gapless from 0).

    First each partition permutes its rows by a random number and numbers them; this is written to the shared
    folder, so what follows does not change when a task runs again. Then the communication matrix
    says how many rows each partition sends to each block of a shard: a multivariate hypergeometric
    draw whose row sums are the partitions' counts and whose column sums are the blocks' sizes. The n-th
    row of a partition goes where the n-th place of its matrix row is. Blocks (at most ``block_rows`` rows, and as many as make about ``block_bytes`` of texts) are permuted
    again, and a row's slot is its block's first slot plus its rank. Blocks keep every task bounded however large a shard.

    Only the partitions' row counts and sizes go to the driver, two numbers per partition. Rows that are equal, null or empty
    are rows like others; columns of ``docs`` called shard or slot (in any case) are replaced. An empty table gives an empty table.
    The order depends on how the input is partitioned; with the same partitions it is the same again.
    """
    docs = without(docs, "shard", "slot")
    luck, place, part, rank, block, base, second = fresh(
        docs, "shard_luck", "shard_place", "shard_part", "shard_rank", "shard_block", "shard_base", "shard_second"
    )
    mixed = docs.withColumn(luck, F.rand(seed)).sortWithinPartitions(luck).drop(luck)
    pinned = written(mixed.withColumn(place, F.monotonically_increasing_id()), "shard-local")
    parted = pinned.withColumn(part, F.shiftright(place, 33)).withColumn(rank, F.col(place).bitwiseAND((1 << 33) - 1))
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)).cast("long") for c, kind in docs.dtypes if kind in ("string", "binary")]
    width = sum(texts, F.lit(32).cast("long"))
    counts = parted.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).orderBy(part).toPandas()
    ids, rows = counts[part].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    sizes = even_parts(int(rows.sum()), shards)
    block_rows = max(1, min(block_rows, int(block_bytes * rows.sum() / max(1, counts["bytes"].sum()))))
    blocks = [even_parts(int(n), max(1, -(-int(n) // block_rows))) for n in sizes]
    columns = np.concatenate(blocks)
    owners = np.repeat(np.arange(shards), [len(b) for b in blocks])
    firsts = np.concatenate([np.cumsum(b) - b for b in blocks])

    @F.pandas_udf(T.IntegerType())
    def column_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known, ends = None, None
        for parts, ranks in batches:
            out = np.zeros(len(parts), dtype=np.int32)
            numbers, places = parts.to_numpy(), ranks.to_numpy()
            for number in np.unique(numbers):
                if number != known:
                    known, ends = number, np.cumsum(matrix_row(int(np.searchsorted(ids, number)), rows, columns, seed))
                mine = numbers == number
                out[mine] = np.searchsorted(ends, places[mine], "right")
            yield pd.Series(out)

    @F.pandas_udf(T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType())]))
    def where(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for numbers in batches:
            yield pd.DataFrame({"shard": owners[numbers].astype(np.int32), "first": firsts[numbers]})

    sent = parted.withColumn(block, column_of(F.col(part), F.col(rank))).withColumn(base, where(block))
    sent = sent.withColumn(second, F.xxhash64(F.lit(seed + 1), F.col(place)))
    within = Window.partitionBy(block).orderBy(second, place)
    done = sent.withColumn("shard", F.col(f"{base}.shard"))
    done = done.withColumn("slot", F.col(f"{base}.first") + F.row_number().over(within) - 1)
    return done.drop(place, part, rank, block, base, second)


@query("op2_sharding")
def op2_sharding(spark, folder):
    done = shard(load(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
