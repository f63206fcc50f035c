"""Exact duplicates: one row stays of all texts that agree byte for byte after normalising."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, fresh, load, written
from .registry import query


def squeeze(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK}+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = squeeze,
    content_hash: Callable[[Column], Column] = F.md5,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """For each row: key, keep_key, group_size, kept and the digest of its normalised text.

    Rows meet by the 128-bit ``content_hash``; only hashes, lengths and keys travel for that, and counts and the
    best row combine before the shuffle, so a group of any size is one row there. The bytes are compared by grouping
    (hash, normalised text): copies collapse where they are read and each text moves once. Texts that share a hash get a number each, and rows meet by
    hash and number; usually there are none. Of a group the row with the most code points
    in its original text stays, then the smallest key, then the row that stands first in the table.

    A null text is an empty one. A null key sorts before all others. Rows repeated with their key, or without one, are rows of their own: they count in
    ``group_size``, and one row of a group is ``kept``. An empty table gives an empty table.
    """
    done = _decided(docs.withColumn("exact_row", F.monotonically_increasing_id()), "exact_row", key, text, normalise, content_hash, digest)
    return done.select(F.col("key").alias(key), "keep_key", "group_size", "kept", "digest")


def _decided(rows: DataFrame, row: str, key: str, text: str, normalise: Callable, content_hash: Callable, digest: Callable) -> DataFrame:
    """(row, key, keep_key, group_size, kept, digest) of numbered rows."""
    rows = rows.select(F.col(f"`{row}`").alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = rows.select("row", "key", F.length(F.coalesce("text", F.lit(""))).alias("n"), normalise(F.col("text")).alias("norm"))
    hashed = rows.withColumn("h", content_hash(F.col("norm")))
    texts = hashed.select("h", "norm").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("texts"))
    shared = written(texts.filter("texts > 1").select("h"), "exact-shared")
    some = hashed.join(shared, "h").select("h", "norm").distinct()
    nth = some.withColumn("nth", F.row_number().over(Window.partitionBy("h").orderBy("norm")))
    nth = written(nth, "exact-collisions")
    told = hashed.join(nth, ["h", "norm"], "left").withColumn("nth", F.coalesce("nth", F.lit(0)))
    light = written(told.select("row", "key", "n", "h", "nth", digest(F.col("norm")).alias("sha")), "exact-keys")
    groups = light.groupBy("h", "nth").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct((-F.col("n")).alias("n"), F.col("key"), F.col("row"))).alias("best")
    )
    groups = written(groups.filter("size > 1").select("h", "nth", "size", "best.key", "best.row").toDF("h", "nth", "size", "best", "best_row"), "exact-groups")
    alone = F.col("size").isNull()
    return light.join(groups, ["h", "nth"], "left").select(
        "row",
        "key",
        F.when(alone, F.col("key")).otherwise(F.col("best")).alias("keep_key"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        F.col("sha").alias("digest"),
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each normalised text, whatever its key.

    The rows are numbered in a table in the shared folder, and the decisions meet them by number.
    """
    (row,) = fresh(docs, "exact_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "exact-rows")
    kept = _decided(numbered, row, key, text, squeeze, F.md5, sha256).filter("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@query(
    "op7_exact_dedup",
    r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                     regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)""",
)
def op7_exact_dedup(spark, folder):
    done = exact_groups(load(spark, folder, "documents"))
    return done.select(
        "doc_id", F.col("keep_key").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256")
    )
