"""Blocks over the whole order: text times, common beginnings, coarse first columns and ties."""

import random

import pytest
from pyspark.sql import functions as F

from talkweave.operators import blocks as B
from talkweave.operators import features as K
from talkweave.operators import ordered as O

ORDERS = {
    "text times": (["at"], "date_format(timestamp_seconds(1600000000 + id * 60), 'yyyy-MM-dd HH:mm:ss') AS at"),
    "common beginning": (["at"], "concat('https://example.org/books/', lpad(id, 7, '0')) AS at"),
    "coarse first column": (["day", "id"], "id % 3 AS day"),
    "number": (["at"], "id * id AS at"),
}


@pytest.mark.parametrize("name", ORDERS)
def test_blocks_are_balanced_and_in_order(spark, name):
    order, column = ORDERS[name]
    df = spark.range(20_000).selectExpr("id", column).repartition(6)
    cut = B.add_block(df, order, B.AUTO)
    sizes = cut.groupBy(B.BLOCK).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("z")).orderBy(B.BLOCK).collect()
    assert len(sizes) > 900 and max(r.n for r in sizes) < 100, len(sizes)
    assert all(x.z < y.a for x, y in zip(sizes, sizes[1:]))


def test_more_rows_ask_for_more_blocks(spark, monkeypatch):
    monkeypatch.setattr(B, "SAMPLE", 2_000)
    monkeypatch.setattr(B, "SPLITS", 4)
    monkeypatch.setattr(B, "BLOCK_ROWS", 500)
    for rows, least, most in ((100, 4, 4), (50_000, 80, 125)):
        cut = B.add_block(spark.range(rows), ["id"], B.AUTO)
        assert least <= cut.select(B.BLOCK).distinct().count() <= most


def test_nulls_ties_and_empty_tables(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(data, "x string, y int, id int")
    got = [r.row_id for r in O_rows(df).collect()]
    assert sorted(got) == list(range(1, 301))
    key = lambda r: (r.x is not None, r.x or "", r.y is not None, r.y or 0, r.id)
    placed = sorted(O_rows(df).collect(), key=lambda r: r.row_id)
    assert [r.id for r in placed] == [r.id for r in sorted(placed, key=key)]
    assert O_rows(df.limit(0)).count() == 0
    assert O_rows(df.limit(1)).first().row_id == 1


def O_rows(df):
    return B.row_position(df, [], ["x", "y", "id"], B.AUTO, "row_id")


def test_labels_with_a_common_beginning_are_ranked_in_blocks(spark):
    df = spark.range(3_000).select(F.concat(F.lit("Class of books number "), F.format_string("%05d", "id")).alias("label"))
    got = {r.label: r["index"] for r in K.label_index(df, "label").collect()}
    assert [got[k] for k in sorted(got)] == list(range(3_000))
    assert B.add_block(df.distinct(), ["label"], B.AUTO).select(B.BLOCK).distinct().count() > 900


def test_history_over_text_times(spark):
    df = spark.range(400).select("id", F.date_format(F.timestamp_seconds(F.col("id") * 37), "yyyy-MM-dd HH:mm:ss").alias("at"), F.concat(F.lit("t"), "id").alias("text"))
    got = {r.id: [h.text for h in r.history] for r in O.history(df.withColumn("s", F.lit(1)), "text", ["at"], ["s"], 3).collect()}
    assert got == {i: [f"t{j}" for j in range(max(0, i - 3), i)] for i in range(400)}
