"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, fresh, load, without, written
from .registry import query


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled(order: Column, weights: tuple[float, ...]) -> Column:
    """``weights`` repeating along a rank that starts at 0."""
    return F.get(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights)).cast("int"))


def source_targets(sizes: DataFrame, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words to take from each source: ``sizes`` (source, size, weight) with ``target`` and ``rate``.

    The sources share ``budget`` times all words by weight; none gives more than ``most`` times its
    own, and what it cannot give is shared again among the others. With share = level x weight that is the
    level at which the capped shares sum to the budget. Source i is full when the sources that fill up
    earlier, plus everyone else at i's own filling level, still stay within the budget: one running sum in the order
    of filling levels, no repeated rounds. The windows run over one row per source, not over documents.
    A source without words has target and rate 0. No weight may be zero or negative.
    """
    everything = Window.partitionBy()
    earlier = Window.orderBy("fills").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sizes.withColumn("cap", most * F.col("size")).withColumn("fills", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("total", budget * F.sum("size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    taken = F.sum("cap").over(earlier) + F.col("fills") * (F.col("weights") - F.sum("weight").over(earlier))
    rows = rows.withColumn("full", taken <= F.col("total"))
    full = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    rows = rows.withColumn("level", (F.col("total") - full) / open_weight)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    rows = rows.withColumn("target", target)
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    return rows.select("source", "size", "weight", "target", rate.alias("rate"))


def draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from md5 of the seed and ``parts``: the same on every run, engine and partitioning."""
    word = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(word), 1, 12), 16, 10).cast("long") / F.lit(float(2**48))


def mix_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    budget: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` (how often the mix takes each row).

    Sources in code point order, null last, take ``weights`` in turn. A row is taken floor(rate) times, and once more
    with a probability equal to the fraction, drawn by its key and text. Words are summed per task before they are shuffled, so a
    source that holds most rows is one row per task. The totals, one row per source, are a small table in the
    shared folder: documents are joined where they are read, or by a sorted join with split skew if
    the sources are too many to broadcast.

    Columns of ``docs`` with those five names (in any case) are replaced. Null or empty texts have size 0 and
    are drawn like others. Rows repeated with key and text share one draw. An empty table gives an empty table.
    """
    docs = without(docs, "size", "source_size", "target", "rate", "copies")
    size, name, order = fresh(docs, "size", "mix_source", "mix_order")
    sized = docs.withColumn(size, word_count(F.col(f"`{text}`")))
    totals = sized.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).alias("size"))
    ranked = totals.withColumn(order, F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.select("source", "size", cycled(F.col(order), weights).alias("weight"))
    plan = written(source_targets(ranked, budget, most), "mix-sources")
    plan = plan.select(F.col("source").alias(name), F.col("size").alias("source_size"), "target", "rate")
    joined = sized.join(plan, F.col(f"`{source}`").eqNullSafe(F.col(name)), "left").drop(name)
    whole = F.floor("rate")
    luck = draw(seed, F.col(f"`{key}`"), F.md5(F.col(f"`{text}`")))
    copies = whole + (luck < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", copies)


def emitted(taken: DataFrame, dropped: bool = False) -> DataFrame:
    """Each row of ``taken`` ``copies`` times, with ``mix_copy`` from 1; with ``dropped`` also, once and with a NULL there, those that are taken 0 times."""
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return taken.withColumn("mix_copy", F.explode_outer(numbers) if dropped else F.explode(numbers))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as :func:`mix_copies` takes it, with all of ``docs``' own columns."""
    # by number: no column of ``docs`` meets one of mix_copies' own
    names = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    own = [names[c.lower()] for c in (key, source, text)]
    taken = mix_copies(docs.toDF(*names.values()), key=own[0], source=own[1], text=own[2], **options)
    return emitted(taken).select(*names.values()).toDF(*docs.columns)


@query(
    "op1_mixing",
    r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          coalesce(md5(text), '') AS digest FROM documents),
        s AS (SELECT source, sum(size)::DOUBLE AS size,
                     [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
              FROM d GROUP BY source),
        f AS (SELECT *, 2.0 * size AS cap, 2.0 * size / weight AS fills, 1.5 * sum(size) OVER () AS total FROM s),
        g AS (SELECT a.*, (SELECT sum(least(b.cap, a.fills * b.weight)) FROM f b) <= total * (1 + 1e-12) AS is_full FROM f a),
        t AS (SELECT source, size, CASE WHEN is_full THEN cap ELSE weight *
                (total - coalesce((SELECT sum(cap) FROM g WHERE is_full), 0)) / (SELECT sum(weight) FROM g WHERE NOT is_full) END AS target
              FROM g),
        r AS (SELECT d.doc_id, d.size, t.size::BIGINT AS source_size, t.target,
                     CASE WHEN t.size > 0 THEN t.target / t.size ELSE 0 END AS rate,
                     ('0x' || substr(md5('17:' || d.doc_id::VARCHAR || ':' || d.digest), 1, 12))::BIGINT / 281474976710656.0 AS u
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM r""",
)
def op1_mixing(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "source", "text")
    copies = emitted(mix_copies(docs).withColumn("row", F.monotonically_increasing_id()), dropped=True)
    words = F.when(F.col("mix_copy").isNull(), 0).otherwise(word_count(F.col("text"))).alias("words")
    kept = ["doc_id", "size", "source_size", "target"]
    done = copies.select("row", *kept, words).groupBy("row", *kept).agg(F.sum("words").alias("taken"))
    return done.select(*kept, "taken")
