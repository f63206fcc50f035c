"""Length of texts in word pieces: greedy longest match against a table of pieces, over distinct words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens


def pieces_of(words: DataFrame, pieces: DataFrame, longest: int = 20) -> DataFrame:
    """(word, pieces, known): the pieces of each distinct word of ``words(word)``.

    ``pieces(piece)`` holds beginnings of words as they are and later parts with ``##`` in front. From the left the longest piece that fits is taken;
    a word that cannot be cut this way is one unknown piece (``known`` false). Only the parts a word has are looked up, in one equi-join; the longest
    match at each place and the walk along them are row-local. Pieces over ``longest`` characters never match.
    """
    distinct = words.select("word").filter(F.length("word") > 0).distinct()
    n = F.length("word")
    starts = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(longest), n - i + 1)),
            lambda m: F.struct(i.alias("at"), m.alias("size"), F.concat(F.when(i > 1, "##").otherwise(""), F.substring("word", i, m)).alias("piece")),
        ),
    )
    spans = distinct.select("word", F.inline(F.flatten(starts)))
    known = pieces.select("piece").filter(F.length("piece") > 0).distinct()
    best = spans.join(known, "piece").groupBy("word", "at").agg(F.max("size").alias("size"))
    steps = best.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("at", "size"))).alias("steps"))
    met = distinct.join(steps, "word", "left")

    def walk(state, _):
        size = F.coalesce(F.try_element_at("steps", state["at"]), F.lit(0))
        piece = F.concat(F.when(state["at"] > 1, "##").otherwise(""), F.substring("word", state["at"], size))
        on = (state["at"] <= F.length("word")) & (size > 0)
        return F.struct(
            F.when(on, state["at"] + size).otherwise(state["at"]).alias("at"),
            F.when(on, F.concat(state["found"], F.array(piece))).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("found"))
    done = met.withColumn("done", F.aggregate(F.sequence(F.lit(1), n), start, walk))
    fits = F.col("done.at") > n
    return done.select("word", F.when(fits, F.col("done.found")).otherwise(F.array(F.lit("[UNK]"))).alias("pieces"), fits.alias("known"))


def piece_lengths(df: DataFrame, key: str, text: str, pieces: DataFrame, out: str = "n_pieces") -> DataFrame:
    """(key, ``out``): how many pieces each text has; distinct words are cut once for the whole table. ``key`` must be unique; a text without words has 0."""
    rows = df.select(F.col(key).alias("k"), F.explode_outer(tokens(F.lower(text))).alias("word"))
    counts = rows.groupBy("k", "word").agg(F.count(F.lit(1)).alias("n"))
    sizes = pieces_of(counts, pieces).select("word", F.size("pieces").alias("size"))
    return counts.join(sizes, "word", "left").groupBy("k").agg(F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0)).alias(out)).withColumnRenamed("k", key)


def common_pieces(df: DataFrame, text: str, least: int = 20, longest: int = 4) -> DataFrame:
    """(piece): a plain vocabulary from a table itself: every character that occurs, and parts of up to ``longest`` characters that ``least`` words hold."""
    words = df.select(F.explode(tokens(F.lower(text))).alias("word")).distinct()
    n = F.length("word")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(longest), n - i + 1)),
                lambda m: F.concat(F.when(i > 1, "##").otherwise(""), F.substring("word", i, m)),
            ),
        )
    )
    held = words.select(F.explode(F.array_distinct(spans)).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    single = F.length(F.regexp_replace("piece", "^##", "")) == 1
    return held.filter(single | (F.col("n") >= least)).select("piece")
