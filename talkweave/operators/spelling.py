"""Spelling: all near words by common deletions, and corrections by the nearest, then commonest, known word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TOKEN

#: words longer than this are compared by thirds, as their deletions grow with the square of the length
LONGEST = 24


def _drop_one(c: Column) -> Column:
    """All texts that lack one character of ``c``."""
    places = F.sequence(F.lit(1), F.length(c))
    short = F.transform(places, lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.when(F.length(c) > 0, F.array_distinct(short)).otherwise(F.array().cast("array<string>"))


def deletions(c: Column, distance: int) -> Column:
    """``c`` and what is left of it after up to ``distance`` deletions, each once."""
    found, last = F.array(c), F.array(c)
    for _ in range(distance):
        last = F.array_distinct(F.flatten(F.transform(last, _drop_one)))
        found = F.array_union(found, last)
    return found


def _by_deletions(words: DataFrame, distance: int) -> DataFrame:
    return words.filter(F.length("word") <= LONGEST + distance).select("word", F.explode(deletions(F.col("word"), distance)).alias("piece"))


def _thirds(words: DataFrame, distance: int, probes: bool) -> DataFrame:
    """Parts of long words: of two within ``distance``, one has an untouched part of the other at nearly the same place.

    The word of ``n`` characters is cut into ``distance`` + 1 parts. ``probes``: what such a part could be in this word if the other has a length near its own.
    """
    n, c = F.length("word"), F.col("word")
    parts = distance + 1
    long = words.filter(n > LONGEST)
    gaps = range(-distance, distance + 1) if probes else (0,)
    out = []
    for gap in gaps:
        size = n + gap
        for p in range(parts):
            start, stop = F.floor(size * p / parts), F.floor(size * (p + 1) / parts)
            for shift in gaps:
                cut = F.substring(c, (start + shift + 1).cast("int"), (stop - start).cast("int"))
                out.append(F.when((start + shift >= 0) & (stop + shift <= n), F.concat_ws(":", size.cast("string"), F.lit(p), cut)))
    return long.select("word", F.explode(F.array_distinct(F.array_compact(F.array(*out)))).alias("piece"))


def near_words(left: DataFrame, right: DataFrame, distance: int = 2) -> DataFrame:
    """(left, right, distance): all pairs of words from ``left(word)`` and ``right(word)`` at an edit distance of up to ``distance``.

    Two words that near have a text in common after as many deletions on either side, so both sides' deletions meet in one equi-join by
    hash, and the true distance decides. The join sorts and merges: the planner knows the size of the files, not how many pieces
    come of their words, and would broadcast them. Words over ``LONGEST`` characters meet by their parts instead.
    Each word counts once; NULL words are left out.
    """
    sides = []
    for side in (left, right):
        words = side.select("word").filter(F.col("word").isNotNull()).distinct()
        sides.append(words)
    a = _by_deletions(sides[0], distance).unionAll(_thirds(sides[0], distance, False))
    b = _by_deletions(sides[1], distance).unionAll(_thirds(sides[1], distance, True))
    a = a.select(F.xxhash64("piece").alias("at"), F.col("word").alias("left"))
    b = b.select(F.xxhash64("piece").alias("at"), F.col("word").alias("right"))
    met = a.join(b.hint("merge"), "at").filter(F.abs(F.length("left") - F.length("right")) <= distance).select("left", "right").distinct()
    far = F.levenshtein("left", "right", distance)
    return met.withColumn("distance", far).filter(F.col("distance") >= 0)


def reach(word: Column) -> Column:
    """How many edits a word may be away from the known one: none up to two characters, one up to four, else two."""
    n = F.length(word)
    return F.when(n <= 2, 0).when(n <= 4, 1).otherwise(2)


def corrections(words: DataFrame, known: DataFrame) -> DataFrame:
    """(word, replacement, distance): for each of ``words(word)`` that ``known(word, count)`` lacks, the nearest known word within its
    :func:`reach`; of several the commonest, then the first in the alphabet. Words without one are left out."""
    missing = words.select("word").filter(F.col("word").isNotNull()).distinct().join(known.select("word").hint("merge"), "word", "left_anti")
    pairs = near_words(missing, known, 2).filter(F.col("distance") <= reach(F.col("left")))
    ranked = pairs.join(known.select(F.col("word").alias("right"), F.col("count")).hint("merge"), "right")
    best = ranked.groupBy("left").agg(F.min(F.struct("distance", (-F.col("count")).alias("n"), F.col("right"))).alias("b"))
    return best.select(F.col("left").alias("word"), F.col("b.right").alias("replacement"), F.col("b.distance").alias("distance"))


def replace_words(df: DataFrame, key: str, text: str, table: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the tokens of ``text`` in lower case, joined by a blank, those in ``table(word, replacement)`` replaced.

    Only the distinct words of each text meet the table; what is replaced comes back as one small map per row. ``key`` must be unique. A NULL text stays NULL.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    words = df.select(F.col(key).alias("k"), F.explode(F.array_distinct(found)).alias("word"))
    hits = words.join(table.select("word", "replacement"), "word")
    maps = hits.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("word", "replacement"))).alias("m"))
    new = F.transform(found, lambda w: F.coalesce(F.try_element_at("m", w), w))
    joined = df.join(maps, F.col(key) == F.col("k"), "left")
    return joined.withColumn(out, F.array_join(F.when(F.col("m").isNull(), found).otherwise(new), " ")).drop("k", "m")
