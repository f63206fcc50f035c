"""Word stems: a cascade of suffix rules over the distinct words of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words as word_array

VOWEL, CONSONANT = "(?:[aeiou]|(?<=[^aeiou])y)", "(?:[^aeiouy]|(?<![^aeiou])y)"
#: fixed values: suffixes and what replaces them where the rest is long enough, by step
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
DOUBLE = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
]
SINGLE = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
LAST = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def measure(stem: Column) -> Column:
    """How many runs of vowels are followed by a run of consonants."""
    runs = F.regexp_replace(F.regexp_replace(stem, rf"{VOWEL}+", "V"), "[^V]+", "C")
    return F.length(runs) - F.length(F.replace(runs, F.lit("VC"), F.lit("V")))


def _first(word: Column, rules: list, allowed) -> Column:
    """The first rule whose suffix the word has; its replacement if ``allowed(stem, suffix)``, else the word as it is."""
    out = word
    for suffix, new in reversed(sorted(rules, key=lambda r: -len(r[0]))):
        stem = F.substring(word, F.lit(1), F.length(word) - len(suffix))
        out = F.when(word.endswith(suffix), F.when(allowed(stem, suffix), F.concat(stem, F.lit(new))).otherwise(word)).otherwise(out)
    return out


def _ends_short(stem: Column) -> Column:
    """Consonant, vowel, consonant at the end, the last none of w, x and y."""
    return stem.rlike(rf"{CONSONANT}{VOWEL}[^aeiouwxy]\z")


def stem_steps() -> list:
    """The cascade, one function of a column per step."""
    has_vowel = lambda s: s.rlike(VOWEL)
    cut = lambda w, n: F.substring(w, F.lit(1), F.length(w) - n)

    def plural(w: Column) -> Column:
        return _first(w, PLURALS, lambda s, x: F.lit(True))

    def participle(w: Column) -> Column:
        eed = F.when(measure(cut(w, 3)) > 0, cut(w, 1)).otherwise(w)
        ed = w.endswith("ed") & has_vowel(cut(w, 2))
        ing = w.endswith("ing") & has_vowel(cut(w, 3))
        return F.when(w.endswith("eed"), eed).when(ed, F.concat(cut(w, 2), F.lit("\x00"))).when(ing, F.concat(cut(w, 3), F.lit("\x00"))).otherwise(w)

    def repair(w: Column) -> Column:
        s = cut(w, 1)
        fixed = (
            F.when(s.rlike("(?:at|bl|iz)\\z"), F.concat(s, F.lit("e")))
            .when(s.rlike(r"([^aeioulsz])\1\z"), cut(s, 1))
            .when((measure(s) == 1) & _ends_short(s), F.concat(s, F.lit("e")))
            .otherwise(s)
        )
        return F.when(w.endswith("\x00"), fixed).otherwise(w)

    def final_y(w: Column) -> Column:
        return F.when(w.endswith("y") & has_vowel(cut(w, 1)), F.concat(cut(w, 1), F.lit("i"))).otherwise(w)

    def longer(rules: list, least: int):
        def step(w: Column) -> Column:
            return _first(w, rules, lambda s, x: (measure(s) > least) & (s.rlike("[st]\\z") if x == "ion" else F.lit(True)))

        return step

    def final_e(w: Column) -> Column:
        s = cut(w, 1)
        return F.when(w.endswith("e") & ((measure(s) > 1) | ((measure(s) == 1) & ~_ends_short(s))), s).otherwise(w)

    def final_l(w: Column) -> Column:
        return F.when(w.endswith("ll") & (measure(cut(w, 1)) > 1), cut(w, 1)).otherwise(w)

    return [plural, participle, repair, final_y, longer(DOUBLE, 0), longer(SINGLE, 0), longer([(x, "") for x in LAST], 1), final_e, final_l]


def stems(words: DataFrame) -> DataFrame:
    """(word, stem) of the distinct ``words(word)``; only words of three or more letters a to z are changed.

    Each step is a projection of its own, so its input is computed once.
    """
    out = words.select("word").filter(F.col("word").isNotNull()).distinct().withColumn("stem", F.col("word"))
    fits = F.col("word").rlike(r"\A[a-z]{3,}\z")
    for step in stem_steps():
        out = out.withColumn("stem", F.when(fits, step(F.col("stem"))).otherwise(F.col("stem")))
    return out


def stemmed_counts(df: DataFrame, text: str) -> DataFrame:
    """(stem, words, count): how often each stem occurs in all texts, and in how many different words. Words are counted before they are stemmed."""
    counts = df.select(F.explode(word_array(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(stems(counts), "word").groupBy("stem").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("count"))
