"""Votes weighted by what raters get right: responsibilities and confusion counts in turn."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def rater_model(votes: DataFrame, key: str = "key", rater: str = "rater", label: str = "label", rounds: int = 100, close: float = 1e-9, smooth: float = 0.01, most: int = 100_000) -> tuple[pd.DataFrame, pd.DataFrame, list[str], int]:
    """Fit class shares and each rater's confusion table to ``votes(key, rater, label)`` without knowing the true labels.

    Votes first become patterns: rows on which the same raters gave the same labels are one row with a number, so a round works on patterns, not on rows. It
    starts from the share of votes each label has in a pattern. A round adds up, per (true class, rater, given label), the patterns' responsibilities
    (one aggregate), and computes them anew; it stops when the log likelihood grows by less than ``close`` of itself. What the driver holds is
    classes and raters in size; more than ``most`` entries are an error. NULL votes count as none. Returns (shares, confusion, classes, rounds done).
    """
    given = votes.filter(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(rater).cast("string").alias("r"), F.col(label).cast("string").alias("l"))
    per_row = given.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("r", "l"))).alias("votes"))
    patterns = written(per_row.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "rater-patterns")
    seen = patterns.select(F.explode("votes").alias("v")).select("v.r", "v.l").distinct().limit(most + 1).toPandas()
    classes, raters = sorted(set(seen["l"])), sorted(set(seen["r"]))
    if not classes or len(classes) ** 2 * len(raters) > most:
        raise ValueError(f"{len(classes)} classes and {len(raters)} raters")
    shape = (len(classes), len(raters), len(classes))
    at_class, at_rater = {c: i for i, c in enumerate(classes)}, {r: i for i, r in enumerate(raters)}
    shares = confusion = None

    def expected(batches):
        """Per task: sums of responsibilities by class, and by class, rater and given label, with the log likelihood."""
        prior, sums, likely = np.zeros(len(classes)), np.zeros(shape), 0.0
        for batch in batches:
            for found, n in zip(batch["votes"], batch["n"]):
                pairs = [(at_rater[v["r"]], at_class[v["l"]]) for v in found]
                if shares is None:
                    own = np.bincount([c for _, c in pairs], minlength=len(classes)).astype(float)
                    own /= own.sum()
                else:
                    logs = np.log(shares) + sum(np.log(confusion[:, r, c]) for r, c in pairs)
                    top = logs.max()
                    own = np.exp(logs - top)
                    likely += n * (top + np.log(own.sum()))
                    own /= own.sum()
                prior += n * own
                for r, c in pairs:
                    sums[:, r, c] += n * own
        values = np.concatenate([[likely], prior, sums.ravel()])
        yield pd.DataFrame({"at": np.arange(len(values)), "v": values})

    last, done = None, 0
    for done in range(1, rounds + 1):
        total = patterns.mapInPandas(expected, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").toPandas()["v"].to_numpy()
        likely, prior, sums = total[0], total[1 : 1 + len(classes)], total[1 + len(classes) :].reshape(shape)
        shares = prior / prior.sum()
        confusion = (sums + smooth) / (sums + smooth).sum(axis=2, keepdims=True)
        if last is not None and likely - last <= close * abs(last):
            break
        last = likely if done > 1 else None
    table = pd.DataFrame([(classes[i], raters[r], classes[j], float(confusion[i, r, j])) for i in range(shape[0]) for r in range(shape[1]) for j in range(shape[2])], columns=["label", "rater", "given", "share"])
    return pd.DataFrame({"label": classes, "share": shares}), table, classes, done


def weighted_vote(votes: DataFrame, model: tuple, key: str = "key", rater: str = "rater", label: str = "label") -> DataFrame:
    """(key, label, share): of each key the class that its votes make likeliest under ``model``, and how likely; the first in the alphabet on ties.

    The model is as large as classes squared times raters and comes to the votes as a literal table; votes are added up per key and class. Keys without a vote are left out.
    """
    shares, confusion, _, _ = model
    spark = votes.sparkSession
    given = votes.filter(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(rater).cast("string").alias("r"), F.col(label).cast("string").alias("g"))
    weights = confusion.groupby(["rater", "given"], sort=False)[["label", "share"]].apply(lambda g: [(a, float(np.log(b))) for a, b in zip(g["label"], g["share"])])
    table = spark.createDataFrame([(r, g, w) for (r, g), w in weights.items()], "r string, g string, w array<struct<c: string, v: double>>")
    logs = given.join(table, ["r", "g"]).select("k", F.inline("w")).groupBy("k", "c").agg(F.sum("v").alias("v"))
    prior = spark.createDataFrame([(c, float(np.log(max(s, 1e-300)))) for c, s in zip(shares["label"], shares["share"])], "c string, p double")
    ready = logs.join(prior, "c").withColumn("v", F.round(F.col("v") + F.col("p"), 9))
    best = ready.groupBy("k").agg(F.min(F.struct((-F.col("v")).alias("v"), F.col("c"))).alias("b"), F.collect_list("v").alias("all"))
    total = F.aggregate("all", F.lit(0.0), lambda s, x: s + F.exp(x + F.col("b.v")))
    return best.select(F.col("k").alias(key), F.col("b.c").alias(label), (1 / total).alias("share"))
