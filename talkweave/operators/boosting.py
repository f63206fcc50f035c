"""Boosted trees with one objective over all classes: features in bins, one aggregate of gradients per level."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import as_class
from ..session import written


@dataclass
class Tree:
    """One class's tree of a round: node i has the children 2i + 1 (bin <= ``bin``) and 2i + 2; ``feature`` is -1 in a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    gain: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node each row has reached after ``depth`` levels."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = self.feature[node]
            node = np.where(f >= 0, 2 * node + 1 + (bins[rows, np.maximum(f, 0)] > self.bin[node]), node)
        return node


@dataclass
class Boosted:
    classes: list[str]
    names: list[str]
    cuts: list[np.ndarray]
    depth: int
    rate: float
    rounds: list[list[Tree]] = field(default_factory=list)

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), len(self.classes)))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += self.rate * tree.value[tree.nodes(bins, self.depth)]
        return out

    def bins(self, values: np.ndarray) -> np.ndarray:
        """How many cuts of its feature each value has reached; a missing value is below all."""
        out = np.empty(values.shape, np.uint8)
        for i, cuts in enumerate(self.cuts):
            out[:, i] = np.where(np.isnan(values[:, i]), 0, np.searchsorted(cuts, values[:, i], "right"))
        return out


def shares(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def values_of(df: DataFrame, features: str | None, extra: Sequence[str]) -> Column:
    """All features of a row in one array: the elements of ``features``, then the columns ``extra``."""
    more = F.array(*[F.col(c).cast("double") for c in extra]) if extra else F.array().cast("array<double>")
    return F.concat(F.col(features).cast("array<double>"), more) if features else more


def quantile_cuts(rows: DataFrame, bins: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """Cuts of each feature between its quantiles, over all rows: one aggregate, as many rows as features."""
    places = rows.select(F.posexplode("x").alias("place", "v"))
    points = F.percentile_approx("v", F.array(*[F.lit(i / bins) for i in range(1, bins)]), F.lit(accuracy))
    found = places.groupBy("place").agg(points.alias("cuts")).orderBy("place").toPandas()
    return [np.unique(np.asarray([c for c in (cuts if cuts is not None else []) if c is not None], float)) for cuts in found["cuts"]]


def best_splits(g: np.ndarray, h: np.ndarray, smooth: float, least: float) -> tuple[np.ndarray, ...]:
    """Of each node, the split of most gain by its histograms (node, feature, bin): feature (-1: none), bin, gain, and both sides' values.

    Gains that agree to nine digits count as equal: the first feature, then the lowest bin, wins.
    """
    gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
    total_g, total_h = gl[:, :, -1:], hl[:, :, -1:]
    gr, hr = total_g - gl, total_h - hl
    part = lambda x, y: x * x / (y + smooth)
    gain = (part(gl, hl) + part(gr, hr) - part(total_g, total_h)) / 2
    gain = np.where((hl >= least) & (hr >= least), np.round(gain, 9), -np.inf)[:, :, :-1].reshape(len(g), -1)
    at = gain.argmax(axis=1)
    top = gain[np.arange(len(g)), at]
    feature, bin_ = np.divmod(at, max(1, g.shape[2] - 1))
    side = lambda x, y: -x[np.arange(len(g)), feature, bin_] / (y[np.arange(len(g)), feature, bin_] + smooth)
    return np.where(top > 0, feature, -1), bin_, top, side(gl, hl), side(gr, hr)


def boost(
    df: DataFrame,
    label: str,
    features: str | None = None,
    extra: Sequence[str] = (),
    rounds: int = 10,
    depth: int = 3,
    rate: float = 0.3,
    smooth: float = 1.0,
    least: float = 1.0,
    bins: int = 32,
    cuts: Sequence[Sequence[float]] | None = None,
    most: int = 1_000,
) -> Boosted:
    """Fit trees to the softmax over all classes of ``label``: each round grows one tree per class from the same shares.

    Features are cut into at most ``bins`` at quantiles of all rows (or at the ``cuts`` given), once, and kept as bytes in the shared folder. Each
    level of a round is one pass: tasks add up gradients and curvatures by class, node, feature and bin, Spark adds up
    the tasks, and the best split of each node comes from that table, whose size depends on the model alone. Rows with a missing feature go with the
    lowest bin; a missing label is a class. More than ``most`` classes are an error; no rows are one too.
    """
    if bins > 256:
        raise ValueError("a bin is a byte")
    rows = df.select(as_class(label).alias("y"), values_of(df, features, extra).alias("x"))
    classes = sorted(r[0] for r in rows.select("y").distinct().limit(most + 1).collect())
    if not 0 < len(classes) <= most:
        raise ValueError(f"{len(classes)} classes")
    cuts = [np.asarray(c, float) for c in cuts] if cuts is not None else quantile_cuts(rows, bins)
    width = len(cuts) - len(extra)
    names = [f"{features}_{i}" for i in range(width)] + list(extra)
    model = Boosted(classes, names, cuts, depth, rate)
    wide = max(len(c) for c in cuts) + 1
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("y")) - 1

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                found = model.bins(np.array([[np.nan if v is None else v for v in x] for x in batch["x"]], float))
                yield pd.DataFrame({"y": batch["y"], "bins": [b.tobytes() for b in found]})

    table = written(rows.select(number.cast("int").alias("y"), "x").mapInPandas(binned, "y int, bins binary"), "boosting")
    k, f = len(classes), len(cuts)

    for _ in range(rounds):
        size = 2 ** (depth + 1) - 1
        trees = [Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)) for _ in classes]
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            shape = (k, width, f, wide)

            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = np.zeros((2, int(np.prod(shape))))
                for batch in batches:
                    n = batch.num_rows
                    if not n:
                        continue
                    data = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, f)
                    p = shares(model.scores(data))
                    p_own = np.zeros((n, k))
                    p_own[np.arange(n), batch.column(0).to_numpy()] = 1
                    place = np.arange(f) * wide + data
                    for c, tree in enumerate(trees):
                        node = tree.nodes(data, level) - first
                        live = node >= 0
                        at = ((c * width + node[live])[:, None] * f * wide + place[live]).ravel()
                        for i, values in enumerate((p[:, c] - p_own[:, c], p[:, c] * (1 - p[:, c]))):
                            total[i] += np.bincount(at, np.repeat(values[live], f), total.shape[1])
                some = np.flatnonzero(total[1])
                yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(t[some]) for t in total]], names=["at", "g", "h"])

            sums = table.mapInArrow(add, "at long, g double, h double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
            g, h = np.zeros(int(np.prod(shape))), np.zeros(int(np.prod(shape)))
            g[sums["at"]], h[sums["at"]] = sums["g"], sums["h"]
            for c, tree in enumerate(trees):
                chosen = best_splits(g.reshape(shape)[c], h.reshape(shape)[c], smooth, least)
                for i, (feature, bin_, gain, left, right) in enumerate(zip(*chosen)):
                    node = first + i
                    if feature >= 0:
                        tree.feature[node], tree.bin[node], tree.gain[node] = feature, bin_, gain
                        tree.value[2 * node + 1], tree.value[2 * node + 2] = left, right
        model.rounds.append(trees)
    return model


def predict_boosted(model: Boosted, df: DataFrame, features: str | None = None, extra: Sequence[str] = (), out: str = "predicted") -> DataFrame:
    """``df`` with the class of the highest score; the first of equals."""

    @F.pandas_udf("string")
    def best(values: pd.Series) -> pd.Series:
        found = model.bins(np.array([[np.nan if v is None else v for v in x] for x in values], float).reshape(len(values), -1))
        return pd.Series([model.classes[i] for i in model.scores(found).argmax(axis=1)])

    return df.withColumn(out, best(values_of(df, features, extra)))


def splits_of(model: Boosted, spark) -> DataFrame:
    """(round, class, node, feature, bin, gain): every split of the model."""
    rows = [
        (r, model.classes[c], int(i), model.names[tree.feature[i]], int(tree.bin[i]), float(tree.gain[i]))
        for r, trees in enumerate(model.rounds)
        for c, tree in enumerate(trees)
        for i in np.flatnonzero(tree.feature >= 0)
    ]
    return spark.createDataFrame(rows, "round int, class string, node int, feature string, bin int, gain double")


def gains(model: Boosted, spark) -> DataFrame:
    """(feature, gain, share): what each feature's splits gained; features never used are left out."""
    total = splits_of(model, spark).groupBy("feature").agg(F.sum("gain").alias("gain"))
    return total.withColumn("share", F.col("gain") / total.agg(F.sum("gain")).scalar())
