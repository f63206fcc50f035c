"""Transport between the labels of two sets: each label a Gaussian, each pair of labels a cost, masses moved at least cost."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import as_class


@dataclass
class Gaussian:
    label: str
    n: float
    mean: np.ndarray
    cov: np.ndarray


def label_moments(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, moments): number, sum and sum of outer products of each label's vectors in one array; mergeable.

    Tasks add up their rows per label, Spark adds up the tasks' arrays: what moves is as large as labels times dimensions squared. NULL vectors are left out.
    """
    rows = df.filter(F.col(vector).isNotNull()).select(as_class(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, group in batch.groupby("label"):
                m = np.stack(group["v"].to_numpy())
                own = np.concatenate([[len(m)], m.sum(axis=0), (m.T @ m).ravel()])
                total[name] = total[name] + own if name in total else own
        if total:  # a task without rows has nothing to say: an empty frame has no arrays to tell their type by
            yield pd.DataFrame({"label": list(total), "v": list(total.values())})

    parts = rows.mapInPandas(add, "label string, v array<double>")
    return parts.groupBy("label").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("moments"))


def gaussians(df: DataFrame, label: str, vector: str, most: int = 1_000) -> list[Gaussian]:
    """Mean and covariance of each label, in the order of the labels. One small array per label comes to the driver; more than ``most`` labels are an error."""
    found = label_moments(df, label, vector).limit(most + 1).toPandas()
    if len(found) > most:
        raise ValueError(f"more than {most} labels")
    out = []
    for name, values in sorted(zip(found["label"], found["moments"])):
        v = np.asarray(values, np.float64)
        dim = int(np.sqrt(len(v) - 0.75) - 0.5)
        n, mean = v[0], v[1 : dim + 1] / v[0]
        out.append(Gaussian(name, n, mean, v[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean)))
    return out


def root(m: np.ndarray) -> np.ndarray:
    """The square root of a symmetric matrix without negative directions."""
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    return (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T


def gaussian_cost(a: Gaussian, b: Gaussian) -> float:
    """The squared transport distance between two Gaussians: of the means, and of the covariances."""
    side = root(a.cov)
    cross = root(side @ b.cov @ side)
    gap = a.mean - b.mean
    return float(max(0.0, gap @ gap + np.trace(a.cov) + np.trace(b.cov) - 2 * np.trace(cross)))


def _high(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def scaled_plan(cost: np.ndarray, p: np.ndarray, q: np.ndarray, entropy: float, close: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """The plan from ``p`` to ``q`` of least cost plus ``entropy`` times the mean cost: rows and columns scaled in turn until both sums hold.

    Where labels hardly exchange mass, scaling in turn takes ever smaller steps; every hundred rounds Newton's method is tried on the same plan.
    """
    weight = entropy * cost.mean() if cost.mean() > 0 else 1.0
    kernel = -cost / weight
    f, g = np.zeros(len(p)), np.zeros(len(q))
    for i in range(rounds):
        f = np.log(p) - _high(kernel + g[None, :], 1)
        g = np.log(q) - _high(kernel + f[:, None], 0)
        plan = np.exp(kernel + f[:, None] + g[None, :])
        if np.abs(plan.sum(axis=1) - p).max() < close:
            return plan
        if i % 100 == 99 and (solved := _newton(kernel, f, p, q, close)) is not None:
            return solved
    raise RuntimeError(f"the plan did not settle in {rounds} rounds")


def _newton(kernel: np.ndarray, f: np.ndarray, p: np.ndarray, q: np.ndarray, close: float, steps: int = 50) -> np.ndarray | None:
    """The plan of :func:`scaled_plan` from row scales ``f``, columns scaled exactly at each step; None if it does not settle."""

    def at(f):
        g = np.log(q) - _high(kernel + f[:, None], 0)
        plan = np.exp(kernel + f[:, None] + g[None, :])
        return plan, p - plan.sum(axis=1), f @ p + g @ q

    plan, gap, gain = at(f)
    for _ in range(steps):
        if np.abs(gap).max() < close:
            return plan
        flow = (plan / q) @ plan.T  # how the rows' sums hang together through the columns
        np.fill_diagonal(flow, 0.0)
        slope = np.diag(flow.sum(axis=1)) - flow
        try:  # one scale is free
            step = np.append(np.linalg.solve(slope[:-1, :-1], gap[:-1]), 0.0)
        except np.linalg.LinAlgError:
            return None
        for _ in range(40):
            tried = at(f + step)
            if np.abs(tried[1]).max() < np.abs(gap).max() or tried[2] > gain:
                break
            step = step / 2
        else:
            return None
        f, (plan, gap, gain) = f + step, tried
    return None


def label_transport(a: DataFrame, b: DataFrame, label: str, vector: str, entropy: float = 0.1) -> DataFrame:
    """(label_a, label_b, cost, share): what each label of ``a`` gives to each of ``b``, and at what cost.

    A label's mass is its share of the rows; the cost is the closed form between the labels' Gaussians. No pair of rows is formed: after two passes
    over the data everything is a table of labels by labels. An empty side gives no rows.
    """
    left, right = gaussians(a, label, vector), gaussians(b, label, vector)
    rows = []
    if left and right:
        cost = np.array([[gaussian_cost(x, y) for y in right] for x in left])
        p, q = (np.array([x.n for x in side]) / sum(x.n for x in side) for side in (left, right))
        plan = scaled_plan(cost, p, q, entropy)
        rows = [(x.label, y.label, float(cost[i, j]), float(plan[i, j])) for i, x in enumerate(left) for j, y in enumerate(right)]
    return a.sparkSession.createDataFrame(rows, "label_a string, label_b string, cost double, share double")


def transport_distance(moved: DataFrame) -> DataFrame:
    """One row: the cost of the whole plan of :func:`label_transport`."""
    return moved.agg(F.sum(F.col("cost") * F.col("share")).alias("distance"))
