"""Boosted trees and label transport against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.operators import boosting as B
from talkweave.operators import rater_weights as W
from talkweave.operators import transport as T


def fixture(n=150, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = np.where(x[:, 0] + 0.3 * x[:, 1] > 0.5, "b", np.where(x[:, 2] > 0, "c", "a"))
    return x, y


def plain_trees(x, y, cuts, rounds, depth, rate, smooth, least):
    """One row and one split at a time."""
    classes = sorted(set(y))
    scores = [[0.0] * len(classes) for _ in y]
    out = []
    for _ in range(rounds):
        p = [[math.exp(s - max(row)) for s in row] for row in scores]
        p = [[v / sum(row) for v in row] for row in p]
        trees = []
        for c, name in enumerate(classes):
            g = [p[i][c] - (y[i] == name) for i in range(len(y))]
            h = [p[i][c] * (1 - p[i][c]) for i in range(len(y))]
            splits, values = {}, {}

            def grow(node, rows, level):
                if level == depth:
                    return
                total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
                best = None
                for f, own in enumerate(cuts):
                    for b, cut in enumerate(own):
                        left = [i for i in rows if x[i][f] < cut]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        gr, hr = total_g - gl, total_h - hl
                        if hl < least or hr < least:
                            continue
                        gain = round((gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - total_g**2 / (total_h + smooth)) / 2, 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, f, b, -gl / (hl + smooth), -gr / (hr + smooth))
                if best:
                    gain, f, b, lv, rv = best
                    splits[node] = (f, b, gain)
                    values[2 * node + 1], values[2 * node + 2] = lv, rv
                    grow(2 * node + 1, [i for i in rows if x[i][f] < cuts[f][b]], level + 1)
                    grow(2 * node + 2, [i for i in rows if x[i][f] >= cuts[f][b]], level + 1)

            grow(0, range(len(y)), 0)
            trees.append((splits, values))
        for i in range(len(y)):
            for c, (splits, values) in enumerate(trees):
                node = 0
                while node in splits:
                    node = 2 * node + 1 + (x[i][splits[node][0]] >= cuts[splits[node][0]][splits[node][1]])
                scores[i][c] += rate * values.get(node, 0.0)
        out.append(trees)
    return out, [classes[int(np.argmax(s))] for s in scores]


def test_trees_equal_plain_ones(spark):
    x, y = fixture()
    cuts = [[-1.005, -0.505, -0.005, 0.495, 1.005]] * 3
    want, predicted = plain_trees(x.tolist(), y.tolist(), cuts, 3, 3, 0.3, 1.0, 1.0)
    df = spark.createDataFrame([(int(i), str(k), [float(v) for v in row[:2]], float(row[2])) for i, (k, row) in enumerate(zip(y, x))], "id int, y string, v array<double>, z double")
    model = B.boost(df.repartition(5), "y", "v", ["z"], rounds=3, depth=3, cuts=cuts)
    got = {(r["round"], r["class"], r.node): (r.feature, r.bin, r.gain) for r in B.splits_of(model, spark).collect()}
    names = ["v_0", "v_1", "z"]
    expected = {(r, model.classes[c], node): (names[f], b, pytest.approx(gain, abs=1e-6)) for r, trees in enumerate(want) for c, (splits, _) in enumerate(trees) for node, (f, b, gain) in splits.items()}
    assert got == expected and len(got) > 20
    done = {r.id: r.predicted for r in B.predict_boosted(model, df, "v", ["z"]).collect()}
    assert [done[i] for i in range(len(y))] == predicted
    assert sum(a == b for a, b in zip(predicted, y)) > 0.85 * len(y)
    used = {r.feature: r.share for r in B.gains(model, spark).collect()}
    assert sum(used.values()) == pytest.approx(1) and max(used, key=used.get) in ("v_0", "z")


def test_quantile_cuts_missing_values_and_one_class(spark):
    df = spark.createDataFrame([(i % 2, float(i) if i % 5 else None, 1.0) for i in range(100)], "y int, a double, same double")
    model = B.boost(df, "y", None, ["a", "same"], rounds=1, depth=2, bins=4)
    assert [len(c) for c in model.cuts] == [3, 1]
    assert B.predict_boosted(model, df, None, ["a", "same"]).count() == 100
    alone = B.boost(df.filter("y = 0"), "y", None, ["a"], rounds=2)
    assert B.splits_of(alone, spark).count() == 0
    assert {r[0] for r in B.predict_boosted(alone, df, None, ["a"]).select("predicted").collect()} == {"0"}
    with pytest.raises(ValueError):
        B.boost(df.limit(0), "y", None, ["a"])


def sets(seed=2):
    rng = np.random.default_rng(seed)
    side = lambda labels, shift: [(name, (rng.normal(size=4) * (1 + i) + shift * i).tolist()) for i, name in enumerate(labels) for _ in range(30 + 20 * i)]
    return side(["a", "b", None], 1.0), side(["b", "c"], 2.0)


def plain_transport(a, b, entropy):
    def tables(rows):
        names = sorted({str(n) for n, _ in rows})
        return [(n, np.array([v for m, v in rows if str(m) == n])) for n in names]

    def power(m):
        values, vectors = np.linalg.eigh(m)
        return vectors @ np.diag(np.sqrt(np.clip(values, 0, None))) @ vectors.T

    left, right = tables(a), tables(b)
    cost = np.zeros((len(left), len(right)))
    for i, (_, x) in enumerate(left):
        for j, (_, y) in enumerate(right):
            cx, cy = np.cov(x.T, bias=True), np.cov(y.T, bias=True)
            inner = power(power(cy) @ cx @ power(cy))
            cost[i, j] = ((x.mean(0) - y.mean(0)) ** 2).sum() + np.trace(cx + cy - 2 * inner)
    p, q = np.array([len(x) for _, x in left]) / len(a), np.array([len(y) for _, y in right]) / len(b)
    kernel = np.exp(-cost / (entropy * cost.mean()))
    u = np.ones(len(p))
    for _ in range(5000):
        v = q / (kernel.T @ u)
        u = p / (kernel @ v)
    plan = u[:, None] * kernel * v
    return {(x, y): (cost[i, j], plan[i, j]) for i, (x, _) in enumerate(left) for j, (y, _) in enumerate(right)}


def test_transport_equals_numpy(spark):
    a, b = sets()
    frame = lambda rows: spark.createDataFrame([*rows, ("a", None)], "kind string, v array<double>").repartition(3)
    for entropy in (0.1, 1.0):
        moved = T.label_transport(frame(a), frame(b), "kind", "v", entropy)
        want = plain_transport([(n or "None", v) for n, v in a], [(n, v) for n, v in b], entropy) if entropy else {}
        got = {(r.label_a, r.label_b): (r.cost, r.share) for r in moved.collect()}
        # the fixture's NULL vectors belong to no label
        assert got.keys() >= want.keys()
        for k, (cost, share) in want.items():
            assert got[k] == (pytest.approx(cost, rel=1e-6), pytest.approx(share, abs=1e-6))
        assert T.transport_distance(moved).first()[0] == pytest.approx(sum(c * s for c, s in want.values()), rel=1e-6)
    assert T.label_transport(frame(a).limit(0), frame(b), "kind", "v").count() == 0
    same = T.label_transport(frame(a), frame(a), "kind", "v", 0.01)
    assert same.filter("label_a = label_b").agg(F.max("cost")).first()[0] < 1e-6


def rated(n=400, seed=11):
    """Rows of a hidden class, five raters of different care, some votes missing."""
    rng = np.random.default_rng(seed)
    classes, care = ["a", "b", "c"], [0.95, 0.9, 0.5, 0.4, 0.35]
    rows, truth = [], {}
    for k in range(n):
        truth[k] = classes[rng.choice(3, p=[0.5, 0.3, 0.2])]
        for r, p in enumerate(care):
            if rng.random() > 0.1:
                rows.append((k, f"r{r}", truth[k] if rng.random() < p else classes[rng.integers(3)]))
    return rows, truth


def plain_raters(rows, rounds, smooth=0.01):
    keys, raters, classes = (sorted({r[i] for r in rows}) for i in range(3))
    votes = {k: [] for k in keys}
    for k, r, c in rows:
        votes[k].append((raters.index(r), classes.index(c)))
    own = {k: np.bincount([c for _, c in v], minlength=len(classes)) / len(v) for k, v in votes.items()}
    for turn in range(rounds):
        shares = sum(own.values()) / len(keys)
        confusion = np.full((len(classes), len(raters), len(classes)), smooth)
        for k, v in votes.items():
            for r, c in v:
                confusion[:, r, c] += own[k]
        confusion /= confusion.sum(axis=2, keepdims=True)
        chances = {k: shares * np.prod([confusion[:, r, c] for r, c in v], axis=0) for k, v in votes.items()}
        own = {k: p / p.sum() for k, p in chances.items()}
    return shares, confusion, {k: classes[int(np.argmax(np.round(np.log(p), 9)))] for k, p in own.items()}, own


def test_rater_weights_equal_numpy(spark):
    rows, truth = rated()
    df = spark.createDataFrame([*rows, (1, "r9", None), (9_999, "r1", None)], "key int, rater string, label string").repartition(5)
    model = W.rater_model(df, rounds=6, close=0.0)
    shares, confusion, voted, own = plain_raters(rows, 6)
    assert model[2] == ["a", "b", "c"] and model[3] == 6
    assert model[0]["share"].to_numpy() == pytest.approx(shares, rel=1e-6)
    assert model[1]["share"].to_numpy() == pytest.approx(confusion.ravel(), rel=1e-6)
    got = {r.key: (r.label, r.share) for r in W.weighted_vote(df, model).collect()}
    assert {k: v[0] for k, v in got.items()} == voted
    assert all(got[k][1] == pytest.approx(own[k].max(), rel=1e-6) for k in got)
    settled = W.rater_model(df)
    assert 2 < settled[3] < 100
    learnt = {r.key: r.label for r in W.weighted_vote(df, settled).collect()}
    assert sum(learnt[k] == c for k, c in truth.items()) > 0.9 * len(truth)
    with pytest.raises(ValueError):
        W.rater_model(df.filter("label IS NULL"))


def test_raters_alike_give_the_majority(spark):
    rows = [(k, f"r{r}", "x" if (k + r) % 3 else "y") for k in range(30) for r in range(3)]
    df = spark.createDataFrame(rows, "key int, rater string, label string")
    model = W.rater_model(df, rounds=1)
    got = {r.key: r.label for r in W.weighted_vote(df, model).collect()}
    assert set(got.values()) == {"x"} and len(got) == 30
