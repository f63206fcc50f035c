"""The inverted index against exact search: all cells give the same answer, some cells most of it."""

import numpy as np
import pytest

from talkweave.operators import retrieval as R
from talkweave.operators import vector_index as V

SCHEMA = "vec_id bigint, embedding array<float>"


def vectors(spark, n=600, dim=12, hot=200, seed=3):
    """Clustered vectors, one of them ``hot`` times, with a NULL and a zero vector."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(8, dim))[rng.integers(0, 8, n)] * 3 + rng.normal(size=(n, dim))
    m[:hot] = m[0]
    order = rng.permutation(n)
    rows = [(int(i), m[j].astype("float32").tolist()) for i, j in enumerate(order)]
    return spark.createDataFrame([*rows, (n, None), (n + 1, [0.0] * dim)], SCHEMA)


def asked(df):
    return df.filter("vec_id % 7 = 0").withColumnRenamed("vec_id", "query_id")


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_all_cells_are_exact(spark, metric):
    df = vectors(spark)
    index = V.build_index(df, cells=9, sample=100, most=20, metric=metric)
    assert int(index.sizes.sum()) == index.vectors.count() < 410
    got = V.search(index, asked(df), k=6, probe=9, cell_rows=25).collect()
    want = R.top_k(asked(df), df, k=6, metric=metric).collect()
    key = lambda r: (r.query_id, r.rank, r.vec_id)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) > 500
    far = {key(r): r.distance for r in want}
    assert all(abs(r.distance - far[key(r)]) < 1e-6 for r in got)


def test_some_cells_find_most(spark):
    df = vectors(spark, hot=50)
    found = V.search(V.build_index(df, cells=10), asked(df), k=5, probe=4)
    share = V.recall(found, R.top_k(asked(df), df, k=5)).first()[0]
    assert 0.9 <= share <= 1.0


def test_nothing_to_find(spark):
    none = spark.createDataFrame([], SCHEMA)
    df = vectors(spark, n=20, hot=2)
    assert V.search(V.build_index(none), asked(df)).count() == 0
    assert V.search(V.build_index(df, cells=4), asked(none)).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)
    assert [(r.rank, r.vec_id) for r in V.search(V.build_index(one), asked(vectors(spark, n=1, dim=2, hot=1)), k=2).collect()] == [(1, 1), (2, 1)]
    with pytest.raises(ValueError):
        V.search(V.build_index(one, most=2), asked(one), k=3)
