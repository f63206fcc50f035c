"""What a worker holds, what is moved, and what is broadcast stays bounded as the tables grow."""

import hashlib
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from talkweave.operators import features as K
from talkweave.operators import retrieval as R
from talkweave.operators import rows as W
from talkweave.operators import scoring as M
from talkweave.operators import spelling as S
from talkweave.operators import transport as T
from talkweave.plans import coding


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_holds_one_tile():
    rng = np.random.default_rng(0)
    q, v = rng.integers(-3, 4, (300, 4)).astype("float64"), rng.integers(-3, 4, (60_000, 4)).astype("float64")
    tracemalloc.start()
    ids, hits, dist = R.nearest(np.arange(300), q, np.arange(60_000), v, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    for i in (0, 299):
        away = ((v - q[i]) ** 2).sum(axis=1)
        want = np.lexsort((np.arange(60_000), away))[:3]
        assert hits[ids == i].tolist() == want.tolist() and dist[ids == i].tolist() == away[want].tolist()


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_blocks_with_text_ids(spark, metric):
    rng = np.random.default_rng(1)
    data = [(f"p{i}", [float(x) for x in rng.integers(1, 9, 3)]) for i in range(60)]
    vectors = spark.createDataFrame(data, "vec_id string, embedding array<float>")
    asked = vectors.withColumnRenamed("vec_id", "query_id")
    found = [sorted(map(tuple, R.top_k(asked, vectors, 4, metric, limit).collect())) for limit in (1 << 20, 600)]
    assert found[0] == found[1] and len(found[0]) == 240


def test_correction_table_broadcasts_no_messages(spark):
    df = spark.createDataFrame([(1, "one two", "x"), (2, "one two", "y"), (3, None, "z")], "at int, text string, label string")
    fixes = spark.createDataFrame([("one", 0, 0, "new", "A")], "prefix string, place int, seq int, text string, label string")
    done = W.apply_correction_table(df, fixes, "text", "label", ["at"])
    assert "BroadcastHashJoin" not in plan_of(done)
    assert sorted(map(tuple, done.select("at", "label").collect())) == [(1, "A"), (2, "y"), (3, "z")]


def test_corrections_broadcast_no_pieces(spark):
    words = spark.createDataFrame([("hause",), ("house",), (None,)], "word string")
    known = spark.createDataFrame([("house", 30), ("mouse", 40)], "word string, count long")
    done = S.corrections(words, known)
    assert "BroadcastHashJoin" not in plan_of(done)
    assert [tuple(r) for r in done.collect()] == [("hause", "house", 1)]


def test_transport_with_empty_tasks(spark):
    rng = np.random.default_rng(2)
    data = [("ab"[i % 3 == 0], [float(x) for x in rng.random(2)]) for i in range(9)]
    one = spark.createDataFrame(data, "kind string, v array<float>").coalesce(1)
    a, b = (sorted(map(tuple, T.label_moments(d, "kind", "v").collect())) for d in (one, one.repartition(32)))
    assert [x[0] for x in a] == [x[0] for x in b] == ["a", "b"]
    assert np.allclose([x[1] for x in a], [x[1] for x in b], rtol=1e-12)


def test_plan_settles_where_labels_hardly_exchange():
    cost = np.array([[0.0, 1.0, 1.5], [1.0, 0.0, 2.0], [1.5, 2.0, 0.0]])
    for p, q in (([0.2, 0.3, 0.5], [0.2, 0.3, 0.5]), ([0.2, 0.3, 0.5], [0.3, 0.3, 0.4])):
        plan = T.scaled_plan(cost, np.array(p), np.array(q), 0.04, rounds=1_000)
        assert np.abs(plan.sum(axis=1) - p).max() < 1e-12 and np.abs(plan.sum(axis=0) - q).max() < 1e-12


def test_score_sees_small_batches(spark):
    sizes = lambda: lambda s: pd.Series([str(len(s))] * len(s))
    seen = M.score(spark.range(5_000).selectExpr("cast(id as string) as text").coalesce(1), "text", sizes)
    assert seen.selectExpr("max(cast(response as int))").first()[0] <= 1_000


def test_embedding_sum_in_blocks(spark):
    """Repeated and missing keys, a word listed twice; a vector goes to a block, not to a text."""
    docs = [(1, "a b a."), (1, "b"), (2, "zzz"), (3, None), (None, "a"), (4, "A c")]
    vec = [("a", [1.0, 2.0]), ("b", [10.0, 20.0]), ("c", [100.0, 0.0]), ("c", [0.5, 0.5]), (None, [9.0, 9.0])]
    df, vectors = spark.createDataFrame(docs, "i int, t string"), spark.createDataFrame(vec, "word string, vector array<float>")
    want = [(None, [0.0, 0.0], 0), (1, [22.0, 44.0], 4), (1, [22.0, 44.0], 4), (2, [0.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, [101.5, 2.5], 3)]
    for size in (1, 20, 1 << 20):
        done = K.embedding_sum(df, vectors, "t", "i", 2, block_bytes=size)
        assert "CoGroup" in plan_of(done)
        assert sorted(((r.i, r.embedding, r.known_words) for r in done.collect()), key=lambda r: r[0] or 0) == want


@pytest.mark.parametrize("kind", ["float32", "float64"])
def test_closest_decides_in_double_precision(kind):
    """Far from zero, of any size, with copies, NaN, infinities and fewer rows than asked for: as by direct differences."""
    rng = np.random.default_rng(3)
    for turn in range(60):
        n, m, dim, k = (int(x) for x in rng.integers(1, (20, 300, 6, 8)))
        v = (rng.integers(-2, 3, (m, dim)) if turn % 2 else rng.normal(size=(m, dim))).astype(kind)
        q = np.concatenate([v[:n], rng.normal(size=(n, dim)).astype(kind)])
        for side in (q, v):
            side *= np.array(10.0 ** ((turn % 5) * 4 - 8), kind)
            side += np.array((turn % 3) * 1e3, kind)
        if turn % 4 == 3:
            v[0], v[m // 2] = np.inf, np.nan
        row, at, dist = R.closest((q, None), (v, None), k, step=7, width=64)
        for i in range(len(q)):
            with np.errstate(all="ignore"):
                away = ((v.astype("float64") - q[i].astype("float64")) ** 2).sum(axis=1)
            want = [j for j in np.lexsort((np.arange(m), away)) if not np.isnan(away[j])][:k]
            assert at[row == i].tolist() == want and dist[row == i].tolist() == away[want].tolist()


def test_closest_looks_at_few_copies():
    """A vector that makes up most of a side is compared a few times, not once for each copy."""
    v = np.zeros((40_000, 16), "float32")
    v[:100] = np.random.default_rng(4).normal(size=(100, 16))
    kept = R._few_copies((v, None), 5)
    assert kept.tolist() == list(range(105))
    row, at, dist = R.closest((v[[0, 200]], None), (v, None), 5)
    assert at[row == 1].tolist() == [100, 101, 102, 103, 104] and at[0] == 0 and not dist[row == 1].any()


@pytest.mark.parametrize("limit", [1 << 20, 300, 100])
def test_top_k_deals_work_and_keeps_null_ids(spark, monkeypatch, limit):
    """Where there is work for several tasks, one scanned partition does not mean one task; ids may be large or missing."""
    monkeypatch.setattr(R, "PAIRS", 50)
    data = [((1 << 60) + i if i else None, [float(i), 1.0]) for i in range(20)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>").coalesce(1)
    asked = vectors.filter("embedding[0] % 3 = 1").withColumnRenamed("vec_id", "query_id")
    if limit == 300:
        asked = asked.limit(4)
    found = R.top_k(asked, vectors, 3, limit=limit)
    assert "REPARTITION_BY_NUM" in plan_of(found)
    got = {(r.query_id, r.rank): r.vec_id for r in found.collect()}
    for i in [1, 4, 7, 10] if limit == 300 else [1, 4, 7, 10, 13, 16, 19]:
        want = {1: [1, 2, None], 19: [19, 18, 17]}.get(i, [i, i - 1, i + 1])
        assert [got.pop(((1 << 60) + i, rank)) for rank in (1, 2, 3)] == [j and (1 << 60) + j for j in want]
    assert not got


def test_embed_hashed_hashes_each_word_once(spark):
    texts = ["b a, b", "", None, "É é x2", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    hashed = R.embed_hashed(df, "t", 8)
    assert "md5" not in plan_of(hashed)
    done = [r.embedding for r in hashed.collect()]
    for text, vector in zip(texts, done):
        words = {None: [], "": [], "b a, b": ["b", "a", ",", "b"], "É é x2": ["é", "é", "x2"], "a": ["a"]}[text]
        counts = np.zeros(8)
        for w in words:
            counts[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8] += 1
        assert vector == (counts / max(np.sqrt((counts**2).sum()), 1)).astype("float32").tolist()


def test_passages_of_one_partition_are_embedded_by_all_cores(spark, monkeypatch):
    told = [(1, i, f"word{i} and more") for i in range(40)]
    df = spark.createDataFrame(told, "c long, t long, text string").coalesce(1).withColumn("key", F.concat_ws(":", "c", "t"))
    parts, real = {}, coding.written
    monkeypatch.setattr(coding, "written", lambda d, name: (parts.update({name: d.rdd.getNumPartitions()}), real(d, name))[1])
    texts = df.select(F.col("key").alias("doc_id"), "text")
    found = coding.retrieve_context(df, texts, "key", "text", ["t"], ["c"], lambda d, c: R.embed_hashed(d, c, 16), k=2, history=0, recursive=False, block=3)
    assert parts["passages"] == 8
    assert found.count() == 80
