"""An inverted index over vectors: coarse cells, coded residuals, and an exact check of what the codes leave open."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .explore import sample_rows

#: vectors of one cell, and questions to it, that one group holds at most (on average; they are dealt by hash)
CELL_ROWS = 20_000


@dataclass
class VectorIndex:
    """``codes``: (cell, rep, scale, err, code), the inverted lists. ``vectors``: (rep, embedding, ids), each different vector once.

    ``centres``: one row per cell. ``sizes``: how many vectors each cell holds. Both are as large as ``cells``, not as the data.
    """

    codes: DataFrame
    vectors: DataFrame
    centres: np.ndarray
    sizes: np.ndarray
    metric: str
    most: int


def directions(c: Column) -> Column:
    """At unit length; NULL for a zero vector."""
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(c, lambda x: x.cast("double") / norm))


def _prepared(c: str, metric: str) -> Column:
    if metric not in ("l2", "cosine"):
        raise ValueError(f"metric {metric!r}")
    return directions(F.col(c)) if metric == "cosine" else F.col(c).cast("array<double>")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all rows of ``a`` and of ``b`` (a batch and the cells' centres, or one group)."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2.0 * (a @ b.T), 0.0)


def build_index(vectors: DataFrame, cells: int = 256, sample: int = 50_000, most: int = 100, metric: str = "l2", seed: int = 42) -> VectorIndex:
    """Index ``vectors(vec_id, embedding)``.

    The centres of the cells come from k-means over a seeded sample of at most ``sample`` rows; every vector then goes to the nearest centre's cell.
    Its residual is coded with one signed byte per dimension and a scale of its own; ``err``, the length of what the code
    misses, is kept, so distances to a code have a known bound. Equal vectors are one row with their ``most`` smallest ids: as ties go by
    id, no answer of up to ``most`` neighbours needs the others, and a vector that makes up a third of the table is one row. NULL vectors, and by
    'cosine' zero ones, are left out.
    """
    ready = vectors.select("vec_id", _prepared("embedding", metric).alias("embedding")).filter(F.col("embedding").isNotNull())
    # the group limit runs before the shuffle: a common vector sends ``most`` rows per task
    first = ready.withColumn("n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("n") <= most)
    distinct = first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = written(distinct.select(F.get("ids", F.lit(0)).alias("rep"), "embedding", "ids"), "index-vectors")
    taught = sample_rows(distinct.select("rep", "embedding"), "rep", sample, seed).select(array_to_vector("embedding").alias("features"))
    taught = written(taught, "index-sample")
    found = min(cells, taught.count())
    if found:
        centres = np.stack(KMeans(k=found, seed=seed, maxIter=10).fit(taught).clusterCenters()) if found > 1 else np.stack([taught.first()[0].toArray()])
    else:
        centres = np.zeros((0, 0))
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            if batch.empty:
                continue
            m = np.stack(batch["embedding"].to_numpy()).astype("float64")
            cell = distances(m, own).argmin(axis=1)
            rest = m - own[cell]
            scale = np.abs(rest).max(axis=1) / 127.0
            code = np.rint(rest / np.where(scale > 0, scale, 1.0)[:, None]).astype(np.int8)
            err = np.linalg.norm(rest - code * scale[:, None], axis=1)
            yield pd.DataFrame({"cell": cell.astype("int32"), "rep": batch["rep"], "scale": scale, "err": err, "code": [c.tobytes() for c in code]})

    rep = dict(distinct.dtypes)["rep"]
    codes = distinct.select("rep", "embedding").mapInPandas(coded, f"cell int, rep {rep}, scale double, err double, code binary")
    codes = written(codes.repartition("cell").sortWithinPartitions("cell"), "index-codes")
    counts = codes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()  # one row per cell
    sizes = np.zeros(len(centres), np.int64)
    sizes[counts["cell"].to_numpy(np.int64)] = counts["n"].to_numpy()
    return VectorIndex(codes, distinct, centres, sizes, metric, most)


def _split(sizes: np.ndarray, rows: int) -> np.ndarray:
    return np.maximum(1, -(-sizes // rows))


def _literal(values: np.ndarray) -> Column:
    """One value per cell, by the cell's number."""
    return F.array(*[F.lit(int(v)).cast("int") for v in values])


def search(index: VectorIndex, queries: DataFrame, k: int = 5, probe: int = 8, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The ``k`` nearest indexed vectors per query: (query_id, rank, vec_id, distance), as :func:`talkweave.operators.retrieval.top_k`.

    ``queries(query_id, embedding)`` look into their ``probe`` nearest cells; with ``probe`` as large as the number of cells
    the answer is exact. Codes and questions meet by cell, large cells and many questions in parts, so a group holds at most about ``cell_rows``
    of each. By the codes' error bounds a group keeps whatever may be among the ``k`` nearest in it; those
    candidates alone meet the vectors themselves, and their true distances decide, the smaller id on ties.
    """
    if k > index.most:
        raise ValueError(f"the index keeps {index.most} ids of equal vectors")
    spark = queries.sparkSession
    asked = queries.select("query_id", _prepared("embedding", index.metric).alias("embedding")).filter(F.col("embedding").isNotNull())
    types = dict(asked.dtypes) | dict(index.vectors.dtypes)
    result = f"query_id {types['query_id']}, rank int, vec_id {types['rep']}, distance double"
    if not len(index.centres):
        return spark.createDataFrame([], result)
    probe = min(probe, len(index.centres))
    shared = spark.sparkContext.broadcast(index.centres)

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            if batch.empty:
                continue
            for start in range(0, len(batch), 256):  # each question comes out once per cell it looks into
                some = batch.iloc[start : start + 256]
                m = np.stack(some["embedding"].to_numpy()).astype("float64")
                near = np.argpartition(distances(m, own), probe - 1, axis=1)[:, :probe]
                yield pd.DataFrame(
                    {
                        "cell": near.ravel().astype("int32"),
                        "query_id": some["query_id"].repeat(probe).to_numpy(),
                        "embedding": [row for row in m for _ in range(probe)],
                    }
                )

    looked = written(asked.mapInPandas(probes, f"cell int, query_id {types['query_id']}, embedding array<double>"), "index-probes")
    counts = looked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()  # one row per cell
    wanted = np.zeros(len(index.centres), np.int64)
    wanted[counts["cell"].to_numpy(np.int64)] = counts["n"].to_numpy()
    parts, turns = _literal(_split(index.sizes, cell_rows)), _literal(_split(wanted, cell_rows))
    of = lambda numbers: F.get(numbers, F.col("cell"))
    dealt = lambda c, numbers: F.pmod(F.xxhash64(c), of(numbers)).cast("int")
    every = lambda numbers: F.explode(F.sequence(F.lit(0), of(numbers) - 1))
    left = index.codes.filter(F.get(_literal(wanted), F.col("cell")) > 0).select("*", dealt("rep", parts).alias("part"), every(turns).alias("turn"))
    right = looked.select("*", every(parts).alias("part")).select("*", dealt("query_id", turns).alias("turn"))

    def near(codes: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        if codes.empty or questions.empty:
            return pd.DataFrame({"query_id": [], "rep": []})
        rest = np.frombuffer(b"".join(codes["code"]), np.int8).reshape(len(codes), -1) * codes["scale"].to_numpy()[:, None]
        m = shared.value[codes["cell"].iloc[0]] + rest
        err, reps = codes["err"].to_numpy(), codes["rep"].to_numpy()
        out = []
        for start in range(0, len(questions), 64):
            some = questions.iloc[start : start + 64]
            away = np.sqrt(distances(np.stack(some["embedding"].to_numpy()), m))
            slack = 1e-6 * (1.0 + away)
            last = min(k, len(m)) - 1
            bound = np.partition(away + err + slack, last, axis=1)[:, last]
            row, at = np.nonzero(away - err - slack <= bound[:, None])
            out.append(pd.DataFrame({"query_id": some["query_id"].to_numpy()[row], "rep": reps[at]}))
        return pd.concat(out)

    keys = ["cell", "part", "turn"]
    candidates = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(near, f"query_id {types['query_id']}, rep {types['rep']}")
    both = candidates.join(index.vectors, "rep").join(asked.withColumnRenamed("embedding", "asked"), "query_id")
    squares = F.aggregate(F.zip_with("embedding", "asked", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    away = squares / 2 if index.metric == "cosine" else F.sqrt(squares)
    rows = both.select("query_id", away.alias("distance"), F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "distance")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of the exact neighbours that were found."""
    same = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return same.agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
