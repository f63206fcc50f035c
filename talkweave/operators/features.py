"""Features and tree models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import as_class
from ..functions.text import clean_token_array
from .blocks import AUTO, row_position

#: bytes of text, and of the sums that come of it, that one block of texts holds (on average; texts are dealt by hash)
BLOCK_BYTES = 32 << 20


def embedding_sum(
    df: DataFrame,
    vectors: DataFrame,
    text: str,
    key: str,
    dim: int,
    stop_words: Sequence[str] = (),
    out: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Sum of the vectors of a text's in-vocabulary words, every occurrence counted.

    ``vectors(word, vector)``. A text without known words gets the zero vector. Texts are dealt into blocks of about ``block_bytes``
    by a hash. A word's vector goes once to each block that holds the word, not to each text that does, and a block adds
    up its texts as one array; texts of one key are added by a mergeable aggregate.
    """
    blocks = df.agg(F.ceil(F.sum(F.octet_length(text) + 8 * dim) / F.lit(block_bytes)).alias("n")).scalar()
    block = F.pmod(F.xxhash64(key, text), F.greatest(F.coalesce(blocks, F.lit(1)), F.lit(1)))
    told = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
    told = told.select(block.alias("block"), F.col(key).alias("key"), clean_token_array(text, stop_words).alias("terms"))
    wanted = told.select("block", F.explode(F.array_distinct("terms")).alias("term")).distinct()
    vocabulary = vectors.filter(F.col("vector").isNotNull()).select(F.col("word").alias("term"), F.col("vector"))
    known = wanted.join(vocabulary, "term").select(F.col("block").alias("at"), "term", "vector")

    def add(texts: pa.Table, words: pa.Table) -> pa.Table:
        total, number = _block_sums(texts.column("terms"), words.column("term"), words.column("vector"), dim)
        some = np.flatnonzero(number)
        sums = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * dim, total[some].ravel())
        return pa.table({"key": texts.column("key").take(pa.array(some)), "sums": sums, "n": number[some]})

    kind = dict(told.dtypes)["key"]
    parts = told.groupBy("block").cogroup(known.groupBy("at")).applyInArrow(add, f"key {kind}, sums array<double>, n bigint")
    sums = parts.groupBy(F.col("key").alias(key)).agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias(out), F.sum("n").alias("known_words")
    )
    zero = F.array_repeat(F.lit(0.0), dim)
    return df.join(sums, key, "left").withColumns(
        {out: F.coalesce(out, zero), "known_words": F.coalesce("known_words", F.lit(0))}
    )


def _block_sums(terms: pa.ChunkedArray, words: pa.ChunkedArray, vectors: pa.ChunkedArray, dim: int, step: int = 16_384) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of its words' vectors, and how many words that were; a word listed twice counts twice."""
    total, number = np.zeros((len(terms), dim)), np.zeros(len(terms), np.int64)
    if not len(words):
        return total, number
    listed = words.combine_chunks().dictionary_encode()
    at = listed.indices.to_numpy()
    table, times = np.zeros((len(listed.dictionary), dim)), np.bincount(at)
    np.add.at(table, at, pc.list_flatten(vectors).to_numpy().astype("float64").reshape(-1, dim))
    found = pc.index_in(pc.list_flatten(terms), value_set=listed.dictionary)
    rows = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy())
    hit = pc.is_valid(found).to_numpy()
    rows, found = rows[hit], pc.drop_null(found).to_numpy()
    for start in range(0, len(found), step):
        row, word = rows[start : start + step], found[start : start + step]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        total[row[first]] += np.add.reduceat(table[word], first)
        number[row[first]] += np.add.reduceat(times[word], first)
    return total, number


def unknown_words(
    df: DataFrame, vectors: DataFrame, text: str, key: str, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Words without a vector and how often each occurs."""
    words = df.select(F.explode(clean_token_array(text, stop_words)).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    return counts.join(vectors.select("word"), "word", "left_anti")


def label_index(df: DataFrame, label: str) -> DataFrame:
    """(label, index): classes in sorted order from 0.

    Only distinct labels are ranked, in blocks between quantiles of the labels, so encoding names or
    other columns with many values needs no single sort.
    """
    classes = df.select(as_class(label).alias("label")).distinct()
    return row_position(classes, [], ["label"], AUTO, "index").select(
        "label", (F.col("index") - 1).cast("int").alias("index")
    )


def with_label_index(df: DataFrame, label: str, out: str = "label_id") -> DataFrame:
    table = label_index(df, label).withColumnRenamed("index", out).withColumnRenamed("label", "__l")
    return df.join(table, as_class(label) == F.col("__l"), "left").drop("__l")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(as_class(label).alias("label")).agg(F.count("*").alias("count"))
    mean = counts.agg(F.avg("count")).scalar()  # rows / classes, from the same counts
    return counts.withColumn("weight", mean / F.col("count"))


def boosted_classifier(
    df: DataFrame,
    label: str,
    features: str,
    extra: Sequence[str] = (),
    method: str = "boosted",
    rounds: int = 20,
    depth: int = 5,
    seed: int = 42,
    parallelism: int = 4,
):
    """Fit a multi-class tree ensemble on an array column plus numeric columns.

    Returns ``(model, labels)``: the fitted pipeline and the classes in index order. 'boosted'
    fits one boosted model per class against the rest, since Spark's boosting is binary;
    'forest' fits one multi-class random forest. Neither repeats a softmax booster number for
    number.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    ready = feature_frame(df, label, features, extra)
    index = StringIndexer(inputCol="__label", outputCol="__y", stringOrderType="alphabetAsc")
    gather = VectorAssembler(inputCols=["__v", *extra], outputCol="__x")
    cols = {"labelCol": "__y", "featuresCol": "__x"}
    if method == "boosted":
        tree = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=seed, **cols)
        learner = OneVsRest(classifier=tree, parallelism=parallelism, **cols)
    elif method == "forest":
        learner = RandomForestClassifier(numTrees=rounds, maxDepth=depth, seed=seed, **cols)
    else:
        raise ValueError(f"method {method!r}")
    model = Pipeline(stages=[index, gather, learner]).fit(ready)
    return model, model.stages[0].labels


def feature_frame(df: DataFrame, label: str, features: str, extra: Sequence[str] = ()) -> DataFrame:
    vector = array_to_vector(F.transform(features, lambda x: x.cast("double")))
    return df.withColumns(
        {
            "__label": as_class(label),
            "__v": vector,
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in extra},
        }
    )


def predict(model, labels: Sequence[str], df: DataFrame, label: str, features: str, extra: Sequence[str] = (), out: str = "predicted") -> DataFrame:
    """Add the predicted class name; the features and helper columns are dropped again."""
    scored = model.transform(feature_frame(df, label, features, extra))
    names = F.array(*[F.lit(x) for x in labels])
    return scored.withColumn(out, F.get(names, F.col("prediction").cast("int"))).select(*df.columns, out)


def feature_importance(model, spark, n: int = 10, names: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` most used features: (feature, importance), averaged over per-class models.

    ``names`` in the order of the features (vector places, then extra columns); without them, their numbers as text.
    """
    last = model.stages[-1]
    models = getattr(last, "models", [last])
    total: dict[int, float] = {}
    for m in models:
        for i, x in enumerate(m.featureImportances.toArray()):
            total[i] = total.get(i, 0.0) + float(x) / len(models)
    width = max(total, default=-1) + 1
    names = [str(i) for i in range(width)] if names is None else list(names)
    rows = [(names[i], total.get(i, 0.0), i) for i in range(min(width, len(names)))]
    return (
        spark.createDataFrame(rows, "feature string, importance double, place int")
        .orderBy(F.desc("importance"), "place")
        .drop("place")
        .limit(n)
    )
