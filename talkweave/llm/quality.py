"""A quality classifier: random-indexing word vectors, pooled per document, and a small network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces, remainder, split_words
from .registry import query

#: word shapes, and the length of a vector
SHAPES, DIM = 256, 32

#: vectors are kept in bytes, this much to a length of one
UNIT = 127

#: a task's sums are kept as 32-bit numbers and passed on after this many words
FLUSH = 1 << 26


def mixed(hashed: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all of theirs."""
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return hashed ^ (hashed >> np.uint64(32))


def index_vectors(hashed: np.ndarray) -> np.ndarray:
    """The sparse index vector of each hash: eight places of plus or minus one, from bits of the hash alone."""
    out, rows = np.zeros((len(hashed), DIM), np.int8), np.arange(len(hashed))
    start, step = (hashed >> np.uint64(40)) % np.uint64(DIM), 2 * ((hashed >> np.uint64(45)) % np.uint64(DIM // 2)) + 1
    for k in range(8):  # an odd step never meets a place twice
        places = ((start + np.uint64(k) * step) % np.uint64(DIM)).astype(np.int64)
        out[rows, places] = 1 - 2 * ((hashed >> np.uint64(49 + k)) & np.uint64(1)).astype(np.int8)
    return out


def byte_hash(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of words (not null, not empty), with their bytes and each word's first place."""
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    if not len(starts):
        return np.zeros(0, np.uint64), data, starts
    place = np.arange(len(data)) - np.repeat(starts, np.diff(offsets))
    powers = np.cumprod(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    hashed = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], starts)
    return mixed(hashed), data, starts


def hashes_and_shapes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the shape (without repetition) of distinct words."""
    hashed, data, starts = byte_hash(words)
    if not len(starts):
        return hashed, np.zeros(0, np.int64)
    small = ((data >= 97) & (data <= 122)) | (data >= 128)
    large = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    size = np.diff(np.append(starts, len(data)))
    n = [np.add.reduceat(x, starts, dtype=np.int64) for x in (small, large, digit)]
    other = size - sum(n)
    case = np.where(n[1] == 0, 0, np.where(n[0] > 0, 1, np.where(n[1] > 1, 2, 3)))
    # by letter case, digits, how many other characters, and length
    shape = case + 4 * (n[2] > 0) + 8 * np.minimum(other, 3) + 32 * np.digitize(size, [2, 5, 13])
    return hashed, shape


@dataclass
class Words:
    """The words of some texts: how many each text has, the distinct ones' hashes and, word for word, which one and its shape."""

    counts: np.ndarray
    hashed: np.ndarray
    codes: np.ndarray
    shape: np.ndarray

    def symbols(self, cells: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, the row of its own vector and of its shape's in a table of ``SHAPES + cells`` rows."""
        return SHAPES + (self.hashed % np.uint64(cells)).astype(np.int64)[self.codes], self.shape


def words_of(batch: pa.RecordBatch, column: int) -> Words:
    """One bit of a word's shape says that it is the word before it again."""
    counts, words = split_words(batch.column(column))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    hashed, shape = hashes_and_shapes(coded.dictionary)
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    return Words(counts, hashed, codes, shape[codes] + 128 * again)


def sums(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a table of sums that are not zero, as (cell, v), in numbers of one, two or four bytes as each row needs."""
    most = np.abs(total).max(axis=1)
    for kind, least, top in ((np.int8, 0, 127), (np.int16, 127, 32767), (np.int32, 32767, 2**31 - 1)):
        some = np.flatnonzero((most > least) & (most <= top))
        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * (DIM * np.dtype(kind).itemsize))
        values = pa.Array.from_buffers(pa.binary(), len(some), [None, ends.buffers()[1], pa.py_buffer(total[some].astype(kind))])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), values], names=["cell", "v"])


def add_sums(total: np.ndarray, batch: pa.RecordBatch) -> None:
    """Adds rows that :func:`sums` made to ``total``."""
    cell, sizes = batch.column(0).to_numpy(), pc.binary_length(batch.column(1)).to_numpy()
    for kind in (np.int8, np.int16, np.int32):
        some = np.flatnonzero(sizes == DIM * np.dtype(kind).itemsize)
        data = b"".join(batch.column(1).take(pa.array(some)).to_pylist())
        np.add.at(total, cell[some], np.frombuffer(data, kind).reshape(-1, DIM))


def word_vectors(docs: DataFrame, text: str = "text", cells: int = 1 << 18, reach: int = 2) -> np.ndarray:
    """A vector for each shape and each of ``cells`` cells of word hashes: the sum of the index vectors around, over the whole
    corpus, at unit length.

    Every word has an index vector of its own; words whose hashes fall into one cell share what is learnt from their
    neighbours. Tasks add up their rows in whole numbers, so the same documents give the same table; the sums of a cell then meet
    in one task, a row from each task before. Directions are rounded to bytes. The table's size, 32 bytes a cell, does not depend
    on the corpus, and only it goes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = index_vectors(mixed(np.arange(1, SHAPES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        total, seen = np.zeros((SHAPES + cells, DIM), np.int32), 0
        for batch in pieces(batches, 0):
            words = words_of(batch, 0)
            if not len(words.codes):
                continue
            own = index_vectors(words.hashed)[words.codes] + shapes[words.shape]
            doc = np.repeat(np.arange(len(words.counts)), words.counts)
            near = np.zeros_like(own)
            for step in range(1, reach + 1):
                same = (doc[step:] == doc[:-step])[:, None]
                near[:-step] += own[step:] * same
                near[step:] += own[:-step] * same
            for symbol in words.symbols(cells):
                order = np.argsort(symbol, kind="stable")
                ranked = symbol[order]
                starts = np.flatnonzero(np.diff(ranked, prepend=-1))
                total[ranked[starts]] += np.add.reduceat(near[order], starts, axis=0, dtype=np.int32)
            seen += len(words.codes)
            if seen > FLUSH:
                yield from sums(total)
                total, seen = np.zeros_like(total), 0
        yield from sums(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SHAPES + cells, DIM), np.int64)
        for batch in batches:
            add_sums(total, batch)
        some = np.flatnonzero(total.any(axis=1))
        found = total[some].astype(np.float64)
        found = np.rint(UNIT * found / np.linalg.norm(found, axis=1, keepdims=True)).astype(np.int8)
        ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * DIM)
        values = pa.Array.from_buffers(pa.binary(), len(some), [None, ends.buffers()[1], pa.py_buffer(found)])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), values], names=["cell", "v"])

    tables = map_texts(docs.select(F.col(f"`{text}`").alias("text")), run, "cell int, v binary")
    found = tables.repartition("cell").mapInArrow(merge, "cell int, v binary").toArrow()
    out = np.zeros((SHAPES + cells, DIM), np.int8)
    for batch in found.to_batches():
        out[batch.column(0).to_numpy()] = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int8).reshape(-1, DIM)
    return out


def pooled(batch: pa.RecordBatch, column: int, vectors: np.ndarray) -> np.ndarray:
    """Per text the mean vector of its words and of their shapes; zeros where it has none."""
    words = words_of(batch, column)
    out = np.zeros((len(words.counts), 2 * DIM), np.float32)
    some = np.flatnonzero(words.counts)
    if len(some):
        starts = (np.cumsum(words.counts) - words.counts)[some]
        for half, symbol in enumerate(words.symbols(len(vectors) - SHAPES)):
            out[some, half * DIM : (half + 1) * DIM] = (
                np.add.reduceat(vectors[symbol], starts, axis=0, dtype=np.int64) / (UNIT * words.counts[some, None])
            )
    return out


@dataclass
class Network:
    """Two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2[:, 0] + b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 40, seed: int = 3) -> Network:
    """Cross-entropy by Adam on four rows in five; the temperature makes the rest likeliest.

    Without rows, every text scores 0.5; with one label only, it scores by that label's share with one count added to either label.
    """
    rng = np.random.default_rng(seed)
    wide = x.shape[1]
    layers = [rng.normal(0, wide**-0.5, (wide, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, 1)), np.zeros(1)]
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(wide), np.ones(wide), [layers[0], layers[1], layers[2] * 0, np.array([np.log(share / (1 - share))])], 1.0)
    net = Network(x.mean(axis=0), x.std(axis=0) + 1e-6, layers, 1.0)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    z = (x - net.mean) / net.scale
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(epochs):
        rng.shuffle(used)
        for at in range(0, len(used), 128):
            rows = used[at : at + 128]
            h = np.tanh(z[rows] @ layers[0] + layers[1])
            off = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -40, 40))) - y[rows, None]) / len(rows)
            back = (off @ layers[2].T) * (1 - h**2)
            grads = [z[rows].T @ back + 1e-4 * layers[0], back.sum(axis=0), h.T @ off + 1e-4 * layers[2], off.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(layers, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if len(held):
        logits, sign = net.logits(x[held]), 2 * y[held] - 1
        tried = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [np.logaddexp(0, -sign * logits / t).mean() for t in tried]
        net.temperature = float(tried[int(np.argmin(losses))])
    return net


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 20_000,
    cells: int = 1 << 18,
) -> Classifier:
    """Word vectors from all ``docs`` (see :func:`word_vectors` for ``cells``), a network from at most ``sample`` labelled ones.

    ``sample`` bounds what the driver fits on: the labelled keys with the smallest hash, one row for each. A key with several labels
    has their majority (ties count as 1); of several texts under a key, the one whose pooled vector comes first teaches. Labels
    or keys that are null teach nothing.
    """
    vectors = word_vectors(docs, text, cells)
    known = labels.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull())
    known = known.groupBy(F.col(f"`{key}`").alias("label_key")).agg((F.avg(F.col(f"`{label}`")) >= 0.5).cast("double").alias("y"))
    chosen = known.orderBy(F.xxhash64(F.lit(11), "label_key"), "label_key").limit(sample)
    chosen = chosen.withColumn("place", F.xxhash64(F.lit(11), "label_key")).select("label_key", "place", "y")
    # the limit above bounds this broadcast
    rows = docs.join(F.broadcast(chosen), F.col(f"`{key}`") == F.col("label_key")).select("place", "y", F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            x = pooled(batch, 2, shared.value).astype(np.float64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["place", "y", "x"])

    found = map_texts(rows, run, "place long, y double, x array<double>")
    found = found.groupBy("place").agg(F.min(F.struct("x", "y")).alias("row")).select("row.y", "row.x").toPandas()
    x = np.array(found["x"].tolist()).reshape(len(found), 2 * DIM)
    order = np.lexsort((x[:, 0], x[:, -1])) if len(x) else np.zeros(0, int)  # the same rows in the same order on each run
    return Classifier(vectors, fit(x[order], found["y"].to_numpy(np.float64)[order]))


def score(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: key and ``score``, the calibrated probability of label 1.

    Each row is scored where it is read; only the model, of fixed size, travels. A null or empty text is scored as a text without words. Repeated
    rows repeat their result; an empty table gives an empty table.
    """
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            found = shared.value.network.probability(pooled(batch, 1, shared.value.vectors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(np.float64))], names=["key", "score"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows, run, schema).select(F.col("key").alias(key), "score")


@query("op4_quality")
def op4_quality(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    labels = load(spark, folder, "labels").filter(remainder("doc_id", 3) != 1)
    found = score(docs, train(docs, labels))
    return found.select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
