"""Documents packed in their order into sequences of a fixed window, with little padding and few cut sentences."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces
from .registry import query
from .tokens import byte_encoder, clean, finer_cuts, from_bytes, stretches_of, totals

#: places for a cut inside a sentence are this many tokens apart at most
GAP = 64


def padding(size: np.ndarray | int, window: int):
    """Tokens of padding for a sequence of ``size``: none for a power of two."""
    return np.where(np.asarray(size) & (np.asarray(size) - 1) == 0, 0, window - np.asarray(size))


def places(doc_ends: np.ndarray, sentence_ends: np.ndarray, sentence: float, inside: float) -> tuple[np.ndarray, np.ndarray]:
    """Where cuts may lie (from 0, which opens the first window) and what each costs.

    Ends of documents cost nothing, other ends of sentences ``sentence``; where these are more than ``GAP`` tokens apart
    there are places at ``inside`` between them.
    """
    at = np.union1d(np.append(doc_ends, 0), sentence_ends)
    wide = np.diff(at) > GAP
    more = [np.arange(a + GAP, b, GAP) for a, b in zip(at[:-1][wide], at[1:][wide])]
    fill = np.concatenate(more) if more else np.zeros(0, np.int64)
    cost = np.full(len(at), float(sentence))
    cost[np.searchsorted(at, doc_ends)] = 0.0
    cost[0] = 0.0
    everywhere = np.concatenate([at, fill])
    order = np.argsort(everywhere, kind="stable")
    return everywhere[order], np.concatenate([cost, np.full(len(fill), float(inside))])[order]


def tails(window: int, inside: float, each: float) -> tuple[np.ndarray, np.ndarray]:
    """The least cost of the last r tokens, for r from 0 to ``window``, and the length of their first sequence.

    The rest of a partition may be cut anywhere, at ``inside`` a cut: into powers of two if that is cheaper than padding.
    """
    cost, first = np.zeros(window + 1), np.arange(window + 1)
    for r in range(1, window + 1):
        cost[r] = float(padding(r, window)) + each
        step = 1
        while step < r:
            if cost[r - step] + inside + each < cost[r]:
                cost[r], first[r] = cost[r - step] + inside + each, step
            step *= 2
    return cost, first


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int, each: float, last: tuple | None = None) -> list[int]:
    """Cuts from ``at[0]`` to ``at[-1]`` of least padding, penalties and ``each`` per sequence.

    Padding up to the window is cost[i] + window - (at[j] - at[i]), so the best i for j is the least cost[i] + at[i] among
    those in reach: the front of a queue that is kept rising. Lengths that are powers of two need no
    padding and are tried one by one where places lie just that far apart. ``last`` (see :func:`tails`) lets the end be cut freely.
    """
    n, step, exact = len(at), 1, []
    while step < window:
        start = np.searchsorted(at, at - step)
        hit = np.flatnonzero((at[np.minimum(start, n - 1)] == at - step) & (start < n))
        exact.append(np.stack([hit, start[hit]]))
        step *= 2
    pairs = np.concatenate(exact, axis=1)
    pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
    upto = np.searchsorted(pairs[0], np.arange(n + 1)).tolist()
    sources, spot, fine = pairs[1].tolist(), at.tolist(), penalty.tolist()
    cost, back, queue = [0.0] * n, [0] * n, deque([0])
    value = [float(spot[0])] * n
    for j in range(1, n):
        here = spot[j]
        while spot[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        least = value[i] + window - here
        for other in sources[upto[j] : upto[j + 1]]:
            if cost[other] < least:
                i, least = other, cost[other]
        cost[j], back[j] = least + fine[j] + each, i
        value[j] = cost[j] + here
        while queue and value[queue[-1]] >= value[j]:
            queue.pop()
        queue.append(j)
    end, j, cuts = spot[-1], n - 1, []
    if last is not None:
        near = int(np.searchsorted(at, end - window))
        j = min(range(near, n), key=lambda i: cost[i] + last[0][end - spot[i]])
        rest = spot[j]
        while rest < end:
            rest += int(last[1][end - rest])
            cuts.append(rest)
    head = []
    while j > 0:
        head.append(spot[j])
        j = back[j]
    return [spot[0], *reversed(head), *cuts]


class Stream:
    """The tokens of documents in their order, not yet cut for good."""

    def __init__(self, kind: pa.DataType):
        self.kind = kind
        self.ids = np.zeros(0, np.uint32)
        self.keys = pa.nulls(0, kind)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.keys = pa.concat_arrays([self.keys, keys.cast(self.kind)])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, cuts: list[int], first: int) -> pa.RecordBatch:
        """The pieces between the first cut and the last, which leave the stream. Sequences are numbered from ``first``."""
        cuts = np.asarray(cuts)
        stop = int(cuts[-1])
        start = np.union1d(cuts[:-1], self.begin[(self.begin > 0) & (self.begin < stop)])
        ends = np.append(start[1:], stop)
        doc = np.searchsorted(self.begin, start, "right") - 1
        sequence = np.searchsorted(cuts, start, "right") - 1
        raw = self.ids[:stop].astype("<u4").view(np.uint8)
        out = [
            self.keys.take(pa.array(doc)),
            pa.array(start - self.begin[doc]),
            pa.array(ends - start),
            from_bytes(raw, 4 * np.append(start, stop), pa.binary()),
            pa.array(self.size[doc]),
            pa.array(first + sequence),
            pa.array(start - cuts[sequence]),
        ]
        stays = np.flatnonzero(self.begin + self.size > stop)
        self.ids = self.ids[stop:].copy()
        self.keys = self.keys.take(pa.array(stays))
        self.begin, self.size = self.begin[stays] - stop, self.size[stays]
        return pa.RecordBatch.from_arrays(out, names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def pack(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = 2048,
    end: int = 1,
    sentence: float = 8,
    inside: float = 32,
    each: float = 1,
) -> DataFrame:
    """One row per piece of a document: key, ``start`` and ``length`` in its ids, ``ids`` (little-endian 32-bit numbers),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    A document is its ids by the byte-level ``vocabulary`` (a path) and then ``end``. Documents follow each other as the
    table's partitions hold them, and each partition's stream is cut into sequences of at most ``window``
    ids: at ends of documents, at ends of sentences for ``sentence`` tokens of penalty, or inside one for ``inside``, so that padding
    and penalties together are least (:func:`best_cuts`). The stream is cut in slices of about 3 MB of text; the last
    sequence of a slice is cut anew with the next. A worker holds one slice, or one document with its ids.

    Nothing is shuffled, and with the same files and settings a task that runs again gives the same sequences. A null or empty text is the end
    id alone. Rows repeated or without key are documents of their own. Other columns of ``docs`` are not read.
    An empty table gives an empty table.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, entries = byte_encoder(vocabulary)
        stops = np.array([b.rstrip(b"\"')] ").endswith((b".", b"!", b"?")) or b"\n" in b for b in entries])
        number, stream = TaskContext.get().partitionId() << 33, None

        def cut(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number
            sentences = np.flatnonzero(stops[stream.ids]) + 1
            at, penalty = places(stream.begin + stream.size, sentences, sentence, inside)
            cuts = best_cuts(at, penalty, window, each, tails(window, inside, each) if final else None)
            cuts = cuts if final else cuts[:-1]
            if len(cuts) > 1:
                yield stream.take(cuts, number)
                number += len(cuts) - 1

        for batch in pieces(batches, 1, 3_000_000):
            counts, coded = stretches_of(clean(batch.column(1)), finer_cuts)
            sizes, ids = encoder.ids(coded)
            own = totals(counts, sizes)
            if stream is None:
                stream = Stream(batch.column(0).type)
            stream.add(batch.column(0), own + 1, np.insert(ids, np.cumsum(own), end))
            yield from cut(False)
        if stream is not None and len(stream.ids):
            yield from cut(True)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    names = [key if c == "key" else c for c in schema.names]
    return map_texts(rows, run, schema).toDF(*names)


@query("op11_packing")
def op11_packing(spark, folder):
    from public_tokenizers import path

    done = pack(load(spark, folder, "documents"), path("byte_bpe_50k.json"))
    return done.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
