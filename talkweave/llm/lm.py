"""Language-model scores from a Bloom filter of quantised n-gram counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces, remainder, split_words, written
from .quality import byte_hash
from .registry import query
from .tokens import from_bytes, text_bytes

#: hashes of the end of a text and of what stands before its first token; as a token, the end is the empty string
END, START = np.uint64(0x51ED270B8D2C3F11), np.uint64(0xA24BAED4963EE407)
#: probes per key, the bits of a word's hash that are kept, and the bits of an n-gram's hash that choose its cells inside its segment
PROBES, WORD_BITS, KEY_BITS = 4, 40, 32
#: bits of a segment for each key put in: about 22 in 100 are set, and four probes all hit a set one by chance in 0.24 of 100
KEY_ROOM = 16


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Tokens:
    """The texts of a batch as numbers of distinct words; the last number is the end that closes each text."""

    counts: np.ndarray
    words: pa.Array | None
    hashes: np.ndarray
    codes: np.ndarray
    before: np.ndarray
    doc: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    counts, words = split_words(texts, lower=True)
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    end = len(distinct)
    total = counts + 1
    last = np.cumsum(total) - 1
    codes = np.full(int(total.sum()), end, np.int64)
    inside = np.ones(len(codes), bool)
    inside[last] = False
    codes[inside] = coded.indices.to_numpy()
    hashes = np.append(byte_hash(distinct)[0], END) & np.uint64((1 << WORD_BITS) - 1)
    return placed(total, distinct, hashes, codes)


def placed(counts: np.ndarray, words: pa.Array | None, hashes: np.ndarray, codes: np.ndarray) -> Tokens:
    before = np.empty(len(codes), np.uint64)
    before[1:] = hashes[codes[:-1]]
    before[np.cumsum(counts) - counts] = START
    return Tokens(counts, words, hashes, codes, before, np.repeat(np.arange(len(counts)), counts))


def pairs_of(t: Tokens) -> np.ndarray:
    """The hash of each token with the one before it."""
    return mixed(t.before * np.uint64(0x9E3779B97F4A7C15) + t.hashes[t.codes])


def low_bytes(values: np.ndarray, n: int) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def from_low_bytes(raw: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), np.uint8)
    out[:, :n] = raw.reshape(-1, n)
    return out.view("<u8")[:, 0]


def hold(t: Tokens, learns: np.ndarray) -> bytes:
    """What :func:`held` needs to give ``t`` and ``learns`` (of each text) back, less the words themselves."""
    small = "<u2" if len(t.hashes) <= 1 << 16 else "<u4"
    parts = [t.counts.astype("<u4"), np.packbits(learns), t.codes.astype(small), low_bytes(t.hashes, WORD_BITS // 8)]
    raw = b"".join([np.array([len(t.counts), len(t.codes), len(t.hashes)], "<u8").tobytes(), *[p.tobytes() for p in parts]])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def held(blob: bytes) -> tuple[Tokens, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True), np.uint8)
    n, m, words = raw[:24].view("<u8").astype(np.int64).tolist()
    small = 2 if words <= 1 << 16 else 4
    cuts = np.cumsum([24, 4 * n, -(-n // 8), small * m])
    counts, learns, codes, hashes = np.split(raw, cuts)[1:]
    tokens = placed(counts.copy().view("<u4").astype(np.int64), None, from_low_bytes(hashes, WORD_BITS // 8), codes.copy().view(f"<u{small}").astype(np.int64))
    return tokens, np.unpackbits(learns, count=n).astype(bool)


@dataclass
class Grams:
    """The distinct n-grams of a batch, sorted by segment and key: those of each word, of the start, and of each pair.

    ``order`` has their places before they were sorted, ``pair`` the place of each token's pair, ``times`` how often each is learnt from.
    """

    segment: np.ndarray
    keys: np.ndarray
    order: np.ndarray
    pair: np.ndarray
    times: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each segment begins and ends."""
        starts = np.flatnonzero(np.diff(self.segment, prepend=-1))
        return starts, np.append(starts[1:], len(self.segment))


def grams_of(t: Tokens, learns: np.ndarray, segments: int) -> Grams:
    """``learns``: of each text, whether its n-grams count."""
    pairs, pair = np.unique(pairs_of(t), return_inverse=True)
    hashes = np.concatenate([mixed(t.hashes), mixed(np.array([START])), pairs])
    mine = learns[t.doc]
    times = np.concatenate([np.bincount(t.codes[mine], minlength=len(t.hashes)), [int(learns.sum())], np.bincount(pair[mine], minlength=len(pairs))])
    segment = (hashes >> np.uint64(KEY_BITS)).astype(np.int64) % segments
    keys = (hashes & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
    order = np.lexsort((keys, segment))
    return Grams(segment[order], keys[order], order, pair, times[order])


def pack(keys: np.ndarray, times: np.ndarray, width: int = 5) -> bytes:
    """Keys of ``width`` bytes, bits that say which occur more than once or never, and how often the former do."""
    parts = [np.uint32(len(keys)), low_bytes(keys, width), np.packbits(times > 1), np.packbits(times == 0), np.minimum(times[times > 1], 2**32 - 1).astype("<u4")]
    return b"".join(p.tobytes() for p in parts)


def unpack(blob: bytes, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(blob, np.uint8)
    n = int(raw[:4].view("<u4")[0])
    _, keys, more, never, counts = np.split(raw, np.cumsum([4, width * n, -(-n // 8), -(-n // 8)]))
    times = np.ones(n, np.int64)
    times[np.unpackbits(never, count=n).astype(bool)] = 0
    times[np.unpackbits(more, count=n).astype(bool)] = counts.copy().view("<u4")
    return from_low_bytes(keys, width), times


def blobs_of(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``data`` (bytes) cut at ``ends``, as binary values."""
    return from_bytes(data, np.append(0, ends), pa.binary())


def quantum(count: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count))."""
    return np.frexp(count.astype(np.float64))[1]


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; 0 for level 0."""
    return np.where(level > 0, (3 * 2.0 ** (level - 1) - 1) / 2, 0.0)


def cells(keys: np.ndarray, level: int, probe: int, bits: int) -> np.ndarray:
    """The place of one probe for (n-gram, level) among a segment's ``bits``."""
    h = mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64) + np.uint64(probe * 0xD6E8FEB86659FD93 % 2**64))
    return (h % np.uint64(bits)).astype(np.int64)


def levels_in(data: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The level of each n-gram of one segment: probed upwards until a key is missing. Never too low, seldom too high.

    ``data`` are the segment's bits; an n-gram of level q was put in as the q keys (n-gram, 1) to (n-gram, q).
    """
    out = np.zeros(len(keys), np.uint8)
    live = np.arange(len(keys) if len(data) else 0)
    level = 0
    while len(live) and level < 64:
        level += 1
        for probe in range(PROBES):
            at = cells(keys[live], level, probe, 8 * len(data))
            live = live[(data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        out[live] = level
    return out


def segment_bits(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The bits of one segment, as many as its distinct keys need; a key's counts are added up."""
    keys, counts = keys[counts > 0], counts[counts > 0]
    if not len(keys):
        return b""
    distinct, owner = np.unique(keys, return_inverse=True)
    level = quantum(np.bincount(owner, counts))
    bits = max(64, 8 * -(-KEY_ROOM * int(level.sum()) // 8))
    on = np.zeros(bits, bool)
    for q in range(1, int(level.max()) + 1):
        some = distinct[level >= q]
        for probe in range(PROBES):
            on[cells(some, q, probe, bits)] = True
    return np.packbits(on, bitorder="little").tobytes()


@dataclass
class Model:
    """``counts``: the table of exact token counts. ``frequent``: the part of it that every worker holds.

    ``filter``: all counts as a log-frequency Bloom filter, cut into ``segments``, of which no worker holds more than one.
    """

    counts: DataFrame
    frequent: pd.DataFrame
    least: int
    tokens: int
    types: int
    #: (segment, bits): a table in the shared folder that grows with the distinct n-grams; none where it is made while scoring
    filter: DataFrame | None
    segments: int


def count_tokens(docs: DataFrame, text: str) -> DataFrame:
    """(token, c) with the end of a text as the empty string; tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, 3_000_000):
            t = tokens_of(batch.column(0))
            n = np.bincount(t.codes, minlength=len(t.hashes))
            words = pa.concat_arrays([t.words, pa.array([""], pa.string())])
            yield pa.RecordBatch.from_arrays([words, pa.array(n)], names=["token", "c"])

    partial = map_texts(docs.select(F.col(f"`{text}`").alias("text")), run, "token string, c long")
    return partial.groupBy("token").agg(F.sum("c").alias("c"))


def keys_by_segment(t: Tokens, learns: np.ndarray, piece: int, segments: int) -> pa.RecordBatch:
    """(segment, piece, blob): the n-grams of a piece for each segment, with their numbers."""
    g = grams_of(t, learns, segments)
    starts, ends = g.parts()
    blobs = [pack(g.keys[a:b], g.times[a:b], KEY_BITS // 8) for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(g.segment[starts]), pa.array(np.full(len(starts), piece, np.int64)), pa.array(blobs, pa.binary())], names=["segment", "piece", "blob"]
    )


def by_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """The rows (segment, piece, blob) of each segment; rows of a segment follow each other."""
    now, numbers, blobs = None, [], []
    for batch in batches:
        for segment, piece, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != now and now is not None:
                yield now, numbers, blobs
                numbers, blobs = [], []
            now = segment
            numbers.append(piece)
            blobs.append(blob)
    if now is not None:
        yield now, numbers, blobs


def build_filter(docs: DataFrame, text: str, segments: int) -> DataFrame:
    """(segment, bits): tokens and pairs of all ``docs``, counted by hash in segments.

    A segment gets all hashes that fall into it, as packed bytes from each task; it counts them, and gives each distinct
    one its bits (:func:`segment_bits`). So every segment has the same load whatever the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, 3_000_000):
            t = tokens_of(batch.column(0))
            yield keys_by_segment(t, np.ones(len(t.counts), bool), 0, segments)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, _, blobs in by_segment(batches):
            bits = segment_bits(*map(np.concatenate, zip(*(unpack(b, KEY_BITS // 8) for b in blobs))))
            yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([bits], pa.binary())], names=["segment", "bits"])

    packed = map_texts(docs.select(F.col(f"`{text}`").alias("text")), run, "segment long, piece long, blob binary")
    return written(packed.repartition("segment").sortWithinPartitions("segment").mapInArrow(fill, "segment long, bits binary"), "lm-filter")


def train(docs: DataFrame, text: str = "text", frequent: int = 400_000, per_segment: int = 500_000, build: bool = True) -> Model:
    """Exact token counts as a table, and, unless it is to be made while scoring, the filter. ``frequent`` bounds how many tokens every worker holds with their count.

    There are as many segments as give each about ``per_segment`` occurrences: a segment's work does not grow with the corpus. Null texts are empty ones. An empty table gives a model that has seen nothing.
    """
    counts = written(count_tokens(docs, text), "lm-counts")
    level = F.floor(F.log2(F.col("c")) * 8)
    steps = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("tokens"), F.min("c").alias("least")
    ).toPandas()  # at most a few hundred rows: eight levels to a power of two
    steps = steps.sort_values("level", ascending=False)
    fits = steps[steps["n"].cumsum() <= frequent]
    least = int(fits["least"].min()) if len(fits) else 2**62
    top = counts.filter(F.col("c") >= least).toPandas()
    tokens, types = int(steps["tokens"].sum()), int(steps["n"].sum())
    segments = max(1, 2 * tokens // per_segment)
    return Model(counts, top, least, tokens, types, build_filter(docs, text, segments) if build else None, segments)


def levels_of(states: DataFrame, model: Model) -> DataFrame:
    """(piece, segment, blob): for each segment that a piece (piece, blob) asks, the levels of its n-grams in their order.

    Pieces go to a segment once, with what is learnt from them. Where the model has a filter, its bits come to the segment too, first in its rows; else
    the segment sets its bits from its rows before it probes them. A task holds one segment at a time, whose size does not grow with the corpus.
    """
    segments, ready = model.segments, model.filter is not None

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield keys_by_segment(*held(blob.as_py()), piece, segments)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, numbers, blobs in by_segment(batches):
            bits = b""
            if numbers[0] < 0:
                bits, numbers, blobs = blobs[0], numbers[1:], blobs[1:]
            if not blobs:
                continue
            keys, times = zip(*(unpack(b, KEY_BITS // 8) for b in blobs))
            every = np.concatenate(keys)
            if not ready:
                bits = segment_bits(every, np.concatenate(times))
            ends = np.cumsum([len(k) for k in keys])
            columns = [pa.array(numbers, pa.int64()), pa.array(np.full(len(numbers), segment, np.int64)), blobs_of(levels_in(np.frombuffer(bits, np.uint8), every), ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["piece", "segment", "blob"])

    met = states.mapInArrow(ask, "segment long, piece long, blob binary")
    if ready:
        met = model.filter.select("segment", F.lit(-1).cast("long").alias("piece"), F.col("bits").alias("blob")).union(met)
    return met.repartition("segment").sortWithinPartitions("segment", "piece").mapInArrow(answer, "piece long, segment long, blob binary")


def filter_scores(states: DataFrame, model: Model, weight: float) -> DataFrame:
    """(row, score) of the texts in ``states`` (piece, blob); a piece's rows are numbered from its own number."""
    total, segments = model.tokens + model.types + 1, model.segments

    def scored(piece: int, t: Tokens, learns: np.ndarray, levels: np.ndarray) -> pa.RecordBatch:
        g = grams_of(t, learns, segments)
        level = np.empty(len(levels), np.int64)
        level[g.order] = levels
        counts = count_of(level)
        words = len(t.hashes)
        single, start, pair = counts[:words], counts[words], counts[words + 1 :][g.pair]
        past = np.empty(len(t.codes))
        past[1:] = single[t.codes[:-1]]
        past[np.cumsum(t.counts) - t.counts] = start
        after = np.minimum(1.0, np.divide(pair, past, out=np.zeros(len(pair)), where=past > 0))
        chance = weight * after + (1 - weight) * np.minimum(1.0, (single[t.codes] + 1) / total)
        value = np.bincount(t.doc, np.log10(chance), len(t.counts))
        return pa.RecordBatch.from_arrays([pa.array(piece + np.arange(len(t.counts))), pa.array(value)], names=["row", "score"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tokens, levels = None, None, []
        for batch in batches:
            piece, segment = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, at = text_bytes(batch.column(2))
            new = np.ones(len(piece), bool)
            new[1:] = piece[1:] != piece[:-1]
            starts = np.flatnonzero(new)
            for a, b in zip(starts, np.append(starts[1:], len(piece))):
                if segment[a] < 0:
                    if tokens is not None:
                        yield scored(now, *tokens, np.concatenate(levels))
                    now, tokens, levels, a = int(piece[a]), held(data[at[a] : at[a + 1]].tobytes()), [], a + 1
                levels.append(data[at[a] : at[b]].copy())
        if tokens is not None:
            yield scored(now, *tokens, np.concatenate(levels))

    rows = states.select("piece", F.lit(-1).cast("long").alias("segment"), "blob").union(levels_of(states, model))
    return rows.repartition("piece").sortWithinPartitions("piece", "segment").mapInArrow(finish, "row long, score double")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", weight: float = 0.6, learns: Column | None = None) -> DataFrame:
    """For each row: key, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10 probabilities of the text).

    ``score`` mixes the relative frequency of a token after the one before it (``weight``) with its add-one frequency; all
    counts in it come from the filter: pieces of about 4 MB of text are kept as word numbers and hashes, their distinct n-grams
    meet the segments of the filter in Spark, and the levels come back to the piece. ``base_score`` needs the exact count of every token. Frequent tokens, which make up most
    of all text, are looked up in place; the others leave as (row, token, times) and meet the table of counts in
    one join, where no token is common. The rows are numbered once, in a table in the shared folder, so rows repeated
    with their key keep apart and each has its result. A null or empty text is one end token. An empty table gives an empty table.

    A model without filter gets it on the way, from the rows of ``docs`` for which ``learns`` holds (see :func:`learn_and_score`).
    """
    if (model.filter is None) != (learns is not None):
        raise ValueError("learns goes with a model without filter")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.frequent)
    total = model.tokens + model.types + 1
    columns = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "times": pa.int64()}
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("token", T.StringType()),
            *[T.StructField(n, T.LongType() if k == pa.int64() else T.DoubleType()) for n, k in columns.items()],
            T.StructField("blob", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        frequent = shared.value
        names, exact = pa.array(frequent["token"], pa.string()), frequent["c"].to_numpy(np.int64)
        row = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, 1, 4_000_000):
            t = tokens_of(batch.column(1))
            n = len(t.counts)
            distinct = pa.concat_arrays([t.words, pa.array([""], pa.string())])
            known = pc.fill_null(pc.index_in(distinct, names), -1).to_numpy()
            count = np.where(known >= 0, exact[known] if len(exact) else 0, 0)
            here = known[t.codes] >= 0
            base = np.bincount(t.doc, np.log10(count[t.codes] + 1.0), n)
            n_known = np.bincount(t.doc, here, n).astype(np.int64)
            rows = row + np.arange(n)
            row += n
            result = {"n_tokens": t.counts, "n_known": n_known, "base": base}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows), pa.nulls(n, pa.string())]
                + [pa.array(result[c], k) if c in result else pa.nulls(n, k) for c, k in columns.items()]
                + [pa.array([hold(t, batch.column(2).to_numpy(zero_copy_only=False))] + [None] * (n - 1), pa.binary())],
                names=schema.names,
            )
            rest = t.doc[~here] * len(t.hashes) + t.codes[~here]
            rest, times = np.unique(rest, return_counts=True)
            words = distinct.take(pa.array(rest % len(t.hashes)))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rest), batch.column(0).type), pa.array(rows[rest // len(t.hashes)]), words]
                + [pa.array(times, k) if c == "times" else pa.nulls(len(rest), k) for c, k in columns.items()]
                + [pa.nulls(len(rest), pa.binary())],
                names=schema.names,
            )

    learns = F.lit(False) if learns is None else F.coalesce(learns, F.lit(False))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), learns.alias("learns"))
    scored = written(map_texts(rows, run, schema), "lm-scored", "zstd")
    rare = scored.filter("token IS NOT NULL").select("row", "token", "times").join(model.counts, "token")
    rare = rare.groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more")
    )
    texts = scored.filter("token IS NULL").drop("token", "times", "blob")
    states = scored.filter("blob IS NOT NULL").select(F.col("row").alias("piece"), "blob")
    texts = texts.join(filter_scores(states, model, weight), "row")
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(total)))
    return texts.join(rare, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        base.alias("base_score"),
        "score",
    )


def learn_and_score(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", weight: float = 0.6, **options) -> tuple[DataFrame, Model]:
    """:func:`score` of all rows by a model of those for which ``learns`` holds, and the model.

    Each piece of text goes to the filter's segments once, to be learnt from and to be scored.
    """
    model = train(docs.filter(learns), text, build=False, **options)
    return score(docs, model, key, text, weight, learns), model


@query("op6_lm_score")
def op6_lm_score(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    found, model = learn_and_score(docs, remainder("doc_id", 7) != 2)
    return found.select(
        "doc_id",
        (remainder("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
