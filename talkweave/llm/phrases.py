"""Phrases that keep together: counts by fingerprint, texts only of what is frequent."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import load, map_texts, written
from .registry import query
from .tokens import clean, from_bytes, text_bytes

#: what ends a piece of text, and what stands between its words
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
#: the base of the fingerprints, and its inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
UNKNOWN = "und"


def spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def value_hash(values: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct strings: a polynomial in their bytes."""
    data, offsets = text_bytes(values)
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers(BASE, int(place.max(initial=0)) + 1)[place]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    return spread(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64))


@dataclass
class Words:
    """The words of many texts: numbers of distinct ones, the number of the piece each stands in, and its language."""

    langs: pa.Array
    names: pa.Array
    code: np.ndarray
    piece: np.ndarray
    lang: np.ndarray

    def hold(self) -> bytes:
        first = np.flatnonzero(np.diff(self.piece, prepend=-1))
        data, offsets = text_bytes(self.names)
        small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
        arrays = [data.tobytes(), small(np.diff(offsets)), small(self.code), small(np.diff(np.append(first, len(self.piece)))), small(self.lang[first])]
        raw = pickle.dumps((self.langs.to_pylist(), *arrays), 5)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def held(blob: bytes) -> Words:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
    langs, data, sizes, code, pieces, lang = pickle.loads(raw)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    names = from_bytes(np.frombuffer(data, np.uint8), offsets, pa.string())
    return Words(pa.array(langs, pa.string()), names, code.astype(np.int64), np.repeat(np.arange(len(pieces)), pieces), np.repeat(lang.astype(np.int64), pieces))


def words_of(texts: pa.Array, langs: pa.Array) -> Words:
    """The words of ``texts`` with A-Z in lower case."""
    data, offsets = text_bytes(pc.ascii_lower(clean(texts)))
    kind = np.zeros(256, np.int8)
    kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
    kinds = kind[data]
    inside = kinds == 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    opens[starts] = inside[starts]
    first = np.flatnonzero(opens)
    kept = np.concatenate([[0], np.cumsum(inside, dtype=np.int32)])
    coded = from_bytes(data[inside], np.append(kept[first], kept[-1]), pa.string()).dictionary_encode()
    doc = np.searchsorted(offsets, first, "right") - 1
    breaks = np.cumsum(kinds == 2, dtype=np.int32)[first] if len(first) else np.zeros(0, np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (np.diff(doc) > 0) | (np.diff(breaks) > 0)
    spoken = pc.fill_null(langs.cast(pa.string()), UNKNOWN).dictionary_encode()
    return Words(spoken.dictionary, coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.cumsum(new) - 1, spoken.indices.to_numpy().astype(np.int64)[doc])


@dataclass
class Grams:
    """The distinct n-grams of some words, by fingerprint, in the order of their segments.

    ``where``: for each, the first word and the length of one occurrence. ``owner``: of each occurrence, the number of its n-gram.
    """

    segment: np.ndarray
    short: np.ndarray
    times: np.ndarray
    first: np.ndarray
    size: np.ndarray
    owner: np.ndarray
    at: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.diff(self.segment, prepend=-1))
        return starts, np.append(starts[1:], len(self.segment))


def grams_of(w: Words, longest: int, segments: int) -> Grams:
    """Fingerprints of all n-grams up to ``longest`` words, from sums of word hashes times powers of the base.

    With P[i] the sum of hash(j) * base**j over j < i, an n-gram at i has (P[i + n] - P[i]) / base**i: the same number wherever it
    stands. Language and length are mixed in. A fingerprint is 32 bits inside one of ``segments``.
    """
    n = len(w.code)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value_hash(w.names)[w.code] * powers(BASE, n))])
    shift, spoken = powers(INVERSE, n), value_hash(w.langs)
    prints, at, size = [], [], []
    for k in range(1, longest + 1):
        here = np.flatnonzero(w.piece[: n - k + 1] == w.piece[k - 1 :]) if n >= k else np.zeros(0, np.int64)
        rolled = (sums[here + k] - sums[here]) * shift[here]
        prints.append(spread(rolled + spoken[w.lang[here]] * np.uint64(2 * k + 1)))
        at.append(here.astype(np.int32))
        size.append(np.full(len(here), k, np.int8))
    prints, at, size = map(np.concatenate, (prints, at, size))
    key = ((prints >> np.uint64(32)) % np.uint64(segments) << np.uint64(32)) | (prints & np.uint64(0xFFFFFFFF))
    del prints
    order = np.argsort(key, kind="stable").astype(np.int32)
    ranked = key[order]
    del key
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    owner = np.empty(len(order), np.int32)
    owner[order] = np.cumsum(new) - 1
    lead = order[first]
    times = np.diff(np.append(first, len(order)))
    return Grams((ranked[first] >> np.uint64(32)).astype(np.int64), ranked[first].astype(np.uint32), times, at[lead], size[lead], owner, at)


def pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Keys in their order, then which of them occur more than once, then how often these do."""
    more = times > 1
    return b"".join([np.uint32(len(keys)).tobytes(), keys.astype("<u4").tobytes(), np.packbits(more).tobytes(), np.minimum(times[more], 2**32 - 1).astype("<u4").tobytes()])


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    more = np.unpackbits(np.frombuffer(blob, np.uint8, -(-n // 8), 4 + 4 * n), count=n).astype(bool)
    times = np.ones(n, np.int64)
    times[more] = np.frombuffer(blob, "<u4", int(more.sum()), 4 + 4 * n + -(-n // 8))
    return np.frombuffer(blob, "<u4", n, 4), times


def gathered(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """``batches`` in slices of about ``most`` bytes of text, one row at least, across their borders."""
    waiting, size = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for stop in range(1, batch.num_rows + 1):
            size += int(sizes[stop - 1])
            if size >= most:
                waiting.append(batch.slice(start, stop - start))
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, size, start = [], 0, stop
        if start < batch.num_rows:
            waiting.append(batch.slice(start))
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def cut_words(docs: DataFrame, text: str, lang: str, slice_bytes: int) -> DataFrame:
    """(slice, blob, langs, sizes): the words of about ``slice_bytes`` of text, and how many each language has among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in gathered(batches, 0, slice_bytes):
            w = words_of(batch.column(0), batch.column(1))
            sizes = np.bincount(w.lang, minlength=len(w.langs))
            columns = [pa.array([number]), pa.array([w.hold()], pa.binary()), pa.array([w.langs.to_pylist()]), pa.array([sizes.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "blob", "langs", "sizes"])
            number += 1
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    return map_texts(rows, run, "slice long, blob binary, langs array<string>, sizes array<long>")


def frequent_marks(slices: DataFrame, longest: int, least: int, segments: int) -> DataFrame:
    """(slice, segment, marks): which n-grams of a slice, in the order of the segment, have fingerprints counted ``least`` times.

    What points to an occurrence is the slice and the place in that order; nothing else travels with a fingerprint.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                g = grams_of(held(blob.as_py()), longest, segments)
                starts, ends = g.parts()
                blobs = [pack(g.short[a:b], g.times[a:b]) for a, b in zip(starts, ends)]
                columns = [pa.array(g.segment[starts]), pa.array(np.full(len(starts), number, np.int64)), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "slice", "blob"])

    def marks(segment: int, numbers: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        keys, times = zip(*map(unpack, blobs))
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        total = np.add.reduceat(np.concatenate(times)[order], first)
        often = np.empty(len(every), bool)
        often[order] = np.repeat(total >= least, np.diff(np.append(first, len(every))))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        out = [np.packbits(x).tobytes() for x in np.split(often, cuts)]
        columns = [pa.array(numbers, pa.int64()), pa.array(np.full(len(numbers), segment, np.int64)), pa.array(out, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "segment", "marks"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, numbers, blobs = None, [], []
        for batch in batches:
            for segment, number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if segment != now and now is not None:
                    yield marks(now, numbers, blobs)
                    numbers, blobs = [], []
                now = segment
                numbers.append(number)
                blobs.append(blob)
        if now is not None:
            yield marks(now, numbers, blobs)

    asked = slices.select("slice", "blob").mapInArrow(ask, "segment long, slice long, blob binary")
    return asked.repartition("segment").sortWithinPartitions("segment").mapInArrow(count, "slice long, segment long, marks binary")


def same_words(w: Words, at: np.ndarray, lead: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the words and the language at ``at`` are those at ``lead``, for ``size`` words."""
    same = w.lang[at] == w.lang[lead]
    last = len(w.code) - 1
    for k in range(int(size.max(initial=0))):
        inside = k < size
        same &= ~inside | (w.code[np.minimum(at + k, last)] == w.code[np.minimum(lead + k, last)])
    return same


def phrase_rows(w: Words, at: np.ndarray, size: np.ndarray, times: np.ndarray) -> list[pa.Array]:
    """(lang, phrase, words, times) of the n-grams of ``size`` words at ``at``."""
    texts = np.empty(0)
    out = []
    for k in np.unique(size):
        mine = size == k
        texts = pc.binary_join_element_wise(*[w.names.take(pa.array(w.code[at[mine] + i])) for i in range(k)], " ")
        out.append([w.langs.take(pa.array(w.lang[at[mine]])), texts, pa.array(size[mine].astype(np.int32)), pa.array(times[mine].astype(np.int64))])
    return [pa.concat_arrays(x) for x in zip(*out)]


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, slice_bytes: int = 4_000_000, segment_grams: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all n-grams up to ``longest`` words that occur ``least`` times, and (lang, n) of the languages.

    Slices of text are cut into words once and kept in the shared folder. Their n-grams' fingerprints, each once per slice with
    its number, go to segments of about ``segment_grams`` occurrences; a bit per fingerprint comes back to the slice. There the occurrences
    behind a frequent fingerprint are compared word by word, and only what they say travels as text, to be counted
    exactly: fingerprints that collide are told apart, and no count is of a fingerprint.
    """
    slices = written(cut_words(docs, text, lang, slice_bytes), "phrase-words")
    spoken = slices.select(F.inline(F.arrays_zip(F.col("langs").alias("lang"), F.col("sizes").alias("n"))))
    spoken = written(spoken.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-langs")
    words = spoken.agg(F.sum("n")).first()[0] or 0
    segments = max(1, -(-longest * words // segment_grams))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blob, marks = None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            w = held(blob)
            g = grams_of(w, longest, segments)
            starts, ends = g.parts()
            often = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=b - a) for m, a, b in zip(marks, starts, ends)] or [np.zeros(0, np.uint8)])
            mine = np.flatnonzero(often[g.owner])
            lead, size = g.first[g.owner[mine]], g.size[g.owner[mine]].astype(np.int64)
            sizes = np.repeat(np.arange(1, longest + 1), [int(np.sum(w.piece[: len(w.code) - k + 1] == w.piece[k - 1 :])) if len(w.code) >= k else 0 for k in range(1, longest + 1)])[mine]
            same = same_words(w, g.at[mine], lead, size) & (sizes == size)
            times = np.bincount(g.owner[mine[same]], minlength=len(g.times))
            real = np.flatnonzero(times)
            rows = [(g.first[real], g.size[real].astype(np.int64), times[real])]
            rows.append((g.at[mine[~same]], sizes[~same], np.ones(int((~same).sum()), np.int64)))
            for at, size, n in rows:
                if len(at):
                    yield pa.RecordBatch.from_arrays(phrase_rows(w, at, size, n), names=["lang", "phrase", "words", "f"])
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for number, segment, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if segment < 0:
                    if now is not None:
                        yield from done()
                    now, blob, marks = number, value, []
                else:
                    marks.append(value)
        if now is not None:
            yield from done()

    states = slices.select("slice", F.lit(-1).cast("long").alias("segment"), F.col("blob").alias("marks"))
    met = states.union(frequent_marks(slices, longest, least, segments)).repartition("slice").sortWithinPartitions("slice", "segment")
    found = met.mapInArrow(finish, "lang string, phrase string, words int, f long")
    counts = found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return written(counts, "phrase-counts"), spoken


def part(phrase: Column, first: int, size: int) -> Column:
    """``size`` words of a phrase from word ``first`` (from 1)."""
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def exact(c: Column) -> Column:
    return c.cast(T.DecimalType(20, 0))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, top: int = 2000, covered: int = 80, buckets: int = 256, **options
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``longest`` words (see :func:`phrase_counts`); cutting one after its first k words gives the counts l and r of both
    parts and floor(2000000 * a / (l + r)); the lowest counts, then the smallest k. A candidate inside a longer one that has ``covered`` in
    a hundred of its occurrences goes. Counts and products are whole numbers of up to 38 digits. A language's best are first found in
    ``buckets`` by hash of the phrase, so no task ranks all candidates of a language.

    A null text is empty, a null language ``und``. Repeated rows count as often as they stand. Other columns of ``docs`` are not read. A table
    without candidates gives an empty table.
    """
    counts, spoken = phrase_counts(docs, text, lang, longest, least, **options)
    candidates = counts.filter("words > 1").withColumnRenamed("f", "a")
    sides = []
    for size in range(2, longest + 1):
        some = candidates.filter(F.col("words") == size)
        for k in range(1, size):
            sides.append(some.select("lang", "phrase", "a", F.lit(k).alias("k"), part(F.col("phrase"), 1, k).alias("left"), part(F.col("phrase"), k + 1, size - k).alias("right")))
    cuts = sides[0]
    for other in sides[1:]:
        cuts = cuts.union(other)
    known = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    cuts = cuts.join(known, ["lang", "left"])
    known = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(known, ["lang", "right"])
    product = exact(F.col("a")) * F.lit(2_000_000).cast(T.DecimalType(10, 0))
    cuts = cuts.withColumn("whole", product).withColumn("both", exact(F.col("l") + F.col("r")))
    cuts = cuts.withColumn("score", F.expr("whole div both"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")

    inner = []
    for size in range(3, longest + 1):
        some = candidates.filter(F.col("words") == size)
        for k in range(2, size):
            inner += [some.select("lang", part(F.col("phrase"), i, k).alias("phrase"), F.col("a").alias("longer")) for i in range(1, size - k + 2)]
    if inner:
        covers = inner[0]
        for other in inner[1:]:
            covers = covers.union(other)
        covers = covers.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        best = best.join(covers, ["lang", "phrase"], "left")
        swallowed = exact(F.col("longer")) * F.lit(100) >= exact(F.col("a")) * F.lit(covered)
        best = best.filter(~F.coalesce(swallowed, F.lit(False)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(buckets))
    ahead = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", bucket).orderBy(*order))).filter(F.col("rank") <= top)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(spoken, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    """The contract in DuckDB's SQL: all n-grams counted as texts."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    grams = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, {k} AS words FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w)"
        for k in range(1, 5)
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, array_to_string(s[1:{k}], ' ') AS lp, array_to_string(s[{k + 1}:], ' ') AS rp FROM c WHERE words > {k}" for k in range(1, 4)
    )
    inner = " UNION ALL ".join(
        f"SELECT lang, array_to_string(s[{i}:{i + k - 1}], ' ') AS phrase, a AS longer FROM c WHERE words = {m}"
        for m in (3, 4) for k in range(2, m) for i in range(1, m - k + 2)
    )
    return rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        f AS (SELECT lang, phrase, words, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS s FROM f WHERE words > 1),
        cuts AS ({cuts}),
        scored AS (SELECT x.lang, x.phrase, x.a, x.k, g.f AS l, h.f AS r, (2000000::HUGEINT * x.a // (g.f + h.f))::BIGINT AS score
                   FROM cuts x JOIN f g ON g.lang = x.lang AND g.phrase = x.lp JOIN f h ON h.lang = x.lang AND h.phrase = x.rp),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        cover AS (SELECT lang, phrase, max(longer) AS longer FROM ({inner}) GROUP BY ALL),
        kept AS (SELECT best.* FROM best LEFT JOIN cover ON cover.lang = best.lang AND cover.phrase = best.phrase
                 WHERE cover.longer IS NULL OR 100::HUGEINT * cover.longer < 80::HUGEINT * best.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""


@query("op13_phrases", _sql())
def op13_phrases(spark, folder):
    return collocations(load(spark, folder, "documents"))
