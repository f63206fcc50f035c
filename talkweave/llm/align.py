"""Token groups of two vocabularies over the same bytes, and the corpus-wide links between their ids.

A byte range of a text gives a :class:`Fragment`: the tokens before its first common end, the groups between, the tokens
after its last. Fragments of neighbouring ranges join to the fragment of both, in any bracketing, so a very long text
is cut into ranges that separate tasks read and a tree of joins puts together.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces, written
from .registry import query
from .tokens import byte_encoder, clean, from_bytes, gather, piece_encoder, piece_table, safe_cuts, stretches_of, text_bytes, totals

#: a pair of ids as one number
SHIFT = np.int64(32)


@dataclass
class Side:
    """Tokens of one vocabulary in their order: ids, and the bytes before and after each."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __getitem__(self, part) -> Side:
        return Side(self.ids[part], self.start[part], self.end[part])

    def __add__(self, other: Side) -> Side:
        return Side(*(np.concatenate([x, y]) for x, y in zip((self.ids, self.start, self.end), (other.ids, other.start, other.end))))


NO_TOKENS = Side(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))


def linked(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The places of all pairs of tokens whose byte ranges overlap."""
    first = np.searchsorted(b.end, a.start, "right")
    sizes = np.searchsorted(b.start, a.end, "left") - first
    return np.repeat(np.arange(len(a.ids)), sizes), gather(first, sizes)


def pair_keys(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (a.ids[i].astype(np.int64) << SHIFT) | b.ids[j].astype(np.int64)


class Script:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: numbers with the sign after them, taken from one table."""

    SIGNS = (",", "|", ";", "")

    def __init__(self, most: int):
        self.most = most
        self.table = pa.array([f"{i}{s}" for s in self.SIGNS for i in range(most)])

    def write(self, a: Side, b: Side, common: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all groups that end at ``common``, and where the text of each document begins and ends.

        ``doc_ends`` are the last byte places of the documents; a document ends where a group does.
        """
        ga, gb = np.searchsorted(common, a.end), np.searchsorted(common, b.end)
        at_a = np.arange(len(ga)) + np.searchsorted(gb, ga, "left")
        at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")
        total = len(ga) + len(gb)
        ids, group, side = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int8)
        ids[at_a], ids[at_b] = a.ids, b.ids
        group[at_a], group[at_b] = ga, gb
        side[at_a], side[at_b] = 0, 1
        sign = np.full(total, 3)
        sign[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        stops = np.searchsorted(group, np.searchsorted(common, doc_ends, "right"))
        sign[stops[stops > 0] - 1] = 3
        words = self.table.take(pa.array(sign * self.most + ids))
        data, at = text_bytes(words)
        return data, at[stops]


@dataclass
class Fragment:
    """What a byte range says: tokens that end in it and are still open on the left, closed groups, tokens open on the right.

    ``closed`` is false if no token of both vocabularies ends at the same byte; then all tokens are in ``left``. ``pairs`` and ``times`` are
    the linked ids of closed groups. ``fits``: the tokens spell the text.
    """

    fits: bool
    closed: bool
    left: tuple[Side, Side]
    groups: int
    text: bytes
    pairs: np.ndarray
    times: np.ndarray
    right: tuple[Side, Side]


def hold(x: Fragment) -> bytes:
    """``x`` as bytes for a table."""
    arrays = [[(s.ids, s.start, s.end) for s in sides] for sides in (x.left, x.right)]
    return squeezed(x.fits, x.closed, x.groups, x.text, x.pairs, x.times, *arrays)


def held(blob: bytes) -> Fragment:
    fits, closed, groups, text, pairs, times, left, right = unsqueezed(blob)
    left, right = (tuple(Side(*s) for s in sides) for sides in (left, right))
    return Fragment(fits, closed, left, groups, text, pairs, times, right)


def counted(pairs: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if times is None:
        return np.unique(pairs, return_counts=True)
    distinct, owner = np.unique(pairs, return_inverse=True)
    return distinct, np.bincount(owner, times, len(distinct)).astype(np.int64)


def fragment(a: Side, b: Side, fits: bool, script: Script) -> Fragment:
    """The fragment of the tokens that end in one byte range."""
    none = (NO_TOKENS, NO_TOKENS)
    common = np.intersect1d(a.end, b.end, assume_unique=True)
    if not len(common):
        return Fragment(fits, False, (a, b), 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64), none)
    parts = [[], [], []]
    for side in (a, b):
        low, high = np.searchsorted(side.end, [common[0], common[-1]], "right")
        for part, cut in zip(parts, (slice(0, low), slice(low, high), slice(high, None))):
            part.append(side[cut])
    inner = parts[1]
    data, _ = script.write(*inner, common[1:], common[-1:])
    pairs, times = counted(pair_keys(*inner, *linked(*inner)))
    return Fragment(fits, True, tuple(parts[0]), len(common) - 1, data.tobytes(), pairs, times, tuple(parts[2]))


def join(x: Fragment, y: Fragment, script: Script) -> Fragment:
    """The fragment of two neighbouring ranges; what is open between them closes to one group if ``y`` has a common end."""
    fits = x.fits and y.fits
    glue = lambda p, q: (p[0] + q[0], p[1] + q[1])
    if not x.closed:
        return Fragment(fits, y.closed, glue(x.left, y.left), y.groups, y.text, y.pairs, y.times, y.right)
    middle = glue(x.right, y.left)
    if not y.closed:
        return Fragment(fits, True, x.left, x.groups, x.text, x.pairs, x.times, middle)
    shown, pairs = group_of(middle, script)
    text = b";".join(t for t in (x.text, shown, y.text) if t)
    pairs, times = counted(
        np.concatenate([x.pairs, pairs, y.pairs]), np.concatenate([x.times, np.ones(len(pairs), np.int64), y.times])
    )
    return Fragment(fits, True, x.left, x.groups + 1 + y.groups, text, pairs, times, y.right)


def group_of(sides: tuple[Side, Side], script: Script) -> tuple[bytes, np.ndarray]:
    """The text of one group, and its linked ids."""
    end = sides[0].end[-1:]
    return script.write(*sides, end, end)[0].tobytes(), pair_keys(*sides, *linked(*sides))


def whole(x: Fragment, script: Script) -> Fragment:
    """The fragment of a whole text: what is open on its left is its first group. One that does not fit is empty."""
    none = np.zeros(0, np.int64)
    if not (x.fits and x.closed):
        return Fragment(False, True, (NO_TOKENS, NO_TOKENS), 0, b"", none, none, (NO_TOKENS, NO_TOKENS))
    start = Fragment(True, True, (NO_TOKENS, NO_TOKENS), 0, b"", none, none, (NO_TOKENS, NO_TOKENS))
    return join(start, x, script)


class Reader:
    """Both vocabularies in a worker."""

    def __init__(self, byte_path: str, piece_path: str):
        self.encoders = []
        encoder, entries = byte_encoder(byte_path, plain=True)
        self.sides = [(encoder, entries), (piece_encoder(piece_path), piece_table(piece_path))]
        self.tables = [(pa.array(e, pa.binary()), np.array([len(b) for b in e], np.int64)) for _, e in self.sides]
        self.script = Script(max(len(e) for _, e in self.sides))

    def read(self, texts: pa.Array) -> tuple[list[Side], list[np.ndarray], np.ndarray]:
        """Tokens of ``texts`` (a blank before each), places counted through all of them with one byte between texts;
        how many each text has on either side; and which texts the tokens of both sides spell.

        Texts that do not fit have no tokens.
        """
        data, offsets = text_bytes(texts)
        counts, coded = stretches_of(texts)
        fits, found = np.ones(len(texts), bool), []
        for (encoder, _), (entries, sizes) in zip(self.sides, self.tables):
            n, ids = encoder.ids(coded)
            own = totals(counts, n)
            length = totals(own, sizes[ids])
            spelt, at = text_bytes(entries.take(pa.array(ids)))
            same = length == np.diff(offsets)
            if same.all():
                wrong = np.flatnonzero(spelt != data)
                same[np.searchsorted(offsets, wrong, "right") - 1] = False
            else:
                ends = np.cumsum(length)
                for i in np.flatnonzero(same):
                    same[i] = np.array_equal(spelt[ends[i] - length[i] : ends[i]], data[offsets[i] : offsets[i + 1]])
            fits &= same
            found.append((own, ids, sizes[ids]))
        sides, numbers = [], []
        first = offsets[:-1] + np.arange(len(texts))
        for own, ids, size in found:
            stays = np.repeat(fits, own)
            own, ids, size = np.where(fits, own, 0), ids[stays], size[stays]
            ends = np.cumsum(size)
            before = np.repeat(first - np.concatenate([[0], ends])[np.cumsum(own) - own], own)
            sides.append(Side(ids, before + ends - size, before + ends))
            numbers.append(own)
        return sides, numbers, fits


def squeezed(*parts) -> bytes:
    raw = pickle.dumps(parts, 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueezed(blob: bytes) -> tuple:
    return pickle.loads(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True))


def small(x: np.ndarray) -> np.ndarray:
    """As the smallest unsigned numbers that hold ``x``."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def held_links(doc: np.ndarray, pairs: np.ndarray, docs: int) -> bytes:
    """The linked ids of each document: distinct pairs, and per document their numbers and how often each occurs."""
    distinct, code = np.unique(pairs, return_inverse=True)
    both, times = np.unique(doc * len(distinct) + code, return_counts=True)
    width = max(1, len(distinct))
    per_doc = np.bincount(both // width, minlength=docs)
    return squeezed(distinct, small(per_doc), small(both % width), small(times))


def row_schema(docs: DataFrame, key: str) -> T.StructType:
    longs = [T.StructField(c, T.LongType()) for c in ("row", "n_a", "n_b", "n_groups", "n_links")]
    return T.StructType([T.StructField("key", docs.schema[key].dataType), *longs, T.StructField("groups_sha256", T.StringType()), T.StructField("blob", T.BinaryType())])


def short_texts(rows: DataFrame, byte_path: str, piece_path: str, schema: T.StructType) -> DataFrame:
    """One row per text of ``rows`` (key, text), whole texts many at a time; the first row of a slice holds its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        reader = Reader(byte_path, piece_path)
        row = TaskContext.get().partitionId() << 34
        for batch in pieces(batches, 1, 2_000_000):
            texts = spaced(batch.column(1))
            (a, b), numbers, fits = reader.read(texts)
            n, sizes = len(texts), np.diff(text_bytes(texts)[1])
            common = np.intersect1d(a.end, b.end, assume_unique=True)
            ends = np.cumsum(sizes + 1) - 1
            per_doc = np.diff(np.searchsorted(common, np.append(-1, ends), "right"))
            data, at = reader.script.write(a, b, common, np.append(-1, ends))
            shas = [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1], at[1:])]
            i, j = linked(a, b)
            doc = np.repeat(np.arange(n), numbers[0])[i]
            blob = held_links(doc, pair_keys(a, b, i, j), n)
            longs = [row + np.arange(n), *numbers, per_doc, np.bincount(doc, minlength=n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in longs], pa.array(shas, pa.string()), pa.array([blob] + [None] * (n - 1), pa.binary())],
                names=schema.names,
            )
            row += n

    return map_texts(rows, run, schema)


def spaced(texts: pa.Array) -> pa.Array:
    """A blank before each text; null and empty texts stay empty."""
    texts = clean(texts)
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))


def ranges(text: bytes, chunk: int) -> list[tuple[int, int, int, int]]:
    """Byte ranges of a text: (first byte, last byte, and the safe cuts around them).

    Ranges end at multiples of ``chunk``, wherever that is in a word; a multiple inside a stretch longer than
    ``chunk`` ends none.
    """
    data = np.frombuffer(text, np.uint8)
    cuts = np.append(safe_cuts(data, np.array([0, len(data)])), len(data))
    marks = np.arange(chunk, len(data), chunk)
    left = cuts[np.searchsorted(cuts, marks, "right") - 1]
    right = cuts[np.searchsorted(cuts, marks, "left")]
    stays = right - left <= chunk
    marks, left, right = marks[stays], left[stays], right[stays]
    return list(zip(np.append(0, marks).tolist(), np.append(marks, len(data)).tolist(), np.append(0, left).tolist(), np.append(right, len(data)).tolist()))


def long_texts(rows: DataFrame, byte_path: str, piece_path: str, schema: T.StructType, chunk: int, fan: int) -> DataFrame:
    """As :func:`short_texts` for long ones: their byte ranges become fragments in tasks of their own, which a tree of joins puts together."""
    key = schema.fields[0]
    long = lambda *names: [T.StructField(c, T.LongType()) for c in names]
    cut_schema = T.StructType([key, *long("row", "part", "parts", "low", "high", "first"), T.StructField("piece", T.StringType())])
    part_schema = T.StructType([key, *long("row", "part", "parts", "n_a", "n_b"), T.StructField("blob", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = (TaskContext.get().partitionId() << 34) + (1 << 33)
        for batch in pieces(batches, 1, 1):
            text = spaced(batch.column(1))[0].as_buffer().to_pybytes()
            found = ranges(text, chunk)
            for part, (low, high, first, last) in enumerate(found):
                values = [row, part, len(found), low, high, first]
                columns = [batch.column(0), *[pa.array([v], pa.int64()) for v in values], pa.array([text[first:last].decode()])]
                yield pa.RecordBatch.from_arrays(columns, names=cut_schema.names)
            row += 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(byte_path, piece_path)
        for batch in pieces(batches, 7, 1):
            (a, b), _, fits = reader.read(batch.column(7))
            low, high, first = (batch.column(i)[0].as_py() for i in (4, 5, 6))
            sides = []
            for side in (a, b):
                mine = (side.end + first > low) & (side.end + first <= high)
                sides.append(Side(side.ids[mine], side.start[mine] + first, side.end[mine] + first))
            made = fragment(*sides, bool(fits.all()), reader.script)
            numbers = [pa.array([len(s.ids)], pa.int64()) for s in sides]
            columns = [*[batch.column(i) for i in range(4)], *numbers, pa.array([hold(made)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=part_schema.names)

    def fold(final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            script, now, sofar = Script(most), None, None

            def done() -> pa.RecordBatch:
                key_of, parts, n_a, n_b, made = sofar
                if not final:
                    values = [now[0], now[1], -(-parts // fan), n_a, n_b]
                    columns = [key_of, *[pa.array([v], pa.int64()) for v in values], pa.array([hold(made)], pa.binary())]
                    return pa.RecordBatch.from_arrays(columns, names=part_schema.names)
                full = whole(made, script)
                n_a, n_b = (n_a, n_b) if full.fits else (0, 0)
                values = [now[0], n_a, n_b, full.groups, int(full.times.sum())]
                sha = hashlib.sha256(full.text).hexdigest() if full.fits else ""
                blob = held_links(np.zeros(int(full.times.sum()), np.int64), np.repeat(full.pairs, full.times), 1)
                columns = [key_of, *[pa.array([v], pa.int64()) for v in values], pa.array([sha]), pa.array([blob], pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for batch in batches:
                for i in range(batch.num_rows):
                    row, part, parts, n_a, n_b = (batch.column(c)[i].as_py() for c in range(1, 6))
                    made = held(batch.column(6)[i].as_py())
                    if now == (row, part // fan):
                        sofar = (sofar[0], parts, sofar[2] + n_a, sofar[3] + n_b, join(sofar[4], made, script))
                        continue
                    if now is not None:
                        yield done()
                    now, sofar = (row, part // fan), (batch.column(0).slice(i, 1), parts, n_a, n_b, made)
            if now is not None:
                yield done()

        return run

    most = max(len(byte_encoder(byte_path)[1]), len(piece_table(piece_path)))
    cuts = map_texts(rows, cut, cut_schema).repartition("row", "part")
    parts = written(cuts.mapInArrow(read, part_schema), "align-parts")
    level = parts.agg(F.max("parts")).first()[0] or 1
    while level > fan:
        group = [F.col("row"), F.floor(F.col("part") / fan)]
        parts = parts.repartition(*group).sortWithinPartitions("row", "part").mapInArrow(fold(False), part_schema)
        level = -(-level // fan)
    return parts.repartition("row").sortWithinPartitions("row", "part").mapInArrow(fold(True), schema)


def pair_counts(states: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each pair of ids is linked, and if no pair of its first id is in more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                distinct, _, codes, _ = unsqueezed(blob.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(np.bincount(codes, minlength=len(distinct)))], names=["pair", "n"])

    found = states.filter("blob IS NOT NULL").select("blob").mapInArrow(run, "pair long, n long")
    counts = found.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", int(SHIFT)))
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_sums(states: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """(row, n_best, count_sum). The ``frequent`` most common pairs at most are with every worker; the others meet the table of counts in a join."""
    level = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"))
    steps = steps.orderBy(F.desc("level")).toPandas()  # at most a few hundred rows: eight levels to a power of two
    fits = steps[steps["rows"].cumsum() <= frequent]
    least = int(fits["least"].min()) if len(fits) else 2**62
    top = counts.filter(F.col("n") >= least).orderBy("pair").toPandas()
    known = tuple(top[c].to_numpy(k) for c, k in (("pair", np.int64), ("n", np.int64), ("best", bool)))
    shared = states.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            for row, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                distinct, per_doc, codes, times = unsqueezed(blob.as_py())
                docs = len(per_doc)
                doc, times = np.repeat(np.arange(docs), per_doc), times.astype(np.int64)
                at = np.minimum(np.searchsorted(pairs, distinct), max(len(pairs) - 1, 0))
                here = pairs[at] == distinct if len(pairs) else np.zeros(len(distinct), bool)
                count, top = (np.where(here, x[at] if len(pairs) else 0, 0).astype(np.int64) for x in (n, best))
                sums = [np.zeros(docs, np.int64), np.zeros(docs, np.int64)]
                for out, value in zip(sums, (top, count)):
                    np.add.at(out, doc, times * value[codes])
                rest = ~here[codes]
                k = int(rest.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.concatenate([np.arange(docs), doc[rest]])),
                        pa.concat_arrays([pa.nulls(docs, pa.int64()), pa.array(distinct[codes[rest]])]),
                        *[pa.array(np.concatenate([x, y])) for x, y in zip((*sums, np.zeros(docs, np.int64)), (np.zeros(k, np.int64), np.zeros(k, np.int64), times[rest]))],
                    ],
                    names=["row", "pair", "n_best", "count_sum", "times"],
                )

    found = states.filter("blob IS NOT NULL").select("row", "blob").mapInArrow(run, "row long, pair long, n_best long, count_sum long, times long")
    found = written(found, "align-sums")
    here = found.filter("pair IS NULL").select("row", "n_best", "count_sum")
    rare = found.filter("pair IS NOT NULL").join(counts, "pair")
    rare = rare.select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    return here.union(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = 1 << 16,
    fan: int = 8,
    frequent: int = 200_000,
) -> DataFrame:
    """For each row: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    A is the byte-level vocabulary on a blank and the text, B the other on the text, to which it adds the blank. Byte places where tokens of
    both end cut them into groups; tokens that share bytes are linked. A pair of ids counts once for each row that
    holds it linked. Texts up to ``chunk`` bytes are read whole; longer ones by byte ranges, ``fan`` fragments joined at a time.
    What a text links is written to the shared folder once, as numbers of distinct pairs; the counts come from there, and go back
    to it from the ``frequent`` commonest pairs in place or from a join.

    Texts that are null, empty or not spelt by both vocabularies have no tokens: zeros and an empty digest. Repeated rows and
    rows without key are documents of their own. Other columns of ``docs`` are not read. An empty table gives an empty table.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = row_schema(docs, key)
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    short = short_texts(rows.filter(~is_long), byte_path, piece_path, schema)
    states = written(short.union(long_texts(rows.filter(is_long), byte_path, piece_path, schema, chunk, fan)), "align-texts")
    counts = written(pair_counts(states), "align-pairs")
    sums = link_sums(states, counts, frequent)
    return states.join(sums, "row").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query("op12_alignment")
def op12_alignment(spark, folder):
    from public_tokenizers import path

    return align(load(spark, folder, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
