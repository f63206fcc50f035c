"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces, remainder, split_words, written
from .registry import query

#: first code point of each stretch and the script it belongs to; 0 is everything else
SCRIPTS = (
    (0x0, 0), (0x41, 1), (0x250, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x780, 0),
    (0x900, 7), (0x980, 8), (0xA00, 0), (0xB80, 9), (0xC00, 0), (0xE00, 10), (0xE80, 0), (0x10A0, 11), (0x1100, 12),
    (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 13), (0x3100, 0), (0x3400, 14), (0xA000, 0),
    (0xAC00, 12), (0xD7B0, 0), (0xF900, 14), (0xFB00, 0),
)
SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS], np.uint32)
SCRIPT_NUMBERS = np.array([n for _, n in SCRIPTS], np.int64)
N_SCRIPTS = int(SCRIPT_NUMBERS.max()) + 1

#: cells of each hashed count table
CELLS = 1 << 17


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@dataclass
class Grams:
    """Characters of distinct words as trigrams, by place; a word's places are ``starts[i]`` up to the next start."""

    starts: np.ndarray
    used: np.ndarray
    triple: np.ndarray
    pair: np.ndarray
    letters: np.ndarray
    script: np.ndarray


def grams_of(words: pa.Array, is_letter: np.ndarray) -> Grams:
    """Each place is a letter after its two forerunners, or the end of a run of letters. Everything but letters is a gap."""
    points = np.frombuffer(("\n".join(words.to_pylist()) + "\n").encode("utf-32-le"), np.uint32)
    breaks = np.flatnonzero(points == 10)
    starts = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else np.zeros(0, np.int64)
    letter = is_letter[points]
    c = np.where(letter, points, 0).astype(np.uint64)
    b = np.concatenate([[0], c[:-1]]).astype(np.uint64)
    a = np.where(b == 0, 0, np.concatenate([[0, 0], c[:-2]])[: len(c)]).astype(np.uint64)
    pair = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = (pair + c * np.uint64(0x165667B19E3779F9)) * np.uint64(0x9FB21C651E98DF25)
    pair = pair * np.uint64(0x9FB21C651E98DF25)
    shift = np.uint64(64 - CELLS.bit_length() + 1)
    letters = np.add.reduceat(letter, starts, dtype=np.int64) if len(starts) else starts
    first = np.full(len(starts), 0, np.uint32)
    where = np.flatnonzero(letter & (b == 0))
    owner = np.searchsorted(starts, where, "right") - 1
    first[owner[::-1]] = points[where[::-1]]
    script = SCRIPT_NUMBERS[np.searchsorted(SCRIPT_STARTS, first, "right") - 1]
    return Grams(starts, letter | (b > 0), (triple >> shift).astype(np.int64), (pair >> shift).astype(np.int64), letters, script)


@dataclass
class Model:
    """Per language the log-probability of a character after two others, and the scripts it was seen in."""

    langs: list[str]
    triples: np.ndarray
    pairs: np.ndarray
    candidates: np.ndarray

    def word_scores(self, grams: Grams, unlikely: float = -1e6) -> np.ndarray:
        """[words, languages]: log-probability of each word's letters; languages without the word's script are ruled out."""
        each = self.triples[grams.triple] - self.pairs[grams.pair]
        each[~grams.used] = 0
        out = np.add.reduceat(each, grams.starts, axis=0)
        ruled_out = (grams.letters > 0)[:, None] & ~self.candidates[grams.script]
        out[ruled_out] = unlikely
        return out


def train(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = 200) -> Model:
    """A model of all rows whose language and text are not null.

    Tasks count hashed trigrams of their rows per language; the sums are at most three small tables per language, whatever the
    corpus' size, and these go to the driver. No language at all gives a model that knows none. A table with more than ``most``
    languages is an error before anything is collected: every worker holds the model, 1 MB a language.
    """

    def flush(tables: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in tables.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells), pa.string()), pa.array(cells), pa.array(counts[cells])], names=["lang", "cell", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, tables = letter_table(), {}
        for batch in pieces(batches, 1):
            langs = batch.column(0)
            for name in langs.unique().to_pylist():
                texts = batch.column(1).filter(pc.equal(langs, name))
                _, words = split_words(pc.utf8_lower(texts))
                seen = pc.value_counts(words)
                if not len(seen):
                    continue
                times = seen.field("counts").to_numpy()
                grams = grams_of(seen.field("values"), is_letter)
                weight = np.repeat(times, np.diff(np.append(grams.starts, len(grams.used)))) * grams.used
                counts = tables.setdefault(name, np.zeros(2 * CELLS + N_SCRIPTS, np.int64))
                counts[:CELLS] += np.bincount(grams.triple, weight, CELLS).astype(np.int64)
                counts[CELLS : 2 * CELLS] += np.bincount(grams.pair, weight, CELLS).astype(np.int64)
                counts[2 * CELLS :] += np.bincount(grams.script, times * grams.letters, N_SCRIPTS).astype(np.int64)
            if len(tables) > 24:
                yield from flush(tables)
                tables = {}
        yield from flush(tables)

    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    known = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = map_texts(known, run, "lang string, cell long, n long")
    total = written(counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")), "language-counts")
    n_langs = total.select("lang").distinct().count()
    if n_langs > most:
        raise ValueError(f"{n_langs} languages to learn, {most} at most: raise `most` where workers can hold the model")
    total = total.toPandas()
    langs = sorted(total["lang"].unique())
    counts = np.zeros((len(langs), 2 * CELLS + N_SCRIPTS))
    counts[np.searchsorted(langs, total["lang"]) if langs else [], total["cell"].to_numpy(np.int64)] = total["n"]
    add, letters = 0.05, 100
    scripts = counts[:, 2 * CELLS :]
    seen = (scripts >= 0.01 * scripts.sum(axis=1, keepdims=True)) & (scripts > 0)
    candidates = seen.T | ~seen.any(axis=0)[:, None]
    triples = np.log(counts[:, :CELLS] + add).T.astype(np.float32)
    pairs = np.log(counts[:, CELLS : 2 * CELLS] + add * letters).T.astype(np.float32)
    return Model(langs, np.ascontiguousarray(triples), np.ascontiguousarray(pairs), candidates)


def viterbi(scores: np.ndarray, codes: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word: sum of word scores less ``penalty`` for each change, over all texts side by side."""
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    live_at = np.searchsorted(-counts[order], -np.arange(1, counts.max(initial=0) + 1), "right")
    first = starts[order]
    n = scores.shape[1]
    back = np.empty((len(codes), n), np.int8 if n < 128 else np.int16)
    best = np.zeros((len(counts), n), np.float64)
    own = np.arange(n, dtype=back.dtype)
    for step, live in enumerate(live_at):
        at = first[:live] + step
        state = best[:live]
        top = state.argmax(axis=1)
        change = state[np.arange(live), top] - penalty
        stay = state >= change[:, None]
        back[at] = np.where(stay, own, top[:, None])
        best[:live] = np.where(stay, state, change[:, None]) + scores[codes[at]]
    path = np.zeros(len(codes), np.int64)
    now = best.argmax(axis=1)
    for step in range(len(live_at) - 1, -1, -1):
        at = first[: live_at[step]] + step
        state = now[: live_at[step]]
        path[at] = state
        now[: live_at[step]] = back[at, state]
    return path


@dataclass
class Labels:
    """What the words of a batch of texts are: languages by number (the last is ``und``), scores, and the path of each word."""

    best: np.ndarray
    score: np.ndarray
    path: np.ndarray
    counts: np.ndarray
    doc: np.ndarray
    known: np.ndarray


def label_words(texts: pa.Array, model: Model, is_letter: np.ndarray, penalty: float) -> Labels:
    n = len(model.langs)
    counts, words = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    doc = np.repeat(np.arange(len(counts)), counts)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    share, path = np.zeros((len(counts), max(n, 1))), np.zeros(len(codes), np.int64)
    if len(codes) and n:
        grams = grams_of(coded.dictionary, is_letter)
        path = viterbi(model.word_scores(grams), codes, counts, penalty)
        share = np.bincount(doc * n + path, grams.letters[codes], len(counts) * n).reshape(-1, n)
    letters = share.sum(axis=1)
    best = np.where(letters > 0, share.argmax(axis=1), n)
    score = np.where(letters > 0, share.max(axis=1) / np.maximum(letters, 1), 0.0)
    return Labels(best, score, path, counts, doc, letters > 0)


def spans_of(found: Labels, names: pa.Array) -> pa.ListArray:
    """Stretches of one language: a new one starts with each text and each change. Texts without letters have none."""
    begins = np.ones(len(found.path), bool)
    begins[1:] = (found.path[1:] != found.path[:-1]) | (found.doc[1:] != found.doc[:-1])
    begins &= found.known[found.doc]
    at = np.flatnonzero(begins)
    stops = np.cumsum(found.counts)
    owner = found.doc[at]
    length = np.minimum(np.append(at[1:], len(found.path)), stops[owner]) - at
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(found.counts)))]).astype(np.int32)
    columns = [names.take(pa.array(found.path[at])), pa.array(at - (stops - found.counts)[owner]), pa.array(length)]
    fields = [pa.field("lang", pa.string()), pa.field("first", pa.int64()), pa.field("words", pa.int64())]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=fields))


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", penalty: float = 15.0) -> DataFrame:
    """For each row: key, ``lang``, ``score`` and ``spans`` (lang, first word, number of words).

    ``lang`` has the most letters in the spans of the text (of ties, the first by name); ``score`` is its share of the letters.
    A text that is null, empty or without letters is ``und`` with score 0 and no spans, and so is every text if the model
    knows no language. Each row is worked on where it is read, a long text as a whole; only the model travels. Repeated rows repeat their
    result; an empty table gives an empty table.
    """
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.LongType()), T.StructField("words", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("lang", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.ArrayType(span)),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, names = letter_table(), pa.array([*shared.value.langs, "und"], pa.string())
        for batch in pieces(batches, 1):
            found = label_words(batch.column(1), shared.value, is_letter, penalty)
            columns = [batch.column(0), names.take(pa.array(found.best)), pa.array(found.score), spans_of(found, names)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows, run, schema).select(F.col("key").alias(key), "lang", "score", "spans")


def keep_identified(docs: DataFrame, model: Model, text: str = "text", penalty: float = 15.0) -> DataFrame:
    """The rows of ``docs`` to which :func:`detect` gives a language, mixed texts too; rows stay where they are read.

    Null texts and texts without letters go. A model that knows no language rejects every row.
    """
    column = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letter_table()
        for batch in pieces(batches, column):
            found = label_words(batch.column(column), shared.value, is_letter, penalty)
            yield batch.filter(pa.array(found.known))

    # by number: a column's name may hold a dot
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return map_texts(numbered, run, numbered.schema).toDF(*docs.columns)


def learnt(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: three in four by crc32 of the id."""
    return docs.filter(remainder("doc_id", 4) != 2)


@query("op3_language_id")
def op3_language_id(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    found = detect(docs, train(learnt(docs)))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), F.col("lang").alias("lang_pred"), "score")
