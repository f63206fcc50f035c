"""Packing, alignment and phrases against the contracts in plain Python, and their edges."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from compare import DATA, compare, open_duckdb
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from talkweave.llm import align, packing, phrases, tokens
from talkweave.llm.queries import QUERIES, SQL

BYTES, PIECES = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b"), (5, "x <|endoftext|> y  <|endoftext|>"), (6, "a▁b c"), (7, "  lead"), (8, "tail  "),
    (9, "é ü  x   y 中文 字"), (10, "\x00 \x7f a\tb \r\n c"), (11, "don't we'll  'tis 's"), (12, "🙂 🙂"), (13, "x" * 5000),
    (14, "ab cd, " * 3000), (14, "a  b"), (None, "one two three."), (None, "one two three."), (15, "end.\nNext line\n\n new  . 12,5 A|B"),
    (16, "0123456789 " * 700), (17, "one two three."),
]
SCHEMA = "doc_id bigint, text string, lang string, length int, `Ids` string, start int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(k, t, [None, "en"][i % 2], 1, "x", 2) for i, (k, t) in enumerate(ODD)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table(sf="sf0.001", columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{DATA / sf / 'documents.parquet'}'").fetchall()


# --- packing ------------------------------------------------------------------


def check_pieces(rows, docs, window=2048):
    """Every document's ids once, in order; sequences within the window without gaps."""
    vocabulary = Tokenizer.from_file(BYTES)
    want = Counter((k, tuple(vocabulary.encode(t or "", add_special_tokens=False).ids + [1])) for k, t in docs)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    pad = total = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        pad, total = pad + (0 if at & (at - 1) == 0 else window - at), total + at
    return want, pad / total


def test_packing_contract(spark):
    docs = table()
    rows = QUERIES["op11_packing"](spark, str(DATA / "sf0.001")).collect()
    want, share = check_pieces(rows, docs)
    assert share < 0.02
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert len(by_doc) == len(want)
    for key, ids in want:
        raw, at = np.array(ids, "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)


def test_packing_edges(odd, none):
    done = packing.pack(odd.repartition(3), BYTES, window=64)
    assert done.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    rows = done.collect()
    want, _ = check_pieces(rows, ODD, window=64)
    seen = Counter()
    order = sorted(rows, key=lambda r: (r.sequence_id >> 33, r.sequence_id, r.offset))
    held = b""
    for r in order:
        assert len(r.ids) == 4 * r.length and r.start * 4 == len(held)
        held += r.ids
        if r.start + r.length == r.doc_tokens:
            seen[r.doc_id, tuple(np.frombuffer(held, "<u4").tolist())] += 1
            held = b""
    assert seen == want
    again = packing.pack(odd.repartition(3), BYTES, window=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert packing.pack(none, BYTES).count() == 0


def least_cost(at, penalty, window, each):
    cost = [0.0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        cost[j] = min(cost[i] + float(packing.padding(at[j] - at[i], window)) + penalty[j] + each for i in range(j) if at[j] - at[i] <= window)
    return cost[-1]


def test_cuts_are_the_best():
    rng = random.Random(8)
    for _ in range(200):
        at = np.cumsum([0] + [rng.randrange(1, 9) for _ in range(rng.randrange(1, 40))])
        penalty = np.array([0.0] + [rng.choice([0.0, 2.0, 5.0]) for _ in at[1:]])
        cuts = packing.best_cuts(at, penalty, 16, 0.5)
        assert cuts[0] == 0 and cuts[-1] == at[-1] and set(cuts) <= set(at.tolist())
        spent = sum(float(packing.padding(b - a, 16)) + penalty[at.tolist().index(b)] + 0.5 for a, b in zip(cuts, cuts[1:]))
        assert spent == pytest.approx(least_cost(at.tolist(), penalty, 16, 0.5)) and max(np.diff(cuts)) <= 16


# --- the encoder ----------------------------------------------------------------


@pytest.mark.parametrize("cut", [tokens.safe_cuts, tokens.finer_cuts])
def test_stretches_give_the_ids_of_whole_texts(cut):
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "ß", " ", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "1", "23", "<|endoftext|>", "<", "|", "中", " ", " ", "x", "The", "-", "_", "▁", "🙂", "\x1c"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)] + [t for _, t in ODD if t]
    sides = [(tokens.byte_encoder(BYTES, plain)[0], tokens.byte_level(BYTES, plain)) for plain in (False, True)]
    for encoder, vocabulary in sides:
        counts, coded = tokens.stretches_of(pa.array(texts), cut)
        sizes, ids = encoder.ids(coded)
        ends = np.cumsum(tokens.totals(counts, sizes))
        for text, a, b in zip(texts, np.append(0, ends), ends):
            assert ids[a:b].tolist() == vocabulary.encode(text, add_special_tokens=False).ids, repr(text)
    if cut is tokens.safe_cuts:
        spaced = [" " + t for t in texts if t and "▁" not in t]
        counts, coded = tokens.stretches_of(pa.array(spaced))
        sizes, ids = tokens.piece_encoder(PIECES).ids(coded)
        ends = np.cumsum(tokens.totals(counts, sizes))
        vocabulary = tokens.pieces_at(PIECES)
        for text, a, b in zip(spaced, np.append(0, ends), ends):
            assert ids[a:b].tolist() == vocabulary.encode(text[1:]), repr(text)


# --- alignment -------------------------------------------------------------------


def aligned(docs):
    """Per document (n_a, n_b, n_groups, links, digest), one token at a time."""
    a_side, b_side = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a_side.encode_special_tokens = True
    a_bytes, b_bytes = tokens.byte_entries(a_side), tokens.piece_table(PIECES)
    out = []
    for key, text in docs:
        spans = []
        for ids, entries in ((a_side.encode(" " + (text or ""), add_special_tokens=False).ids, a_bytes), (b_side.encode(text or ""), b_bytes)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(entries[i]), i))
                at += len(entries[i])
            spans.append((side, b"".join(entries[i] for i in ids)))
        (a, spelt_a), (b, spelt_b) = spans
        if not text or not spelt_a == spelt_b == (" " + text).encode():
            out.append((key, 0, 0, 0, [], ""))
            continue
        common = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [([], []) for _ in common]
        for side, found in enumerate((a, b)):
            for _, e, i in found:
                groups[bisect.bisect_left(common, e)][side].append(str(i))
        links, first = [], 0
        for s, e, i in a:
            while b[first][1] <= s:
                first += 1
            j = first
            while j < len(b) and b[j][0] < e:
                links.append((i, b[j][2]))
                j += 1
        shown = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        out.append((key, len(a), len(b), len(groups), links, hashlib.sha256(shown.encode()).hexdigest()))
    counts = Counter(pair for r in out for pair in set(r[4]))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    return [(*r[:4], len(r[4]), sum(counts[p] == best[p[0]] for p in r[4]), sum(counts[p] for p in r[4]), r[5]) for r in out]


def test_alignment_contract(spark):
    got = [tuple(r) for r in QUERIES["op12_alignment"](spark, str(DATA / "sf0.001")).collect()]
    assert sorted(got) == sorted(aligned(table()))


@pytest.mark.parametrize("chunk,frequent", [(40, 5), (200, 0), (1 << 16, 10_000)])
def test_alignment_of_odd_and_long_texts(odd, none, chunk, frequent):
    got = [tuple(r) for r in align.align(odd, BYTES, PIECES, chunk=chunk, fan=3, frequent=frequent).collect()]
    assert sorted(map(str, got)) == sorted(map(str, aligned(ODD)))
    assert align.align(none, BYTES, PIECES).count() == 0


def test_fragments_join_in_any_bracketing():
    reader, rng = align.Reader(BYTES, PIECES), random.Random(2)
    text = " Überraschung naïve tokenization, don't 12345 中文 🙂 antidisestablishmentarianism"
    (a, b), _, fits = reader.read(pa.array([text]))
    size = len(text.encode())

    def made(low, high):
        sides = [s[(s.end > low) & (s.end <= high)] for s in (a, b)]
        return align.fragment(*sides, bool(fits.all()), reader.script)

    one = align.whole(made(0, size), reader.script)
    for _ in range(60):
        cuts = [0, *sorted(rng.sample(range(1, size), rng.randrange(1, 12))), size]
        parts = [align.held(align.hold(made(x, y))) for x, y in zip(cuts, cuts[1:])]
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [align.join(parts[i], parts[i + 1], reader.script)]
        done = align.whole(parts[0], reader.script)
        assert (done.text, done.groups) == (one.text, one.groups)
        assert done.pairs.tolist() == one.pairs.tolist() and done.times.tolist() == one.times.tolist()
    assert one.groups == one.text.count(b";") + 1


# --- phrases ----------------------------------------------------------------------


def mined(docs, least=30, top=2000):
    counts, sizes = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower(text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            counts.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {p: n for p, n in counts.items() if n >= least and len(p[1]) > 1}
    out = defaultdict(list)
    for (lang, words), a in found.items():
        inside = any(
            100 * n >= 80 * a and other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), n in found.items()
        )
        if not inside:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, some in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(rows)


def test_phrases_sql_and_plain_python(spark):
    assert compare("op13_phrases", QUERIES["op13_phrases"], SQL["op13_phrases"], spark, open_duckdb("sf0.001"), "sf0.001") is None
    got = QUERIES["op13_phrases"](spark, str(DATA / "sf0.001")).collect()
    assert sorted(map(tuple, got)) == mined(table(columns="text, lang"))


def phrase_docs():
    rng = random.Random(6)
    words = ["a", "b", "C", "D d", "é", " ", "e\tf", "x" * 300]
    signs = [" ", " ", " ", "  ", ", ", ".", "\n", "\x0b", "\t"]
    docs = [("".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randrange(30))), rng.choice(["en", "und", None, ""])) for _ in range(300)]
    return docs + [(None, "en"), ("", None), (".,;", "xx"), ("big data " * 3000, "en"), ("big data " * 3000, "en")]


@pytest.mark.parametrize("slice_bytes,segment_grams,top", [(500, 200, 7), (4_000_000, 4_000_000, 2000)])
def test_phrases_in_slices_and_segments(spark, slice_bytes, segment_grams, top):
    docs = phrase_docs()
    df = spark.createDataFrame([(i, t, g, 1, "s") for i, (t, g) in enumerate(docs)], "n int, text string, lang string, a int, `Phrase` string")
    got = phrases.collocations(df.repartition(4), least=8, top=top, buckets=3, slice_bytes=slice_bytes, segment_grams=segment_grams)
    assert sorted(map(tuple, got.collect())) == mined(docs, 8, top)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.filter("n < 3"), least=10_000).count() == 0


def test_collisions_are_told_apart(spark, monkeypatch):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "text string, lang string")
    real = phrases.spread
    # all n-grams share 64 fingerprints
    monkeypatch.setattr(phrases, "spread", lambda h: real(h) % np.uint64(64) + (np.uint64(1) << np.uint64(33)))
    got = phrases.collocations(df.repartition(3), least=8, slice_bytes=3_000, segment_grams=500)
    assert sorted(map(tuple, got.collect())) == mined(docs, 8)
